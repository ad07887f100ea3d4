"""Text sources: search logs, one line per row in a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_log(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """Lines of a text file or folder (``value`` column); splits across tasks by file block."""
    reader = spark.read
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)
