"""Batch sinks: the tag document table and the segment export.

The shop appended its tag documents to a search index with no document id,
so every rerun duplicated them. Here the document table is written with
``mode('overwrite')`` keyed by the run, so reruns replace it; any
``DataFrameWriter`` format works (parquet by default, JSON for a document
store's bulk loader, or a connector's format name with its options).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_documents(tags: DataFrame, path: str | None = None, fmt: str = "parquet",
                    table: str | None = None, options: dict[str, str] | None = None,
                    partition_by: tuple[str, ...] = ()) -> None:
    """Write the tag table as documents (one row per member), replacing the previous run."""
    w = tags.write.mode("overwrite").format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("give path or table")


def write_export(lines: DataFrame, path: str) -> None:
    """Export lines (``line`` column) as text with CRLF line ends, one file per task."""
    lines.select("line").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def console(df: DataFrame, n: int = 20) -> None:
    """Print sink for batch results (the original jobs printed their results)."""
    df.show(n, truncate=False)
