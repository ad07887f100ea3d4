"""Reading the shop's tables.

On a cluster the seven shop tables live in a catalog (``spark.table``) or
as parquet folders; locally the driver-generated parquet is mapped onto the
same schemas by :mod:`memberlens.sources.fixtures`. Either way the
operators only ever see DataFrames with the column names of section 1.2 of
the survey, so Catalyst can prune columns and push filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHOP_TABLES = ("t_member", "t_order", "t_order_commodity", "t_coupon",
               "t_coupon_member", "t_delivery", "t_feedback")


def read_parquet_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table stored as ``{root}/{name}.parquet`` (a file or a folder)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_parquet_stream(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The same table as a stream of its files, read where they lie (``_metadata`` is there)."""
    path = f"{root.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = spark.readStream.schema(schema)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return stream.parquet(path)
    # A stream follows a folder; the pattern leaves the other tables out.
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(root)


def catalog_tables(spark: SparkSession, database: str = "ecommerce") -> dict[str, DataFrame]:
    """The shop tables from a metastore database, as on the original cluster."""
    return {name: spark.table(f"{database}.{name}") for name in SHOP_TABLES}
