"""Snapshot, then log: a chunked snapshot reconciled with the changes made while it was read.

A table is read in chunks, one key range each, while its change log goes on.
Around the read of a chunk the log's position is noted: the low mark before,
the high mark after it. What the chunk saw of a change between the marks is not
known, so those changes win over the chunk's rows:

* a chunk with its changes up to the high mark is the state of its key range at
  the high mark; these rows are the snapshot's ``read`` records;
* of the log, changes beyond the high mark of the chunk that has their key come
  after them; earlier ones are in the reads already.

So every change is delivered once, in the reads or after them, in whatever
order chunks and changes interleave, and each chunk has marks of its own: no
lock, and no pause of the log. The log may be batch or stream for the second
part (:func:`log_after_snapshot`), which is a stateless filter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlens.functions.intervals import interval_numbers

#: One row per chunk; keys as text, ``low_key`` inclusive, ``high_key`` exclusive, NULL for an open end.
MARKS_SCHEMA = ("database string, table string, chunk long, low_key string, high_key string, "
                "low_mark long, high_mark long")


def _ordered(key: Column, numeric: bool) -> Column:
    """A key as text in the key's order; numbers are shifted and padded."""
    if not numeric:
        return key
    shifted = key.try_cast("bigint").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    return F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0")


def _place(database: Column, table: Column, ordered: Column) -> Column:
    return F.concat(database, F.lit("\x01"), table, F.lit("\x01"), ordered)


class _Chunks:
    """Finds the chunk of a key: the last chunk that starts at or before it, if it is not past that chunk's end."""

    def __init__(self, marks: DataFrame, numeric: bool):
        self.numeric = numeric
        start = _place(F.col("database"), F.col("table"),
                       F.coalesce(_ordered(F.col("low_key"), numeric), F.lit("")))
        marks = marks.withColumn("_start", start)
        self.number = interval_numbers(marks.select(F.col("_start").alias("cut")))
        self.marks = self.number(marks, F.col("_start"), "_number").select(
            "_number", F.col("database").alias("_db"), F.col("table").alias("_tbl"), F.col("chunk").alias("_chunk"),
            _ordered(F.col("high_key"), numeric).alias("_end"), F.col("low_mark").alias("_low"),
            F.col("high_mark").alias("_high"))

    def of(self, changes: DataFrame, key: str) -> DataFrame:
        """``changes`` with ``_chunk, _low, _high``, NULL where no chunk has the key."""
        ordered = _ordered(F.try_element_at(F.col("data"), F.lit(key)), self.numeric)
        placed = self.number(changes.withColumn("_ordered", ordered),
                             _place(F.col("database"), F.col("table"), F.col("_ordered")), "_at")
        inside = ((F.col("_at") == F.col("_number")) & (F.col("database") == F.col("_db"))
                  & (F.col("table") == F.col("_tbl")) & (F.col("_end").isNull() | (F.col("_ordered") < F.col("_end"))))
        return placed.join(self.marks, inside, "left").drop("_at", "_number", "_db", "_tbl", "_end", "_ordered")


def snapshot_reads(rows: DataFrame, marks: DataFrame, log: DataFrame, key: str = "id",
                   numeric: bool = True) -> DataFrame:
    """The snapshot's records: ``operation, data, database, table, timestamp, position``.

    ``rows`` is what the chunks read (``database, table, chunk, data``), ``log``
    an envelope with the log's ``position``, as far as the largest high mark. A
    record's position is the high mark of its chunk; its timestamp that of the
    change it shows, NULL if it is as the chunk read it. Rows and changes
    without the key are left out.
    """
    return _reads(rows, marks, _Chunks(marks, numeric).of(log, key), key)


def _reads(rows: DataFrame, marks: DataFrame, placed: DataFrame, key: str) -> DataFrame:
    inside = (placed.where("position > _low and position <= _high")
              .withColumn("_key", F.try_element_at(F.col("data"), F.lit(key))).where("_key is not null")
              .groupBy("database", "table", "_chunk", "_high", "_key")
              .agg(F.max_by(F.struct("operation", "data", "timestamp"), "position").alias("c")))
    high = marks.select("database", "table", F.col("chunk").alias("_chunk"), F.col("high_mark").alias("_high"))
    read = (rows.select("database", "table", F.col("chunk").alias("_chunk"), F.col("data").alias("_seen"),
                        F.try_element_at(F.col("data"), F.lit(key)).alias("_key"))
            .where("_key is not null").join(high, ["database", "table", "_chunk"]))
    both = read.join(inside, ["database", "table", "_chunk", "_high", "_key"], "full")
    changed = F.col("c").isNotNull()
    return both.where(~changed | (F.col("c.operation") != "delete")).select(
        F.lit("read").alias("operation"), F.when(changed, F.col("c.data")).otherwise(F.col("_seen")).alias("data"),
        "database", "table", F.col("c.timestamp").alias("timestamp"), F.col("_high").alias("position"))


def _after(placed: DataFrame) -> DataFrame:
    return placed.where("_high is null or position > _high").drop("_chunk", "_low", "_high")


def log_after_snapshot(log: DataFrame, marks: DataFrame, key: str = "id", numeric: bool = True) -> DataFrame:
    """The changes that the snapshot does not show; batch or stream.

    Changes of keys that no chunk has (another table, a gap between the ranges,
    no key at all) all pass.
    """
    return _after(_Chunks(marks, numeric).of(log, key))


def snapshot_then_log(rows: DataFrame, marks: DataFrame, log: DataFrame, key: str = "id",
                      numeric: bool = True) -> DataFrame:
    """The reads and the changes after them as one change log."""
    placed = _Chunks(marks, numeric).of(log, key)
    reads = _reads(rows, marks, placed, key)
    return reads.unionByName(_after(placed).select(*reads.columns))


def state_at_end(log: DataFrame, key: str = "id") -> DataFrame:
    """``database, table, key, data`` after the last change of each key in log order; deleted keys are gone."""
    return (log.withColumn("_key", F.try_element_at(F.col("data"), F.lit(key))).where("_key is not null")
            .groupBy("database", "table", F.col("_key").alias(key))
            .agg(F.max_by(F.struct("operation", "data"), "position").alias("c"))
            .where("c.operation <> 'delete'").select("database", "table", key, "c.data"))


def key_ranges(table: DataFrame, key: str, chunk_rows: int = 10_000_000) -> list[tuple[str | None, str | None]]:
    """Ranges of a whole-number key with about ``chunk_rows`` rows each; the first and last are open."""
    n = table.count()
    parts = max(1, -(-n // chunk_rows))
    inner = table.select(F.col(key).cast("double").alias("k")).approxQuantile(
        "k", [p / parts for p in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds: list[str | None] = [None, *[str(int(b)) for b in sorted(set(inner))], None]
    return list(zip(bounds[:-1], bounds[1:]))


def take_snapshot(spark: SparkSession, read_range: Callable[[str | None, str | None], DataFrame],
                  position: Callable[[], int], ranges: list[tuple[str | None, str | None]], path: str,
                  database: str, table: str) -> DataFrame:
    """Read a table chunk by chunk into ``{path}/rows`` and note the marks in ``{path}/marks``.

    ``read_range(low, high)`` reads the rows of one key range from the source,
    ``position()`` the source's log position. Chunks that are complete are not
    read again, so a run that was stopped goes on where it was; a chunk that was
    not complete is read again with new marks. Returns the marks.
    """
    held = lambda kind: f"{path}/{kind}"
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for chunk, (low, high) in enumerate(ranges):
        if fs.exists(fs_path(f"{held('marks')}/chunk={chunk}/_SUCCESS")):
            continue
        before = position()
        data = read_range(low, high)
        image = F.map_from_arrays(F.array(*[F.lit(c) for c in data.columns]),
                                  F.array(*[F.col(f"`{c}`").cast("string") for c in data.columns]))
        (data.select(F.lit(database).alias("database"), F.lit(table).alias("table"), image.alias("data"))
         .write.mode("overwrite").parquet(f"{held('rows')}/chunk={chunk}"))
        mark = [(database, table, low, high, before, position())]
        (spark.createDataFrame(mark, "database string, table string, low_key string, high_key string, "
                                     "low_mark long, high_mark long")
         .coalesce(1).write.mode("overwrite").parquet(f"{held('marks')}/chunk={chunk}"))
    return read_marks(spark, path)


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MARKS_SCHEMA).parquet(f"{path}/marks")


def read_snapshot_rows(spark: SparkSession, path: str) -> DataFrame:
    """What the chunks read: ``database, table, chunk, data``."""
    return spark.read.schema("database string, table string, chunk long, data map<string,string>").parquet(f"{path}/rows")
