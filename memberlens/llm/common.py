"""Spark helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()
#: Rows of an Arrow batch, where the session has Spark's own 10,000: texts are long, and a task holds a batch twice.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``spark-submit --py-files`` does."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if sc.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{home.name}.zip"  # read by the driver, which serves it
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(home.rglob("*.py")):
            z.write(path, path.relative_to(home.parent))
    sc.addPyFile(str(to))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    One of our own is made only where the setting is missing and the master is
    local, as in tests; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared is None:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(df: DataFrame) -> int:
    """The session's shuffle partition count, which grows with the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def slim(task: Callable) -> Callable:
    """A map over batches that gives the memory it held back when a partition ends, not when its idle worker does."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return run


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of equal ``key`` in a partition sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """Connected components: ``node, root`` for every node of an edge, ``root`` the smallest reachable id.

    Alternates the large-star and small-star steps until the edges stop
    changing. A node's neighbours are only ever minimised over, so no group is
    collected; the joins on a node are plain equi joins that AQE can split.
    Null ends and self loops are ignored; an empty input gives an empty result.
    """
    a, b = F.col(u), F.col(v)
    now = checkpointed(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                       .where(a.isNotNull() & b.isNotNull() & (a != b)).distinct())
    mark = _mark(now)
    for _ in range(max_rounds):
        ends = now.select(F.col("lo").alias("n"), F.col("hi").alias("m")).unionByName(
            now.select(F.col("hi").alias("n"), F.col("lo").alias("m")))
        least = ends.groupBy("n").agg(F.min("m").alias("m")).select("n", F.least("n", "m").alias("least"))
        large = (now.join(least, now["lo"] == least["n"])
                 .select(F.col("least").alias("lo"), "hi").where("lo <> hi").distinct())
        small = large.groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("least"))
        new = (large.join(small, large["hi"] == small["n"])
               .select(F.explode(F.array(F.struct(F.col("least").alias("lo"), F.col("lo").alias("hi")),
                                         F.struct(F.col("least").alias("lo"), F.col("hi")))).alias("e"))
               .select("e.lo", "e.hi").where("lo <> hi").distinct())
        now = checkpointed(new)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not converge")
    return (now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            .unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges: one row to the driver."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")),
                           F.bit_xor(F.xxhash64("hi", "lo"))).first())


def utf8_bytes(text: Column) -> Column:
    """Length of a text in UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
