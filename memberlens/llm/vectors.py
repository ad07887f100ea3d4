"""Embedding near-duplicates by random-hyperplane sign hashing.

Vectors of one label and dimension meet where all sign bits of one table
agree; the cosine of every such pair is then computed in double precision.
Buckets beyond ``BLOCK`` rows are dealt out as pairs of blocks, so no bucket
is gathered by one task, and what leaves a task are link counts and links to
the smallest id of a local component, never the pairs.

A pair is counted in the first table in which it meets. The number of bits
follows the number of vectors, the number of tables from the bits and the
recall asked for at the very threshold (closer pairs are found more often).

Equal vectors of a label are one class, which is linked within. Null, zero or
non-finite vectors and null labels link with nothing. Rows with equal ids are
separate vectors, linked only if they are near. A vector with a null id links
like any other but never names a component: ``component_id`` is null, and
``kept`` true, only where no vector of its component has an id. Vectors are
scaled by their largest entry first, so no norm overflows. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.common import checkpointed, components, runs

BLOCK = 1024
SEED = 7


def table_plan(n: int, min_cosine: float, recall: float) -> tuple[int, int]:
    """Bits per table and number of tables for ``n`` vectors."""
    bits = min(24, max(5, math.ceil(math.log2(max(n, 1) / 512 + 1))))
    same = (1 - math.acos(min_cosine) / math.pi) ** bits
    return bits, max(2, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def _codes(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The sign code of each vector in each table; planes depend on seed and dimension only."""
    planes = np.random.Generator(np.random.PCG64(SEED)).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs @ (1 << np.arange(bits))).astype(np.int32)


def _hashed(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vec")
            size = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                part = batch.take(pa.array(rows))
                x = part.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                code = _codes(x, bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"),
                     pa.array([v.tobytes() for v in x], pa.binary()),
                     pa.array(code.tolist(), pa.list_(pa.int32()))], ["id", "label", "raw", "codes"])
    return run


def _linked(min_cosine: float):
    """Links of one pair of blocks: for every row its counted links and its local component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "deal"):
            t = int(group.column("t")[0].as_py())
            b1, b2 = int(group.column("b1")[0].as_py()), int(group.column("b2")[0].as_py())
            mine = group.column("mine").to_numpy()
            ids, mult = group.column("id").to_numpy(), group.column("copies").to_numpy()
            x = np.frombuffer(b"".join(group.column("raw").to_pylist()), np.float64).reshape(len(ids), -1)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            codes = np.array(group.column("codes").to_pylist(), np.int32)
            left = np.flatnonzero(mine == b1)
            right = left if b1 == b2 else np.flatnonzero(mine == b2)
            near = x[left] @ x[right].T >= min_cosine
            if b1 == b2:
                np.fill_diagonal(near, False)
            a, b = np.nonzero(near)
            a, b = left[a], right[b]
            if not len(a):
                continue
            counted = ~(codes[a, :t] == codes[b, :t]).any(axis=1)
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, a[counted], mult[b[counted]])
            if b1 != b2:
                np.add.at(links, b[counted], mult[a[counted]])
            root = ids.copy()
            while True:  # the smallest id spreads over the links
                new = root.copy()
                np.minimum.at(new, a, root[b])
                np.minimum.at(new, b, root[a])
                if (new == root).all():
                    break
                root = new
            some = (links > 0) | (root != ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(links[some]), pa.array(root[some])], ["id", "links", "root"])
    return run


def near_vectors(rows: DataFrame, min_cosine: float = 0.93, recall: float = 0.995, id_col: str = "vec_id",
                 vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                       F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    takes_part = (F.col("label").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0))
    valid = base.where(takes_part)
    # The number of a class is written with it, so it stays the same if a task runs again.
    keys = valid.select("id", "label", "vec", F.xxhash64("label", "vec").alias("same"))
    classes = checkpointed(keys.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
                           .withColumn("id", F.monotonically_increasing_id()))
    n = classes.count()
    bits, tables = table_plan(n, min_cosine, recall)
    coded = (classes.select("id", "label", "vec").mapInArrow(
        _hashed(bits, tables), "id long, label string, raw binary, codes array<int>")
        .join(classes.select("id", "copies"), "id"))
    met = coded.select("id", "label", "raw", "codes", "copies", F.posexplode("codes").alias("t", "code")).withColumn(
        "bucket", F.xxhash64("label", F.length("raw"), "t", "code"))
    sizes = (met.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
             .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    dealt = (met.join(sizes, "bucket")
             .withColumn("mine", F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", "raw", "codes", "copies", "t", "mine", F.least("mine", "other").alias("b1"),
                     F.greatest("mine", "other").alias("b2"), "bucket")
             .withColumn("deal", F.xxhash64("bucket", "b1", "b2")))
    found = checkpointed(dealt.repartition("deal").sortWithinPartitions("deal")
                         .mapInArrow(_linked(min_cosine), "id long, links long, root long"))
    roots = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    placed = (classes.join(links, "id", "left").join(roots, F.col("id") == F.col("node"), "left")
              .withColumn("root", F.coalesce("root", "id")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classed = (placed.drop("component_id").join(least, "root")
               .select(F.xxhash64("label", "vec").alias("same"), F.col("label").alias("l"), F.col("vec").alias("w"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    linked = (keys.join(classed, (keys["same"] == classed["same"]) & (keys["label"] == classed["l"])
                        & (keys["vec"] == classed["w"])).select("id", "n_links", "component_id"))
    alone = base.where(~F.coalesce(takes_part, F.lit(False)))
    out = linked.unionByName(alone.select("id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
