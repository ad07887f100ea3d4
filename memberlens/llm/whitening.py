"""Embedding whitening over distinct vectors with weights.

Each entry c becomes the whole number ``floor(scale * c) + shift``. Equal
vectors are one class, found by a grouping that Spark pre-aggregates; a class
has its number of rows as weight, or one (the default: the fit list is the
distinct vectors). The weighted sums are exact whole numbers, so the mean S / n
is, and what is multiplied is the exact n * x - S, divided by n: centred before
multiplying, whatever the shift. Each batch of classes adds its products up in
one matrix product, Spark adds the matrices cell by cell, and the driver gets
one dim x dim matrix, whose size does not depend on the rows. Each class is
whitened once; rows get the values of their class by a join on its digest.
Classes with over 1 / ``HOT`` of all rows, of which there are fewer than
``HOT``, are broadcast, so no task holds the rows of a hot vector.

Nulls and odd rows: a vector that is null or holds a null, a non-finite entry
or one whose whole number is 2 ** 53 or more is left out. Vectors of different
lengths are separate tables with a fit of their own; an empty vector has no
component and gives no row. Rows with equal or null ids each give their rows.
A component without variance (relative to the largest eigenvalue, below what
double precision can tell from zero) has no whitened form and is left out, so
a table of one distinct vector gives no rows, like an empty table.
``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberlens.llm.common import checkpointed

HOT = 200
LARGEST = 1 << 53


def whole_entries(vec: Column, scale: int, shift: int) -> Column:
    """The vector's whole numbers, null where the row takes no part."""
    fits = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(LARGEST // (2 * max(scale, 1)))))
    return F.when(fits, F.transform(vec, lambda c: F.floor(c * scale).cast("long") + shift))


def _matrix(batch: pa.RecordBatch, dim: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and entries of a batch's vectors of one length."""
    at = np.flatnonzero(size == dim)
    flat = batch.column("x").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    return at, flat.reshape(len(at), dim)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    size = np.diff(batch.column("x").offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
    for dim in np.unique(size):
        if dim:
            yield int(dim), *_matrix(batch, int(dim), size)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length: the weights and the weighted sum of each dimension, as whole numbers of any size."""
    n: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        weight = batch.column("weight").to_numpy(zero_copy_only=False)
        for dim, at, x in _by_length(batch):
            n[dim] = n.get(dim, 0) + int(weight[at].sum())
            # Halves of the bits, so that the sums of a batch stay whole in 64 bits.
            low, high = x & 0x3FFFFFF, x >> 26
            part = ((high * weight[at, None]).sum(axis=0).astype(object) << 26) + (low * weight[at, None]).sum(axis=0)
            sums[dim] = sums.get(dim, 0) + part
    rows = [(d, k, n[d], Decimal(int(s))) for d in n for k, s in enumerate(sums[d])]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)))],
        ["dim", "i", "n", "s"])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where that is sure to hold it, Python's whole numbers otherwise."""
    s = np.array(sums, object)
    if len(x) and n * int(np.abs(x).max()) < 1 << 62 and max(abs(v) for v in sums) < 1 << 62:
        return n * x - s.astype(np.int64)
    return n * x.astype(object) - s


def _products(fits: dict[int, tuple[int, list[int]]], to: dict[int, np.ndarray] | None = None):
    """By length: the weighted products of the centred vectors, or of their projections on the columns of ``to``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = batch.column("weight").to_numpy(zero_copy_only=False)
            for dim, at, x in _by_length(batch):
                n, sums = fits[dim]
                c = _centred(x, n, sums).astype(np.float64) / n
                if to is not None:
                    c = c @ to[dim]
                total[dim] = total.get(dim, 0) + (c * weight[at, None]).T @ c
        cells = [(d, i, j, float(v)) for d, m in total.items() for i, row in enumerate(m) for j, v in enumerate(row)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in cells], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.float64()))],
            ["dim", "i", "j", "v"])
    return run


def _covariances(classes: DataFrame, fits: dict, to: dict | None = None) -> dict[int, np.ndarray]:
    """The covariance matrix of each length; the partitions' matrices are added by Spark."""
    cells = (classes.select("x", "weight").mapInArrow(_products(fits, to), "dim int, i int, j int, v double")
             .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect())
    made: dict[int, np.ndarray] = {}
    for d in {r["dim"] for r in cells}:
        width = 1 + max(r["i"] for r in cells if r["dim"] == d)
        made[d] = np.zeros((width, width))
    for r in cells:
        made[r["dim"]][r["i"], r["j"]] = r["v"] / fits[r["dim"]][0]
    return made


def _directions(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first eigenvalues, falling, and their unit eigenvectors as columns, each with its largest entry positive."""
    e, u = np.linalg.eigh((v + v.T) / 2)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    some = e > max(e[0], 0.0) * len(v) * np.finfo(float).eps
    e, u = e[some], u[:, some]
    return e, u * np.where(u[np.abs(u).argmax(axis=0), np.arange(len(e))] < 0, -1.0, 1.0)


def _whitened(fits: dict, to: dict[int, np.ndarray]):
    """Of each class its exact deviation and its whitened components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_length(batch):
                if not to[dim].shape[1]:
                    continue
                n, sums = fits[dim]
                c = _centred(x, n, sums)
                if c.dtype == object or dim * int(np.abs(c).max()) ** 2 >= 1 << 63:
                    c = c.astype(object)
                squares = (c * c).sum(axis=1)
                deviation = [int(s) if s < 1 << 63 else None for s in squares]
                white = (c.astype(np.float64) / n) @ to[dim]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)),
                     pa.array(deviation, pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))],
                    ["key", "dim", "deviation", "white"])
    return run


def whiten(rows: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, weighted: bool = False,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component.

    ``n`` is the sum of the fit weights: the number of distinct vectors, or
    with ``weighted`` that of rows.
    """
    spark = rows.sparkSession
    x = whole_entries(F.col(vec_col).cast("array<double>"), scale, shift)
    entries = rows.select(F.col(id_col).alias("id"), x.alias("x")).where("x is not null").select(
        "id", "x", F.md5(F.concat_ws(",", "x")).alias("key"))
    # The checkpoint is read by every later step: sums, products, whitening and the last check.
    classes = checkpointed(entries.groupBy("key").agg(F.first("x").alias("x"), F.count("*").alias("copies"))
                           .withColumn("weight", F.col("copies") if weighted else F.lit(1).cast("long")))
    sums = (classes.select("x", "weight").mapInArrow(_sums, "dim int, i int, n long, s decimal(38,0)")
            .groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    fits: dict[int, tuple[int, list[int]]] = {}
    for d in {r["dim"] for r in sums}:
        own = sorted((r["i"], r["n"], int(r["s"])) for r in sums if r["dim"] == d)
        fits[d] = (own[0][1], [s for _, _, s in own])
    found = {d: (v, *_directions(v, components)) for d, v in _covariances(classes, fits).items()}
    to = {d: u / np.sqrt(e) for d, (_, e, u) in found.items()}
    checked = _covariances(classes, fits, {d: t for d, t in to.items()}) if to else {}
    figures = [(d, k + 1, fits[d][0], float(e[k] / np.trace(v)), float(np.abs(checked[d] - np.eye(len(e))).max()))
               for d, (v, e, _) in found.items() for k in range(len(e))]
    white = checkpointed(classes.select("key", "x").mapInArrow(
        _whitened(fits, to), "key string, dim int, deviation long, white array<double>"))
    total = classes.agg(F.sum("copies")).first()[0] or 0
    hot = classes.where(F.col("copies") * HOT > F.lit(total).cast("long")).where("copies > 1").select("key")
    ids = entries.select("id", "key")
    common = F.broadcast(white.join(F.broadcast(hot), "key"))
    placed = (ids.join(common, "key").unionByName(
        ids.join(F.broadcast(hot), "key", "left_anti").join(white.join(F.broadcast(hot), "key", "left_anti"), "key")))
    figures_df = spark.createDataFrame(figures, "d int, component int, n long, explained double, identity_error double")
    return (placed.select("id", "dim", "deviation", F.posexplode("white").alias("at", "whitened"))
            .join(F.broadcast(figures_df), (F.col("dim") == F.col("d")) & (F.col("at") + 1 == F.col("component")))
            .select(F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"))
