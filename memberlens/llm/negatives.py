"""Hard-negative mining by a secondary-sort shuffle.

Scores are whole inner products of floor(scale * x). Rows and anchors are
dealt to tiles (a block of rows, a block of anchors), and each tile multiplies
its block matrices. Two passes over the tiles give the candidates:

* the first keeps, of each anchor, the tile's best ``positives`` rows of its
  label; the best of all tiles are the anchor's positives;
* the second keeps, for the window that each positive opens, the tile's best
  ``negatives`` rows of another label in it. What a tile leaves out is behind
  as many better rows of that tile, so it is behind them in the whole as well.

Both are packed into sortable byte keys (anchor, descending score, kind, id).
``repartitionAndSortWithinPartitions`` brings an anchor's rows to one task in
that order, and an iterator goes over them once: a positive opens its window, a
negative goes to the open windows that it falls into and that are not full. The
iterator holds the open windows of one anchor, never its rows.

Rows with a null label, a null vector, or a null or non-finite component take
no part. Vectors of different lengths have no inner product and never meet.
Every row counts by itself: rows with equal ids, even equal rows, are other
rows to each other, and an anchor id that several rows have gives the results
of each. A null id is no anchor and comes last among ties; its positives and
negatives are returned with a null id. Components and scores beyond a long are
held at its limits. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.common import checkpointed, partitions, runs

ROWS_IN_TILE = 4096
ANCHORS_IN_TILE = 16384
AT_ONCE = 256
LIMIT = (1 << 63) - 1

#: anchor id, its row number, descending score, kind (positives first), no id, id, row number
KEY = ">QQQBBQQ"
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    """The vectors of a tile, which all have one length."""
    flat = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1) if table.num_rows else flat.reshape(0, 0)


def _scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where these hold every partial sum, otherwise in Python's whole numbers."""
    size = x.shape[1]
    if not size:
        return np.zeros((len(a), len(x)))
    if size * float(np.abs(a).max()) * float(np.abs(x).max()) < 2.0**52:
        return a.astype(np.float64) @ x.T.astype(np.float64)
    exact = a.astype(object) @ x.T.astype(object)
    return np.clip(exact, -LIMIT, LIMIT)


def _first(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each anchor the columns of its best ``k`` allowed scores; columns come in the order that breaks ties."""
    if scores.dtype == object:
        for r in range(len(scores)):
            yield r, np.array(sorted(np.flatnonzero(allowed[r]), key=lambda c: (-scores[r, c], c))[:k], int)
        return
    held = np.where(allowed, scores, -np.inf)
    width = held.shape[1]
    bar = np.partition(held, width - k, axis=1)[:, width - k] if width > k else np.full(len(held), -np.inf)
    good = (held >= bar[:, None]) & allowed
    for r in np.flatnonzero(good.any(axis=1)):
        at = np.flatnonzero(good[r])
        yield int(r), at[np.lexsort((at, -held[r, at]))][:k]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.Table]]:
    """The anchors and rows of each tile; rows in the order of their ids, null ids last."""
    for tile in runs(batches, "tile"):
        asks = tile.column("asks").to_numpy(zero_copy_only=False)
        anchors, rows = tile.filter(pa.array(asks)), tile.filter(pa.array(~asks))
        if anchors.num_rows and rows.num_rows:
            yield anchors, rows.sort_by([("id", "ascending"), ("uid", "ascending")])


def _candidates(k: int, low: int | None = None):
    """The tile's best ``k`` rows of each anchor's label, or with ``low`` of each of its windows' other labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, rows in _tiles(batches):
            x, label = _numbers(rows, "x"), rows.column("label").to_numpy()
            uid = rows.column("uid").to_numpy()
            for start in range(0, anchors.num_rows, AT_ONCE):
                part = anchors.slice(start, AT_ONCE)
                scores = _scores(_numbers(part, "x"), x)
                same = part.column("label").to_numpy()[:, None] == label[None, :]
                own = part.column("uid").to_numpy()
                found: list[tuple[int, int]] = []
                if low is None:
                    for r, at in _first(scores, same & (own[:, None] != uid[None, :]), k):
                        found += [(r, c) for c in at]
                else:
                    windows = [w or [] for w in part.column("windows").to_pylist()]
                    for t in range(max(map(len, windows), default=0)):
                        top = [w[t] if t < len(w) else None for w in windows]
                        live = np.array([w is not None for w in top])
                        hi = np.array([w or 0 for w in top], object)[:, None]
                        lo = np.array([-(-low * (w or 0) // 100) for w in top], object)[:, None]
                        if scores.dtype != object:
                            lo, hi = lo.astype(np.float64), hi.astype(np.float64)
                        inside = (scores >= lo) & (scores <= hi)
                        for r, at in _first(scores, ~same & live[:, None] & inside.astype(bool), k):
                            found += [(r, c) for c in at]
                    found = sorted(set(found))
                if not found:
                    continue
                r, c = (np.array(v, np.int64) for v in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").combine_chunks().take(pa.array(r)), pa.array(own[r]),
                     pa.array([int(s) for s in scores[r, c]], pa.int64()),
                     rows.column("id").combine_chunks().take(pa.array(c)), pa.array(uid[c])],
                    ["anchor", "anchor_uid", "score", "other", "other_uid"])
    return run


FOUND = "anchor long, anchor_uid long, score long, other long, other_uid long"


def _packed(kind: int):
    """Candidates as sortable keys: unsigned, so that the bytes sort as the numbers do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up = 1 << 63
        for batch in batches:
            keys = [struct.pack(KEY, a + up, u, up - s, kind, o is None, (o or 0) + up, v)
                    for a, u, s, o, v in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["key"])
    return run


def _mined(k: int, low: int):
    """Over keys in order: each positive opens a window, each negative goes to the open windows that have room."""
    def run(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        up, now = 1 << 63, None
        windows: list[list] = []  # positive, its score, negatives given so far
        for key, _ in keys:
            a, u, s, kind, none, o, _ = struct.unpack(KEY, key)
            score, other = up - s, None if none else o - up
            if (a, u) != now:
                now, windows = (a, u), []
            if not kind:
                windows.append([other, score, 0])
                continue
            for w in windows:
                if w[2] < k and low * w[1] <= 100 * score <= 100 * w[1]:
                    w[2] += 1
                    yield a - up, w[0], w[2], other, w[1], score
    return run


def _spread(key: bytes) -> int:
    """The anchor's part of a key as a number."""
    return int.from_bytes(key[:16], "big") * 0x9E3779B97F4A7C15 >> 32


def _tiled(rows: DataFrame, anchors: DataFrame, n: int, n_anchors: int, many: int) -> DataFrame:
    """Rows and anchors dealt to tiles of one vector length: each row once a block of anchors, and the other way round."""
    down, across = max(1, math.ceil(n / ROWS_IN_TILE)), max(1, math.ceil(n_anchors / ANCHORS_IN_TILE))
    block = lambda parts: F.pmod(F.xxhash64("uid"), F.lit(parts))
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    right = (rows.withColumn("row_block", block(down)).withColumn("anchor_block", every(across))
             .withColumn("asks", F.lit(False)).withColumn("windows", F.lit(None).cast("array<long>")))
    left = (anchors.withColumn("anchor_block", block(across)).withColumn("row_block", every(down))
            .withColumn("asks", F.lit(True)))
    tile = F.xxhash64(F.size("x"), "row_block", "anchor_block")
    columns = [tile.alias("tile"), "asks", "id", "uid", "label", "x", "windows"]
    return (left.select(*columns).unionByName(right.select(*columns))
            .repartition(many, "tile").sortWithinPartitions("tile"))


def mine_negatives(rows: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80,
                   scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``anchor_every`` divides. A negative's score
    is at most its positive's and at least ``low`` % of it.
    """
    spark = rows.sparkSession
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = float((1 << 63) - 1024)
    base = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("label").isNotNull() & finite)
            .select("id", "label", F.transform("vec", lambda c: F.greatest(F.least(
                F.floor(F.greatest(F.least(c * scale, F.lit(held)), F.lit(-held))), F.lit(LIMIT)),
                F.lit(-LIMIT))).alias("x")))
    # Written, so that the numbers of the rows stay the same if a task runs again.
    base = checkpointed(base.withColumn("uid", F.monotonically_increasing_id()))
    anchors = base.where(F.col("id") % anchor_every == 0)
    n, n_anchors = base.count(), anchors.count()
    many = partitions(rows)
    plain = anchors.withColumn("windows", F.lit(None).cast("array<long>"))
    near = _tiled(base, plain, n, n_anchors, many).mapInArrow(_candidates(positives), FOUND)
    best = near.withColumn("place", F.expr(
        "row_number() over (partition by anchor_uid order by score desc, other asc nulls last, other_uid)"))
    best = checkpointed(best.where(F.col("place") <= positives).drop("place"))
    opened = anchors.join(best.groupBy(F.col("anchor_uid").alias("uid")).agg(  # at most ``positives`` scores each
        F.collect_set("score").alias("windows")), "uid")
    far = _tiled(base, opened, n, n_anchors, many).mapInArrow(_candidates(negatives, low), FOUND)
    keys = (best.mapInArrow(_packed(0), "key binary").unionByName(far.mapInArrow(_packed(1), "key binary"))
            .rdd.map(lambda r: (bytes(r[0]), None)))
    mined = (keys.repartitionAndSortWithinPartitions(many, _spread)
             .mapPartitions(_mined(negatives, low)))
    return spark.createDataFrame(mined, OUT)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", **options) -> DataFrame:
    """``mine_negatives`` after the label of every row whose id 7 divides became the next of ten."""
    changed = F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
    return mine_negatives(rows.withColumn(label_col, changed), id_col=id_col, label_col=label_col, **options)
