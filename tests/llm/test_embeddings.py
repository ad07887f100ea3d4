"""Hard-negative mining and whitening against plain versions that look at every pair and every row."""

import math

import numpy as np
import pytest

from memberlens.llm import negatives, whitening
from memberlens.llm.common import ship
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def sortable(rows):
    return sorted(tuple((x is None, x) for x in r) for r in rows)


def mined(rows, every=100, positives=5, count=5, low=80, scale=256):
    """The definition, row by row, in whole numbers."""
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, [math.floor(scale * float(c)) for c in v], label))
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for k, (a, x, label) in enumerate(kept):
        if a is None or a % every:
            continue
        score = lambda y: sum(p * q for p, q in zip(x, y))
        others = [(score(y), i, other) for j, (i, y, other) in enumerate(kept) if j != k and len(y) == len(x)]
        others.sort(key=lambda o: order(o[0], o[1]))
        for ps, p, _ in [o for o in others if o[2] == label][:positives]:
            hard = [o for o in others if o[2] != label and low * ps <= 100 * o[0] <= 100 * ps][:count]
            out += [(a, p, r + 1, o[1], ps, o[0]) for r, o in enumerate(hard)]
    return out


def flipped(rows):
    return [(i, v, (label + 1) % 10 if label is not None and i is not None and i % 7 == 0 else label)
            for i, v, label in rows]


def test_mining_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = negatives.hard_negatives(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(flipped(rows))
    assert want and sorted(map(tuple, got.collect())) == sorted(want)


def close_rows(seed, n, label_count=3):
    """Few directions, so that scores tie, and many negatives in every window."""
    rng = np.random.default_rng(seed)
    base = rng.integers(-3, 4, (12, 6)) / 8 + 0.5
    return [(int(i), (base[rng.integers(12)] + rng.integers(-1, 2, 6) / 64).astype(float).tolist(),
             int(rng.integers(label_count))) for i in range(n)]


def test_mining_ties_over_many_tiles(spark, monkeypatch):
    """Windows with hundreds of tied rows, over several blocks of rows and of anchors."""
    monkeypatch.setattr(negatives, "ROWS_IN_TILE", 90)
    monkeypatch.setattr(negatives, "ANCHORS_IN_TILE", 7)
    rows = close_rows(3, 700)
    got = negatives.mine_negatives(spark.createDataFrame(rows, SCHEMA), anchor_every=25)
    want = mined(rows, every=25)
    assert len(want) > 400 and sorted(map(tuple, got.collect())) == sorted(want)


def test_mining_awkward_rows(spark):
    """Nulls, non-finite and huge components, repeated ids and rows, other lengths, no positive, and a hot label."""
    rows = close_rows(5, 80, 2)
    v = rows[0][1]
    rows += [(None, v, 0), (None, rows[1][1], 1), (100, v, 0), (100, v, 0), (100, rows[3][1], 1), (200, None, 1),
             (201, [0.1, None, 0.3, 0.1, 0.1, 0.1], 1), (202, [float("nan")] * 6, 0), (300, [float("inf")] + [0.0] * 5, 0),
             (400, v, None), (500, v[:3], 0), (501, v[:3], 0), (502, v[1:4], 1), (600, v, 9), (700, [], 0), (701, [], 0),
             (702, [], 1), (800, [0.0] * 6, 0), (900, [-c for c in v], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "uid", "x", "tile", "score", "anchor", "windows", "key", "asks", "vec", "place"):
        df = df.selectExpr("*", f"'clash' as {name}")
    assert sortable(negatives.mine_negatives(df).collect()) == sortable(mined(rows))
    assert negatives.mine_negatives(spark.createDataFrame([], SCHEMA)).collect() == []


def test_mining_large_scores(spark):
    """Products beyond what doubles hold stay whole numbers; those beyond a long are held at its limits."""
    rows = [(100, [2.0**18, 1.0, 3.0], 0), (1, [2.0**18, 5.0, 1.0], 0), (2, [2.0**18, 5.0, 0.99], 1),
            (3, [2.0**18, 4.996, 1.0], 1), (4, [2.0**18 - 1, 7.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.mine_negatives(df).collect())) == sorted(mined(rows))
    huge = spark.createDataFrame([(100, [1e200], 0), (1, [1e300], 0), (2, [1e100], 1)],
                                 "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in negatives.mine_negatives(huge).collect()] == [
        (100, 1, 1, 2, negatives.LIMIT, negatives.LIMIT)]


def entries(rows, scale=64, shift=1_000_000):
    return [(i, tuple(math.floor(scale * float(c)) + shift for c in v)) for i, v, _ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def check_whitened(rows, got, weighted=False):
    """Everything but the sign of a component against numpy on the whole table at once."""
    kept = entries(rows)
    for dim in {len(x) for _, x in kept}:
        own = [(i, x) for i, x in kept if len(x) == dim]
        fit = [x for _, x in own] if weighted else sorted({x for _, x in own})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
        cov = centred.T @ centred / n
        mine = [r for r in got if r["n"] == n and r["vec_id"] in {i for i, _ in own}]
        e, u = np.linalg.eigh(cov)
        e, u = e[::-1], u[:, ::-1]
        k = min(16, dim, int((e > e[0] * 1e-12).sum()))
        assert len(mine) == k * len(own)
        assert {r["n"] for r in mine} == {n} and max(r["identity_error"] for r in mine) <= 1e-4
        by_id = {i: x for i, x in own}
        for r in mine:
            x = by_id[r["vec_id"]]
            assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x, sums))
            assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(cov), rel=1e-8)
        sign = {}
        for r in mine:
            j = r["component"] - 1
            want = np.array([(n * c - s) / n for c, s in zip(by_id[r["vec_id"]], sums)]) @ u[:, j] / math.sqrt(e[j])
            if abs(want) > 1e-3:
                sign.setdefault(j, math.copysign(1, want) * math.copysign(1, r["whitened"]))
            assert r["whitened"] == pytest.approx(sign.get(j, 1) * want, abs=1e-6)


def test_whitening_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = whitening.whiten(df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened([(r["vec_id"], r["embedding"], 0) for r in df.collect()], got.collect())


@pytest.mark.parametrize("weighted", [False, True])
def test_whitening_copies_and_odd_rows(spark, weighted):
    """A vector that a third of the rows hold, others twice, other lengths, nulls, non-finite and huge entries."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=20) * np.linspace(1, 3, 20)).tolist(), 0) for i in range(120)]
    rows += [(1000 + i, rows[7][1], None) for i in range(60)] + [(2000 + i, rows[i][1], 0) for i in range(9)]
    rows += [(3000, None, 0), (3001, [None] + [0.0] * 19, 0), (3002, [float("nan")] * 20, 0), (3003, [], 0),
             (3004, [float("-inf")] * 20, 0)]
    rows += [(4000 + i, rng.normal(size=3).tolist(), 0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "x", "key", "copies", "weight", "d", "component", "n", "dim"):
        df = df.selectExpr("*", f"'clash' as {name}")
    got = whitening.whiten(df, weighted=weighted).collect()
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], la) for i, v, la in rows]
    check_whitened([r for r in rows if r[1] != []], got, weighted)


def test_whitening_degenerate(spark):
    """No rows, one distinct vector, a dimension that never varies, null and equal ids, entries without a whole number."""
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], SCHEMA)).collect() == []
    rows = [(1, [0.0, 5.0], 0), (1, [1.0, 5.0], 0), (None, [2.0, 5.0], 0), (4, [1e30, 0.0], 0)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, round(r["whitened"], 9), r["component"]) for r in got) == [
        (False, 1, -1.224744871, 1), (False, 1, 0.0, 1), (True, 0, 1.224744871, 1)]
    assert all(r["explained"] == pytest.approx(1) and r["n"] == 3 for r in got)
    wide = [(k, [float(k) * 2.0**36, 0.0], 0) for k in range(4)]
    got = whitening.whiten(spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int")).collect()
    assert [r["deviation"] for r in got] == [None] * 4 and max(r["identity_error"] for r in got) < 1e-4
