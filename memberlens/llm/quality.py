"""Quality by a sparse rule ensemble over text statistics.

Statistics of a text are counted over its bytes in one pass. Shallow trees
on them give conjunctive rules (the path to every node); a lasso-penalised
logistic regression keeps few of the rules, and those become one Spark
column expression over the statistics.

Bounds of the fit: ``FIT_ROWS`` labelled rows, ``TREES`` trees of depth
``DEPTH``.

Nulls: a null text counts as empty and gets a score like any other; null
labels are not learned from. Where all labels are alike every score is the
base rate. Repeated rows give repeated rows, an empty table an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberlens.llm.arrays import text_bytes, words
from memberlens.llm.common import checkpointed, pieces
from memberlens.llm.sampling import labelled, remainder, sigmoid

FIT_ROWS = 12_000
TREES = 24
DEPTH = 3
STATS = ("log_words", "word_length", "upper", "digit", "symbol", "exclaim", "bar", "stop", "comma", "other_sign",
         "doubled", "distinct", "top_word", "lines", "marked_words")

_CLASS = np.zeros(256, np.int8)
_CLASS[65:91] = 1
_CLASS[48:58] = 2
for _k, _signs in ((3, b"#$%&*@^~=+<>{}[]\\_/"), (4, b"!"), (5, b"|"), (6, b".?"), (7, b",;:"), (8, b"\"'()-`"), (9, b"\n"),
                   (10, b" \t\x0b\x0c\r")):
    _CLASS[list(_signs)] = _k


def text_stats(column: pa.Array) -> np.ndarray:
    """The statistics ``STATS`` of each text; shares are of its bytes or words."""
    data, at = text_bytes(column)
    n = len(at) - 1
    size = np.diff(at)
    kind = _CLASS[data]
    doc = np.repeat(np.arange(n), size)
    count = np.bincount(doc * 11 + kind, minlength=n * 11).reshape(n, 11)
    hashes, w = words(data, at)
    many = np.diff(w)
    owner = np.repeat(np.arange(n), many)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    starts = np.flatnonzero(first)
    runs = np.diff(np.concatenate([starts, [len(hashes)]]))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner[order][starts], runs)
    sign = (kind >= 3) & (kind <= 5)
    ends = np.zeros(len(data), bool)
    ends[:-1] = sign[:-1] & ((kind[1:] == 10) | (kind[1:] == 9))
    b, c = np.maximum(size, 1), np.maximum(many, 1)
    marked = np.bincount(doc, ends, n)
    distinct = np.bincount(owner[order][starts], minlength=n)
    return np.column_stack([
        np.log1p(many), size / c, count[:, 1] / b, count[:, 2] / b, count[:, 3] / b, count[:, 4] / b, count[:, 5] / b,
        count[:, 6] / c, count[:, 7] / c, count[:, 8] / c, np.bincount(owner, same, n) / c, distinct / c, top / c,
        count[:, 9] / c, marked / c]).astype(float)


def with_stats(rows: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and the statistics of every row; a map without a shuffle."""
    inner = [f"c{k}" for k in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "t"):
            stats = text_stats(batch.column("t"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in inner), *(pa.array(stats[:, k]) for k in range(len(STATS)))],
                [*inner, *STATS])

    schema = ", ".join([f"{n} {rows.schema[c].dataType.simpleString()}" for c, n in zip(keep, inner)]
                       + [f"{s} double" for s in STATS])
    made = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner)], F.col(text_col).alias("t"))
    return made.mapInArrow(run, schema).select(*[F.col(n).alias(c) for c, n in zip(keep, inner)], *STATS)


Rule = tuple[tuple[int, float, bool], ...]
"""Conditions (statistic, limit, whether it is at most the limit)."""


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    """Which rows meet every condition of a rule."""
    return np.logical_and.reduce([(x[:, s] <= cut) == below for s, cut, below in rule])


def grow(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, path: Rule, rules: set[Rule]) -> None:
    """Collect the path to every node of a regression tree on a random part of the statistics."""
    if len(path) >= DEPTH or len(x) < 20 or target.var() < 1e-9:
        return
    best = (1e-9, -1, 0.0)
    for s in rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False):
        cuts = np.unique(np.quantile(x[:, s], np.linspace(0.02, 0.98, 33)))
        below = x[:, s][:, None] <= cuts[None, :]
        left = below.sum(0)
        total = (below * target[:, None]).sum(0)
        ok = (left >= 5) & (len(x) - left >= 5)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = total**2 / left + (target.sum() - total) ** 2 / (len(x) - left) - target.sum() ** 2 / len(x)
        gain = np.where(ok, gain, -1.0)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), int(s), float(cuts[k]))
    _, s, cut = best
    if s < 0:
        return
    for below in (True, False):
        rule = (*path, (s, cut, below))
        rules.add(rule)
        part = (x[:, s] <= cut) == below
        grow(x[part], target[part], rng, rule, rules)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 500) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression by accelerated proximal steps."""
    w, v = np.zeros(z.shape[1] + 1), np.zeros(z.shape[1] + 1)
    full = np.column_stack([np.ones(len(z)), z])
    lipschitz = 0.25 * np.linalg.norm(full, 2) ** 2 / len(y)
    t = 1.0
    for _ in range(steps):
        new = v - full.T @ (sigmoid(full @ v) - y) / len(y) / lipschitz
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - penalty / lipschitz, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v = new + (before - 1) / t * (new - w)
        w = new
    return float(w[0]), w[1:]


class RuleModel(NamedTuple):
    """An intercept and weighted conjunctive rules."""

    base: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The score as one column expression over the statistics."""
        terms = [F.when(reduce(lambda a, b: a & b, [F.col(STATS[s]) <= F.lit(cut) if below else F.col(STATS[s]) > F.lit(cut)
                                                    for s, cut, below in rule]), F.lit(weight)).otherwise(F.lit(0.0))
                 for rule, weight in self.rules]
        total = reduce(lambda a, b: a + b, terms, F.lit(self.base))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def learn_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, penalty: float = 2e-3, seed: int = 11) -> RuleModel:
    """Rules from boosted shallow trees on random halves of the rows, then lasso weights."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        return RuleModel(float(np.log(p / (1 - p))), [])
    rng = np.random.Generator(np.random.PCG64(seed))
    rules: set[Rule] = set()
    guess = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(trees):
        part = rng.random(len(y)) < 0.5
        if part.sum() < 20:
            part[:] = True
        own: set[Rule] = set()
        residual = y - sigmoid(guess)
        grow(x[part], residual[part], rng, (), own)
        rules |= own
        for rule in sorted(own, key=len)[-(2**DEPTH):]:
            if len(rule) == max(map(len, own)):
                at = holds(rule, x)
                if at.any():
                    guess[at] += 2.0 * residual[at].mean()
    ordered = sorted(rules)
    if not ordered:
        return learn_rules(x[:0], y[:0])
    z = np.column_stack([holds(r, x) for r in ordered]).astype(float)
    base, weights = lasso(z, y, penalty)
    kept = [(r, float(w)) for r, w in zip(ordered, weights) if abs(w) > 1e-3]
    return RuleModel(base, kept)


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", mod: int = 5, held: int = 0,
          fit_rows: int = FIT_ROWS) -> RuleModel:
    """The rule model from labelled rows that are not held out."""
    train = with_stats(labelled(docs, labels, label_col, mod, held, fit_rows), ["id", "label"])
    rows = checkpointed(train).collect()  # at most fit_rows rows of statistics
    rows.sort(key=lambda r: r["id"])
    x = np.array([[r[s] for s in STATS] for r in rows], float).reshape(-1, len(STATS))
    return learn_rules(x, np.array([r["label"] for r in rows], float))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, mod: int = 5, held: int = 0,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = learn(docs, labels, "quality", mod, held)
    scored = with_stats(docs, [id_col], text_col).select(id_col, model.column().alias("score"))
    return scored.select(id_col, (remainder(F.col(id_col), mod) == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
