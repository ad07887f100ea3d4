"""Document fingerprints by locally consistent parsing.

A text is parsed into a hierarchy of phrases. On every level runs of one
symbol become a phrase; between them deterministic coin tossing labels each
symbol by the lowest bit in which it differs from the one before, twice more
until labels are below 6, and phrases begin at local maxima of the labels.
Where a phrase begins thus depends on a few symbols around it only, so equal
substrings get equal phrases inside, wherever they stand. A phrase is named
by a hash of its symbols, and names are the symbols of the next level.

The fingerprint is the ``KEPT`` smallest scrambled names of phrases of
``FROM_LEVEL`` or more levels (of a shorter text, of its highest levels), as
hexadecimal digits; the likeness of two is the share of names they have in
common.

Nulls: a null text counts as empty; its fingerprint is empty, and two empty
ones are alike (1). An only document is its own next. Rows with equal ids
follow each other by text. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.arrays import BYTE_VALUES, FACTORS, mix, text_bytes
from memberlens.llm.common import partitions

KEPT = 64
FROM_LEVEL = 2
MAX_LEVELS = 40
LEVEL_FACTOR = int(FACTORS[40])


def _lowest_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """2 * (lowest bit in which a and b differ) + that bit of a; a differs from b."""
    both = a ^ b
    low = both & (~both + np.uint64(1))
    bit = np.frexp(low.astype(np.float64))[1].astype(np.uint64) - np.uint64(1)
    return np.uint64(2) * bit + ((a >> bit) & np.uint64(1))


def _table(size: int) -> np.ndarray:
    a, b = np.meshgrid(np.arange(size, dtype=np.uint64), np.arange(size, dtype=np.uint64), indexing="ij")
    out = np.zeros((size, size), np.uint8)
    apart = a != b
    out[apart] = _lowest_difference(a[apart], b[apart])
    return out.ravel()


_SECOND, _THIRD = _table(128), _table(16)


def phrase_starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin. ``first`` marks the beginning of every text; no phrase crosses it."""
    n = len(symbols)
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[0] = 0
    edge = first.copy()
    repeat = (symbols == before) & ~edge
    # A run and its neighbours: where a run begins and where it ends, a phrase does.
    starts = edge.copy()
    starts[:-1] |= repeat[1:] & ~repeat[:-1]
    starts[1:] |= repeat[:-1] & ~repeat[1:]
    loose = ~repeat & ~edge
    label = np.zeros(n, np.uint8)
    label[loose] = _lowest_difference(symbols[loose], before[loose]).astype(np.uint8)
    for step, table in ((128, _SECOND), (16, _THIRD)):
        after = np.zeros(n, np.uint8)
        index = label[1:].astype(np.int32) * step + label[:-1]
        after[1:] = table[index]
        after[~loose] = 0  # nothing comes in from the text before
        label = after
    left, right = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    left[1:], right[:-1] = label[:-1], label[1:]
    starts |= loose & (label > left) & (label >= right)
    return starts


def next_level(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases, and which of them begin a text."""
    at = np.flatnonzero(phrase_starts(symbols, first))
    size = np.diff(np.concatenate([at, [len(symbols)]]))
    place = np.arange(len(symbols)) - np.repeat(at, size)
    # Odd factors of the place keep the order of the symbols in the name.
    factor = FACTORS[place & 31] * (2 * place.astype(np.uint64) + np.uint64(1))
    return mix(np.add.reduceat(symbols * factor, at) + size.astype(np.uint64)), first[at]


def fingerprints(column: pa.Array) -> list[str]:
    """The fingerprint of each text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    solid = np.flatnonzero(np.diff(offsets))
    if not len(solid):
        return [""] * n
    first = np.zeros(len(data), bool)
    first[offsets[solid]] = True
    symbols = mix(BYTE_VALUES[data])
    doc = np.repeat(np.arange(n), np.diff(offsets))[first.nonzero()[0]]  # texts that have a symbol
    names, owners, levels = [], [], []
    for level in range(1, MAX_LEVELS + 1):
        symbols, first = next_level(symbols, first)
        owner = doc[np.cumsum(first) - 1]
        names.append(mix(symbols + np.uint64(level * LEVEL_FACTOR % 2**64)))
        owners.append(owner)
        levels.append(np.full(len(symbols), level, np.int8))
        many = np.bincount(owner, minlength=n)
        alive = many[owner] > 1  # a text of one phrase is parsed
        if not alive.any():
            break
        symbols, first = symbols[alive], first[alive]
        doc = np.unique(owner[alive])
    name, owner, level = np.concatenate(names), np.concatenate(owners), np.concatenate(levels)
    top = np.zeros(n, np.int8)
    np.maximum.at(top, owner, level)
    use = level >= np.minimum(FROM_LEVEL, np.maximum(top - 1, 1))[owner]
    name, owner = name[use], owner[use]
    order = np.lexsort((name, owner))
    name, owner = name[order], owner[order]
    keep = np.ones(len(name), bool)
    keep[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    name, owner = name[keep], owner[keep]
    start = np.searchsorted(owner, np.arange(n + 1))
    packed = (name >> np.uint64(32)).astype(">u4")
    return [packed[a:min(b, a + KEPT)].tobytes().hex() for a, b in zip(start, start[1:])]


def likeness(a: str, b: str) -> float:
    """Share of names in common, from 0 to 1: of the smallest names of both together, those that both have, counted
    against the mean size of the two sets (2 J / (1 + J))."""
    x = {a[k:k + 8] for k in range(0, len(a), 8)}
    y = {b[k:k + 8] for k in range(0, len(b), 8)}
    if not x or not y:
        return float(x == y)
    both = sorted(x | y)[:KEPT]
    hit = sum(1 for k in both if k in x and k in y) / len(both)
    return 2 * hit / (1 + hit)


def edited(text: str, after: str) -> str:
    """The last half of the code points replaced by as many first ones of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in order; the first row of the next partition stands at its end, marked."""
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        changed = [edited(t, rows[k + 1][1]) for k, (_, t, _) in enumerate(rows[:-1])]
        own = fingerprints(pa.array([r[1] for r in rows], pa.large_string()))
        other = fingerprints(pa.array(changed, pa.large_string()))
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows[:-1]], pa.int64()), pa.array([len(r[1]) for r in rows[:-1]], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]), pa.array(own[:-1]), pa.array(other),
            pa.array([likeness(a, b) for a, b in zip(own, other)]),
            pa.array([likeness(a, b) for a, b in zip(own, own[1:])])],
            ["i", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    held: list[tuple] = []
    size = 0
    deal = None
    for batch in batches:
        for b, i, t, g in zip(*(batch.column(c).to_pylist() for c in ("b", "i", "t", "guest"))):
            if b != deal:  # what a hash has put together are separate stretches
                if len(held) > 1:
                    yield flush(held)
                held, size, deal = [], 0, b
            held.append((i, t, g))
            size += len(t)
            if size > 1 << 20 and len(held) > 1:
                yield flush(held)
                held, size = held[-1:], len(t)
    if len(held) > 1:
        yield flush(held)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, in ascending order of ids.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Texts are shuffled once, by ranges of ids whose
    bounds come from the ids alone; the first text of a range is also sent to
    the range before it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    many = partitions(docs) * 2
    cuts = docs.select(F.col(id_col).cast("double").alias("x")).approxQuantile(
        "x", [k / many for k in range(1, many)], 0.2 / many) if many > 1 else []
    bounds = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    order = F.coalesce(F.col("i"), F.lit(-(1 << 63)))  # a null id comes first
    split = rows.withColumn("b", F.size(F.filter(bounds, lambda c: c <= order)))
    present = [r["b"] for r in split.select("b").distinct().collect()]  # at most one row per range
    present.sort()
    ahead = {b: present[k - 1] for k, b in enumerate(present)}
    # The first rows of each range: least id, then least text; found without the texts where ids differ.
    least = split.groupBy("b").agg(F.min(order).alias("least"))
    firsts = (split.join(F.broadcast(least), "b").where(order == F.col("least"))
              .groupBy("b").agg(F.min(F.struct("t", "i")).alias("f")).select("b", "f.i", "f.t"))
    pairs = [x for b, to in ahead.items() for x in (F.lit(b), F.lit(to))]
    guests = (firsts.select(F.element_at(F.create_map(*pairs), F.col("b")).alias("b"), "i", "t",
                            F.lit(True).alias("guest")) if pairs else None)
    dealt = split.select("b", "i", "t", F.lit(False).alias("guest"))
    dealt = dealt.unionByName(guests) if guests is not None else dealt
    made = (dealt.repartition(max(len(present), 1), "b")
            .sortWithinPartitions("b", "guest", F.col("i").asc_nulls_first(), "t")
            .mapInArrow(_fingerprinted, "i long, n_chars long, edited_sha256 string, fingerprint string, "
                        "edited_fingerprint string, near_edited double, near_next double"))
    return made.withColumnRenamed("i", id_col)
