"""Numpy helpers that treat a batch of texts as one byte array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
FACTORS = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the rolling base (or of its inverse) modulo 2**64; kept up to 4 MB."""
    name = "inverse" if inverse else "base"
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, 1), BASE_INVERSE if inverse else BASE, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= 4 << 20:
            _POWERS[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty), one after another, and the n + 1 offsets."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any slice follows (see ``slice_hash``)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=out[1:])
    return out


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes [start, end), the same wherever they stand."""
    value = (sums[end] - sums[start]) * powers(len(sums), True)[start]
    return mix(value + (end - start).astype(np.uint64) * FACTORS[0])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (run of bytes other than ASCII white space) and the word offsets of the texts."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    if lower:
        data = LOWER[data]
    solid = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | first[1:])) + 1
    return slice_hash(rolling(data), start, end), np.searchsorted(start, offsets)


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingle hashes of each text, ascending in each, and the offsets of the texts.

    A text of fewer words is one shingle of them all; one without words has none.
    """
    data, offsets = text_bytes(column)
    hashes, at = words(data, offsets)
    count = np.diff(at)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), made)
    first = np.concatenate([[0], np.cumsum(made)])
    index = np.arange(first[-1]) - first[doc] + at[doc]
    value = np.zeros(len(index), np.uint64)
    for j in range(n):
        there = index + j < at[doc + 1]
        value += np.where(there, hashes[np.minimum(index + j, max(len(hashes) - 1, 0))], np.uint64(0)) * FACTORS[j + 1] \
            if len(hashes) else value
    value = mix(value)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[keep], doc[keep]
    return value, np.searchsorted(doc, np.arange(len(count) + 1))
