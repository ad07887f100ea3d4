"""Byte-pair encoding by a prefix-sharing trie traversal, and its decoding.

The encoding of a string ends in exactly one token whose merge with the rest
is the one that the ranked merges choose; so the last token of every prefix
describes its whole encoding. Distinct words, sorted, are a trie in
depth-first order: the traversal keeps the last token at each depth and
works only on the bytes that a word does not share with the one before it.

Nulls: a null text counts as empty (0 tokens, the digest of no bytes).
Repeated rows give repeated rows, an empty table an empty result, other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.common import pieces, slim
from memberlens.llm.token_counts import byte_letters

#: The pattern that byte-level pre-tokenizers split with (a fixed value; letters first, which matches alike).
PATTERN = r""" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words and pairs that a Python worker keeps; beyond it the memory starts anew.
KEPT_WORDS = 400_000
KEPT_PAIRS = 400_000


State = tuple[dict, list[tuple[int, int]], bytes]
"""The states after one more byte, the tokens that end here (longest first: bytes, id), and the bytes so far."""


class ByteTrie:
    """Vocabulary of a byte-level tokenizer file, with the states of the traversal."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        value = {c: b for b, c in enumerate(byte_letters())}
        as_bytes = lambda s: bytes(value[c] for c in s)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {as_bytes(t): i for t, i in vocab.items() if t not in special}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.bytes_of.update({i: s.encode() for s, i in special.items()})
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.pattern = regex.compile(PATTERN)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        self.span = max(self.bytes_of) + 1
        self.starts = {t[:k] for t in self.ids for k in range(1, len(t) + 1)}
        self.states: dict[bytes, State] = {}
        self.fits: dict[int, bool] = {}

    def merged(self, symbols: list[int]) -> list[int]:
        """Merge by rank, one pair at a time."""
        none = (len(self.rank), -1)
        while len(symbols) > 1:
            best = min((*self.rank.get(p, none), k) for k, p in enumerate(zip(symbols, symbols[1:])))
            if best[1] < 0:
                break
            symbols[best[2]:best[2] + 2] = [best[1]]
        return symbols

    def compatible(self, pair: int) -> bool:
        """Whether the bytes of two tokens, merged anew, give the same two tokens."""
        if len(self.fits) > KEPT_PAIRS:
            self.fits.clear()
        a, b = divmod(pair, self.span)
        raw = self.bytes_of[a] + self.bytes_of[b]
        known = self.fits[pair] = self.merged([self.ids[raw[k:k + 1]] for k in range(len(raw))]) == [a, b]
        return known

    def state(self, text: bytes) -> State:
        """The state of the longest end of ``text`` that starts some token."""
        while text and text not in self.starts:
            text = text[1:]
        found = self.states.get(text)
        if found is None:
            ends = [(len(text) - k, self.ids[text[k:]]) for k in range(len(text)) if text[k:] in self.ids]
            found = self.states[text] = ({}, ends, text)
        return found

    def encode(self, words: set[bytes]) -> dict[bytes, list[int]]:
        """Ids of every word; the bytes of a shared prefix are visited once."""
        out: dict[bytes, list[int]] = {}
        path, span, fits = b"", self.span, self.fits
        states, last, size = [self.state(b"")], [-1], [0]
        for word in sorted(words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del states[shared + 1:], last[shared + 1:], size[shared + 1:]
            now, depth = states[-1], shared
            for byte in word[shared:]:
                depth += 1
                follow, _, text = now
                now = follow.get(byte)
                if now is None:
                    now = follow[byte] = self.state(text + bytes((byte,)))
                for n, token in now[1]:
                    if n == depth:
                        break
                    pair = last[depth - n] * span + token
                    known = fits.get(pair)
                    if self.compatible(pair) if known is None else known:
                        break
                states.append(now)
                last.append(token)
                size.append(n)
            path, ids, at = word, [], depth
            while at:
                ids.append(last[at])
                at -= size[at]
            ids.reverse()
            out[word] = ids
        return out


@lru_cache(maxsize=2)
def byte_trie(path: str) -> ByteTrie:
    return ByteTrie(path)


class Coded:
    """Words that a Python worker has encoded, as one flat array of ids."""

    def __init__(self, trie: ByteTrie):
        self.trie = trie
        size = max(trie.bytes_of) + 1
        names = [f"{i}," for i in range(size)]
        self.digits = np.zeros((size, len(names[-1])), np.uint8)
        for i, name in enumerate(names):
            self.digits[i, :len(name)] = np.frombuffer(name.encode(), np.uint8)
        raw = [trie.bytes_of.get(i, b"") for i in range(size)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.at = np.zeros(1 << 16, np.int64)
        self.add([(s, [i]) for s, i in self.trie.special.items()])

    def add(self, words: list[tuple[str, list[int]]]) -> None:
        old = len(self.index)
        size = np.cumsum([len(ids) for _, ids in words]) + self.at[old]
        flat = np.fromiter(chain.from_iterable(ids for _, ids in words), np.int32)
        self.ids = _room(self.ids, self.at[old] + len(flat))
        self.at = _room(self.at, old + len(words) + 1)
        self.ids[self.at[old]:self.at[old] + len(flat)] = flat
        self.at[old + 1:old + 1 + len(words)] = size
        self.index.update(zip((w for w, _ in words), range(old, old + len(words))))


def _room(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    out = np.zeros(max(n, 2 * len(array)), array.dtype)
    out[:len(array)] = array
    return out


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indexes start .. start + size of every slice, one after another."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - end + size, size)


_KEPT: dict[str, Coded] = {}


def encode_texts(texts: list[str | None], path: str, kept_words: int | None = None) -> list[tuple[np.ndarray, bytes, bytes]]:
    """For each text its ids, the ids joined by commas, and the UTF-8 text decoded from them."""
    trie = byte_trie(path)
    coded = _KEPT.get(path)
    if coded is None:
        coded = _KEPT[path] = Coded(trie)
    elif len(coded.index) > (KEPT_WORDS if kept_words is None else kept_words):
        coded.clear()
    split = []
    for text in texts:
        parts = trie.cut.split(text) if text and trie.cut else [text or ""]
        tokens: list[str] = []
        for part in parts:
            tokens += [part] if part in trie.special else trie.pattern.findall(part)
        split.append(tokens)
    new = set().union(*split).difference(coded.index)
    if new:
        ids = trie.encode({t.encode() for t in new})
        coded.add([(t, ids[t.encode()]) for t in new])
    word = np.fromiter(map(coded.index.__getitem__, chain.from_iterable(split)), np.int64)
    size = coded.at[word + 1] - coded.at[word]
    ids = coded.ids[ragged(coded.at[word], size)]
    words_at = np.concatenate([[0], np.cumsum([len(t) for t in split])])
    ids_at = np.concatenate([[0], np.cumsum(size)])[words_at]
    digits = coded.digits[ids]
    solid = digits > 0
    digits_at = np.concatenate([[0], np.cumsum(solid.sum(1))])[ids_at]
    joined = digits[solid].tobytes()
    raw_size = coded.raw_at[ids + 1] - coded.raw_at[ids]
    raw_at = np.concatenate([[0], np.cumsum(raw_size)])[ids_at]
    raw = coded.raw[ragged(coded.raw_at[ids], raw_size)].tobytes()
    return [(ids[ids_at[k]:ids_at[k + 1]], joined[digits_at[k]:max(digits_at[k + 1] - 1, digits_at[k])],
             raw[raw_at[k]:raw_at[k + 1]].decode("utf-8", "replace").encode()) for k in range(len(texts))]


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids: bool = False,
                     kept_words: int | None = None) -> DataFrame:
    """Every row with its encoding: ``n_tokens, ids_sha256, decoded_sha256`` and, if asked, ``ids`` and ``decoded``.

    All columns of ``docs`` stay (a clashing column of the input is replaced);
    a map without a shuffle. ``kept_words`` bounds the words that a Python
    worker remembers (results are the same; fewer take more time).
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if ids else [])
    kinds = ["long", "string", "string", "array<int>", "string"]
    keep = [c for c in docs.columns if c not in added]
    inner = {c: f"c{k}" for k, c in enumerate(keep)}
    if text_col not in inner:
        raise ValueError(f"no column {text_col}")
    schema = ", ".join([f"{inner[c]} {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + [f"x{k} {kind}" for k, kind in enumerate(kinds[:len(added)])])
    text = inner[text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            coded = encode_texts(batch.column(text).to_pylist(), path, kept_words)
            more = [pa.array([len(c[0]) for c in coded], pa.int64()),
                    pa.array([hashlib.sha256(c[1]).hexdigest() for c in coded]),
                    pa.array([hashlib.sha256(c[2]).hexdigest() for c in coded])]
            if ids:
                more += [pa.array([c[0] for c in coded], pa.list_(pa.int32())),
                         pa.array([c[2].decode() for c in coded])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more],
                                             [*batch.schema.names, *(f"x{k}" for k in range(len(more)))])

    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    return rows.mapInArrow(slim(run), schema).select(
        *[F.col(n).alias(c) for c, n in inner.items()], *[F.col(f"x{k}").alias(c) for k, c in enumerate(added)])
