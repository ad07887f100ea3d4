"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch are held as one flat array of symbol ids
with offsets. Every round finds the lowest-rank adjacent pair of each
sequence and merges it in all sequences at once; sequences without a ranked
pair leave the array. The symbols that survive are the tokens.

Nulls: a null or empty text has 0 bytes and 0 tokens. Repeated rows give
repeated rows, an empty table an empty result, other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.common import pieces, utf8_bytes

WORD_END = "</w>"
#: Words whose counts a Python worker keeps; beyond it the memory starts anew.
KEPT_WORDS = 300_000


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class MergeTable:
    """Vocabulary and ranked merges of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + WORD_END] for c in letters], np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]

    def counts(self, tokens: list[str]) -> np.ndarray:
        """The number of symbols that are left of each pre-token."""
        raw = [t.encode() for t in tokens]
        size = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(size) - 1
        symbols[ends] = self.final[flat[ends]]
        out = size.copy()
        owner = np.repeat(np.arange(len(raw)), size)
        none = len(self.keys)
        while len(symbols) > 1:
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), none - 1)
            ranked = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            if not ranked.any():
                break
            rank = np.where(ranked, self.ranks[at], none)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(np.concatenate([rank, [none]]), first)
            each = np.repeat(least, np.diff(np.concatenate([first, [len(symbols)]])))
            hit = (rank == each[:-1]) & ranked
            left = np.flatnonzero(hit)
            # In a run such as a a a, every second hit starts inside the one before.
            run = np.concatenate([[True], left[1:] != left[:-1] + 1])
            start = np.maximum.accumulate(np.where(run, np.arange(len(left)), 0))
            left = left[(np.arange(len(left)) - start) % 2 == 0]
            symbols[left] = self.made[at[left]]
            keep = np.ones(len(symbols), bool)
            keep[left + 1] = False
            np.subtract.at(out, owner[left], 1)
            keep &= each < none  # a sequence without a ranked pair is done
            symbols, owner = symbols[keep], owner[keep]
        return out

    def split(self, text: str) -> tuple[int, list[str]]:
        """The number of special strings in a text, and its normalised pre-tokens."""
        parts, found = [text], 0
        for special in self.specials:
            if special in text:
                cut = [p.split(special) for p in parts]
                found += sum(len(c) - 1 for c in cut)
                parts = [x for c in cut for x in c]
        tokens: list[str] = []
        for part in parts:
            # Lower-casing goes letter by letter: no final sigma.
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            tokens += self.pattern.findall(part)
        return found, tokens


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


_KEPT: dict[str, dict[str, int]] = {}


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text; new pre-tokens of all of them are merged together."""
    table = merge_table(path)
    kept = _KEPT.setdefault(path, {})
    if len(kept) > KEPT_WORDS:
        kept.clear()
    split = [table.split(t) if t else (0, []) for t in texts]
    new = set().union(*(s[1] for s in split)).difference(kept) if split else set()
    if new:
        ordered = list(new)
        kept.update(zip(ordered, table.counts(ordered).tolist()))
    return [found + sum(map(kept.__getitem__, tokens)) for found, tokens in split]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; a map without a shuffle.

    ``path`` is the tokenizer file as the executors see it.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "t"):
            counts = count_texts(batch.column("t").to_pylist(), path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), batch.column("b"), pa.array(counts, pa.int64())], ["i", "b", "n"])

    rows = docs.select(F.col(id_col).alias("i"), utf8_bytes(F.col(text_col)).alias("b"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return (rows.mapInArrow(run, f"i {kind.simpleString()}, b long, n long")
            .select(F.col("i").alias(id_col), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"),
                    (F.col("n") > limit).alias("over_limit")))
