"""Toxicity by a weighted lexicon that an Aho-Corasick automaton matches.

Texts are folded first: case, loose accents, letters that look like Latin ones, and
digits and signs that stand for letters. The lexicon (words and word starts)
and its weights are learned from labelled rows; exception phrases take the
weight of the entry inside them back. The sum of the weights, and the sum
against the length of the text, give the score.

Bound of the fit: ``FIT_ROWS`` labelled rows.

Nulls: a null or empty text has no match and the score of one without any. Labels that are null are not learned
from; without positive labels the lexicon is empty and every score the base
rate. Repeated rows give repeated rows, an empty table an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.common import checkpointed, pieces, slim
from memberlens.llm.sampling import labelled, logistic, remainder, sigmoid

FIT_ROWS = 20_000
STEMS = (4, 5, 6, 7)
STEM_WORDS = 8
MIN_WEIGHT = 2.0
MIN_SHARE = 0.02
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish")
# Letters that look like Latin ones, and digits that stand for letters.
LOOKALIKES = {"а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
              "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i",
              "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
              "ɡ": "g"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}

_DIGITS = str.maketrans(DIGITS)
_OTHER = str.maketrans({**LOOKALIKES, **DIGITS, **{chr(c): None for c in range(0x300, 0x370)},
                        **dict.fromkeys("­​‌‍⁠﻿")})
_SIGN = re.compile(r"(?<=\w)[@$](?=\w)")
_GAP = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Folded words with one blank around each; a blank for an empty text."""
    if not text:
        return " "
    text = text.lower()
    if "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: "a" if m.group() == "@" else "s", text)
    text = text.translate(_DIGITS) if text.isascii() else unicodedata.normalize("NFKC", text).translate(_OTHER)
    return f" {_GAP.sub(' ', text).strip()} " if text else " "


class Lexicon(NamedTuple):
    """Patterns with weights (a blank marks a word's end), exception phrases, and the weights of the score."""

    weights: dict[str, float]
    exceptions: dict[str, float]
    model: list[float]


def automaton(weights: dict[str, float]) -> ahocorasick.Automaton | None:
    """The matcher of all patterns; none for an empty lexicon."""
    if not weights:
        return None
    found = ahocorasick.Automaton()
    for pattern, weight in weights.items():
        found.add_word(pattern, weight)
    found.make_automaton()
    return found


def features(folded: list[str], weights: dict[str, float]) -> np.ndarray:
    """For each folded text the matched weight, and the matched weight per thousand words, both as logarithms."""
    match = automaton(weights)
    total = np.array([sum(w for _, w in match.iter(t)) if match else 0.0 for t in folded], float)
    words = np.array([t.count(" ") - 1 for t in folded], float)
    total = np.maximum(total, 0.0)
    return np.column_stack([np.log1p(total), np.log1p(1000 * total / (np.maximum(words, 0) + 20))])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, next word) of toxic texts, and how many other texts have an entry, of each piece."""
    for batch in pieces(batches, "text"):
        pairs: set[tuple[str, str]] = set()
        other: Counter[str] = Counter()
        toxic: Counter[str] = Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            words = fold(text).split()
            entries = [(w, n) for w, n in zip(words, words[1:] + [""])]
            entries += [(f"{w[:k]}*", w) for w in set(words) for k in STEMS if len(w) > k]
            (toxic if label else other).update({e for e, _ in entries})
            if label:
                pairs.update(entries)
        rows = [(e, n, 0, 0) for e, n in pairs] + [(e, None, toxic[e], other[e]) for e in toxic.keys() | other.keys()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))] if rows else
            [pa.array([], t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64())],
            ["entry", "next", "toxic", "other"])


def choose(entries: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Patterns and weights from entries with their weight and number of toxic texts.

    A word start counts if no single word makes up most of it, and if no
    longer or shorter start does better; a word under a start adds what its
    own weight has above that of the start.
    """
    words = {e: v for e, v in entries.items() if not e.endswith("*")}
    starts = {e[:-1]: v for e, v in entries.items() if e.endswith("*")}
    most: dict[str, int] = {}
    for word, (_, n) in words.items():
        for k in STEMS:
            most[word[:k]] = max(most.get(word[:k], 0), n)
    kept: dict[str, float] = {}
    for s, (weight, n) in sorted(starts.items(), key=lambda x: (-x[1][0] * x[1][1] ** 0.5, len(x[0]), x[0])):
        if most.get(s, 0) < 0.6 * n and not any(s.startswith(o) or o.startswith(s) for o in kept):
            kept[s] = weight
    out = {f" {s}": w for s, w in kept.items()}
    for word, (weight, _) in words.items():
        more = weight - max((w for s, w in kept.items() if word.startswith(s)), default=0.0)
        if more > 1:
            out[f" {word} "] = more
    return out


def learn(docs: DataFrame, labels: DataFrame, mod: int = 3, held: int = 1, fit_rows: int = FIT_ROWS,
          exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """The lexicon and score weights from labelled rows that are not held out.

    An entry must stand in toxic texts with many different next words (or, a
    word start, in many different words), so that copies of a few texts do
    not make one; its weight is the logarithm of the odds.
    """
    train = checkpointed(labelled(docs, labels, "toxic", mod, held, fit_rows))
    n_toxic, n_all = train.agg(F.sum("label"), F.count("*")).first()
    n_toxic, n_other = int(n_toxic or 0), int(n_all - (n_toxic or 0))
    weights: dict[str, float] = {}
    if n_toxic:
        made = checkpointed(train.mapInArrow(slim(_candidates), "entry string, next string, toxic long, other long"))
        counts = made.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("other") + 0.5) / (n_other + 1))
        spread = made.where("next is not null").distinct().groupBy("entry").agg(F.count("*").alias("spread"))
        least = max(3, round(MIN_SHARE * n_toxic))
        chosen = (counts.where(F.col("toxic") >= least).withColumn("weight", weight)
                  .where(F.col("weight") >= MIN_WEIGHT)
                  .join(spread, "entry").where(
                      F.col("spread") >= F.when(F.col("entry").endswith("*"), STEM_WORDS).otherwise(2 * least))
                  .orderBy(F.desc("spread"), "entry").collect())  # of the words of fit_rows texts
        weights = choose({r["entry"]: (r["weight"], r["toxic"]) for r in chosen})
    inside = {}
    for phrase in map(fold, exceptions):
        back = sum(w for p, w in weights.items() if p in phrase)
        if back:
            inside[phrase] = -back
    patterns = weights | inside

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            x = features([fold(t) for t in batch.column("text").to_pylist()], patterns)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                             ["label", "a", "b"])

    rows = train.mapInArrow(slim(run), "label int, a double, b double").collect()  # at most fit_rows rows
    x = np.array([[r["a"], r["b"]] for r in rows], float).reshape(-1, 2)
    y = np.array([r["label"] for r in rows], float)
    model = logistic(x, y, ridge=0.05) if 0 < y.sum() < len(y) else np.zeros(3)
    return Lexicon(weights, inside, model.tolist())


def score_texts(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxic_score``; a map without a shuffle."""
    patterns = lexicon.weights | lexicon.exceptions
    model = np.array(lexicon.model)
    keep = [c for c in docs.columns if c != "toxic_score"]
    inner = {c: f"c{k}" for k, c in enumerate(keep)}
    text = inner[text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            x = features([fold(t) for t in batch.column(text).to_pylist()], patterns)
            score = sigmoid(model[0] + x @ model[1:])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "score"])

    schema = ", ".join([f"{inner[c]} {docs.schema[c].dataType.simpleString()}" for c in keep] + ["score double"])
    return (docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()]).mapInArrow(slim(run), schema)
            .select(*[F.col(n).alias(c) for c, n in inner.items()], F.col("score").alias("toxic_score")))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 3, held: int = 1,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    scored = score_texts(docs.select(id_col, text_col), learn(docs, labels, mod, held), text_col)
    return scored.select(id_col, (remainder(F.col(id_col), mod) == held).alias("held_out"),
                         F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= threshold).cast("int").alias("predicted"))
