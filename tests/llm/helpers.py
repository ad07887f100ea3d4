"""Small tables with awkward rows, and plain versions of the operators to hold them against."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty, blank, odd and very long texts, and repeated rows."""
    base, passage = prose(1, 120), prose(2, 60)
    words = base.split()
    near = " ".join(words[:100] + ["changed"] + words[101:])
    far = " ".join(words[:60]) + " " + prose(3, 60)
    rows = [(1, base), (2, base.upper()), (3, near), (4, far), (5, None), (6, ""), (7, " \t\n\x0b "), (8, "one two"),
            (9, "one two"), (10, prose(4, 40) + " " + passage + " " + prose(5, 40)), (11, passage + " " + prose(6, 30)),
            (12, "naïve Ünï çødé 日本語のテキスト😀 ÀÉ don't <|endoftext|> we'll"), (13, "a" * 700), (14, "a" * 900),
            (15, "for " * 300), (16, prose(7, 6000)), (17, prose(7, 5990)), (18, near + " tail"), (20, base), (20, base),
            (None, prose(8, 50)), (None, None), (-3, passage), (21, "\x00\x00" * 40 + "x"), (22, "\x00\x00" * 50 + "y")]
    return [(i, t, "en", ["s1", "s2", None, "", "ä"][k % 5], len(t or "")) for k, (i, t) in enumerate(rows)]


def awkward(spark: SparkSession) -> DataFrame:
    """The rows above with further columns whose names clash with those that operators use inside."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    for name in ("i", "t", "m", "key", "bucket", "doc", "names", "kept", "size", "hash", "copies", "mix_copies", "score",
                 "n_tokens", "toxic_score", "component_id", "root", "label"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def word_list(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SPACE.split(lower) if w]


def shingles(text: str | None, n: int) -> set[tuple[str, ...]]:
    words = word_list(text)
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def similar_components(rows: list[tuple], n: int, percent: int) -> dict[int, int]:
    """By id (rows with null ids left out): the smallest id reachable by links."""
    sets = {r[0]: shingles(r[1], n) for r in rows if r[0] is not None}
    parent = {i: i for i in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: find(i) for i in sets}


def removal(rows: list[tuple], least: int) -> list[tuple]:
    """(id, bytes, removed, spans, digest of the rest) of every row, by looking at every string."""
    order = lambda i: float("inf") if i is None else i
    first: dict[bytes, float] = {}
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for i, b in texts:
        for k in range(len(b) - least + 1):
            s = b[k:k + least]
            first[s] = min(first.get(s, float("inf")), order(i))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - least + 1):
            if first[b[k:k + least]] < order(i):
                gone[k:k + least] = [True] * least
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out
