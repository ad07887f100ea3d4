"""The n-gram Jaccard join, suffix-array de-duplication and embedding near-duplicates against plain versions."""

import random

import numpy as np
import pytest

from memberlens.llm import ngram_join, repeats, vectors
from memberlens.llm.common import components, ship
from tests.llm.helpers import awkward, awkward_rows, nothing, prose, removal, shingles, similar_components


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_similar_texts_on_awkward_rows(spark, n, percent):
    got = ngram_join.similar_texts(awkward(spark), n, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    rows = awkward_rows()
    want = similar_components(rows, n, percent)
    expected = [(r[0], len(shingles(r[1], n)), want[r[0]] if r[0] is not None else None) for r in rows]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    assert want[18] == 1 and want[2] == 1 and want[4] == 4 and want[9] == 8


def test_chains_of_near_copies(spark):
    """Neighbours are similar, ends are not: pivots alone do not link them all."""
    words = prose(9, 200).split()
    rng = random.Random(5)
    rows = []
    for k in range(60):
        words = [w if rng.random() > 0.02 else f"w{k}{j}" for j, w in enumerate(words)]
        rows.append((1000 - k, " ".join(words), "en", "s", 0))
    rows += [(2000 + k, prose(10, 60) + " " + prose(100 + k, 5 + k % 9), "en", "s", 0) for k in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_texts(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), 5, 80).collect()}
    assert got == similar_components(rows, 5, 80)


def test_long_lists_in_blocks(spark, monkeypatch):
    """Tokens that very many texts have: lists dealt out in small blocks connect what the pairs would."""
    monkeypatch.setattr(ngram_join, "SHORT", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "PIVOTS", 0)
    rng = random.Random(11)
    lines = [prose(300 + k, 12) for k in range(14)]
    rows = []
    for k in range(220):  # texts made of a few lines that many texts have
        text = " ".join(rng.sample(lines, rng.randint(5, 9)))
        rows.append((k, text))
        if k % 4 == 0:
            words = text.split()
            words[rng.randrange(len(words))] = f"w{k}"
            rows.append((1000 + k, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_texts(
        spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    want = similar_components(rows, 4, 85)
    assert got == want and len(set(want.values())) < len(rows) - 20


def edited(text, at):
    words = text.split()
    return " ".join(words[:at] + ["changed"] + words[at + 1:])


def test_near_copies_without_an_id(spark):
    """Near copies that both have a null id, alone in a table and next to one of a numbered text and a text that is alone."""
    schema = "doc_id long, text string"
    pair = [(None, prose(20, 120)), (None, edited(prose(20, 120), 60))]
    got = ngram_join.similar_texts(spark.createDataFrame(pair, schema), 5, 80).collect()
    assert [(r["doc_id"], r["component_id"]) for r in got] == [(None, None)] * 2
    rows = pair + [(50, prose(21, 120)), (None, edited(prose(21, 120), 40)), (60, edited(prose(21, 120), 80)),
                   (None, prose(22, 120)), (7, edited(edited(prose(20, 120), 60), 100)), (80, prose(23, 120))]
    got = ngram_join.similar_texts(spark.createDataFrame(rows, schema), 5, 80).collect()
    want = [(None, 7), (None, 7), (50, 50), (None, 50), (60, 50), (None, None), (7, 7), (80, 80)]
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=key) == sorted(want, key=key)


def test_similar_texts_of_nothing(spark):
    assert ngram_join.similar_texts(nothing(spark)).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    df = spark.createDataFrame(edges + [(None, 5), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_remove_repeats_on_awkward_rows(spark):
    got = repeats.remove_repeats(awkward(spark))
    found = sorted((tuple(r[:5]) for r in got.collect()), key=key)
    assert found == sorted(removal(awkward_rows(), 50), key=key)
    assert repeats.remove_repeats(nothing(spark)).collect() == []


def test_remove_repeats_on_random_bytes(spark):
    """Few letters and edited copies: many overlapping repeats, shorter than a context and longer."""
    rng = random.Random(3)
    base = "".join(rng.choice("ab") for _ in range(600))
    rows = []
    for k in range(40):
        a, b = sorted(rng.sample(range(len(base)), 2))
        cut = "".join(c if rng.random() > 0.01 else rng.choice("abé") for c in base[a:b])
        rows.append((rng.randint(0, 1000), cut + "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))))
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r[:5]) for r in repeats.remove_repeats(df).collect()) == sorted(removal(rows, 50))


def test_kept_columns_and_text(spark):
    passage = prose(2, 30)
    df = spark.createDataFrame([(1, passage, "en"), (2, "Ü " + passage + " end", "de")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in repeats.remove_repeats(df, keep=["doc_id", "lang"]).collect()}
    assert got[1]["kept"] == passage and got[2]["lang"] == "de" and got[2]["n_spans"] == 1
    assert got[2]["kept"] in ("Ü  end", "Ü end", "Üend", "Ü  nd")


def test_repeat_groups_are_maximal():
    bodies = [b"xabcabcab", b"yabcabcad"]
    string, start, common = repeats.suffix_order(bodies, 3)
    suffixes = [bodies[s][k:] for s, k in zip(string, start)]
    assert suffixes == sorted(suffixes) and len(suffixes) == 14
    left = [bodies[s][k - 1] if k else -1 for s, k in zip(string, start)]
    found = {(suffixes[a][:size], b - a + 1) for a, b, size in repeats.repeat_groups(common.tolist(), left, 3)}
    want = set()
    text = [(s, k) for s in range(2) for k in range(len(bodies[s]))]
    for s, k in text:
        for size in range(3, len(bodies[s]) - k + 1):
            sub = bodies[s][k:k + size]
            at = [(x, y) for x, y in text if bodies[x][y:y + size] == sub]
            right = {bodies[x][y + size:y + size + 1] or (x, "end") for x, y in at}
            before = {bodies[x][y - 1:y] if y else (x, "start") for x, y in at}
            if len(at) > 1 and len(right) > 1 and len(before) > 1:
                want.add((sub, len(at)))
    assert found == want


def test_rows_without_an_id_cost_no_more(spark):
    """Hundreds of rows without an id, and of one id, with shared passages: what the plain removal gives, in its time."""
    rng = random.Random(8)
    shared = [prose(900 + k, 16) for k in range(6)]

    def text(k):
        parts = [prose(2000 + 3 * k + j, rng.randint(4, 12)) for j in range(2)]
        return f"{parts[0]} {rng.choice(shared)} {parts[1]} {rng.choice(shared)[rng.randint(0, 20):]}"

    rows = [(None, text(k)) for k in range(150)] + [(77, text(500 + k)) for k in range(150)]
    rows += [(k, text(1000 + k)) for k in range(40)] + [(None, rows[3][1])] * 20 + [(77, rows[160][1])] * 20
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(removal(rows, 50), key=order)


def plain_links(rows, least):
    good = [(i, np.array(v, float), l) for i, v, l in rows
            if l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {}
    for a, (i, v, l) in enumerate(good):
        for b, (j, w, m) in enumerate(good):
            if a != b and l == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links.setdefault(i, []).append(j)
    return links


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + 0.12 * rng.normal(size=16)).tolist(), int(k % 3)) for k in range(150)]
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 0), (502, None, 1), (503, [0.0] * 16, 1), (504, rows[1][1], None),
             (505, [float("nan")] * 16, 1), (506, [float("inf")] + [1.0] * 15, 2), (507, [None] + [1.0] * 15, 2),
             (508, [], 2), (509, [1.0, 2.0], 2), (510, [2.0, 4.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as id", "2 as bucket")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    want = plain_links(rows, 0.93)
    got = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    assert set(got) == {r[0] for r in rows}
    found, total = sum(r["n_links"] for r in got.values()), sum(map(len, want.values()))
    assert 0.98 * total <= found <= total and total > 500
    for i, r in got.items():
        assert r["n_links"] <= len(want.get(i, [])) and r["kept"] == (r["component_id"] == i)
    assert got[500]["component_id"] == 0 and got[510]["component_id"] == 509
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in range(502, 509))
    assert vectors.near_vectors(df.where("false")).collect() == []


def test_large_buckets_are_dealt_as_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(k, (np.ones(8) + 0.05 * rng.normal(size=8)).tolist(), 1) for k in range(120)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    want = plain_links(rows, 0.93)
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: len(j) for i, j in want.items()}
    assert {r["component_id"] for r in got} == {0}


def test_repeated_vector_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)],
                               "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in vectors.near_vectors(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_vectors_by_class_not_by_id(spark):
    """Equal ids of different vectors, null ids and norms beyond a double, against every pair of rows."""
    v, near, far = [1.0, 0.2, 0.0], [1.0, 0.21, 0.01], [0.0, 0.0, 1.0]
    rows = [(1, v, 1), (1, near, 1), (2, [2.0, 0.4, 0.0], 1), (1, far, 1), (None, near, 1), (None, far, 2), (None, far, 2),
            (7, [1e200, 2e199, 0.0], 1), (8, [1e-200, 2e-201, 0.0], 1), (None, [5.0, 5.0, 0.0], 3)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(
        [(1, 5, 1, True), (1, 5, 1, True), (2, 5, 1, False), (1, 0, 1, True), (None, 5, 1, False), (None, 1, None, True),
         (None, 1, None, True), (7, 5, 1, False), (8, 5, 1, False), (None, 0, None, True)], key=key)


def test_recall_at_the_threshold_of_large_plans():
    """Pairs right at the threshold meet in a table, for the plans of up to a billion vectors."""
    rng = np.random.default_rng(6)
    for n in (5 * 10**4, 2 * 10**6, 10**9):
        bits, tables = vectors.table_plan(n, 0.93, 0.995)
        a = rng.normal(size=(1500, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.normal(size=a.shape)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        b = 0.9305 * a + (1 - 0.9305**2) ** 0.5 * b
        met = (vectors._codes(a, bits, tables) == vectors._codes(b, bits, tables)).any(axis=1)
        assert met.mean() >= 0.985
