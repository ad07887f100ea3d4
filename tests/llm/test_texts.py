"""Token counts, BPE, fingerprints, licences, mixing, toxicity and quality."""

import hashlib
import textwrap
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from memberlens.llm import (bpe_trie, fingerprints, license_rules, mixing, quality, token_counts, toxicity)
from memberlens.llm.common import ship
from memberlens.llm.oracle import ORACLE
from memberlens.llm.sampling import labelled, remainder
from tests.llm.helpers import awkward, awkward_rows, nothing, prose, word_list

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
#: Letters that all versions of Unicode tables agree on.
LETTERS = "abctheingCDEéñÑßΣσςİıÅÉ'’sltmrvd 0123½²٣-_!?.,\n\t\x0b　\x85日本語ひら😀👍🏽“”|>"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def key(row):
    return tuple((x is None, x) for x in row)


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(LETTERS, max_size=40), st.sampled_from(["<|endoftext|>", "<|startoftext|>", "don't", "aaaa"])),
                max_size=6).map("".join))
def test_tokens_are_those_of_the_library(text):
    assert token_counts.count_texts([text], WORDS) == [len(library_cached(WORDS).encode(text, add_special_tokens=False).ids)]
    ids = library_cached(BYTES).encode(text, add_special_tokens=False).ids
    got, joined, decoded = bpe_trie.encode_texts([text], BYTES)[0]
    assert got.tolist() == ids and joined.decode() == ",".join(map(str, ids))
    assert decoded.decode() == library_cached(BYTES).decode(ids, skip_special_tokens=False)


_LIBRARY = {}


def library_cached(path):
    return _LIBRARY.setdefault(path, None) or _LIBRARY.__setitem__(path, library(path)) or _LIBRARY[path]


def test_token_counts_on_awkward_rows(spark):
    t = library(WORDS)
    want = [(i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 2048)
            for i, x, *_ in awkward_rows()]
    assert sorted(map(tuple, token_counts.token_counts(awkward(spark), WORDS).collect()), key=key) == sorted(want, key=key)
    assert token_counts.token_counts(nothing(spark), WORDS).collect() == []


def test_encoding_on_awkward_rows(spark):
    t = library(BYTES)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, x, *_ in awkward_rows():
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    got = bpe_trie.encode_documents(awkward(spark), BYTES).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    full = bpe_trie.encode_documents(awkward(spark), BYTES, ids=True)
    assert full.where("size(ids) <> n_tokens").count() == 0 and "mix_copies" in full.columns
    assert full.where("text is not null and decoded <> text").count() == 0
    assert bpe_trie.encode_documents(nothing(spark), BYTES).collect() == []


def test_words_forgotten_by_a_full_memory(monkeypatch):
    monkeypatch.setattr(bpe_trie, "KEPT_WORDS", 5)
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 5)
    texts = [prose(k, 20) for k in range(6)]
    for _ in range(2):
        assert [len(bpe_trie.encode_texts([t], BYTES)[0][0]) for t in texts] == [
            len(library_cached(BYTES).encode(t).ids) for t in texts]
        assert [token_counts.count_texts([t], WORDS)[0] for t in texts] == [
            len(library_cached(WORDS).encode(t, add_special_tokens=False).ids) for t in texts]


def test_fingerprints_on_awkward_rows(spark):
    got = fingerprints.fingerprint_documents(awkward(spark)).collect()
    rows = sorted(((r[0], r[1] or "") for r in awkward_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(rows):
        new = fingerprints.edited(t, rows[(k + 1) % len(rows)][1])
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    assert sorted((tuple(r[:3]) for r in got), key=key) == sorted(want, key=key)
    named = defaultdict(set)
    text = {r[0]: r[1] for r in awkward_rows() if r[0] is not None}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] is not None:
            named[text[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(f) == 1 for f in named.values())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[16]["near_edited"] > 0.25 and by_id[8]["near_next"] == 1.0
    assert fingerprints.fingerprint_documents(nothing(spark)).collect() == []


def test_one_document_is_its_own_next(spark):
    got = fingerprints.fingerprint_documents(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).collect()
    assert [(r["n_chars"], r["edited_sha256"]) for r in got] == [(6, hashlib.sha256(b"abcabc").hexdigest())]


def test_phrases_inside_equal_substrings_are_equal():
    inner = prose(5, 80)
    shifted = [prose(k, 3) + " " + inner + " " + prose(k + 50, 4) for k in range(20)]
    alone = [fingerprints.fingerprints(pa.array([t]))[0] for t in shifted]
    assert alone == fingerprints.fingerprints(pa.array(shifted))  # neighbours in a batch do not matter
    assert min(fingerprints.likeness(a, b) for a in alone for b in alone) > 0.6
    other = fingerprints.fingerprints(pa.array([prose(k + 500, 90) for k in range(20)]))
    assert max(fingerprints.likeness(a, b) for a in alone for b in other) < 0.15


def oracle(name, rows):
    con = duckdb.connect()
    con.sql("create table documents(doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    if rows:
        con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    found = con.sql(ORACLE[name])
    return found.columns, found.fetchall()


LICENSES = [(100, "Intro.\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "en", "s1", 0),
            (101, "x Redistribution and use in source and binary forms, with or without modification, are permitted", "en", "s1", 0),
            (102, "Redistributions in binary form must reproduce the above copyright notice\nRedistribution and use in source "
                  "and binary forms, with or without modification, are permitted\nRedistributions of source code must retain "
                  "the above copyright notice", "en", "s2", 0),
            (103, "REDISTRIBUTION and use in source and binary forms, with or without modification, are permitted. Redistributions "
                  "of source code must retain the above copyright notice; released under the mit license! Redistributions in "
                  "binary form must reproduce the above copyright notice", "en", "s2", 0)]


@pytest.mark.parametrize("name", ["op2_mix_sources", "op10_license_scan"])
def test_against_sql(spark, name):
    rows = [r for r in awkward_rows() if "\x00" not in (r[1] or "") and r[0] != 20] + LICENSES
    df = spark.createDataFrame(rows, awkward(spark).select("doc_id", "text", "lang", "source", "n_chars").schema)
    df = df.selectExpr("*", "1 as size", "2 as hash", "3 as mix_copies", "4 as sid", "5 as _id")
    got = mixing.mix_sources(df).drop("copies") if name.startswith("op2") else license_rules.scan_licenses(df)
    columns, want = oracle(name, rows)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want, key=key)
    empty = nothing(spark)
    assert (mixing.mix_sources(empty) if name.startswith("op2") else license_rules.scan_licenses(empty)).collect() == []


def test_license_rules(spark):
    got = {r["doc_id"]: r["licenses"] for r in license_rules.scan_licenses(spark.createDataFrame(
        LICENSES, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert got == {100: "Apache-2.0,MIT", 101: "", 102: "", 103: "BSD-2-Clause,MIT"}


APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
          "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
UNLESS = ('Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on '
          'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.')
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       'documentation files (the "Software"), to deal in the Software without restriction, subject to the following conditions: '
       "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
       'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO')
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
       "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
       "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
ENDORSE = (" 3. Neither the name of Some Lab nor the names of its contributors may be used to endorse or promote products derived "
           "from this software without specific prior written permission.")
GPL = ("Thing is free software{} you can redistribute it and/or modify it under the terms of the GNU General Public License as "
       "published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version.")


@pytest.mark.parametrize("width", [35, 50, 72, 79, 5000])
@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_licences(spark, width, mark):
    texts = {"Apache-2.0": [APACHE, APACHE + " " + UNLESS], "MIT": [MIT, "Note: released under the MIT License."],
             "BSD-2-Clause": [BSD], "BSD-3-Clause": [BSD + ENDORSE], "GPL-3.0": [GPL.format(":", ",", 3)],
             "GPL-2.0": [GPL.format(";", ";", 2)], "CC-BY-4.0": ["This text is licensed under CC BY 4.0."],
             "": [GPL.format(":", ",", 4), "It is not licensed under CC BY 4.0.", BSD[:200]],
             "LicenseRef-proprietary": ["Copyright 2020 Some Lab, all rights reserved."]}
    rows = [(name, "\n".join(mark + l for l in ["Intro", *textwrap.wrap(t, width, break_on_hyphens=False,
                                                                       break_long_words=False), "", "The end."]))
            for name, some in texts.items() for t in some]
    got = license_rules.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert [(r["doc_id"], r["licenses"]) for r in got] == [(name, name) for name, _ in rows]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_licence_line_of_the_given_tables(spark, sf):
    """Lines are found by words of their own, not by the rules."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    line = r"(?i)\b(licen[cs]ed?|copyright|rights reserved|creative commons|CC BY|all rights|proprietary|confidential)\b"
    held = {r["doc_id"]: r["n"] for r in docs.select("doc_id", F.explode(F.split("text", "\n")).alias("l"))
            .where(F.col("l").rlike(line)).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    got = {r["doc_id"]: r for r in license_rules.scan_licenses(docs).collect()}
    assert held and {i for i, r in got.items() if r["licenses"]} == set(held)
    assert all(got[i]["n_sentences"] == n for i, n in held.items())
    assert any(r["licenses"] == "LicenseRef-proprietary" for r in got.values())


def test_mix_meets_its_targets(spark):
    rows = [(k, prose(k, 5 + k % 90), "en", f"s{k % 7}" if k % 3 else "hot", 0) for k in range(600)]
    rows += [(9000, "w", "en", "tiny", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix_sources(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_sources(df).collect()))
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == len(word_list(rows[min(r["doc_id"], 600)][1])) and r["taken"] <= 3 * r["size"]
        assert r["target"] <= 3 * r["source_size"] + 1e-6
        taken[s] += r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in got))
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert target["tiny"] == 3 and taken["tiny"] == 3


def labelled_corpus(spark, n=900):
    rows, labels = [], []
    for k in range(n):
        bad, low = k % 8 == 0, k % 7 == 0
        words = prose(k, 60).split()
        if bad:
            words[5::20] = [("wretch", "Wr3tch", "grüblo" + words[9][:3], "grüblo" + words[8])[(k // 8) % 4]] * 3
        if low:
            words = [w + "***" if (k // 7) % 2 else w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, 0 if low else 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled_corpus(spark)
    lexicon = toxicity.learn(docs, labels)
    assert " wretch " in lexicon.weights and any(p.strip().startswith("grübl"[:4]) for p in lexicon.weights)
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [r for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    right = sum(got[r["doc_id"]]["predicted"] == r["toxic"] for r in held)
    assert len(held) > 200 and right / len(held) > 0.97


def test_exceptions_take_weight_back():
    weights = {" trash ": 5.0}
    inside = weights | {" trash can ": -5.0}
    assert toxicity.features([toxicity.fold("the TRASH can")], inside)[0, 0] == 0
    assert toxicity.features([toxicity.fold("you tr4sh, сan it")], weights)[0, 0] > 0
    assert toxicity.fold("Ιdi0t  p@thetic сlοwn") == " idiot pathetic clown "


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled_corpus(spark)
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    held = [r for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    right = sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in held)
    assert len(held) > 100 and right / len(held) > 0.97
    model = quality.learn(docs, labels)
    assert 0 < len(model.rules) < 60


@pytest.mark.parametrize("op", [toxicity.toxicity, quality.quality])
def test_scores_on_awkward_rows(spark, op):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (3, None, None), (None, 0, 1), (4, 0, 1), (4, 0, 0), (999, 1, 1)],
                                   "doc_id long, quality int, toxic int").selectExpr("*", "1 as label", "2 as id")
    got = op(docs, labels).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert op(docs, labels.where("false")).count() == len(awkward_rows())
    assert op(nothing(spark), labels).collect() == []
    assert all((r["score"] >= (0.7 if op is toxicity.toxicity else 0.3)) == r["predicted"] for r in got)


def test_held_out_remainders(spark):

    got = spark.range(50).select("id", remainder(F.col("id"), 3))
    assert all(r[1] == zlib.crc32(str(r[0]).encode()) % 3 for r in got.collect())


def test_text_stats_are_those_of_the_text():
    texts = ["", None, "Aa bb bb!! x|y 12\nz", "one"]
    got = quality.text_stats(pa.array(texts))
    assert got.shape == (4, len(quality.STATS)) and np.isfinite(got).all()
    row = dict(zip(quality.STATS, got[2]))
    assert row["upper"] == 1 / 19 and row["digit"] == 2 / 19 and row["bar"] == 1 / 19 and row["exclaim"] == 2 / 19
    assert row["distinct"] == 1.0 and row["doubled"] == 0 and row["marked_words"] == 1 / 6
    alone = quality.text_stats(pa.array([texts[2]]))
    assert (alone[0] == got[2]).all()


def test_mix_spreads_documents_without_an_id(spark):
    """A source of null ids, and one of a single id, come near their targets like any other."""
    rows = [(None, prose(400 + k, 40), "a") for k in range(500)] + [(7, prose(1000 + k, 40), "b") for k in range(500)]
    rows += [(5000 + k, prose(k, 10), "c") for k in range(100)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r["doc_id"] if r["doc_id"] in (None, 7) else "c"] += r["taken"]
        target[r["doc_id"] if r["doc_id"] in (None, 7) else "c"] = r["target"]
    assert len(got) == 1100 and all(abs(taken[s] - target[s]) <= 40 for s in target)


def test_sample_of_labelled_rows_is_bounded(spark):
    """Thousands of documents of one labelled id, more labels than the bound, null and repeated labels."""
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(3000)] + [(k, f"other {k}") for k in range(2, 400)]
                                 + [(None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)] + [(1, 0), (None, 1), (3, None)],
                                   "doc_id long, quality int")
    whole = labelled(docs, labels, "quality", 5, 0, 10_000).collect()
    assert len({r["id"] for r in whole}) == len(whole) and all(zlib.crc32(str(r["id"]).encode()) % 5 for r in whole)
    assert [r["label"] for r in whole if r["id"] == 1] == [0]
    some = labelled(docs, labels, "quality", 5, 0, 60)
    assert 50 <= some.count() <= 60 and sorted(map(tuple, some.collect())) == sorted(map(tuple, some.collect()))
