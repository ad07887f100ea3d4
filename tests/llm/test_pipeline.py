"""The pipeline's stages against plain versions of what they keep."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest

from memberlens.llm import bpe_trie
from memberlens.llm.common import ship
from tests.llm.helpers import awkward_rows, nothing, prose, removal, similar_components
from tests.llm.test_texts import labelled_corpus


@pytest.fixture()
def folder(spark, tmp_path):
    ship(spark)
    docs, labels = labelled_corpus(spark, 400)
    more = spark.createDataFrame([(r[0] + 5000 if r[0] is not None else None, *r[1:]) for r in awkward_rows()
                                  if "\x00" not in (r[1] or "")], docs.schema)
    docs.unionByName(more).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert len(names) == 5
    clean = stages["toxicity"](spark, docs, folder)
    toxic = {r[0] for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 1").collect()}
    left = {r["doc_id"] for r in clean.collect()}
    everything = {r["doc_id"] for r in docs.collect()}
    assert everything - left <= toxic and len(toxic & left) < 0.1 * len(toxic)

    single = stages["near_duplicates"](spark, docs, folder)
    assert single.columns == corpus_pipeline.COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = similar_components(rows, 5, 80)
    kept = Counter(r["doc_id"] for r in single.collect())
    assert {i for i in kept if i is not None} == {i for i, c in groups.items() if i == c}
    # Each text that is alone stays, as often as texts without words do; a null id is no group.
    assert all(n == 1 for i, n in kept.items() if i is not None)
    assert kept[None] == sum(1 for i, _ in rows if i is None)

    cut = {r["doc_id"]: r for r in stages["repeated_passages"](spark, docs, folder).collect()}
    rest = {r[0]: r for r in removal(rows, 50)}
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert all(digest(r["text"]) == rest[i][4] for i, r in cut.items() if i is not None and i != 5012)
    gone = {i for i, r in rest.items() if r[2] and r[4] == digest("")}
    assert gone and {i for i in everything if i not in cut} == gone
    assert all(r["n_chars"] == len(r["text"]) for i, r in cut.items() if i is not None and rest[i][2])

    mixed = Counter(r["doc_id"] for r in stages["mix"](spark, docs, folder).collect())
    assert max(v for i, v in mixed.items() if i is not None and i != 5020) <= 3


def test_near_duplicates_keep_rows_by_text(spark):
    """Null ids, texts without words and different texts under one id: what is alone stays, one of each group stays."""
    ship(spark)
    edit = lambda t: " ".join(t.split()[:60] + ["changed"] + t.split()[61:])
    alone = [prose(30 + k, 80) for k in range(12)]
    twin, other, pair = prose(60, 120), prose(61, 120), prose(62, 120)
    rows = [(None, t) for t in alone] + [(None, None), (None, ""), (9, " "), (9, " "), (None, None)]
    rows += [(3, twin), (None, edit(twin)), (4, edit(twin)), (None, twin)]            # a numbered group: 3 stays
    rows += [(None, pair), (None, edit(pair)), (None, pair), (None, pair.upper())]    # a group without ids: one row stays
    rows += [(8, other), (8, prose(63, 50)), (8, other)]                              # two texts under one id: both stay
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()]
    none = [t for i, t in got if i is None]
    assert len(none) == 12 + 3 + 1 and Counter(none)[None] == 2 and set(alone) <= set(none)
    assert len([t for t in none if t in (pair, edit(pair), pair.upper())]) == 1
    assert sorted((i, t) for i, t in got if i is not None) == sorted(
        [(3, twin), (8, other), (8, prose(63, 50)), (9, " "), (9, " ")])


def test_registered():
    import __spark_entry__
    import bench
    registered = __spark_entry__.queries()
    assert registered["pipeline"] and bench.chosen(registered, []) == list(registered)


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    assert got and len({r["doc_id"] for r in got}) < spark.read.parquet(f"{folder}/documents.parquet").count()
    trie = bpe_trie.byte_trie(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    for r in got[:50]:
        assert len(r["ids"]) == r["n_tokens"] and all(i in trie.bytes_of for i in r["ids"])


def test_stages_of_nothing(spark, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing(spark), folder).collect() == []
