"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``.

* toxicity: texts predicted toxic go; texts without a lexicon match stay.
* near_duplicates: of each group linked by five-word shingles at 80 % or
  more, the document with the smallest id stays, one with a null id only where
  all are null; texts without words stay, and so does each text that is alone,
  whether its id is null or another text has it too.
* repeated_passages: bytes that a document with a smaller id has as well, in
  strings of 50 or more, go; a document of which nothing is left goes.
* mix: a document is repeated as often as the mix takes it, or goes.
* encode: every document with its token ids.

Null texts and ids, empty texts and repeated rows pass as the operators
define them; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlens.llm import bpe_trie, mixing, ngram_join, repeats, toxicity
from memberlens.llm.common import shared_folder, ship, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, lexicon).where("toxic_score < 0.7").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.one_of_each(docs.select(*COLUMNS), n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    cut = repeats.remove_repeats(docs, keep=["doc_id", "lang", "source", "n_chars"])
    changed = F.col("n_removed") > 0
    return (cut.where(~changed | (F.length("kept") > 0))
            .withColumn("n_chars", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")))
            .withColumnRenamed("kept", "text").select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(docs).where("mix_copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    coded = bpe_trie.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=True,
                                      kept_words=100_000)  # workers share the executor with what earlier stages left
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [("toxicity", reject_toxic), ("near_duplicates", drop_near_duplicates),
                                   ("repeated_passages", cut_repeats), ("mix", mix), ("encode", encode)]

#: SQL can express neither the learned lexicon nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
