"""Mixing sources to target weights with hash-threshold histograms.

Each source gets a share of all words. It is taken ``floor(target / size)``
times whole; the rest is a budget that documents with a hash below a
threshold fill. The threshold comes from histograms of words by source and
hash bucket: the bucket in which the budget ends is refined into smaller
buckets, level by level, and only that one; documents are never sorted.

Nulls and ties: a null text has size 0, a null source is a source of its own
and comes last. The hash is of id and text, so documents without an id, or
with one id, are spread like others; rows equal in both share a hash, so they
are taken or left together. A source without words has target 0. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memberlens.llm.common import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    """Number of runs of bytes other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(key: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of an id and a text, as a long."""
    named = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """``source, source_size, target`` from the rows' ``source, size``.

    One row per source goes through the ordered windows; the documents were
    reduced to those before. Words over a source's limit are shared again by
    weight: the level at which limits and shares use up all words.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
             .withColumn("weight", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
             .withColumn("cap", F.lit(float(most)) * F.col("source_size")))
    level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = (named.withColumn("total", F.sum("source_size").over(everything))
              .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(after))
              .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
              .withColumn("level", F.max(F.when(F.col("fits"), F.col("level"))).over(everything)))
    return filled.select("source", "source_size",
                         F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def joinable(small: DataFrame, limit: int = 10_000) -> DataFrame:
    """A table of one row per source, broadcast if it is counted to be small; else left to a shuffle join."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source: ``copies`` of all its documents, and ``below``: a further copy of those with a smaller hash.

    ``rows`` has ``source, size, hash``. A level of the search sums the words
    of the open bucket by the next bits of the hash and keeps the bucket in
    which the budget ends; it stops when that bucket holds a single hash, so
    the last document is taken if that comes nearer to the budget.
    """
    safe = F.greatest("source_size", F.lit(1))
    copies = F.floor(F.col("target") / safe)
    state = targets.select("source", copies.alias("copies"), F.lit(0).cast("long").alias("prefix"),
                           F.lit(0).cast("long").alias("before"),
                           (F.col("target") - copies * F.col("source_size")).alias("budget"))
    state = checkpointed(state)
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        s = joinable(state.withColumnRenamed("source", "s"))
        inside = rows.join(s, rows["source"].eqNullSafe(s["s"])
                           & (F.shiftright(rows["hash"], shift + LEVEL_BITS) == s["prefix"]))
        buckets = (inside.groupBy("source", "copies", "before", "budget", F.shiftright("hash", shift).alias("bucket"))
                   .agg(F.sum("size").alias("words"), F.min("hash").alias("lo"), F.max("hash").alias("hi")))
        order = Window.partitionBy("source").orderBy("bucket")  # at most 2 ** LEVEL_BITS rows each
        ends = F.col("before") + F.sum("words").over(order)
        found = (buckets.withColumn("ends", ends).where(F.col("ends") > F.col("budget"))
                 .groupBy("source", "copies", "budget")
                 .agg(F.min_by(F.struct((F.col("ends") - F.col("words")).alias("before"), "bucket", "words", "lo", "hi"),
                               "bucket").alias("b")))
        state = checkpointed(found.select("source", "copies", F.col("b.bucket").alias("prefix"),
                                          F.col("b.before").alias("before"), "budget", F.col("b.words").alias("words"),
                                          "b.lo", "b.hi"))
        if not state.where("lo <> hi").limit(1).count():
            break
    nearer = F.col("before") * 2 + F.col("words") < F.col("budget") * 2
    state = state.select("source", F.when(nearer, F.col("hi") + 1).otherwise(F.col("lo")).alias("below"))
    t, s = targets.alias("t"), state.alias("s")
    return t.join(s, F.col("t.source").eqNullSafe(F.col("s.source")), "left").select(
        "t.source", "t.source_size", "t.target", copies.alias("copies"),
        # No open bucket: the whole source fits into the budget, or it has no words.
        F.coalesce("s.below", F.lit(1 << HASH_BITS)).alias("below"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0,
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_copies``: how often the mix takes each document.

    Only ids, sources and sizes are shuffled; the texts are joined with the
    limits of their source where they are read.
    """
    size, hash_ = word_count(F.col(text_col)), row_hash(F.col(id_col), F.col(text_col))
    rows = checkpointed(docs.select(F.col(source_col).alias("source"), size.alias("size"), hash_.alias("hash")))
    limits = thresholds(rows, checkpointed(source_targets(rows, weights, most)))
    limits = joinable(checkpointed(limits.select(*[F.col(c).alias(f"mix_{c}") for c in limits.columns])))
    more = (F.col("mix_copies") < F.floor(F.lit(most))) & (F.col("mix_hash") < F.col("mix_below"))
    own = [c for c in docs.columns if not c.startswith("mix_")]
    named = docs.select(*own, size.alias("mix_size"), hash_.alias("mix_hash"))
    return (named.join(limits, named[source_col].eqNullSafe(limits["mix_source"]))
            .select(*own, "mix_size", "mix_source_size", "mix_target",
                    (F.col("mix_copies") + more.cast("long")).alias("mix_copies")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` of every row: ``taken`` words are ``copies * size``."""
    mixed = mix_documents(docs, id_col=id_col, **options)
    return mixed.select(id_col, F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), F.col("mix_copies").alias("copies"),
                        (F.col("mix_copies") * F.col("mix_size")).alias("taken"))
