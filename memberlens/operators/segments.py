"""Member segments from tag clauses: select, bulk-evaluate, export.

:func:`segment_select` compiles a clause list into one Column predicate
(see :mod:`memberlens.functions.clauses`) and returns the whole segment, or
its best ``k`` members where the caller asks for them (the shop's search
page showed the first 1000 hits).

:func:`segment_bulk` evaluates *many* segments given as a rules DataFrame
``(segment_id, name, value, type)`` through :func:`clause_index`, one bitmap of
tag rows per distinct clause and 32,768 rows. Segments are ORs (or ANDs) and
AND NOTs over bitmaps; sizes come from the bitmaps alone
(:func:`segment_sizes`), members by expanding them. There is one plan and one
meaning for any number of rules:

* only fields that a rule names are read; a value of equality asks under its
  field and value, a field once a row whether it exists;
* the bounds of all range rules cut the values into elementary intervals. A
  value finds its own by search (:mod:`memberlens.functions.intervals`) and
  asks under the few nodes above it in a tree of them; a rule stands under the
  nodes that make up its range, each value under one of these at most, so the
  rows of the join grow with the hits, not with values times rules.

Rules and row numbers are broadcast only if they are counted to be few; where
they are not, AQE splits a value that every member has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberlens.functions.clauses import CLAUSE_TYPES, EXACT, segment_columns
from memberlens.functions.intervals import interval_numbers
from memberlens.session import materialize

PAGE_SIZE = 1000              # fixed value: the page showed the first 1000 hits
KEY = "memberId"


def segment_select(tags: DataFrame, clauses, combine: str = "any",
                   limit: int | None = None) -> DataFrame:
    """``(memberId, phone, matched)`` of the segment, best matches first.

    ``matched`` = number of should clauses that hold; ties are broken by
    ``memberId`` so the result is deterministic. ``limit`` keeps the best
    so many (a top-k, planned without a full sort); by default the segment
    is whole.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1; leave it out for the whole segment")
    keep, matched = segment_columns(tags.schema, clauses, combine)
    out = (tags.filter(keep)
               .select(KEY, "phone", matched.alias("matched"))
               .orderBy(F.desc("matched"), F.asc(KEY)))
    return out if limit is None else out.limit(limit)


def segment_size(tags: DataFrame, clauses, combine: str = "any") -> DataFrame:
    """One row ``members``: the size of the whole segment."""
    keep, _ = segment_columns(tags.schema, clauses, combine)
    return tags.agg(F.count(F.when(keep, 1)).alias("members"))


def segment_export(segment: DataFrame, path: str | None = None) -> DataFrame:
    """Export lines ``[memberId,phone]``; written with CRLF line ends when ``path`` is given.

    A missing phone renders as ``null``, as string concatenation did in
    the shop's download. The write is distributed (one file per task).
    """
    line = F.concat(F.lit("["), F.col(KEY).cast("string"), F.lit(","),
                    F.coalesce(F.col("phone").cast("string"), F.lit("null")), F.lit("]"))
    lines = segment.select(line.alias("line"))
    if path:
        lines.write.mode("overwrite").option("lineSep", "\r\n").text(path)
    return lines


# --------------------------------------------------------------------- bulk

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_FLOAT = (T.FloatType, T.DoubleType)
#: Children of a node in the tree of elementary intervals.
FAN = 16
BITS = 32_768                 # fixed value: rows in one of Spark's bitmaps
#: Rules up to this number, and tag rows up to that one, are broadcast; they are counted first.
FEW_RULES = 2_000
FEW_ROWS = 1_000_000


def _kind(dtype: T.DataType) -> str:
    """How a field's values compare: ``whole`` (exactly), ``float`` or ``text``."""
    dtype = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
    return "whole" if isinstance(dtype, _WHOLE) else "float" if isinstance(dtype, _FLOAT) else "text"


_VALUE = T.StructType([T.StructField("field", T.StringType()), T.StructField("exact", EXACT),
                       T.StructField("num", T.DoubleType()), T.StructField("text", T.StringType())])


def _value(field, exact, num, text):
    """A value that sorts by field, then as its kind does; text only where the field is text."""
    return F.struct(field.alias("field"), exact.alias("exact"), num.alias("num"), text.alias("text"))


def _entries(tags: DataFrame, asked: dict[str, set[str]]) -> DataFrame:
    """``(n, ask, field, key, value)``: what each tag row has of the asked fields.

    ``ask`` is ``=`` for a value by its text (``key``), ``~`` for one by its
    order (``value``), ``?`` for a field that is there at all.
    """
    kinds = T.StructType([T.StructField("ask", T.StringType()), T.StructField("field", T.StringType()),
                          T.StructField("key", T.StringType()), T.StructField("value", _VALUE)])
    none_of = F.array().cast(T.ArrayType(kinds))

    def entry(ask: str, name: str, key, value):
        return F.struct(F.lit(ask).alias("ask"), F.lit(name).alias("field"), key.cast("string").alias("key"),
                        value.cast(_VALUE).alias("value"))

    def element(ask: str, name: str, kind: str):
        def one(x):
            exact = x.cast(EXACT) if kind == "whole" else F.lit(None).cast(EXACT)
            num = x.cast("double") + F.lit(0.0) if kind == "float" else F.lit(None).cast("double")
            if ask == "=":
                return entry(ask, name, {"whole": exact, "float": num}.get(kind, x), F.lit(None))
            text = x.cast("string") if kind == "text" else F.lit(None).cast("string")
            return entry(ask, name, F.lit(None), _value(F.lit(name), exact, num, text))
        return one

    parts = []
    for f in tags.schema.fields:
        name, kind, col = f.name.lower(), _kind(f.dataType), F.col(f.name)
        asks = asked.get(name, set())
        if "?" in asks:
            there = col.isNotNull() & (F.size(col) > 0) if isinstance(f.dataType, T.ArrayType) else col.isNotNull()
            parts.append(F.when(there, F.array(entry("?", name, F.lit(None), F.lit(None)))).otherwise(none_of))
        for ask in sorted(asks - {"?"}):
            one = element(ask, name, kind)
            if isinstance(f.dataType, T.ArrayType):
                parts.append(F.coalesce(F.transform(F.array_distinct(F.array_compact(col)), one), none_of))
            else:
                parts.append(F.when(col.isNotNull(), F.array(one(col))).otherwise(none_of))
    return tags.select("n", F.explode(F.flatten(F.array(*parts))).alias("e")).select("n", "e.*")


def _normalise_rules(rules: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """The rules with typed values; a segment without should clauses gets one that every member meets."""
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    r = rules.select("segment_id", F.lower("name").alias("field"),
                     F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), "type").distinct()
    need = r.groupBy("segment_id").agg(F.count(F.when(F.col("type") != "notMatch", 1)).alias("nShould"))
    always = (need.filter(F.col("nShould") == 0)
                  .select("segment_id", F.lit(KEY.lower()).alias("field"),
                          F.lit("").alias("value"), F.lit("exists").alias("type")))
    both = F.col("type") == "rangeBoth"
    parts = F.split("value", "-", -1)
    low = F.when(both, F.when(F.size(parts) == 2, parts[0])).otherwise(F.col("value"))
    high = F.when(both, F.when(F.size(parts) == 2, parts[1])).otherwise(F.col("value"))
    finite = lambda c: F.when(F.abs(c) < float("inf"), c + F.lit(0.0))

    def exact(c):
        # Beyond every whole number a bound is as good as the largest.
        wide = finite(c.try_cast("double"))
        return F.coalesce(F.trim(c).try_cast(EXACT), F.when(F.abs(wide) > 1e27, F.signum(wide) * F.lit(1e27)).cast(EXACT))

    r = (r.unionByName(always).join(need, "segment_id")
          .withColumn("kind", F.try_element_at(kind, F.col("field")))
          .select("segment_id", "field", "value", "type", "nShould", "kind",
                  (F.col("type") == "notMatch").alias("negated"),
                  F.when(F.col("kind") == "whole", exact(low)).alias("loExact"),
                  F.when(F.col("kind") == "whole", exact(high)).alias("hiExact"),
                  F.when(F.col("kind") == "float", finite(low.try_cast("double"))).alias("loNum"),
                  F.when(F.col("kind") == "float", finite(high.try_cast("double"))).alias("hiNum")))
    key = (F.when(F.col("kind") == "whole", F.col("loExact").cast("string"))
            .when(F.col("kind") == "float", F.col("loNum").cast("string")).otherwise(F.col("value")))
    return r.withColumn("key", key)


def _check_rules(norm: DataFrame) -> tuple[int, dict[str, set[str]]]:
    """The number of rules, and how each field is asked for; refuses what :func:`segment_select` refuses.

    One row comes back, with at most three entries a column of the tag table.
    """
    valued = F.col("type") != "exists"
    unread = valued & (F.col("kind") != "text") & (F.coalesce(F.col("loExact").cast("double"), F.col("loNum")).isNull()
                                                   | F.coalesce(F.col("hiExact").cast("double"), F.col("hiNum")).isNull())
    ask = F.when(F.col("type") == "exists", "?").when(F.col("type").startswith("range"), "~").otherwise("=")
    n = norm.agg(F.count("*").alias("rules"),
                 F.collect_set(F.when(F.col("kind").isNotNull(), F.struct("field", ask.alias("ask")))).alias("asked"),
                 F.count(F.when(~F.col("type").isin(*CLAUSE_TYPES), 1)).alias("type"),
                 F.count(F.when(F.col("kind").isNull(), 1)).alias("field"),
                 F.count(F.when((F.col("type") == "rangeBoth") & (F.col("kind") == "text"), 1)).alias("text"),
                 F.count(F.when(unread, 1)).alias("value")).first()
    if n["type"]:
        raise ValueError(f"{n['type']} rule(s) with an unknown type; expected {CLAUSE_TYPES}")
    if n["field"]:
        raise ValueError(f"{n['field']} rule(s) name a field the tag table does not have")
    if n["text"]:
        raise ValueError(f"{n['text']} rangeBoth rule(s) on a field that is not numeric")
    if n["value"]:
        raise ValueError(f"{n['value']} rule(s) with a value that is not a number (rangeBoth takes 'lo-hi')")
    asked: dict[str, set[str]] = {}
    for r in n["asked"]:
        asked.setdefault(r["field"], set()).add(r["ask"])
    return n["rules"], asked


def _tree_nodes(low, high, levels: int):
    """The nodes ``(level, node)`` of the tree that make up the intervals ``low`` to ``high``, each of them once."""
    nodes = T.ArrayType(T.StructType([T.StructField("level", T.IntegerType()), T.StructField("node", T.LongType())]))

    def some(level, start, end):
        """``start`` to ``end`` - 1 of a level."""
        made = F.transform(F.sequence(start, F.greatest(end - 1, start)),
                           lambda k: F.struct(level.alias("level"), k.alias("node")))
        return F.when(start < end, made).otherwise(F.array().cast(nodes))

    def step(state, level):
        left, right = state["left"], state["right"]
        inner_left, inner_right = F.ceil(left / FAN) * FAN, F.floor(right / FAN) * FAN
        last = (inner_left >= inner_right) | (level == levels)
        emitted = F.when(last, some(level, left, right)).otherwise(
            F.concat(some(level, left, inner_left), some(level, inner_right, right)))
        to = lambda x: F.when(last, F.lit(0)).otherwise((x / FAN)).cast("long")
        return F.struct(to(inner_left).alias("left"), to(inner_right).alias("right"),
                        F.concat(state["nodes"], emitted).alias("nodes"))

    start = F.struct(low.cast("long").alias("left"), (high + 1).cast("long").alias("right"), F.array().cast(nodes).alias("nodes"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step)["nodes"]


def _rule_asks(clauses: DataFrame, has_range: bool):
    """``(clause, probe)``: under what each distinct clause is asked for; how values probe ranges; the tree's levels."""
    probe = (F.when(F.col("type") == "exists", F.xxhash64(F.lit("?"), "field"))
             .otherwise(F.xxhash64(F.lit("="), "field", "key")))
    plain = clauses.where(F.col("type").isin("match", "notMatch", "exists")).select("clause", probe.alias("probe"))
    if not has_range:
        return plain, None, 0
    text = F.col("kind") == "text"
    low, high = (_value(F.col("field"), F.col(f"{e}Exact"), F.col(f"{e}Num"), F.when(text, F.col("value")))
                 for e in ("lo", "hi"))
    ranges = (clauses.where(F.col("type").startswith("range"))
              .withColumn("low", F.when(F.col("type") != "rangeLte", low))
              .withColumn("high", F.when(F.col("type") != "rangeGte", high)))
    number = interval_numbers(ranges.select(F.explode(F.array("low", "high")).alias("cut")), points=True)
    most = 2 * number.cuts
    levels = 0
    while FAN ** (levels + 1) <= most:
        levels += 1
    placed = number(number(ranges, F.col("low"), "from"), F.col("high"), "to")
    asked = (placed.withColumn("from", F.coalesce("from", F.lit(0))).withColumn("to", F.coalesce("to", F.lit(most)))
             .where("from <= to")
             .select("clause", "field", F.explode(_tree_nodes(F.col("from"), F.col("to"), levels)).alias("e")))
    asked = asked.select("clause", F.xxhash64(F.lit("~"), "field", "e.level", "e.node").alias("probe"))
    return plain.unionByName(asked), number, levels


def clause_index(tags: DataFrame, norm: DataFrame, asked: dict[str, set[str]], few: bool) -> DataFrame:
    """``(clause, bucket, bitmap, last)``: the rows of ``tags`` (numbered from 1 as ``n``) that meet each clause.

    The bitmaps are built in the map tasks; a row that meets a clause by
    several elements sets its bit once.
    """
    clauses = norm.select("clause", "field", "key", "value", "type", "kind", "loExact", "hiExact", "loNum", "hiNum").distinct()
    rules, number, levels = _rule_asks(clauses, any("~" in a for a in asked.values()))
    entries = _entries(tags, asked)
    plain = entries.where("ask <> '~'").select("n", F.when(F.col("ask") == "?", F.xxhash64(F.lit("?"), "field"))
                                               .otherwise(F.xxhash64(F.lit("="), "field", "key")).alias("probe"))
    if number is not None:
        ranged = number(entries.where("ask = '~'"), F.col("value"), "at")
        up = F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda h: F.struct(
            h.alias("level"), F.floor(F.col("at") / F.pow(F.lit(FAN), h)).cast("long").alias("node"))))
        above = ranged.select("n", "field", up.alias("e"))
        plain = plain.unionByName(above.select("n", F.xxhash64(F.lit("~"), "field", "e.level", "e.node").alias("probe")))
    return (plain.join(F.broadcast(rules) if few else rules, "probe").groupBy("clause", F.bitmap_bucket_number("n").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bitmap"),
                 F.max(F.bitmap_bit_position("n")).alias("last")))


def _clause_bitmaps(tags: DataFrame, rules: DataFrame, combine: str, by_member: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(segment_id, negated, nShould, bucket, bitmap, last)``, a row for each clause of a segment; the numbered tag rows.

    ``by_member`` numbers the rows in the order of their members.
    """
    if combine not in ("any", "all"):
        raise ValueError("combine must be 'any' or 'all'")
    norm = materialize(_normalise_rules(rules, {f.name.lower(): _kind(f.dataType) for f in tags.schema.fields})
                       .withColumn("clause", F.xxhash64("field", "value", "type")))
    n_rules, asked = _check_rules(norm)
    few = n_rules <= FEW_RULES
    # Written, so that the numbers of the rows stay the same if a task runs again.
    ordered = tags.orderBy(KEY) if by_member else tags
    rows = materialize(ordered.withColumn("n", F.monotonically_increasing_id() + 1))
    cores = tags.sparkSession.sparkContext.defaultParallelism
    numbered = rows
    if numbered.rdd.getNumPartitions() < cores:        # a small table, written by a few tasks
        numbered = numbered.repartition(cores, "n")
    uses = norm.select("segment_id", "clause", "negated", "nShould").distinct()
    return clause_index(numbered, norm, asked, few).join(F.broadcast(uses) if few else uses, "clause"), rows


def _segment_bitmaps(tags: DataFrame, rules: DataFrame, combine: str) -> tuple[DataFrame, DataFrame]:
    """``(segment_id, bucket, yes, no, last)`` and the numbered tag rows ``(n, memberId)``.

    A segment holds the rows in ``yes`` that are not in ``no`` (NULL: none).
    """
    held, rows = _clause_bitmaps(tags, rules, combine)
    join = "bitmap_or_agg" if combine == "any" else "bitmap_and_agg"
    made = held.groupBy("segment_id", "bucket").agg(
        F.expr(f"{join}(bitmap) filter (where not negated)").alias("yes"),
        F.expr("bitmap_or_agg(bitmap) filter (where negated)").alias("no"),
        F.expr("count(1) filter (where not negated)").alias("met"),
        F.max("nShould").alias("nShould"), F.expr("max(last) filter (where not negated)").alias("last"))
    need = F.lit(1) if combine == "any" else F.greatest(F.col("nShould"), F.lit(1))
    return (made.where(F.col("met") >= need).withColumn("no", F.when(F.bitmap_count("no") > 0, F.col("no")))
            .select("segment_id", "bucket", "yes", "no", "last"), rows.select("n", KEY))


def _byte(bitmap, k):
    bitmap = F.col(bitmap) if isinstance(bitmap, str) else bitmap
    return F.ascii(F.decode(F.substring(bitmap, k + 1, F.lit(1)), "ISO-8859-1"))


def _set_bits(bitmaps: DataFrame, octet, *keep: str) -> DataFrame:
    """``keep`` and ``n`` of each bit that is set; ``octet`` gives byte ``k`` of a row's bitmap, ``last`` its last bit."""
    used = F.sequence(F.lit(0), F.floor(F.col("last") / 8).cast("int"))
    octets = F.filter(F.transform(used, lambda k: F.struct(k.alias("k"), octet(k).alias("v"))), lambda o: o["v"] != 0)
    bits = bitmaps.select(*dict.fromkeys([*keep, "bucket"]), F.explode(octets).alias("o")).select(
        "*", F.explode(F.expr("filter(sequence(0, 7), b -> (shiftright(o.v, b) & 1) = 1)")).alias("b"))
    return bits.select(*keep, ((F.col("bucket") - 1) * BITS + F.col("o.k") * 8 + F.col("b") + 1).alias("n"))


def segment_bulk(tags: DataFrame, rules: DataFrame, combine: str = "any") -> DataFrame:
    """``(segment_id, memberId)``: the distinct members of every segment of ``rules``.

    ``rules`` has columns ``segment_id, name, value, type`` (one row per
    clause). A clause list means what it means to :func:`segment_select`: it
    is judged per tag row, and a member belongs to a segment if one of its
    rows does.
    """
    bitmaps, rows = _segment_bitmaps(tags, rules, combine)

    def left(k):
        yes = _byte("yes", k)
        return F.when(F.col("no").isNull(), yes).otherwise(yes.bitwiseAND(F.bitwise_not(_byte("no", k))))

    hits = _set_bits(bitmaps, left, "segment_id")
    rows = F.broadcast(rows) if rows.count() <= FEW_ROWS else rows
    return hits.join(rows, "n").select("segment_id", KEY).where(F.col(KEY).isNotNull()).distinct()


#: Shards of a segment whose best rows are found before those of the segment.
SHARDS = 256


#: More than the clauses of any segment.
MOST = 2**31


def _best_of_bucket(k: int, combine: str):
    """The best ``k`` rows of a segment's ``bitmaps`` of one bucket, less those in ``no``.

    One number a row, the better the smaller: ``(MOST - met) * BITS`` and its
    bit. Byte by byte, so that what is made at once are a bucket's rows and one
    byte of each bitmap, however many clauses a segment and rows the table has.
    """
    one = lambda bits, b: F.call_function("shiftright", bits, b).bitwiseAND(F.lit(1))

    def rows(i):
        octets = F.transform("bitmaps", lambda bitmap: _byte(bitmap, i))
        held = F.struct(octets.alias("octets"), F.coalesce(_byte("no", i), F.lit(0)).alias("no"))

        def of(h):
            left = F.aggregate(h["octets"], F.lit(0), lambda a, o: a.bitwiseOR(o)).bitwiseAND(F.bitwise_not(h["no"]))
            bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda b: one(left, b) == 1)

            def number(b):
                met = F.aggregate(h["octets"], F.lit(0), lambda n, o: n + one(o, b))
                return (F.lit(MOST) - met) * BITS + i * 8 + b
            return F.when(left != 0, F.transform(bits, number)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.array(held), of)[0]             # of one element: each byte is read once

    found = F.flatten(F.transform(F.sequence(F.lit(0), F.floor(F.col("last") / 8).cast("int")), rows))
    if combine == "all":
        found = F.filter(found, lambda x: x < (MOST + 1 - F.greatest(F.col("nShould"), F.lit(1))) * BITS)
    return F.slice(F.array_sort(found), 1, k)


def segment_top(tags: DataFrame, rules: DataFrame, k: int = PAGE_SIZE, combine: str = "any") -> DataFrame:
    """``(segment_id, rank, memberId, phone, matched)``: the best ``k`` rows of every segment of ``rules``.

    The order is that of :func:`segment_select`, so a segment's rows are those
    of ``segment_select(..., limit=k)``; all segments take one plan. A row's
    ``matched`` is the number of its segment's should bitmaps that hold it.
    Rows are numbered in the order of their members, so the bitmaps alone
    decide ties, and only the best rows are joined with the tag table. The
    bitmaps of a segment and a bucket are counted together and give ``k`` rows
    at most, so no task holds a row for each hit; each task hands on at most
    ``k`` rows of a segment's shard, each shard ``k`` to its segment. Rows
    without a member id take no part; a segment without rows has none here.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    held, rows = _clause_bitmaps(tags.where(F.col(KEY).isNotNull()), rules, combine, by_member=True)
    # The bitmaps are few bytes and much work: the tasks are as many as the table's, not as few as the bytes ask for.
    tasks = max(tags.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    met = held.repartition(tasks, "segment_id", "bucket").groupBy("segment_id", "bucket").agg(
        F.expr("collect_list(bitmap) filter (where not negated)").alias("bitmaps"),
        F.expr("bitmap_or_agg(bitmap) filter (where negated)").alias("no"),
        F.max("nShould").alias("nShould"), F.expr("max(last) filter (where not negated)").alias("last"))
    # Outer, as a plain explode is planned with a filter that works the array out once more.
    found = (met.select("segment_id", "bucket", "nShould", F.explode_outer(_best_of_bucket(k, combine)).alias("x"))
             .where("x is not null"))
    # A segment without should clauses has one that every member meets; it counts for nothing.
    matched = F.when(F.col("nShould") > 0, F.lit(MOST) - F.floor(F.col("x") / BITS)).otherwise(0).cast("int")
    hits = found.select("segment_id", ((F.col("bucket") - 1) * BITS + F.col("x") % BITS + 1).alias("n"), matched.alias("matched"))
    # Each partition of the table numbers its buckets from a multiple of SHARDS, so a hash deals them out.
    hits = hits.withColumn("shard", F.pmod(F.xxhash64(F.bitmap_bucket_number("n")), F.lit(SHARDS)))
    best = [F.desc("matched"), F.asc("n")]
    by_shard = Window.partitionBy("segment_id", "shard").orderBy(*best)
    by_segment = Window.partitionBy("segment_id").orderBy(*best)
    top = (hits.withColumn("place", F.row_number().over(by_shard)).where(F.col("place") <= k)
           .withColumn("rank", F.row_number().over(by_segment)).where(F.col("rank") <= k)
           .select("segment_id", "n", "matched", "rank"))
    return rows.select("n", KEY, "phone").join(top, "n").select("segment_id", "rank", KEY, "phone", "matched")


def segment_sizes(tags: DataFrame, rules: DataFrame, combine: str = "any") -> DataFrame:
    """``(segment_id, members)`` of every segment that has members.

    Counted on the bitmaps, without a row per member, where the tag table has
    one row a member; where members repeat, their rows are expanded first.
    """
    bitmaps, rows = _segment_bitmaps(tags, rules, combine)
    if rows.groupBy(KEY).count().where("count > 1").limit(1).count():
        return segment_bulk(tags, rules, combine).groupBy("segment_id").agg(F.count("*").alias("members"))
    both = bitmaps.select("segment_id", "bucket", "no", F.explode(F.array("yes", "no")).alias("b")).where("b is not null")
    per = both.groupBy("segment_id", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("b")).alias("either"),
                                                   F.max(F.coalesce(F.bitmap_count("no"), F.lit(0))).alias("none"))
    return (per.groupBy("segment_id").agg(F.sum(F.col("either") - F.col("none")).alias("members"))
            .where("members > 0"))
