"""Segment semantics (OR of should clauses, null under negation, types, arrays)."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from memberlens.functions.clauses import parse_clauses
from memberlens.operators import catalogue as CT
from memberlens.operators import segments as SG

TAG_SCHEMA = ("memberId long, phone string, sex int, channel int, subOpenId string, address long, "
              "regTime string, orderCount long, orderTime string, orderMoney double, "
              "favGoods array<long>, freeCouponTime string, couponTimes array<string>, "
              "chargeMoney double, overTime long, feedback long")

ROWS = [
    (1, "13800000001", 1, 1, "wx1", 1, "2020-01-01", 1, "2020-01-02", 100.0, [5, 6], "2020-01-03",
     ["2020-01-04"], 25.0, 900, 1),
    (2, "null", 2, 2, "null", -1, "2020-01-02", 3, "2020-01-05", 40.0, [], None, None, None, None, None),
    (3, "13800000003", -1, 2, None, 3, "2020-01-03", None, None, None, None, None, None, None, 4000, 4),
    (7, "13800000007", 1, 5, "wx7", 7, "2020-01-04", 2, "2020-01-04", 500.0, [19], "2020-01-01",
     ["2020-01-01", "2020-01-01"], 600.0, 1800, 3),
]


@pytest.fixture(scope="module")
def tags(spark):
    return spark.createDataFrame(ROWS, TAG_SCHEMA)


def ids(df):
    return sorted(r.memberId for r in df.collect())


def sel(tags, clauses, **kw):
    return ids(SG.segment_select(tags, clauses, **kw))


def test_or_of_should_clauses(tags):
    assert sel(tags, [{"name": "sex", "value": "1", "type": "match"},
                      {"name": "channel", "value": "2", "type": "match"}]) == [1, 2, 3, 7]


def test_not_match_keeps_null_field(tags):
    got = sel(tags, [{"name": "subOpenId", "value": "null", "type": "notMatch"}])
    assert got == [1, 3, 7]          # member 3 has a NULL subOpenId and is kept


def test_numeric_range_is_numeric_and_inclusive(tags):
    assert sel(tags, [{"name": "orderMoney", "value": "40-100", "type": "rangeBoth"}]) == [1, 2]
    assert sel(tags, [{"name": "orderCount", "value": "2", "type": "rangeGte"}]) == [2, 7]


def test_array_match_and_exists(tags):
    assert sel(tags, [{"name": "favGoods", "value": "6", "type": "match"}]) == [1]
    assert sel(tags, [{"name": "favGoods", "value": "", "type": "exists"}]) == [1, 7]
    assert sel(tags, [{"name": "couponTimes", "value": "2020-01-01", "type": "match"}]) == [7]


def test_case_insensitive_field_and_string_dates(tags):
    assert sel(tags, [{"name": "feedBack", "value": "3", "type": "match"}]) == [7]
    assert sel(tags, [{"name": "regTime", "value": "2020-01-03", "type": "rangeGte"}]) == [3, 7]


def test_no_clause_is_everyone(tags):
    assert sel(tags, []) == [1, 2, 3, 7]
    assert len(SG.segment_select(tags, [], limit=2).collect()) == 2


def test_order_by_matches_then_id(tags):
    rows = SG.segment_select(tags, [{"name": "sex", "value": "1", "type": "match"},
                                    {"name": "favGoods", "value": "19", "type": "match"}]).collect()
    assert [(r.memberId, r.matched) for r in rows] == [(7, 2), (1, 1)]


def test_combine_all(tags):
    assert sel(tags, [{"name": "sex", "value": "1", "type": "match"},
                      {"name": "channel", "value": "5", "type": "match"}], combine="all") == [7]


def test_bad_clauses_raise(tags):
    with pytest.raises(ValueError):
        parse_clauses([{"name": "sex", "value": "1", "type": "fuzzy"}])
    with pytest.raises(ValueError):
        SG.segment_select(tags, [{"name": "orderMoney", "value": "-5-10", "type": "rangeBoth"}])
    with pytest.raises(ValueError):
        SG.segment_select(tags, [{"name": "regTime", "value": "a-b", "type": "rangeBoth"}])


def test_clauses_from_page_json(tags):
    body = json.dumps({"selectedTags": json.dumps([{"name": "sex", "value": "2", "type": "match"},
                                                   {"name": "sex", "value": "2", "type": "match"}])})
    assert len(parse_clauses(body)) == 1
    assert sel(tags, body) == [2]


def test_export_lines(spark, tags, workdir):
    seg = SG.segment_select(tags, [{"name": "memberId", "value": "7", "type": "match"}])
    lines = SG.segment_export(seg, path=f"{workdir}/out")
    assert [r.line for r in lines.collect()] == ["[7,13800000007]"]
    import glob
    text = b"".join(open(p, "rb").read() for p in glob.glob(f"{workdir}/out/part-*")).decode()
    assert text == "[7,13800000007]\r\n"


def test_bulk_equals_select_per_segment(spark, tags):
    segs = {
        "a": [("sex", "1", "match"), ("channel", "2", "match")],
        "b": [("subOpenId", "null", "notMatch")],
        "c": [("orderMoney", "40-100", "rangeBoth"), ("feedback", "1", "notMatch")],
        "d": [("favGoods", "", "exists"), ("couponTimes", "2020-01-01", "match")],
        "e": [],
    }
    rules = spark.createDataFrame([(s, n, v, t) for s, cl in segs.items() for n, v, t in cl],
                                  "segment_id string, name string, value string, type string")
    for broadcast in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        got = SG.segment_bulk(tags, rules)
        by_seg = {}
        for r in got.collect():
            by_seg.setdefault(r.segment_id, []).append(r.memberId)
        for s, cl in segs.items():
            if not cl:
                continue
            expect = sel(tags, [{"name": n, "value": v, "type": t} for n, v, t in cl], limit=None)
            assert sorted(by_seg.get(s, [])) == expect, (s, broadcast)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def random_rules(seed, n):
    """Segments of a few clauses of every type over fields of every kind, with bounds that values hit exactly."""
    rng = random.Random(seed)
    money, day = ["0", "40", "40.0", "99.99", "100", "500.5", "1e3"], ["2020-01-0%d" % k for k in range(1, 7)]
    pool = [("orderMoney", money), ("chargeMoney", money), ("orderCount", ["0", "1", "2", "2.5", "3"]), ("regTime", day),
            ("favGoods", ["4", "5", "6", "19"]), ("couponTimes", day), ("sex", ["1", "2", "3"]), ("overTime", ["900", "1800"])]
    segs = {}
    for k in range(n):
        clauses = set()
        for _ in range(rng.randint(1, 4)):
            name, values = rng.choice(pool)
            kind = rng.choice(["match", "notMatch", "rangeGte", "rangeLte", "rangeBoth", "exists"])
            text = name in ("regTime", "couponTimes")
            if kind == "rangeBoth":
                kind, value = ("rangeGte", rng.choice(values)) if text else (kind, "-".join(rng.sample(values, 2)))
            else:
                value = "" if kind == "exists" else rng.choice(values)
            clauses.add((name, value, kind))
        segs[f"s{k}"] = sorted(clauses)
    return segs


@pytest.mark.parametrize("seed,combine,few", [(1, "any", True), (2, "all", True), (3, "any", False), (4, "all", False)])
def test_bitmaps_equal_select_for_random_rules(spark, tags, monkeypatch, seed, combine, few):
    """Members and sizes of 60 random segments, with rules broadcast or not, and with members of several rows."""
    if not few:
        monkeypatch.setattr(SG, "FEW_RULES", 0)
        monkeypatch.setattr(SG, "FEW_ROWS", 0)
    table = tags.unionByName(tags.withColumn("orderMoney", F.lit(None).cast("double"))) if seed % 2 else tags
    segs = random_rules(seed, 60)
    rules = spark.createDataFrame([(s, *c) for s, cl in segs.items() for c in cl],
                                  "segment_id string, name string, value string, type string")
    got = {}
    for r in SG.segment_bulk(table, rules, combine).collect():
        got.setdefault(r.segment_id, []).append(r.memberId)
    rows = table.collect()
    local = spark.createDataFrame(rows, table.schema)
    want = {}
    for s, cl in segs.items():
        keep, _ = SG.segment_columns(table.schema, [dict(zip(("name", "value", "type"), c)) for c in cl], combine)
        want[s] = keep.cast("int")
    flags = local.select("memberId", *[c.alias(s) for s, c in want.items()]).collect()
    expect = {s: sorted({f.memberId for f in flags if f[s]}) for s in segs}
    assert {s: sorted(m) for s, m in got.items()} == {s: m for s, m in expect.items() if m}
    sizes = {r.segment_id: r.members for r in SG.segment_sizes(table, rules, combine).collect()}
    assert sizes == {s: len(m) for s, m in expect.items() if m}


def test_a_value_joins_only_the_ranges_that_hold_it(spark):
    """10,000 disjoint ranges: as many hits as values, each found under one node of the interval tree."""
    table = spark.range(1, 3001).selectExpr("id as memberId", "cast(id as string) as phone", "id * 10 as orderCount")
    rules = spark.range(10_000).selectExpr("cast(id as string) as segment_id", "'orderCount' as name",
                                           "concat(id * 3, '-', id * 3 + 2) as value", "'rangeBoth' as type")
    got = SG.segment_bulk(table, rules)
    assert got.count() == 2999 and got.where("cast(segment_id as long) <> memberId * 10 div 3").count() == 0


BIG = 2**53


def test_whole_numbers_are_exact(spark):
    """Neighbours beyond 2**53 are told apart by every clause type, in select, size, bulk and counts."""
    rows = [(BIG + k, f"p{k}", [BIG + k, 5], BIG / 1) for k in range(3)]
    big = spark.createDataFrame(rows, "memberId long, phone string, favGoods array<long>, orderMoney double")
    cases = {("memberId", str(BIG + 1), "match"): [1], ("memberId", str(BIG + 1), "notMatch"): [0, 2],
             ("memberId", str(BIG + 1), "rangeGte"): [1, 2], ("memberId", f"{BIG + 0}.5", "rangeGte"): [1, 2],
             ("memberId", f"{BIG}-{BIG + 1}", "rangeBoth"): [0, 1], ("favGoods", str(BIG + 2), "match"): [2],
             ("memberId", "1e40", "rangeLte"): [0, 1, 2], ("memberId", "2.5", "match"): []}
    rules = spark.createDataFrame([(str(k), *c) for k, c in enumerate(cases)],
                                  "segment_id string, name string, value string, type string")
    bulk = SG.segment_bulk(big, rules).collect()
    counts = {tuple(r[2:5]): r[5] for r in CT.tag_counts(big, [("g", "l", *c) for c in cases]).collect()}
    for k, (c, want) in enumerate(cases.items()):
        clause = [dict(zip(("name", "value", "type"), c))]
        want = [BIG + x for x in want]
        assert sel(big, clause) == want, c
        assert sorted(r.memberId for r in bulk if r.segment_id == str(k)) == want, c
        assert counts[c] == SG.segment_size(big, clause).first().members == len(want)


def test_one_meaning_for_any_number_of_rules(spark):
    """Several rows per member: the same members for a few rules, for 501, and for thousands, and as select finds."""
    from memberlens.operators import tags as TG
    from memberlens.sources import fixtures as FX
    from tests.conftest import SF_SMALL
    table = TG.user_tag(FX.load(spark, SF_SMALL, *FX.SHOP_TABLE_NAMES)).repartition(8)
    clauses = [("freeCouponTime", "2024-01-05", "notMatch"), ("sex", "1", "match")]
    want = sorted(set(sel(table, [dict(zip(("name", "value", "type"), c)) for c in clauses])))
    mine = [("mine", *c) for c in clauses]
    for n in (0, 499, 20_000):
        more = [(f"s{k}", "orderMoney", f"{k}-{k + 1}", "rangeBoth") if n < 1000 else (f"s{k}", "memberId", str(k), "match")
                for k in range(n)]
        rules = spark.createDataFrame(mine + more, "segment_id string, name string, value string, type string")
        got = SG.segment_bulk(table, rules).filter("segment_id = 'mine'").collect()
        assert sorted(r.memberId for r in got) == want


@pytest.mark.parametrize("rule", [("sex", "abc", "match"), ("regTime", "1-2", "rangeBoth"), ("orderMoney", "5", "rangeBoth"),
                                  ("sex", "1", "fuzzy"), ("nothing", "1", "match"), ("orderMoney", "nan", "rangeGte"),
                                  ("orderMoney", "-5-10", "rangeBoth")])
def test_bulk_refuses_what_select_refuses(spark, tags, rule):
    with pytest.raises((ValueError, KeyError)):
        SG.segment_select(tags, [dict(zip(("name", "value", "type"), rule))])
    with pytest.raises(ValueError):
        SG.segment_bulk(tags, spark.createDataFrame([("a", *rule)],
                                                    "segment_id string, name string, value string, type string"))


def test_a_limit_is_asked_for(tags):
    with pytest.raises(ValueError):
        SG.segment_select(tags, [], limit=0)


def test_tag_counts_equal_single_tag_segments(spark, tags):
    cat = CT.tag_catalogue_rows("2020-01-05")
    assert len(cat) == 77
    counts = {(r.name, r.value, r.type): r.memberCount for r in CT.tag_counts(tags, cat).collect()}
    for (_, _, n, v, t) in cat[:20] + cat[-8:]:
        expect = SG.segment_size(tags, [{"name": n, "value": v, "type": t}]).first().members
        assert counts[(n, v, t)] == expect


TOP_SEGMENTS = {
    "two": [("sex", "1", "match"), ("channel", "2", "match"), ("orderCount", "3", "rangeGte")],
    "some": [("orderMoney", "100-300", "rangeBoth"), ("favGoods", "6", "match"), ("subOpenId", "null", "notMatch"),
             ("overTime", "500", "rangeLte")],
    "no_should": [("subOpenId", "null", "notMatch"), ("address", "3", "notMatch")],
    "all_of_them": [("memberId", "", "exists")],
    "none": [("memberId", "-5", "match")],
}


@pytest.mark.parametrize("combine", ["any", "all"])
def test_top_rows_of_many_segments(spark, combine):
    """For each rule set the rows, places and counts of ``segment_select(limit=k)``, whatever the order of the table."""
    r = random.Random(5)
    pick = lambda *xs: r.choice(xs)
    made = [(i if i % 50 else None, f"1{i}", pick(1, 2, -1, None), pick(1, 2, 3), pick("null", "wx", None), pick(1, 3, 5), None,
             pick(1, 2, 3, 4, None), None, float(r.randrange(500)), pick([], [5, 6], [6, 6], None), None, None, None,
             pick(100, 500, 900, None), None) for i in range(1, 3001)]
    r.shuffle(made)
    table = spark.createDataFrame(made, TAG_SCHEMA).repartition(6)
    rules = spark.createDataFrame([(s, *c) for s, cs in TOP_SEGMENTS.items() for c in cs],
                                  "segment_id string, name string, value string, type string")
    known = table.where("memberId is not null")
    got = {}
    for row in SG.segment_top(table, rules, 40, combine).collect():
        got.setdefault(row.segment_id, []).append((row["rank"], row.memberId, row.phone, row.matched))
    assert "none" not in got and len(got) == 4
    for segment, rows in got.items():
        clauses = [dict(zip(("name", "value", "type"), c)) for c in TOP_SEGMENTS[segment]]
        want = SG.segment_select(known, clauses, combine, limit=40).collect()
        assert sorted(rows) == [(i, *w) for i, w in enumerate(want, 1)]
    with pytest.raises(ValueError):
        SG.segment_top(table, rules, 0)
    assert SG.segment_top(table.limit(0), rules, 3).count() == 0


def test_top_rows_join_only_the_best(spark, tags):
    """Each task limits its rows of a segment before they are shuffled, and the tag table meets only what is left."""
    rules = spark.createDataFrame([("a", "sex", "1", "match")], "segment_id string, name string, value string, type string")
    plan = SG.segment_top(tags, rules, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def _rows_of_segments(plan):
    """The rows that each node of an executed plan made, of those nodes that give a segment."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        below = [plan.executedPlan()]
    elif "QueryStage" in name or name == "ReusedExchange":
        below = [plan.plan() if "QueryStage" in name else plan.child()]
    else:
        below = [plan.children().apply(i) for i in range(plan.children().size())]
    made = plan.metrics().get("numOutputRows")
    if made.isDefined() and "segment_id" in plan.output().mkString(","):
        yield name, made.get().value()
    for p in below:
        yield from _rows_of_segments(p)


def test_top_rows_without_a_row_for_each_hit(spark):
    """Three buckets of members: no node makes a row of a segment for each hit, and the best rows are those of select."""
    n = 70_000
    made = {"memberId": F.col("id"), "phone": F.concat(F.lit("1"), F.col("id")), "sex": F.col("id") % 5, "channel": F.col("id") % 5}
    table = spark.range(1, n + 1, numPartitions=3).select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], TAG_SCHEMA).schema])
    segments = {"all": [("memberId", "", "exists"), ("sex", "1", "match"), ("channel", "1", "match")],
                "most": [("sex", "0", "rangeGte"), ("channel", "3", "rangeGte"), ("sex", "2", "notMatch")],
                "few": [("memberId", str(n - 3), "rangeGte")], "no_should": [("sex", "1", "notMatch")]}
    rules = spark.createDataFrame([(s, *c) for s, cs in segments.items() for c in cs],
                                  "segment_id string, name string, value string, type string")
    for k in (4, 33_000):                                # fewer and more than a bucket has
        top = SG.segment_top(table, rules, k)
        got = {}
        for row in top.collect():
            got.setdefault(row.segment_id, []).append((row["rank"], row.memberId, row.phone, row.matched))
        for segment, rule in segments.items():
            want = SG.segment_select(table, [dict(zip(("name", "value", "type"), c)) for c in rule], limit=k).collect()
            assert sorted(got[segment]) == [(i, *w) for i, w in enumerate(want, 1)], segment
        if k == 4:
            made = list(_rows_of_segments(top._jdf.queryExecution().executedPlan()))
            assert made and max(rows for _, rows in made) < 300, made


# ----------------------------------------------------------------- property test

def _py_clause(row, name, value, typ):
    key = {k.lower(): k for k in row}[name.lower()]
    x = row[key]
    if typ == "exists":
        return x is not None and (not isinstance(x, list) or len(x) > 0)
    if x is None:
        return False
    vals = x if isinstance(x, list) else [x]
    for e in vals:
        if isinstance(e, (int, float)):
            if typ == "rangeBoth":
                lo, hi = (float(p) for p in value.split("-"))
                ok = lo <= e <= hi
            else:
                v = float(value)
                ok = {"match": e == v, "notMatch": e == v, "rangeGte": e >= v, "rangeLte": e <= v}[typ]
        else:
            ok = {"match": e == value, "notMatch": e == value, "rangeGte": e >= value,
                  "rangeLte": e <= value}[typ]
        if ok:
            return True
    return False


def _py_segment(rows, clauses):
    out = []
    for r in rows:
        should = [c for c in clauses if c[2] != "notMatch"]
        neg = [c for c in clauses if c[2] == "notMatch"]
        keep = any(_py_clause(r, *c) for c in should) if should else True
        keep = keep and not any(_py_clause(r, *c) for c in neg)
        if keep:
            out.append(r["memberId"])
    return sorted(out)


CLAUSE = st.one_of(
    st.tuples(st.sampled_from(["sex", "channel", "feedback", "orderCount"]),
              st.sampled_from(["1", "2", "3", "-1", "5"]), st.sampled_from(["match", "notMatch", "rangeGte", "rangeLte"])),
    st.tuples(st.sampled_from(["orderMoney", "chargeMoney", "overTime"]),
              st.sampled_from(["0-50", "30-600", "100-5000"]), st.just("rangeBoth")),
    st.tuples(st.sampled_from(["subOpenId", "phone"]), st.sampled_from(["null", "wx1"]),
              st.sampled_from(["match", "notMatch"])),
    st.tuples(st.sampled_from(["favGoods", "couponTimes", "freeCouponTime", "feedback"]),
              st.just(""), st.just("exists")),
    st.tuples(st.just("favGoods"), st.sampled_from(["5", "6", "19"]), st.sampled_from(["match", "notMatch"])),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(CLAUSE, max_size=4))
def test_segment_matches_python_model(tags, clauses):
    rows = [r.asDict() for r in tags.collect()]
    # duplicates are removed by the parser, as the page does
    uniq = list(dict.fromkeys(clauses))
    got = sel(tags, [{"name": n, "value": v, "type": t} for n, v, t in uniq], limit=None)
    assert got == _py_segment(rows, uniq)
