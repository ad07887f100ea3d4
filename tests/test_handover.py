"""Snapshot then log: any interleaving of chunks and changes gives the state of the log alone."""

import random
import types

import pytest
from pyspark.sql import functions as F

from memberlens.functions import intervals
from memberlens.functions.intervals import interval_numbers
from memberlens.operators import handover as HO

ENVELOPE = ("operation string, data map<string,string>, database string, table string, timestamp string, position long")


def make_log(rng, n, keys, table="t", first=1):
    """A log over a few keys, and the state after each position."""
    log, states, state = [], [{}], {}
    for p in range(first, first + n):
        k = str(rng.choice(keys))
        if k in state and rng.random() < 0.3:
            log.append(("delete", state.pop(k), "db", table, str(1000 + p), p))
        else:
            op = "update" if k in state else "create"
            state[k] = {"id": k, "v": str(p)}
            log.append((op, state[k], "db", table, str(1000 + p), p))
        states.append(dict(state))
    return log, states


def snapshot(rng, states, bounds, less, table="t"):
    """Chunks read at a random moment between their marks, in a random order of time."""
    rows, marks = [], []
    for c, (low, high) in enumerate(zip([None, *bounds], [*bounds, None])):
        before, seen, after = sorted(rng.randrange(len(states)) for _ in range(3))
        marks.append(("db", table, c, low, high, before, after))
        for k, data in states[seen].items():
            if (low is None or not less(k, low)) and (high is None or less(k, high)):
                rows.append(("db", table, c, data))
    return rows, marks


@pytest.mark.parametrize("seed,numeric", [(1, True), (2, True), (3, False), (4, True)])
def test_any_interleaving_gives_the_state_of_the_log(spark, seed, numeric):
    rng = random.Random(seed)
    keys = [-7, -1, 0, 2, 9, 10, 11, 40, 100, 2**62] if numeric else ["", "a", "a b", "b", "ß", "zz", "日本", "é"]
    bounds = ["-1", "5", "10", "41"] if numeric else ["a", "b", "z"]
    less = (lambda a, b: int(a) < int(b)) if numeric else (lambda a, b: a.encode() < b.encode())
    log, states = make_log(rng, 120, keys)
    rows, marks = snapshot(rng, states, bounds, less)
    other, other_states = make_log(rng, 30, keys, "u")                  # a second table with ranges of its own
    more, more_marks = snapshot(rng, other_states, bounds[:1], less, "u")
    third, _ = make_log(rng, 20, keys, "never read")
    bad = [("create", {"v": "no key"}, "db", "t", "1", 500), ("create", None, "db", "t", "1", 501)]
    env = spark.createDataFrame(log + other + third + bad, ENVELOPE)
    chunk = spark.createDataFrame(rows + more + [("db", "t", 0, {"v": "no key"})],
                                  "database string, table string, chunk long, data map<string,string>")
    mark = spark.createDataFrame(marks + more_marks, HO.MARKS_SCHEMA)
    got = HO.snapshot_then_log(chunk, mark, env, numeric=numeric)
    as_rows = lambda df: sorted((r.table, r.id, sorted(r.data.items())) for r in df.collect())
    want = as_rows(HO.state_at_end(env))
    assert as_rows(HO.state_at_end(got)) == want
    assert [w for w in want if w[0] == "t"] == sorted(("t", k, sorted(d.items())) for k, d in states[-1].items())
    # Nothing twice: one read a key, and each change in the reads or after them.
    reads = got.where("operation = 'read'").collect()
    assert len({(r.table, r.data["id"]) for r in reads}) == len(reads)
    in_chunk = lambda k: next(m for m in marks if (m[3] is None or not less(k, m[3])) and (m[4] is None or less(k, m[4])))
    after = sorted(r.position for r in got.where("operation <> 'read' and table = 't'").collect())
    assert after == sorted([c[5] for c in log if c[5] > in_chunk(c[1]["id"])[6]] + [500, 501])
    assert {(r.data["id"], r.data["v"]) for r in reads if r.table == "t"} == {
        (k, d["v"]) for m in marks for k, d in states[m[6]].items() if in_chunk(k) is m}


def test_gap_between_ranges_and_empty_inputs(spark):
    env = spark.createDataFrame([("create", {"id": "5"}, "db", "t", "1", 1), ("create", {"id": "15"}, "db", "t", "1", 2)], ENVELOPE)
    mark = spark.createDataFrame([("db", "t", 0, None, "10", 5, 6)], HO.MARKS_SCHEMA)
    chunk = spark.createDataFrame([("db", "t", 0, {"id": "5"})], "database string, table string, chunk long, data map<string,string>")
    got = HO.snapshot_then_log(chunk, mark, env).collect()
    assert sorted((r.operation, r.data["id"], r.position) for r in got) == [("create", "15", 2), ("read", "5", 6)]
    assert HO.snapshot_then_log(chunk.limit(0), mark.limit(0), env).count() == 2
    assert HO.snapshot_then_log(chunk, mark, env.limit(0)).count() == 1


def test_take_snapshot_goes_on_where_it_stopped(spark, workdir):
    """A source whose rows change while it is read; a run that fails in the middle and is started again."""
    rng = random.Random(9)
    log, states = make_log(rng, 400, range(100))
    clock = types.SimpleNamespace(at=100, fail=True)

    def position():
        return clock.at

    def read_range(low, high):
        clock.at += 13
        if clock.at > 180 and clock.fail:
            raise OSError("source gone")
        seen = [(int(k), d["v"]) for k, d in states[clock.at].items()
                if (low is None or int(k) >= int(low)) and (high is None or int(k) < int(high))]
        clock.at += 7
        return spark.createDataFrame(seen, "id long, v string")

    whole = spark.createDataFrame([(int(k),) for k in states[100]], "id long")
    ranges = HO.key_ranges(whole, "id", chunk_rows=10)
    assert len(ranges) >= 4 and ranges[0][0] is None and ranges[-1][1] is None
    with pytest.raises(OSError):
        HO.take_snapshot(spark, read_range, position, ranges, workdir, "db", "t")
    done = {r.chunk: r.high_mark for r in HO.read_marks(spark, workdir).collect()}
    clock.fail = False
    marks = HO.take_snapshot(spark, read_range, position, ranges, workdir, "db", "t")
    found = {r.chunk: r.high_mark for r in marks.collect()}
    assert len(found) == len(ranges) and done and all(found[c] == m for c, m in done.items())
    env = spark.createDataFrame(log, ENVELOPE)
    got = HO.snapshot_then_log(HO.read_snapshot_rows(spark, workdir), marks, env)
    state = {r.id: r.data["v"] for r in HO.state_at_end(got).collect()}
    assert state == {k: d["v"] for k, d in states[-1].items()}


def test_log_after_snapshot_on_a_stream(spark, workdir):
    log, _ = make_log(random.Random(5), 60, range(20))
    env = spark.createDataFrame(log, ENVELOPE)
    env.write.parquet(f"{workdir}/log")
    marks = spark.createDataFrame([("db", "t", 0, None, "8", 3, 10), ("db", "t", 1, "8", None, 20, 30)], HO.MARKS_SCHEMA)
    stream = HO.log_after_snapshot(spark.readStream.schema(ENVELOPE).parquet(f"{workdir}/log"), marks)
    q = (stream.writeStream.format("parquet").option("path", f"{workdir}/out")
         .option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.position for r in spark.read.parquet(f"{workdir}/out").collect())
    assert got == sorted(c[5] for c in log if c[5] > (10 if int(c[1]["id"]) < 8 else 30))


@pytest.mark.parametrize("kind,values", [
    ("long", [5, -3, 5, 2**60, 0, None]), ("string", ["b", "", "ä", "a", None]),
    ("decimal(38,10)", [1, 2, 3, 10**27]), ("double", [0.5, -1.0, 1e300, float("inf")])])
@pytest.mark.parametrize("few", [200_000, 0])
def test_interval_numbers(spark, monkeypatch, kind, values, few):
    """Against a plain count, with the parts broadcast and joined by a shuffle."""
    from decimal import Decimal
    monkeypatch.setattr(intervals, "FEW", few)
    if kind.startswith("decimal"):
        values = [Decimal(v) for v in values]
    cuts = spark.createDataFrame([(v,) for v in values], f"cut {kind}")
    probe = spark.createDataFrame([(v,) for v in values] + [(None,)], f"x {kind}")
    got = interval_numbers(cuts)(probe.withColumn("y", F.lit(1)), F.col("x"), "n").collect()
    known = {v for v in values if v is not None}
    size = (lambda v: v.encode()) if kind == "string" else (lambda v: v)
    assert len(got) == len(values) + 1
    assert all(r.n == (None if r.x is None else sum(size(c) <= size(r.x) for c in known)) for r in got)
    assert [r.n for r in interval_numbers(cuts.limit(0))(probe, F.col("x"), "n").collect() if r.x is not None] == [
        0] * sum(v is not None for v in values)


def test_many_cuts(spark):
    """Thousands of cuts: a value costs one row and the right number."""
    cuts = spark.range(20000).selectExpr("id * 3 as cut")
    probe = spark.range(0, 70000, 7).selectExpr("id as x")
    got = interval_numbers(cuts)(probe, F.col("x"), "n")
    assert got.count() == 10000 and got.where("n <> least(x div 3 + 1, 20000)").count() == 0
