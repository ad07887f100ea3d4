"""Change events: envelope, typed rows, dedup, current state, and the streams."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from memberlens.operators import changes as CH
from memberlens.sources import changes as CS
from memberlens.streaming import cdc as ST

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC in ms


def rec(table, op, ts_ms, before=None, after=None, server="mysql", db="ecommerce"):
    return json.dumps({"topic": f"{server}.{db}.{table}", "op": op, "ts_ms": ts_ms,
                       "before": before, "after": after})


def order(i, create_time, status=1, amount=None):
    return {"id": i, "user_id": 100 + i, "create_time": create_time, "operate_time": None,
            "province_id": 3, "order_status": status, "total_amount": amount}


def lines_df(spark, lines):
    return CS.parse_change_json(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_envelope_operations_and_delete(spark):
    raw = lines_df(spark, [
        rec("order_info", "c", T0, after=order(1, "2024-01-01 00:00:00", amount=9.5)),
        rec("order_info", "u", T0 + 1, before=order(1, "2024-01-01 00:00:00"),
            after=order(1, "2024-01-01 00:00:00", status=2)),
        rec("order_info", "d", T0 + 2, before=order(1, "2024-01-01 00:00:00", status=2)),
        rec("user_info", "r", T0 + 3, after={"id": 5, "name": "x"}),
    ])
    env = CH.cdc_envelope(raw).collect()
    assert [e.operation for e in env] == ["create", "update", "delete", "read"]
    assert [e.table for e in env] == ["order_info"] * 3 + ["user_info"]
    assert env[0].database == "ecommerce" and env[0].timestamp == str(T0)
    assert env[0].data["total_amount"] == "9.5" and env[0].data["operate_time"] is None
    assert "operate_time" in env[0].data           # null value kept
    assert env[2].data["order_status"] == "2"      # delete uses the before image
    routed = CH.cdc_route_topics(CH.cdc_envelope(raw)).collect()
    assert {r.topic for r in routed} == {"order_info", "user_info"}
    assert json.loads(routed[0].value)["operate_time"] is None


def test_typed_rows_and_partitions(spark):
    raw = lines_df(spark, [
        rec("order_info", "c", T0, after=order(1, "2024-01-01 00:30:00", amount=1.25)),
        rec("order_info", "c", T0, after=order(2, "not a time")),
        rec("order_info", "c", T0, after={"id": "x7", "order_status": "2"}),
    ])
    rows = CH.ods_partition_columns(CH.cdc_typed_rows(CH.cdc_envelope(raw))).collect()
    assert (rows[0].dt, rows[0].hr, rows[0].total_amount, rows[0].op) == ("2024-01-01", "00", 1.25, "create")
    assert rows[1].dt is None and rows[1].hr is None
    assert rows[2].id is None and rows[2].order_status == 2   # bad value -> NULL, not a failure


def test_current_state_and_dedup(spark):
    a = rec("order_info", "c", T0, after=order(1, "t"))
    raw = lines_df(spark, [
        a, a,                                                     # redelivered
        rec("order_info", "u", T0 + 5, after=order(1, "t", status=3)),
        rec("order_info", "c", T0, after=order(2, "t")),
        rec("order_info", "d", T0 + 9, before=order(2, "t")),
    ])
    env = CH.cdc_envelope(raw)
    assert CH.cdc_dedup(env).count() == 4
    state = {r.id: (r.operation, r.data["order_status"]) for r in CH.cdc_current_state(env).collect()}
    assert state == {"1": ("update", "3")}


def _write_batches(folder, batches):
    """One file per batch, modification times increasing (the file source's order)."""
    os.makedirs(folder, exist_ok=True)
    now = time.time() - 1000
    for i, lines in enumerate(batches):
        p = os.path.join(folder, f"batch-{i:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (now + i * 10, now + i * 10))


def _ods_run(spark, src, out, ckpt, delay="61 minutes"):
    raw = CS.read_change_files(spark, src, stream=True, max_files_per_trigger=1)
    rows = CH.ods_partition_columns(CH.cdc_watermark(
        CH.cdc_typed_rows(CH.cdc_envelope(raw), table="order_info")))
    q = ST.ods_stream(rows, out, checkpoint=ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    c = ST.partition_commit_stream(spark, out, checkpoint=ckpt + "-commit",
                                   trigger={"availableNow": True}, commit_delay=delay)
    c.awaitTermination()


def test_ods_stream_keeps_late_rows_and_commits(spark, workdir):
    h = 3600 * 1000
    batches = [
        [rec("order_info", "c", T0 + 30 * 60 * 1000, after=order(1, "2024-01-01 00:30:00"))],
        [rec("order_info", "c", T0 + 2 * h, after=order(2, "2024-01-01 02:00:00")),
         rec("user_info", "c", T0 + 2 * h, after={"id": 9})],
        # 3 s late (inside the 5 s lateness) and 1 h late: both must be written.
        [rec("order_info", "c", T0 + 2 * h - 3000, after=order(3, "2024-01-01 01:59:57")),
         rec("order_info", "c", T0 + h - 1000, after=order(4, "2024-01-01 00:59:59")),
         rec("order_info", "c", T0 + 2 * h, after=order(5, "garbage"))],
        [rec("order_info", "c", T0 + 3 * h + 2 * 60 * 1000, after=order(6, "2024-01-01 03:02:00"))],
    ]
    src, out, ckpt = f"{workdir}/src", f"{workdir}/ods", f"{workdir}/ckpt"
    _write_batches(src, batches)
    _ods_run(spark, src, out, ckpt)
    ods = ST.read_ods(spark, out)
    got = {r.id: (r.dt, r.hr) for r in ods.collect()}
    assert got == {1: ("2024-01-01", "00"), 2: ("2024-01-01", "02"), 3: ("2024-01-01", "01"),
                   4: ("2024-01-01", "00"), 5: (None, None), 6: ("2024-01-01", "03")}
    # watermark = 03:02:00 - 5 s; hour h is complete once h + 61 min <= watermark
    commits = {(r.dt, r.hr) for r in ST.read_commits(spark, out).collect()}
    # (02:00 + 61 min = 03:01 <= 03:01:55; 03:00 + 61 min is not)
    assert commits == {("2024-01-01", "00"), ("2024-01-01", "01"), ("2024-01-01", "02")}
    assert os.path.exists(f"{out}/dt=2024-01-01/hr=00/_SUCCESS")
    assert not os.path.exists(f"{out}/dt=2024-01-01/hr=03/_SUCCESS")
    # Restart from the checkpoint: nothing is read or written twice.
    _ods_run(spark, src, out, ckpt)
    assert ST.read_ods(spark, out).count() == 6


def test_late_rows_open_a_new_version_of_an_hour(spark, workdir):
    """A reader pinned to a version sees the same rows before and after late ones come; the last version has all."""
    h, src, out = 3600 * 1000, f"{workdir}/src", f"{workdir}/ods"
    os.makedirs(src)

    def put(name, lines):
        with open(f"{src}/{name}.json", "w") as f:
            f.write("\n".join(lines))

    at = lambda i, ms, t: rec("order_info", "c", ms, after=order(i, t))
    put("a", [at(1, T0, "2024-01-01 00:10:00"), at(2, T0 + 4 * h, "2024-01-01 04:00:00")])
    _ods_run(spark, src, out, f"{workdir}/ckpt")
    pinned = lambda v: sorted(r.id for r in ST.read_ods_as_marked(spark, out, v).collect())
    assert pinned(1) == pinned(None) == [1]
    put("b", [at(3, T0 + 1, "2024-01-01 00:20:00"), at(4, T0 + 2, "2024-01-01 01:20:00"), at(5, T0, "no time")])
    _ods_run(spark, src, out, f"{workdir}/ckpt")
    assert pinned(1) == [1, 4] and pinned(None) == pinned(2) == [1, 3, 4]
    put("c", [at(6, T0 + 3, "2024-01-01 00:30:00"), at(7, T0 + 6 * h, "2024-01-01 06:00:00")])
    _ods_run(spark, src, out, f"{workdir}/ckpt")
    assert pinned(1) == [1, 2, 4] and pinned(2) == [1, 2, 3, 4] and pinned(None) == [1, 2, 3, 4, 6]
    marks = {(r.hr, r.version): r.rows for r in ST.read_commit_versions(spark, out).collect()}
    assert marks == {("00", 1): 1, ("00", 2): 1, ("00", 3): 1, ("01", 1): 1, ("04", 1): 1}
    assert {r.hr: (r.version, r.rows) for r in ST.read_commits(spark, out).collect()} == {
        "00": (3, 3), "01": (1, 1), "04": (1, 1)}


def test_many_commit_batches_and_replays(spark, workdir):
    """The folders that a batch lists stay as few however many batches there were; a replayed batch changes nothing."""
    out, seen = f"{workdir}/ods", []
    for n in range(40):
        hour = n // 4
        rows = [("2024-01-01", f"{hour:02d}", str(T0 + 3600_000 * hour + n), f"f{n}")]
        if n % 10 == 9:
            rows.append(("2024-01-01", "00", str(T0), f"late{n}"))
        batch = spark.createDataFrame(rows, "dt string, hr string, timestamp string, file string")
        done = ST.commit_batch(batch, n, out, success_file=False)
        if n in (7, 20, 39):
            assert ST.commit_batch(batch, n, out, success_file=False) == done
        seen += done
        assert len(os.listdir(f"{out}/_ods_meta/hours")) <= 2
    assert len(seen) == len(set(seen)) == ST.read_commit_versions(spark, out).count()
    files = {f for r in ST.read_commit_versions(spark, out).collect() for f in r.files}
    assert files == {f"f{n}" for n in range(32)} | {"late9", "late19", "late29", "late39"}
    assert {(r.hr, r.version) for r in ST.read_commits(spark, out).collect() if r.hr in ("00", "01")} == {("00", 5), ("01", 1)}


def test_ods_reference_commit_delay(spark, workdir):
    batches = [[rec("order_info", "c", T0 + 90 * 1000, after=order(1, "2024-01-01 00:01:30"))]]
    src, out = f"{workdir}/src", f"{workdir}/ods"
    _write_batches(src, batches)
    _ods_run(spark, src, out, f"{workdir}/ckpt", delay="1 minute")
    # 00:00 + 1 min <= 00:01:30 - 5 s: the hour is marked after its first minute.
    assert {(r.dt, r.hr) for r in ST.read_commits(spark, out).collect()} == {("2024-01-01", "00")}


def test_route_topics_file_sink(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(src, [[rec("order_info", "c", T0, after=order(1, "t")),
                          rec("user_info", "c", T0, after={"id": 2, "name": None})]])
    env = CH.cdc_envelope(CS.read_change_files(spark, src, stream=True))
    q = ST.route_topics_stream(env, path=f"{workdir}/topics", checkpoint=f"{workdir}/ck",
                               trigger={"availableNow": True})
    q.awaitTermination()
    back = spark.read.schema("value string, topic string").json(f"{workdir}/topics")
    topics = {r.topic for r in back.collect()}
    assert topics == {"order_info", "user_info"}


def test_dedup_keeps_distinct_changes(spark):
    """Same row and millisecond with other data, and the same table in another database, are other changes."""
    a = rec("order_info", "u", T0, after=order(1, "t"))
    raw = lines_df(spark, [a, a, rec("order_info", "u", T0, after=order(1, "t", status=2)),
                           rec("order_info", "u", T0, after=order(1, "t"), db="other")])
    assert CH.cdc_dedup(CH.cdc_envelope(raw)).count() == 3
    placed = CS.parse_change_json(spark.createDataFrame([(a, 0), (a, 1), (a, 1)], "value string, offset long"))
    assert CH.cdc_dedup(CH.cdc_envelope(placed, keep=("offset",)), position=("offset",)).count() == 2


def test_stream_dedup_drops_no_late_row(spark, workdir):
    """250 changes out of order in their event times, 50 of them delivered again: 250 come out."""
    import random
    rng = random.Random(4)
    once = [rec("order_info", "c", T0 + 60_000 * k, after=order(k, "t")) for k in range(250)]
    rng.shuffle(once)
    src = f"{workdir}/src"
    _write_batches(src, [once[:80], once[80:170] + once[:30], once[170:] + once[100:120]])
    env = CH.cdc_envelope(CS.read_change_files(spark, src, stream=True, max_files_per_trigger=1))
    q = (CH.cdc_dedup(env).select(F.to_json("data").alias("value")).writeStream.format("parquet")
         .option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{workdir}/out")
    assert got.count() == got.distinct().count() == 250


def test_stream_dedup_state_survives_restarts_and_expires(spark, workdir):
    """Files and changes two hours older than the last ones are kept over three restarts; old keys leave the state."""
    src, out = f"{workdir}/src", f"{workdir}/out"
    part = [[rec("order_info", "c", T0 + 1000 * k - 7_200_000 * p, after=order(1000 * p + k, "t")) for k in range(50)]
            for p in range(4)]
    removed = 0
    for p in range(4):
        os.makedirs(src, exist_ok=True)
        for n, lines in enumerate((part[p], part[p - 1][:20] if p else [])):
            name = f"{src}/f{p}{n}.json"
            with open(name, "w") as f:
                f.write("\n".join(lines))
            os.utime(name, (time.time() - 7200 * (p + 1),) * 2)     # each file is older than all before it
        env = CH.cdc_envelope(CS.read_change_files(spark, src, stream=True, max_files_per_trigger=1))
        q = (CH.cdc_dedup(env, delay="2 hours").select(F.to_json("data").alias("value")).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        ops = [o for b in q.recentProgress for o in b["stateOperators"]]
        assert all(o["numRowsDroppedByWatermark"] == 0 for o in ops)
    got = spark.read.parquet(out)
    assert got.count() == got.distinct().count() == 200
    # With a delay that passes, the same keys leave the state.
    env = CH.cdc_envelope(CS.read_change_files(spark, src, stream=True, max_files_per_trigger=1))
    q = (CH.cdc_dedup(env, delay="1 millisecond").select(F.to_json("data").alias("value")).writeStream.format("parquet")
         .option("path", f"{workdir}/short").option("checkpointLocation", f"{workdir}/ck2")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    ops = [o for b in q.recentProgress for o in b["stateOperators"]]
    assert sum(o["numRowsRemoved"] for o in ops) >= 150 and ops[-1]["numRowsTotal"] <= 60


def test_streams_go_on_after_a_restart_with_default_arguments(spark, workdir):
    """Three starts over a growing source: every row once, in the ODS folder, the topics and the state."""
    src, now = f"{workdir}/src", {"availableNow": True}
    for start in range(3):
        batch = [rec("order_info", "c", T0 + 1000 * k, after=order(k, "2024-01-01 00:00:00"))
                 for k in range(50 * start, 50 * start + 50)]
        os.makedirs(src, exist_ok=True)
        with open(f"{src}/b{start}.json", "w") as f:
            f.write("\n".join(batch) + "\n")
        env = CH.cdc_envelope(CS.read_change_files(spark, src, stream=True))
        rows = CH.ods_partition_columns(CH.cdc_typed_rows(env, table="order_info"))
        ST.ods_stream(rows, f"{workdir}/ods", trigger=now).awaitTermination()
        ST.partition_commit_stream(spark, f"{workdir}/ods", trigger=now).awaitTermination()
        ST.route_topics_stream(env, path=f"{workdir}/topics", trigger=now).awaitTermination()
        ST.current_state_stream(env, f"{workdir}/state", trigger=now, compact_every=2).awaitTermination()
        n = 50 * (start + 1)
        ids = [r.id for r in ST.read_ods(spark, f"{workdir}/ods").collect()]
        assert sorted(ids) == list(range(n))
        assert spark.read.schema("value string, topic string").json(f"{workdir}/topics").count() == n
        assert ST.read_current_state(spark, f"{workdir}/state").count() == n
    assert len(os.listdir(f"{workdir}/state/changes")) <= 3
    with pytest.raises(ValueError):
        ST.ods_stream(rows, f"{workdir}/ods", checkpoint=f"{workdir}/new", trigger=now)
    with pytest.raises(ValueError):
        ST.route_topics_stream(env, console=True, trigger=now)


def test_state_by_database_and_without_key(spark):
    raw = lines_df(spark, [rec("order_info", "c", T0, after=order(1, "t")), rec("order_info", "c", T0, after=order(1, "t"), db="b"),
                           rec("x", "c", T0, after={"other": 1}), rec("x", "c", T0, after={"more": 2})])
    env = CH.cdc_envelope(raw)
    assert sorted((r.database, r.id) for r in CH.cdc_current_state(env).collect()) == [("b", "1"), ("ecommerce", "1")]
    assert {(r.table, r.records, r.withoutKey) for r in CH.change_quality(env).collect()} == {
        ("order_info", 1, 0), ("x", 2, 2)}


def test_rejects_and_good_rows_are_all_rows(spark):
    lines = ["not json", rec("order_info", "c", T0, after=order(1, "t")), "{}", json.dumps({"topic": "a.b", "op": "c"}),
             rec("order_info", "c", T0), json.dumps({"topic": "a.b.c", "after": {"id": 1}})]
    raw = lines_df(spark, lines)
    bad = {r.value: r.reason for r in CH.rejected_changes(raw).collect()}
    assert CH.valid_changes(raw).count() == 1 and len(bad) == 5 and set(bad) < set(lines)
    assert bad["not json"] == "not a change record" and len(set(bad.values())) == 4


def test_changes_without_the_key_are_rejected_with_their_text(spark):
    lines = [rec("order_info", "c", T0, after=order(1, "t")), rec("order_info", "u", T0 + 1, after=order(1, "t", 2)),
             rec("order_info", "c", T0, after={"status": "1"}), rec("order_info", "c", T0, after={"id": None}),
             rec("order_info", "d", T0, before={"status": "1"}), "not json"]
    raw = lines_df(spark, lines)
    good, bad = CH.valid_changes(raw, key="id"), CH.rejected_changes(raw, key="id").collect()
    assert sorted([r.value for r in good.collect()] + [r.value for r in bad]) == sorted(lines)
    assert sorted((r.value, r.reason) for r in bad) == sorted(zip(lines[2:], ["no key"] * 3 + ["not a change record"]))
    state = CH.cdc_current_state(CH.cdc_envelope(CH.valid_changes(raw))).collect()
    assert [tuple(r) for r in state] == [tuple(r) for r in CH.cdc_current_state(CH.cdc_envelope(good)).collect()]


def test_user_rows_are_typed_and_stored(spark, workdir):
    user = {"id": 7, "login_name": "ann", "birthday": "1990-02-03", "create_time": "2024-01-01 05:00:00", "status": "1"}
    _write_batches(f"{workdir}/src", [[rec("user_info", "c", T0 + 5 * 3600_000, after=user),
                                       rec("user_info", "c", T0 + 9 * 3600_000, after={**user, "id": 8, "birthday": "x"})]])
    env = CH.cdc_envelope(CS.read_change_files(spark, f"{workdir}/src", stream=True))
    rows = CH.ods_partition_columns(CH.cdc_typed_rows(env, CH.USER_INFO_SCHEMA, table="user_info"))
    ST.ods_stream(rows, f"{workdir}/ods", trigger={"availableNow": True}).awaitTermination()
    ST.partition_commit_stream(spark, f"{workdir}/ods", schema=CH.USER_INFO_SCHEMA,
                               trigger={"availableNow": True}).awaitTermination()
    got = {r.id: r for r in ST.read_ods(spark, f"{workdir}/ods", CH.USER_INFO_SCHEMA).collect()}
    assert str(got[7].birthday) == "1990-02-03" and got[8].birthday is None and got[7].hr == "05"
    assert [(r.dt, r.hr) for r in ST.read_commits(spark, f"{workdir}/ods").collect()] == [("2024-01-01", "05")]


def test_the_watermark_is_on_the_stream(spark, workdir):
    _write_batches(f"{workdir}/src", [[rec("order_info", "c", T0 + 10_000, after=order(1, "t"))],
                                      [rec("order_info", "c", T0 + 11_000, after=order(2, "t"))]])
    rows = CH.cdc_watermark(CH.cdc_typed_rows(CH.cdc_envelope(
        CS.read_change_files(spark, f"{workdir}/src", stream=True, max_files_per_trigger=1))))
    q = (rows.writeStream.format("noop").option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    marks = [p["eventTime"].get("watermark") for p in q.recentProgress if p.get("eventTime")]
    assert "2024-01-01T00:00:05.000Z" in marks


def test_current_state_log_with_delete_and_reinsert(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(src, [
        [rec("order_info", "c", T0, after=order(1, "t")), rec("order_info", "c", T0, after=order(2, "t"))],
        [rec("order_info", "d", T0 + 5, before=order(1, "t")), rec("order_info", "u", T0 + 6, after=order(2, "t", 5))],
        [rec("order_info", "c", T0 + 9, after=order(1, "t", 7))],
    ])
    env = CH.cdc_envelope(CS.read_change_files(spark, src, stream=True, max_files_per_trigger=1))
    q = ST.current_state_stream(env, f"{workdir}/state", checkpoint=f"{workdir}/ck",
                                trigger={"availableNow": True})
    q.awaitTermination()
    got = {r.id: (r.operation, r.data["order_status"])
           for r in ST.read_current_state(spark, f"{workdir}/state").collect()}
    assert got == {"1": ("create", "7"), "2": ("update", "5")}


def _state_batch(spark, number, keys, value, op="update"):
    rows = [("db", "t", op, str(T0 + number), {"id": str(k), "v": str(value)}) for k in keys]
    return spark.createDataFrame(rows, "database string, table string, operation string, timestamp string, data map<string,string>")


def test_state_log_of_200_batches_writes_each_change_a_few_times(spark, workdir):
    """A first load, then small batches: the state is right, written rows and kept folders stay bounded."""
    path, want, changes, written = f"{workdir}/state", {}, 0, 0
    for number in range(200):
        keys = range(600) if number == 0 else [(7 * number + i) % 640 for i in range(3)]
        gone = number % 9 == 5
        batch = _state_batch(spark, number, keys, number, "delete" if gone else "update").coalesce(1)
        ST.append_state(batch, number, path, compact_every=8)
        changes += len(keys)
        for k in keys:
            want[str(k)] = None if gone else str(number)
        if number in ST._versions(spark, f"{path}/manifests"):
            runs = ST.state_runs(spark, path, number)
            assert all(old[2] >= 2 * new[2] for old, new in zip(runs, runs[1:]))
            assert runs[0][0] == 0 and runs[-1][1] == number and all(a[1] + 1 == b[0] for a, b in zip(runs, runs[1:]))
            written += runs[-1][2]
    got = {r.id: r.data["v"] for r in ST.read_current_state(spark, path).collect()}
    assert got == {k: v for k, v in want.items() if v is not None}
    assert written <= 4 * changes < 25 * 600                     # a fold of everything would write 25 times the state
    assert len(os.listdir(f"{path}/manifests")) == 2 and len(os.listdir(f"{path}/changes")) <= 16
    assert len(os.listdir(f"{path}/runs")) <= 8
    assert ST.state_version(spark, path) == 199


def test_state_log_readers_stay_on_their_batch(spark, workdir):
    path = f"{workdir}/state"
    def values(df):
        return {r.id: r.data["v"] for r in df.collect()}
    for number in range(5):
        ST.append_state(_state_batch(spark, number, [1, number + 10], number), number, path, compact_every=2)
    pinned = ST.read_current_state(spark, path)                  # planned now, read after the next merge
    ST.append_state(_state_batch(spark, 5, [1, 15], 5), 5, path, compact_every=2)
    want = {"1": "4", **{str(n + 10): str(n) for n in range(5)}}
    assert values(pinned) == want == values(ST.read_current_state(spark, path, at=4))
    ST.append_state(_state_batch(spark, 5, [1, 15], 5), 5, path, compact_every=2)      # replayed
    assert values(ST.read_current_state(spark, path)) == {**want, "1": "5", "15": "5"}
    with pytest.raises(ValueError):
        ST.read_current_state(spark, path, at=0)
    plan = ST.read_current_state(spark, path).where("id = '15'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,15)" in plan
    assert ST.read_current_state(spark, f"{workdir}/none").count() == 0


def test_stream_equals_batch_operator(spark, workdir):
    from memberlens.sources.tables import read_parquet_table
    from tests.conftest import SF_SMALL
    events = read_parquet_table(spark, SF_SMALL, "events")
    recs = CS.change_records_from_events(events)
    recs.repartitionByRange(3, "ts_ms").select("value").write.text(f"{workdir}/raw")
    batch = CH.ods_partition_columns(CH.cdc_typed_rows(
        CH.cdc_envelope(CS.parse_change_json(recs)), table="order_info"))
    _ods_run(spark, f"{workdir}/raw", f"{workdir}/ods", f"{workdir}/ck")
    streamed = ST.read_ods(spark, f"{workdir}/ods")
    cols = streamed.columns
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_fixed_topic_and_console_options(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(src, [[rec("order_info", "c", T0, after=order(1, "t"))]])
    env = CH.cdc_envelope(CS.read_change_files(spark, src, stream=True))
    q = ST.route_topics_stream(env, path=f"{workdir}/t", fixed_topic="all_changes",
                               checkpoint=f"{workdir}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    back = spark.read.schema("value string, topic string").json(f"{workdir}/t")
    assert [r.topic for r in back.collect()] == ["all_changes"]


def test_sql_view_stream_and_catalog_partitions(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(src, [[rec("order_info", "c", T0 + 2 * 3600 * 1000, after=order(1, "2024-01-01 00:30:00")),
                          rec("order_info", "c", T0 + 2 * 3600 * 1000, after=order(2, "2024-01-01 02:00:00"))]])
    raw = CS.read_change_files(spark, src, stream=True)
    CH.ods_partition_columns(CH.cdc_typed_rows(CH.cdc_envelope(raw), table="order_info")).createOrReplaceTempView("merged")
    rows = spark.sql("select * from merged where id > 0")
    assert rows.isStreaming
    out = f"{workdir}/ods"
    table = "ods_test.order_info"
    ST.ensure_ods_table(spark, table, out)
    ST.ensure_ods_table(spark, table, out)          # idempotent, never drops
    q = ST.ods_stream(rows, out, checkpoint=f"{workdir}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    c = ST.partition_commit_stream(spark, out, checkpoint=f"{workdir}/ck2", table=table,
                                   trigger={"availableNow": True})
    c.awaitTermination()
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert parts == {"dt=2024-01-01/hr=00"}
    assert spark.table(table).count() == 2          # the in-memory catalog lists all files
    spark.sql(f"DROP TABLE {table}")
    spark.sql("DROP DATABASE ods_test")
