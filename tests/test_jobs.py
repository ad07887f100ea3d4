"""The command-line jobs, run in-process on the fixture tables."""

import glob
import json
import os

from memberlens import jobs
from memberlens.sources import fixtures as FX
from tests.conftest import SF_SMALL


def _tables(spark, workdir):
    root = os.path.join(workdir, "shop")
    for name, df in FX.load(spark, SF_SMALL, *FX.SHOP_TABLE_NAMES).items():
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def test_batch_jobs(spark, workdir):
    root = _tables(spark, workdir)
    names = jobs.run_metrics(spark, jobs.parser().parse_args(
        ["metrics", "--tables", root, "--as-of", FX.MEMBER_AS_OF, "--coupon-as-of", FX.COUPON_AS_OF,
         "--out", f"{workdir}/metrics"]))
    for n in names:
        assert glob.glob(f"{workdir}/metrics/{n}/part-*"), n
    jobs.main(["user-tags", "--tables", root, "--out", f"{workdir}/tags"], spark=spark)
    assert spark.read.parquet(f"{workdir}/tags").count() == spark.read.parquet(f"{root}/t_member.parquet").count()
    clauses = json.dumps([{"name": "sex", "value": "1", "type": "match"}])
    jobs.main(["segment", "--tags", f"{workdir}/tags", "--clauses", clauses, "--out", f"{workdir}/seg"],
              spark=spark)
    text = b"".join(open(p, "rb").read() for p in glob.glob(f"{workdir}/seg/part-*")).decode()
    assert text.endswith("\r\n") and text.startswith("[")


def test_hot_words_and_cdc_jobs(spark, workdir):
    FX.view(spark, SF_SMALL, "search_log").write.text(f"{workdir}/log")
    jobs.main(["hot-words", "--log", f"{workdir}/log", "--out", f"{workdir}/hot"], spark=spark)
    assert spark.read.json(f"{workdir}/hot").count() == 10
    from memberlens.sources import changes as CS
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    CS.change_records_from_events(events).select("value").write.text(f"{workdir}/changes")
    jobs.main(["cdc-ods", "--source", f"{workdir}/changes", "--ods", f"{workdir}/ods",
               "--checkpoint", f"{workdir}/ck", "--available-now"], spark=spark)
    from memberlens.streaming import cdc as ST
    assert ST.read_ods(spark, f"{workdir}/ods").count() == events.filter("event_type = 'purchase'").count()
    assert ST.read_commits(spark, f"{workdir}/ods").count() > 0
    jobs.main(["cdc-topics", "--source", f"{workdir}/changes", "--out", f"{workdir}/topics",
               "--checkpoint", f"{workdir}/ck2", "--available-now"], spark=spark)
    assert spark.read.json(f"{workdir}/topics").count() == events.count()


def test_jobs_write_what_they_reject(spark, workdir):
    """Every change job keeps the records it cannot use, with their text and reason."""
    from memberlens.sources import changes as CS
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    records = CS.with_broken_records(CS.change_records_from_events(events)).select("value")
    records.write.text(f"{workdir}/changes")
    lone = json.dumps({"topic": "a.b.c", "op": "c", "ts_ms": 1, "before": None, "after": {"other": 1}})
    spark.createDataFrame([(lone,)], "value string").write.mode("append").text(f"{workdir}/changes")
    n_bad = events.filter("event_id % 101 = 0 or event_id % 103 = 0 or event_id % 107 = 0 or event_id % 109 = 0").count()
    for job, more, reasons in (("cdc-topics", 0, 4), ("cdc-dedup", 0, 4), ("cdc-state", 1, 5), ("cdc-ods", 0, 4)):
        out = f"{workdir}/{job}"
        jobs.main([job, "--source", f"{workdir}/changes", "--ods" if job == "cdc-ods" else "--out", out,
                   "--checkpoint", f"{out}-ck", "--available-now"], spark=spark)
        bad = spark.read.json(f"{out}/_rejects")
        assert n_bad and bad.count() == n_bad + more and bad.select("reason").distinct().count() == reasons
        assert {r.value for r in bad.collect()} <= {r.value for r in records.collect()} | {lone}
