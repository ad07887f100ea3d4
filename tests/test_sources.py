"""Sources and sinks: text logs, change files, Kafka reader checks, document table."""

import json
import os

import pytest

from memberlens.sources import changes as CS
from memberlens.sources import fixtures as FX
from memberlens.sources.logs import read_log
from memberlens.sources.sinks import write_documents, write_export
from tests.conftest import SF_SMALL


def test_read_log_and_crlf(spark, workdir):
    p = os.path.join(workdir, "log.txt")
    with open(p, "wb") as f:
        f.write(b"a\tb\tc\r\nx\ty\r\n")
    assert [r.value for r in read_log(spark, p, line_sep="\r\n").collect()] == ["a\tb\tc", "x\ty"]


def test_change_files_batch_reader(spark, workdir):
    p = os.path.join(workdir, "changes")
    os.makedirs(p)
    with open(os.path.join(p, "part.json"), "w") as f:
        f.write(json.dumps({"topic": "s.db.t", "op": "c", "ts_ms": 5, "before": None,
                            "after": {"id": 1, "v": 2.5, "n": None}}) + "\n")
        f.write("not json\n")
    rows = CS.read_change_files(spark, p).collect()
    assert rows[0].after == {"id": "1", "v": "2.5", "n": None}
    assert rows[1].topic is None          # a broken record parses to NULLs, it does not fail


def test_kafka_reader_arguments(spark):
    with pytest.raises(ValueError):
        CS.read_change_kafka(spark, "host:9092")
    with pytest.raises(ValueError):
        CS.read_change_kafka(spark, "host:9092", topics="a", pattern="b.*")
    # The Kafka connector is not on this machine's class path: a clear error.
    with pytest.raises(Exception, match="(?i)kafka"):
        CS.read_change_kafka(spark, "host:9092", pattern="ecommerce\\..*")


def test_document_table_overwrites(spark, workdir):
    tags = FX.view(spark, SF_SMALL, "t_member").limit(5)
    out = os.path.join(workdir, "docs")
    write_documents(tags, out)
    write_documents(tags, out)                      # a rerun replaces, never duplicates
    assert spark.read.parquet(out).count() == 5
    write_documents(tags, out + "_json", fmt="json")
    assert spark.read.json(out + "_json").count() == 5


def test_export_writer(spark, workdir):
    lines = spark.createDataFrame([("[1,138]",), ("[2,null]",)], "line string")
    write_export(lines.coalesce(1), os.path.join(workdir, "exp"))
    import glob
    data = b"".join(open(f, "rb").read() for f in glob.glob(os.path.join(workdir, "exp", "part-*")))
    assert data == b"[1,138]\r\n[2,null]\r\n"


def test_records_from_events_round_trip(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    raw = CS.parse_change_json(CS.change_records_from_events(events))
    assert raw.count() == events.count()
    ops = {r.op for r in raw.select("op").distinct().collect()}
    assert ops == {"r", "c", "u", "d"}
    assert raw.filter("op = 'd' and after is null and before is not null").count() > 0
