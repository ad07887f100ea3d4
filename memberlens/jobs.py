"""Command-line jobs: the shop's batch and stream programs, as spark-submit entries.

    spark-submit --py-files memberlens.zip -m memberlens.jobs <job> [options]

Jobs (each writes its results instead of printing them):

* ``metrics``    member pies/heat (+ document), funnel, growth and cumulative GMV,
                 week-over-week, coupon reminders -> one folder per metric
* ``user-tags``  the tag document table (one row per member, or ``--reference-form``)
* ``segment``    a segment of a tag table from clauses -> ``[memberId,phone]`` lines
* ``segments``   the members of every segment of a rules file
* ``tag-counts`` members per catalogue tag
* ``hot-words``  top-k words of a tab-separated search log
* ``cdc-topics`` change records -> one topic per table (Kafka or JSON folders)
* ``cdc-ods``    change records -> hour-partitioned ODS table + partition commit
* ``cdc-state``  change records -> the rows as they are now
* ``cdc-dedup``  change records -> the same without redeliveries, by topic

Shop tables come from a catalog database (``--database``, ``--hive`` for a
Hive metastore) or from parquet folders ``{--tables}/{t_member,...}``.
Outputs are overwritten, so a rerun replaces the previous result.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from memberlens.operators import catalogue as CT
from memberlens.operators import changes as CH
from memberlens.operators import hotwords as HW
from memberlens.operators import metrics as M
from memberlens.operators import segments as SG
from memberlens.operators import tags as TG
from memberlens.session import get_session
from memberlens.sources import changes as CS
from memberlens.sources.logs import read_log
from memberlens.sources.sinks import write_documents
from memberlens.sources.tables import SHOP_TABLES, catalog_tables, read_parquet_table
from memberlens.streaming import cdc as ST


def shop_tables(spark: SparkSession, args) -> dict:
    if args.tables:
        return {n: read_parquet_table(spark, args.tables, n) for n in SHOP_TABLES}
    return catalog_tables(spark, args.database)


def run_metrics(spark: SparkSession, args) -> list[str]:
    t = shop_tables(spark, args)
    m, o, cm = t["t_member"], t["t_order"], t["t_coupon_member"]
    coupon_as_of = args.coupon_as_of or args.as_of
    results = {
        "member_overview": M.member_overview(m, o, cm),
        "member_overview_document": M.member_overview_document(m, o, cm),
        "conversion_funnel": M.conversion_funnel(o, cm),
        "growth_line": M.growth_line(m, o, args.as_of),
        "gmv_cumulative": M.gmv_cumulative(m, o, args.as_of),
        "wow_reg": M.wow_compare(m, "id", args.as_of),
        "wow_order": M.wow_compare(o, "order_id", args.as_of),
        "remind_free": M.remind_free(cm, coupon_as_of),
        "remind_coupon": M.remind_coupon(cm, coupon_as_of),
        "remind_expiry": M.remind_expiry(cm, coupon_as_of),
    }
    for name, df in results.items():
        df.write.mode("overwrite").json(f"{args.out}/{name}")
    return list(results)


def run_user_tags(spark: SparkSession, args) -> None:
    t = shop_tables(spark, args)
    tags = TG.user_tag(t) if args.reference_form else TG.user_tag_member(t)
    write_documents(tags, args.out, fmt=args.format, table=args.table)


def run_segment(spark: SparkSession, args) -> None:
    tags = spark.read.format(args.format).load(args.tags)
    clauses = json.loads(args.clauses)
    seg = SG.segment_select(tags, clauses, combine=args.combine, limit=args.top)
    SG.segment_export(seg, path=args.out)


def run_hot_words(spark: SparkSession, args) -> None:
    HW.hot_words(read_log(spark, args.log), k=args.k).write.mode("overwrite").json(args.out)


def run_segments(spark: SparkSession, args) -> None:
    tags = spark.read.format(args.format).load(args.tags)
    rules = spark.read.schema("segment_id string, name string, value string, type string").json(args.rules)
    SG.segment_bulk(tags, rules, combine=args.combine).write.mode("overwrite").parquet(args.out)


def run_tag_counts(spark: SparkSession, args) -> None:
    tags = spark.read.format(args.format).load(args.tags)
    rows = CT.tag_catalogue_rows(args.as_of, args.coupon_as_of)
    CT.tag_counts(tags, rows).write.mode("overwrite").json(args.out)


def _changes(spark: SparkSession, args, out: str | None = None, key: str | None = None, keep: tuple[str, ...] = ()):
    """The envelope of the usable records; the others are written, with their text and reason, beside the results.

    Rejects go to ``--rejects``, or to a ``_rejects`` folder in the job's
    output folder or, for a topic sink, in its checkpoint.
    """
    if args.kafka:
        raw = CS.read_change_kafka(spark, args.kafka, topics=args.topics, pattern=args.pattern,
                                   starting_offsets=args.starting_offsets)
    else:
        raw = CS.read_change_files(spark, args.source, stream=True)
    to = args.rejects or f"{out or args.checkpoint}/_rejects"
    ST.rejects_stream(CH.rejected_changes(raw, key=key), to, checkpoint=args.checkpoint and f"{args.checkpoint}/rejects",
                      trigger=_trigger(args), name=f"{args.job}-rejects")
    return CH.cdc_envelope(CH.valid_changes(raw, key=key), keep=keep if args.kafka else ())


def _until_done(spark: SparkSession, args) -> None:
    """All streams of an ``--available-now`` run come to their end; otherwise the job goes on until one stops."""
    if args.available_now:
        for query in spark.streams.active:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def _trigger(args) -> dict:
    return {"availableNow": True} if args.available_now else {"processingTime": args.trigger}


#: Where a record of a topic stands; two deliveries of one record have the same.
POSITION = ("kafka_topic", "partition", "offset")


def _place(args, kind: str) -> str | None:
    return args.checkpoint and f"{args.checkpoint}/{kind}"


def run_cdc_topics(spark: SparkSession, args) -> None:
    ST.route_topics_stream(_changes(spark, args, args.out), kafka_servers=args.sink_kafka, path=args.out,
                           checkpoint=args.checkpoint, trigger=_trigger(args), include_envelope=args.include_envelope)
    _until_done(spark, args)


def run_cdc_ods(spark: SparkSession, args) -> None:
    schema = CH.TABLE_SCHEMAS[args.source_table]
    rows = CH.cdc_typed_rows(_changes(spark, args, args.ods), schema, table=args.source_table)
    rows = CH.ods_partition_columns(CH.cdc_watermark(rows, args.watermark_delay))
    if args.table:
        ST.ensure_ods_table(spark, args.table, args.ods, schema)
    data = ST.ods_stream(rows, args.ods, checkpoint=_place(args, "data"), trigger=_trigger(args))
    if args.available_now:
        data.awaitTermination()
    ST.partition_commit_stream(spark, args.ods, checkpoint=_place(args, "commit"), schema=schema,
                               trigger=_trigger(args), commit_delay=args.commit_delay,
                               watermark_delay=args.watermark_delay, table=args.table)
    _until_done(spark, args)


def run_cdc_state(spark: SparkSession, args) -> None:
    env = _changes(spark, args, args.out, key=args.key, keep=("offset",))
    ST.current_state_stream(env, args.out, key=args.key, tiebreak="offset" if args.kafka else None,
                            checkpoint=args.checkpoint, trigger=_trigger(args))
    _until_done(spark, args)


def run_cdc_dedup(spark: SparkSession, args) -> None:
    env = _changes(spark, args, args.out, keep=POSITION)
    once = CH.cdc_dedup(env, position=POSITION if args.kafka else (), delay=args.delay)
    ST.route_topics_stream(once, kafka_servers=args.sink_kafka, path=args.out, checkpoint=args.checkpoint,
                           trigger=_trigger(args), include_envelope=True, name="cdc_dedup")
    _until_done(spark, args)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="memberlens.jobs")
    p.add_argument("--hive", action="store_true", help="use the Hive metastore catalog")
    sub = p.add_subparsers(dest="job", required=True)

    def tables(sp):
        g = sp.add_mutually_exclusive_group(required=True)
        g.add_argument("--database", help="catalog database holding t_member, t_order, ...")
        g.add_argument("--tables", help="folder holding {t_member,...}.parquet")

    s = sub.add_parser("metrics")
    tables(s)
    s.add_argument("--as-of", required=True)
    s.add_argument("--coupon-as-of")
    s.add_argument("--out", required=True)

    s = sub.add_parser("user-tags")
    tables(s)
    s.add_argument("--out")
    s.add_argument("--table")
    s.add_argument("--format", default="parquet")
    s.add_argument("--reference-form", action="store_true",
                   help="line-grain counts and one row per free coupon, as the original table")

    s = sub.add_parser("segment")
    s.add_argument("--tags", required=True)
    s.add_argument("--format", default="parquet")
    s.add_argument("--clauses", required=True, help='JSON list of {"name","value","type"}')
    s.add_argument("--combine", default="any", choices=("any", "all"))
    s.add_argument("--top", type=int, help=f"the best so many (the page showed {SG.PAGE_SIZE}); all if left out")
    s.add_argument("--out", required=True)

    s = sub.add_parser("segments")
    s.add_argument("--tags", required=True)
    s.add_argument("--format", default="parquet")
    s.add_argument("--rules", required=True, help="JSON lines with segment_id, name, value, type")
    s.add_argument("--combine", default="any", choices=("any", "all"))
    s.add_argument("--out", required=True)

    s = sub.add_parser("tag-counts")
    s.add_argument("--tags", required=True)
    s.add_argument("--format", default="parquet")
    s.add_argument("--as-of", required=True)
    s.add_argument("--coupon-as-of")
    s.add_argument("--out", required=True)

    s = sub.add_parser("hot-words")
    s.add_argument("--log", required=True)
    s.add_argument("--k", type=int, default=HW.DEFAULT_TOP_K)
    s.add_argument("--out", required=True)

    for name in ("cdc-topics", "cdc-ods", "cdc-state", "cdc-dedup"):
        s = sub.add_parser(name)
        src = s.add_mutually_exclusive_group(required=True)
        src.add_argument("--kafka", help="bootstrap servers of the change topics")
        src.add_argument("--source", help="folder of JSON change records")
        s.add_argument("--topics")
        s.add_argument("--pattern")
        s.add_argument("--starting-offsets", default="earliest")
        s.add_argument("--checkpoint")
        s.add_argument("--rejects", help="folder for records that cannot be used")
        s.add_argument("--trigger", default="5 seconds")
        s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        if name in ("cdc-topics", "cdc-dedup"):
            s.add_argument("--sink-kafka")
            s.add_argument("--out")
            if name == "cdc-topics":
                s.add_argument("--include-envelope", action="store_true")
            else:
                s.add_argument("--delay", default="1 hour", help="how long a redelivery is recognised")
        elif name == "cdc-state":
            s.add_argument("--out", required=True)
            s.add_argument("--key", default="id")
        else:
            s.add_argument("--ods", required=True)
            s.add_argument("--table")
            s.add_argument("--source-table", default="order_info", choices=sorted(CH.TABLE_SCHEMAS))
            s.add_argument("--commit-delay", default="61 minutes")
            s.add_argument("--watermark-delay", default="5 seconds")
    return p


JOBS = {"metrics": run_metrics, "user-tags": run_user_tags, "segment": run_segment,
        "segments": run_segments, "tag-counts": run_tag_counts, "hot-words": run_hot_words,
        "cdc-topics": run_cdc_topics, "cdc-ods": run_cdc_ods, "cdc-state": run_cdc_state, "cdc-dedup": run_cdc_dedup}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or get_session(f"memberlens-{args.job}", hive=args.hive)
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
