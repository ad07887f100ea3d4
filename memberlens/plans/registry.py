"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each entry maps the driver's generated tables onto the shop tables (see
:mod:`memberlens.sources.fixtures`) and runs one operator over the *whole*
tables. Timestamps in results are rendered as text so that the result is
independent of the reader's time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlens.operators import catalogue as CT
from memberlens.operators import changes as CH
from memberlens.operators import handover as HO
from memberlens.operators import hotwords as HW
from memberlens.operators import metrics as M
from memberlens.operators import segments as SG
from memberlens.operators import tags as TG
from memberlens.session import materialize, scratch_dir
from memberlens.sources import changes as CS
from memberlens.sources import fixtures as FX
from memberlens.sources.tables import read_parquet_stream, read_parquet_table
from memberlens.streaming import cdc as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _v(spark, root, name):
    return FX.view(spark, root, name)


MEMBER_AS_OF = FX.MEMBER_AS_OF
COUPON_AS_OF = FX.COUPON_AS_OF


# ----------------------------------------------------------------- metrics (P1-P15)

@register("member_sex")
def q_member_sex(spark, root):
    return M.member_sex(_v(spark, root, "t_member"))


@register("member_channel")
def q_member_channel(spark, root):
    return M.member_channel(_v(spark, root, "t_member"))


@register("member_mp_sub")
def q_member_mp_sub(spark, root):
    return M.member_mp_sub(_v(spark, root, "t_member"))


@register("member_heat")
def q_member_heat(spark, root):
    return M.member_heat(_v(spark, root, "t_member"), _v(spark, root, "t_order"),
                         _v(spark, root, "t_coupon_member"))


@register("member_overview")
def q_member_overview(spark, root):
    return M.member_overview(_v(spark, root, "t_member"), _v(spark, root, "t_order"),
                             _v(spark, root, "t_coupon_member"))


@register("member_overview_document")
def q_member_overview_document(spark, root):
    return M.member_overview_document(_v(spark, root, "t_member"), _v(spark, root, "t_order"),
                                      _v(spark, root, "t_coupon_member"))


@register("conversion_funnel")
def q_conversion_funnel(spark, root):
    return M.conversion_funnel(_v(spark, root, "t_order"), _v(spark, root, "t_coupon_member"))


@register("growth_line")
def q_growth_line(spark, root):
    return M.growth_line(_v(spark, root, "t_member"), _v(spark, root, "t_order"), MEMBER_AS_OF)


@register("gmv_before")
def q_gmv_before(spark, root):
    return M.gmv_before(_v(spark, root, "t_order"), MEMBER_AS_OF)


@register("gmv_cumulative")
def q_gmv_cumulative(spark, root):
    return M.gmv_cumulative(_v(spark, root, "t_member"), _v(spark, root, "t_order"), MEMBER_AS_OF)


@register("wow_reg")
def q_wow_reg(spark, root):
    return M.wow_reg(_v(spark, root, "t_member"), MEMBER_AS_OF)


@register("wow_order")
def q_wow_order(spark, root):
    return M.wow_order(_v(spark, root, "t_order"), MEMBER_AS_OF)


@register("wow_compare_reg")
def q_wow_compare_reg(spark, root):
    return M.wow_compare(_v(spark, root, "t_member"), "id", MEMBER_AS_OF)


@register("wow_compare_order")
def q_wow_compare_order(spark, root):
    return M.wow_compare(_v(spark, root, "t_order"), "order_id", MEMBER_AS_OF)


@register("remind_free")
def q_remind_free(spark, root):
    return M.remind_free(_v(spark, root, "t_coupon_member"), COUPON_AS_OF)


@register("remind_coupon")
def q_remind_coupon(spark, root):
    return M.remind_coupon(_v(spark, root, "t_coupon_member"), COUPON_AS_OF)


@register("remind_expiry")
def q_remind_expiry(spark, root):
    return M.remind_expiry(_v(spark, root, "t_coupon_member"), COUPON_AS_OF)


# ----------------------------------------------------------------- tags (P16-P25)


TAG_TABLES = ("t_member", "t_order", "t_order_commodity", "t_coupon", "t_coupon_member",
              "t_delivery", "t_feedback")


def shop_tables(spark, root) -> dict:
    return FX.load(spark, root, *TAG_TABLES)


@register("tag_member_base")
def q_tag_member_base(spark, root):
    return TG.tag_member_base(_v(spark, root, "t_member"))


@register("tag_order_behavior")
def q_tag_order_behavior(spark, root):
    return TG.tag_order_behavior(_v(spark, root, "t_order"), _v(spark, root, "t_order_commodity"))


@register("tag_order_behavior_by_order")
def q_tag_order_behavior_by_order(spark, root):
    return TG.tag_order_behavior_by_order(_v(spark, root, "t_order"),
                                          _v(spark, root, "t_order_commodity"))


@register("tag_free_coupon")
def q_tag_free_coupon(spark, root):
    return TG.tag_free_coupon(_v(spark, root, "t_coupon_member"))


@register("tag_coupon_times")
def q_tag_coupon_times(spark, root):
    return TG.tag_coupon_times(_v(spark, root, "t_coupon_member"))


@register("tag_charge_money")
def q_tag_charge_money(spark, root):
    return TG.tag_charge_money(_v(spark, root, "t_coupon_member"), _v(spark, root, "t_coupon"))


@register("tag_over_time")
def q_tag_over_time(spark, root):
    return TG.tag_over_time(_v(spark, root, "t_delivery"))


@register("tag_feedback")
def q_tag_feedback(spark, root):
    return TG.tag_feedback(_v(spark, root, "t_feedback"))


@register("user_tag")
def q_user_tag(spark, root):
    return TG.user_tag(shop_tables(spark, root))


@register("user_tag_member")
def q_user_tag_member(spark, root):
    return TG.user_tag_member(shop_tables(spark, root))


# ----------------------------------------------------------------- segments (P26-P30)


# Parameters of the registered segment queries (what a user clicks).
SEGMENT_OR_NOT = [{"name": "sex", "value": "1", "type": "match"},
                  {"name": "channel", "value": "2", "type": "match"},
                  {"name": "subOpenId", "value": "null", "type": "notMatch"}]
SEGMENT_MIXED = [{"name": "orderMoney", "value": "100000-200000", "type": "rangeBoth"},
                 {"name": "favGoods", "value": "6", "type": "match"},
                 {"name": "couponTimes", "value": "2024-01-20", "type": "match"},
                 {"name": "overTime", "value": "3000", "type": "rangeGte"},
                 {"name": "feedBack", "value": "4", "type": "notMatch"}]
SEGMENT_NOT_ONLY = [{"name": "subOpenId", "value": "null", "type": "notMatch"},
                    {"name": "address", "value": "-1", "type": "notMatch"}]


def catalogue_rows():
    return CT.tag_catalogue_rows(MEMBER_AS_OF, COUPON_AS_OF)


def bulk_rule_rows():
    """Every catalogue tag as its own segment plus three multi-clause segments."""
    rows = [(f"tag{i:02d}", name, value, typ)
            for i, (_, _, name, value, typ) in enumerate(catalogue_rows())]
    for sid, clauses in (("or_not", SEGMENT_OR_NOT), ("mixed", SEGMENT_MIXED),
                         ("not_only", SEGMENT_NOT_ONLY)):
        rows += [(sid, c["name"], c["value"], c["type"]) for c in clauses]
    return rows


def _tags(spark, root):
    return TG.user_tag_member(shop_tables(spark, root))


@register("segment_select")
def q_segment_select(spark, root):
    return SG.segment_select(_tags(spark, root), SEGMENT_OR_NOT)


@register("segment_select_mixed")
def q_segment_select_mixed(spark, root):
    return SG.segment_select(_tags(spark, root), SEGMENT_MIXED)


@register("segment_select_not_only")
def q_segment_select_not_only(spark, root):
    return SG.segment_select(_tags(spark, root), SEGMENT_NOT_ONLY)


@register("segment_size")
def q_segment_size(spark, root):
    return SG.segment_size(_tags(spark, root), SEGMENT_OR_NOT)


@register("segment_bulk")
def q_segment_bulk(spark, root):
    rules = spark.createDataFrame(bulk_rule_rows(),
                                  "segment_id string, name string, value string, type string")
    return SG.segment_bulk(_tags(spark, root), rules)


TOP_K = 50


@register("segment_top")
def q_segment_top(spark, root):
    rules = spark.createDataFrame(bulk_rule_rows(),
                                  "segment_id string, name string, value string, type string")
    return SG.segment_top(_tags(spark, root), rules, TOP_K)


def range_rule_rows():
    """The bulk rules, and 150 ranges of money and days that overlap one another."""
    rows = bulk_rule_rows()
    rows += [(f"order{k:03d}", "orderMoney", f"{k * 4000}-{k * 4000 + 3000 * (k % 7)}", "rangeBoth") for k in range(100)]
    rows += [(f"wait{k:03d}", "overTime", str(600 + 90 * k), "rangeGte" if k % 2 else "rangeLte") for k in range(40)]
    rows += [(f"day{k:03d}", "regTime", f"2001-0{6 + k % 2}-{1 + k:02d}", "rangeLte") for k in range(10)]
    return rows


@register("segment_sizes")
def q_segment_sizes(spark, root):
    rules = spark.createDataFrame(range_rule_rows(), "segment_id string, name string, value string, type string")
    return SG.segment_sizes(_tags(spark, root), rules)


@register("segment_export")
def q_segment_export(spark, root):
    return SG.segment_export(SG.segment_select(_tags(spark, root), SEGMENT_OR_NOT))


@register("tag_counts")
def q_tag_counts(spark, root):
    return CT.tag_counts(_tags(spark, root), catalogue_rows())


# ----------------------------------------------------------------- hot words (P31-P32)


@register("hot_words")
def q_hot_words(spark, root):
    return HW.hot_words(_v(spark, root, "search_log"))


@register("hot_words_malformed")
def q_hot_words_malformed(spark, root):
    return HW.hot_words_malformed(_v(spark, root, "search_log"))


# ----------------------------------------------------------------- change events (P33-P40)


def _raw_changes(spark, root):
    events = read_parquet_table(spark, root, "events")
    return CS.parse_change_json(CS.change_records_from_events(events))


def _envelope(spark, root):
    return CH.cdc_envelope(_raw_changes(spark, root), keep=("seq",))


@register("cdc_envelope")
def q_cdc_envelope(spark, root):
    env = _envelope(spark, root)
    return env.select("operation", "database", "table", "timestamp",
                      F.to_json("data", CS.JSON_KEEP_NULLS).alias("data_json"))


@register("cdc_route_topics")
def q_cdc_route_topics(spark, root):
    return CH.cdc_route_topics(_envelope(spark, root))


@register("cdc_typed_rows")
def q_cdc_typed_rows(spark, root):
    return CH.cdc_typed_rows(_envelope(spark, root), CH.ORDER_INFO_SCHEMA, table="order_info")


@register("cdc_watermark")
def q_cdc_watermark(spark, root):
    rows = CH.cdc_watermark(CH.cdc_typed_rows(_envelope(spark, root), table="order_info"))
    return rows.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS"))


@register("cdc_current_state")
def q_cdc_current_state(spark, root):
    st = CH.cdc_current_state(_envelope(spark, root), key="id", tiebreak="seq")
    return st.select("table", "id", "operation", "timestamp",
                     F.to_json("data", CS.JSON_KEEP_NULLS).alias("data_json"))


@register("cdc_typed_user_rows")
def q_cdc_typed_user_rows(spark, root):
    rows = CH.cdc_typed_rows(_envelope(spark, root), CH.USER_INFO_SCHEMA, table="user_info")
    return rows.withColumn("birthday", F.col("birthday").cast("string"))


@register("cdc_change_quality")
def q_cdc_change_quality(spark, root):
    """Counts of the good records by table, and of the rejected ones by reason, as one table."""
    raw = _raw_changes(spark, root)
    good = CH.change_quality(CH.cdc_envelope(CH.valid_changes(raw)))
    bad = CH.rejected_changes(raw).groupBy(F.col("reason").alias("table")).agg(F.count("*").alias("records"))
    return good.unionByName(bad.select(F.lit("rejected").alias("database"), "table", "records",
                                       F.col("records").alias("withoutKey"), F.col("records").alias("withoutTime")))


@register("cdc_rejects")
def q_cdc_rejects(spark, root):
    """Good and rejected records by reason: together they are all records."""
    records = CS.with_broken_records(CS.change_records_from_events(read_parquet_table(spark, root, "events")))
    raw = CS.parse_change_json(records)
    bad = CH.rejected_changes(raw, keep=("seq",))
    both = bad.select("reason", "seq").unionByName(CH.valid_changes(raw).select(F.lit("good").alias("reason"), "seq"))
    return both.groupBy("reason").agg(F.count("*").alias("records"), F.sum("seq").alias("seqSum"))


def _handover(spark, root):
    """A chunked snapshot of both tables, read while the log went on, and the log."""
    log = _envelope(spark, root)
    rows, marks = CS.snapshot_from_changes(log)
    marks = materialize(marks)          # as if read back: a row for each chunk
    return HO.snapshot_then_log(rows, marks, log.withColumnRenamed("seq", "position"))


@register("cdc_snapshot_handover")
def q_cdc_snapshot_handover(spark, root):
    """The state that snapshot and log give together, which is that of the log alone."""
    state = HO.state_at_end(_handover(spark, root))
    return state.select("table", "id", F.to_json("data", CS.JSON_KEEP_NULLS).alias("data_json"))


@register("cdc_snapshot_handover_log")
def q_cdc_snapshot_handover_log(spark, root):
    """What is handed over: reads at the high marks, and the changes beyond them, each once."""
    return _handover(spark, root).groupBy("table", "operation").agg(
        F.count("*").alias("records"), F.sum("position").alias("positionSum"),
        F.sum(F.try_element_at("data", F.lit("id")).cast("bigint")).alias("idSum"))


@register("cdc_dedup")
def q_cdc_dedup(spark, root):
    # Every record delivered twice (an at-least-once sink replaying a whole batch).
    raw = _raw_changes(spark, root)
    env = CH.cdc_envelope(raw.unionByName(raw))
    return CH.cdc_dedup(env).select(
        "operation", "table", "timestamp", F.to_json("data", CS.JSON_KEEP_NULLS).alias("data_json"))


# The streams read the given table itself, as it lies there.

def _change_stream(spark, root, redeliver=False):
    """Parsed change records derived from a stream over ``events``."""
    records = CS.change_records_from_events(read_parquet_stream(spark, root, "events"))
    if redeliver:
        records = records.unionByName(records)
    return CS.parse_change_json(records)


def _drained(query):
    query.awaitTermination()


NOW = {"availableNow": True}


def _run_ods_stream(spark, root):
    """Stream the order changes into an ODS folder of this run."""
    out = scratch_dir(spark, "ods-run")
    rows = CH.cdc_typed_rows(CH.cdc_envelope(_change_stream(spark, root)), table="order_info")
    rows = CH.ods_partition_columns(CH.cdc_watermark(rows))
    _drained(ST.ods_stream(rows, out, trigger=NOW, name=_run_name("cdc_ods", out)))
    return out


def _run_name(name, folder):
    return f"{name}_{folder.rsplit('-', 1)[-1]}"          # unique per run: runs may overlap


@register("cdc_ods_partitioned")
def q_cdc_ods_partitioned(spark, root):
    return ST.read_ods(spark, _run_ods_stream(spark, root))


@register("cdc_partition_commit")
def q_cdc_partition_commit(spark, root):
    out = _run_ods_stream(spark, root)
    _drained(ST.partition_commit_stream(spark, out, trigger=NOW, name=_run_name("cdc_ods_commit", out)))
    return ST.read_commits(spark, out).select("dt", "hr")


@register("cdc_route_topics_stream")
def q_cdc_route_topics_stream(spark, root):
    """P34 through the streaming topic sink (partitioned JSON files), read back."""
    out = scratch_dir(spark, "topics-run")
    env = CH.cdc_envelope(_change_stream(spark, root))
    _drained(ST.route_topics_stream(env, path=out, trigger=NOW, name=_run_name("cdc_topics", out)))
    return spark.read.schema("value string, topic string").json(out).select("topic", "value")


@register("cdc_current_state_stream")
def q_cdc_current_state_stream(spark, root):
    """P39 as a stream (log of batches and snapshot), resolved to current rows."""
    out = scratch_dir(spark, "state-run")
    env = CH.cdc_envelope(_change_stream(spark, root), keep=("seq",))
    _drained(ST.current_state_stream(env, out, tiebreak="seq", trigger=NOW, name=_run_name("cdc_state", out)))
    return (ST.read_current_state(spark, out)
              .select("table", "id", "operation", "timestamp",
                      F.to_json("data", CS.JSON_KEEP_NULLS).alias("data_json")))


@register("cdc_dedup_stream")
def q_cdc_dedup_stream(spark, root):
    """P40 on a stream: every record delivered twice, in the table's own order."""
    out = scratch_dir(spark, "dedup-run")
    env = CH.cdc_envelope(_change_stream(spark, root, redeliver=True))
    rows = CH.cdc_dedup(env).select(
        "operation", "table", "timestamp", F.to_json("data", CS.JSON_KEEP_NULLS).alias("data_json"))
    _drained(rows.writeStream.queryName(_run_name("cdc_dedup", out)).format("parquet").option("path", out)
             .option("checkpointLocation", f"{out}/_checkpoints/dedup").trigger(**NOW).start())
    return spark.read.schema("operation string, table string, timestamp string, data_json string").parquet(out)
