"""Database change events: envelope, topic routing, typed rows, event time,
current state and de-duplication.

All functions work on batch and on streaming DataFrames alike (they are
plain projections, or aggregates Spark supports in both modes), so one
definition serves the tests (batch over files) and the pipeline (stream
over Kafka).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberlens.sources.changes import JSON_KEEP_NULLS

# Change operation codes of the capture connector, lower-cased
# operation names as the envelope carries them.
OPERATIONS = {"r": "read", "c": "create", "u": "update", "d": "delete",
              "t": "truncate", "m": "message"}

ENVELOPE_COLUMNS = ("operation", "data", "database", "table", "timestamp")

# The operational order table (fixed value: the ODS table's columns).
ORDER_INFO_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("operate_time", T.StringType()),
    T.StructField("province_id", T.IntegerType()),
    T.StructField("order_status", T.IntegerType()),
    T.StructField("total_amount", T.DoubleType()),
])

# The operational user table (fixed values: names and types of its columns).
USER_INFO_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("login_name", T.StringType()),
    T.StructField("nick_name", T.StringType()),
    T.StructField("passwd", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("phone_num", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("head_img", T.StringType()),
    T.StructField("user_level", T.StringType()),
    T.StructField("birthday", T.DateType()),
    T.StructField("gender", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("operate_time", T.StringType()),
    T.StructField("status", T.StringType()),
])
TABLE_SCHEMAS = {"order_info": ORDER_INFO_SCHEMA, "user_info": USER_INFO_SCHEMA}

ODS_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _operation(op: F.Column) -> F.Column:
    mapping = F.create_map(*[F.lit(x) for kv in OPERATIONS.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, F.lower(op)), F.lower(op))


def cdc_envelope(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``operation, data, database, table, timestamp`` from parsed change records.

    * database / table: second and third dot-separated parts of the topic;
    * operation: the lower-cased operation name;
    * data: the ``after`` image, or ``before`` for deletes (which have no
      ``after``); values are strings, NULL values are kept;
    * timestamp: milliseconds of the change, as text.

    ``keep`` names input columns to carry along (e.g. a Kafka offset).
    """
    parts = F.split(F.col("topic"), r"\.")
    return raw.select(
        _operation(F.col("op")).alias("operation"),
        F.coalesce(F.col("after"), F.col("before")).alias("data"),
        F.try_element_at(parts, F.lit(2)).alias("database"),
        F.try_element_at(parts, F.lit(3)).alias("table"),
        F.col("ts_ms").cast("string").alias("timestamp"),
        *keep)


def reject_reason(key: str | None = None) -> F.Column:
    """Why a parsed change record cannot be used; NULL for a good one.

    ``key`` names the column that the state is kept by: a record whose image
    lacks it is no part of the state (:func:`newest_changes`).
    """
    parts = F.split(F.col("topic"), r"\.")
    reason = (F.when(F.col("topic").isNull() & F.col("op").isNull(), F.lit("not a change record"))
               .when(F.coalesce(F.size(parts), F.lit(0)) < 3, F.lit("no server.database.table topic"))
               .when(F.col("op").isNull(), F.lit("no operation"))
               .when(F.col("after").isNull() & F.col("before").isNull(), F.lit("no row image")))
    if key is None:
        return reason
    image = F.coalesce(F.col("after"), F.col("before"))
    return reason.when(F.try_element_at(image, F.lit(key)).isNull(), F.lit("no key"))


def valid_changes(raw: DataFrame, key: str | None = None) -> DataFrame:
    """The parsed records that :func:`cdc_envelope` can use; with ``key``, those that have it."""
    return raw.filter(reject_reason(key).isNull())


def rejected_changes(raw: DataFrame, column: str = "value", key: str | None = None,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """``(value, reason)`` of the records that :func:`valid_changes` leaves out, with their text as it came."""
    return (raw.select(*keep, F.col(column).alias("value"), reject_reason(key).alias("reason"))
            .filter("reason is not null"))


def change_quality(envelope: DataFrame, key: str = "id", time_column: str = "create_time") -> DataFrame:
    """Per database and table: records, those without a key, and those whose time does not parse."""
    value = lambda c: F.try_element_at(F.col("data"), F.lit(c))
    parsed = F.try_to_timestamp(value(time_column), F.lit(ODS_TIME_FORMAT))
    return envelope.groupBy("database", "table").agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(value(key).isNull(), 1)).alias("withoutKey"),
        F.count(F.when(parsed.isNull(), 1)).alias("withoutTime"))


def envelope_json(envelope: DataFrame) -> DataFrame:
    """The envelope serialised as one JSON object per change (``value``), nulls kept."""
    return envelope.select(F.to_json(F.struct(*ENVELOPE_COLUMNS), JSON_KEEP_NULLS).alias("value"))


def cdc_route_topics(envelope: DataFrame, include_envelope: bool = False,
                     key_column: str | None = None) -> DataFrame:
    """``(topic, value)`` rows for a topic-per-table sink.

    The topic is the source table; the value is the row image as JSON
    (``include_envelope=True`` sends the whole envelope so that operation
    and time survive downstream). ``key_column`` adds the row's key as
    ``key``: a topic keeps the order of the changes of one key.
    """
    value = (F.to_json(F.struct(*ENVELOPE_COLUMNS), JSON_KEEP_NULLS) if include_envelope
             else F.to_json(F.col("data"), JSON_KEEP_NULLS))
    key = [F.try_element_at(F.col("data"), F.lit(key_column)).alias("key")] if key_column else []
    return envelope.select(F.col("table").alias("topic"), *key, value.alias("value"))


def cdc_typed_rows(envelope: DataFrame, schema: T.StructType = ORDER_INFO_SCHEMA,
                   table: str | None = None, op_column: str = "op") -> DataFrame:
    """Typed columns of ``schema`` from the ``data`` map, plus ``timestamp`` and the operation.

    Values that do not parse as the declared type become NULL instead of
    failing the stream. ``table`` keeps only that source table.
    """
    env = envelope if table is None else envelope.filter(F.col("table") == table)
    cols = [F.try_element_at(F.col("data"), F.lit(f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return env.select(*cols, F.col("timestamp"), F.col("operation").alias(op_column))


def cdc_watermark(rows: DataFrame, delay: str = "5 seconds",
                  millis_column: str = "timestamp") -> DataFrame:
    """Add ``event_time`` (from the envelope milliseconds) with a bounded-lateness watermark.

    On a stream the watermark trails the largest event time by ``delay``
    and is reported in the query progress; with no stateful operator after
    it, no row is dropped. The ODS partition commit applies the same
    lateness to the event times of the committed rows. On a batch it is a
    no-op.
    """
    event_time = F.timestamp_millis(F.col(millis_column).cast("bigint"))
    return rows.withColumn("event_time", event_time).withWatermark("event_time", delay)


def ods_partition_columns(rows: DataFrame, time_column: str = "create_time",
                          fmt: str = ODS_TIME_FORMAT) -> DataFrame:
    """Add ``dt`` (yyyy-MM-dd) and ``hr`` (HH) from a text time; unparseable -> NULL."""
    t = F.try_to_timestamp(F.col(time_column), F.lit(fmt))
    return rows.withColumn("dt", F.date_format(t, "yyyy-MM-dd")).withColumn("hr", F.date_format(t, "HH"))


def newest_changes(envelope: DataFrame, key: str = "id", tiebreak: str | None = None) -> DataFrame:
    """The newest change per ``(database, table, key)``, deletes included.

    Newest is the largest millisecond time, then ``tiebreak`` (e.g. a log
    offset), then the text of the change, so that the result is defined in
    every case. Changes without the key are left out (:func:`rejected_changes`
    with the key returns them, :func:`change_quality` counts them). ``max_by``
    aggregates partially in the map tasks, so a key with a huge change history
    is still folded in every task first.
    """
    tie = F.col(tiebreak).cast("bigint") if tiebreak else F.lit(None).cast("bigint")
    keyed = envelope.withColumn("_key", F.try_element_at(F.col("data"), F.lit(key))).filter("_key is not null")
    return newest_per_key(keyed, F.col("_key").alias(key), tie)


def newest_per_key(changes: DataFrame, key: Column, tie: Column) -> DataFrame:
    """The newest of ``changes`` for each database, table and ``key``; see :func:`newest_changes`."""
    order = F.struct(F.col("timestamp").cast("bigint"), tie, F.col("operation"),
                     F.to_json("data", JSON_KEEP_NULLS))
    return (changes.groupBy("database", "table", key)
            .agg(F.max_by(F.struct("operation", "timestamp", "data", tie.alias("tie")), order).alias("s"))
            .selectExpr("* except (s)", "s.operation", "s.timestamp", "s.data", "s.tie"))


def cdc_current_state(envelope: DataFrame, key: str = "id",
                      tiebreak: str | None = None) -> DataFrame:
    """``(database, table, key, operation, timestamp, data)``: the rows as they are now.

    The newest change of each key (:func:`newest_changes`); keys whose newest
    change is a delete are dropped.
    """
    return newest_changes(envelope, key, tiebreak).filter("operation <> 'delete'").drop("tie")


def cdc_dedup(envelope: DataFrame, position: tuple[str, ...] = (), delay: str = "1 hour") -> DataFrame:
    """Drop redelivered change events, and nothing else.

    A redelivery has the same source position (``position``, e.g. topic,
    partition and offset of the log) or, without one, the same envelope in
    full: database, table, operation, time and row image.

    On a stream the keys seen are kept state that expires: redeliveries are
    recognised within ``delay`` of each other by the clock of the batches, and
    the state is purged after it. That clock only moves on, whatever times the
    source, the topic or a file carries, so no change is ever late.
    """
    same = list(position) or ["database", "table", "operation", "timestamp", "_image"]
    out = envelope if position else envelope.withColumn("_image", F.to_json("data", JSON_KEEP_NULLS))
    if not envelope.isStreaming:
        return out.dropDuplicates(same).drop("_image")
    return (out.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", delay)
            .dropDuplicatesWithinWatermark(same).drop("_seen", "_image"))
