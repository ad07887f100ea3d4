"""Database change records: schemas, readers and a generator from events.

A change record is the JSON a change-data-capture connector publishes per
row change: ``topic`` (``server.database.table``), ``op`` (``r`` snapshot
read, ``c`` create, ``u`` update, ``d`` delete), ``ts_ms`` (milliseconds of
the change) and the row image ``before``/``after``. Row images are read as
``map<string,string>``: every value becomes its JSON text, and a JSON null
stays NULL, so one schema serves every source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_IMAGE = T.MapType(T.StringType(), T.StringType(), valueContainsNull=True)
RAW_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("before", ROW_IMAGE),
    T.StructField("after", ROW_IMAGE),
])
JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def parse_change_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """``topic, op, ts_ms, before, after`` from JSON text records (other columns kept)."""
    parsed = F.from_json(F.col(column).cast("string"), RAW_SCHEMA)
    clash = [c for c in RAW_SCHEMA.fieldNames() if c in lines.columns]
    return lines.withColumn("_rec", parsed).drop(*clash).select("*", "_rec.*").drop("_rec")


def read_change_files(spark: SparkSession, path: str, stream: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines change records from a folder, as a batch or a streaming DataFrame.

    The records keep their text (``value``).
    """
    if stream:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return parse_change_json(reader.load(path))
    return parse_change_json(spark.read.text(path))


def read_change_kafka(spark: SparkSession, bootstrap_servers: str, topics: str | None = None,
                      pattern: str | None = None, starting_offsets: str = "earliest",
                      stream: bool = True, group_id: str | None = None,
                      options: dict[str, str] | None = None) -> DataFrame:
    """Change records from Kafka: one topic list (``subscribe``) or a regex (``subscribePattern``).

    ``starting_offsets='earliest'`` replays the snapshot and the change log;
    ``'latest'`` reads new changes only. New topics matching ``pattern`` and
    new partitions are picked up at every micro-batch. Needs the Kafka
    connector package on the cluster's class path.
    """
    if bool(topics) == bool(pattern):
        raise ValueError("give exactly one of topics or pattern")
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", bootstrap_servers)
    reader = reader.option("subscribe" if topics else "subscribePattern", topics or pattern)
    reader = reader.option("startingOffsets", starting_offsets)
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load().select(F.col("value").cast("string").alias("value"),
                               F.col("topic").alias("kafka_topic"), "partition", "offset",
                               F.col("timestamp").alias("arrival"))
    return parse_change_json(raw)


# ----------------------------------------------------------------- records from events

SERVER = "mysql"          # fixed value: server name in the generated topics
DATABASE = "ecommerce"    # fixed value: the shop database


def change_records_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Change records (JSON text in ``value``; ``seq``, ``ts_ms`` alongside) from ``events``.

    Purchases become changes of ``order_info`` rows, all other events
    changes of ``user_info`` rows; ``view`` is a snapshot read, ``signup`` a
    create, ``error`` a delete (row image in ``before`` only) and the rest
    updates (both images). Each table's images have its own columns; both hold
    real NULLs (``operate_time`` of reads and creates, ``passwd``, every third
    ``gender``). ``keep`` names columns to carry.
    """
    ts, user, event = F.col("ts").cast("timestamp"), F.col("user_id"), F.col("event_id")
    order = F.col("event_type") == "purchase"
    op = (F.when(F.col("event_type") == "view", F.lit("r"))
           .when(F.col("event_type") == "signup", F.lit("c"))
           .when(F.col("event_type") == "error", F.lit("d"))
           .otherwise(F.lit("u")))
    created = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    operated = F.when(op.isin("u", "d"), created)
    order_row = {"id": event, "user_id": user, "create_time": created, "operate_time": operated,
                 "province_id": event % 34, "order_status": F.lit(1) + event % 5, "total_amount": F.col("value")}
    name = F.concat(F.lit("user"), user.cast("string"))
    user_row = {"id": user, "login_name": name, "nick_name": F.concat(F.lit("nick"), (user % 10).cast("string")),
                "passwd": F.lit(None), "name": F.concat(F.lit("N "), (event % 100).cast("string")),
                "phone_num": F.concat(F.lit("138"), F.lpad(user.cast("string"), 8, "0")),
                "email": F.concat(name, F.lit("@example.org")), "head_img": F.lit(""),
                "user_level": (F.lit(1) + event % 3).cast("string"),
                "birthday": F.date_add(F.lit("1990-01-01").cast("date"), (user % 3650).cast("int")),
                "gender": F.when(user % 3 == 1, F.lit("F")).when(user % 3 == 2, F.lit("M")),
                "create_time": created, "operate_time": operated, "status": (event % 2).cast("string")}

    def image(row: dict):
        return F.create_map(*[x for c, v in row.items() for x in (F.lit(c), v.cast("string"))])

    row = F.when(order, image(order_row)).otherwise(image(user_row))
    table = F.when(order, F.lit("order_info")).otherwise(F.lit("user_info"))
    record = F.struct(F.concat(F.lit(f"{SERVER}.{DATABASE}."), table).alias("topic"),
                      op.alias("op"),
                      F.unix_millis(ts).alias("ts_ms"),
                      F.when(op.isin("u", "d"), row).alias("before"),
                      F.when(op != "d", row).alias("after"))
    return events.select(*keep, F.col("event_id").alias("seq"), F.unix_millis(ts).alias("ts_ms"),
                         F.to_json(record, JSON_KEEP_NULLS).alias("value"))


def with_broken_records(records: DataFrame) -> DataFrame:
    """The records with some of each kind that a reader must reject, by ``seq``.

    Cut off in the middle (101 divides ``seq``), a topic without a database
    (103), no operation (107), no row image (109).
    """
    seq, value = F.col("seq"), F.col("value")
    return records.withColumn("value", F.when(seq % 101 == 0, F.substring(value, 1, 20))
                              .when(seq % 103 == 0, F.regexp_replace(value, r'"topic":"\w+\.\w+\.', '"topic":"'))
                              .when(seq % 107 == 0, F.regexp_replace(value, r'"op":"\w"', '"op":null'))
                              .when(seq % 109 == 0, F.regexp_replace(value, r'"before":.*$', '"before":null,"after":null}'))
                              .otherwise(value))


CHUNKS = 8


def snapshot_from_changes(envelope: DataFrame, position: str = "seq") -> tuple[DataFrame, DataFrame]:
    """What a chunked snapshot of the tables behind a log would have read: ``(rows, marks)``.

    Each table's ids (from 0 on) are cut into ``CHUNKS`` ranges of one width;
    chunk k is read when about (k + 1) / (2 CHUNKS + 2) of the log is written,
    with the marks a fortieth of the log before and after the moment it saw.
    """
    key = F.try_element_at(F.col("data"), F.lit("id"))
    log = envelope.withColumn("_id", key.cast("bigint")).withColumn("_pos", F.col(position))
    ends = log.groupBy("database", "table").agg(F.max("_id").alias("_most"), F.max("_pos").alias("_last"))
    marks = (ends.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CHUNKS - 1).cast("long"))))
             .withColumn("_width", F.expr(f"_most div {CHUNKS} + 1"))
             .withColumn("low_mark", F.expr(f"_last * (chunk + 1) div {2 * CHUNKS + 2}"))
             .withColumn("_seen", F.expr("low_mark + _last div 40"))
             .withColumn("high_mark", F.expr("low_mark + _last div 20"))
             .withColumn("low_key", F.when(F.col("chunk") > 0, (F.col("chunk") * F.col("_width")).cast("string")))
             .withColumn("high_key", F.when(F.col("chunk") < CHUNKS - 1,
                                            ((F.col("chunk") + 1) * F.col("_width")).cast("string"))))
    seen = (log.join(F.broadcast(marks), ["database", "table"])        # CHUNKS rows a table
            .where(F.expr("chunk = _id div _width") & (F.col("_pos") <= F.col("_seen")))
            .groupBy("database", "table", "chunk", "_id")
            .agg(F.max_by(F.struct("operation", "data"), "_pos").alias("c"))
            .where("c.operation <> 'delete'").select("database", "table", "chunk", "c.data"))
    return seen, marks.select("database", "table", "chunk", "low_key", "high_key", "low_mark", "high_mark")
