"""Change-event streams: topic routing, the hour-partitioned ODS table with
partition commit, the current-state table and de-duplication.

A stream into a folder keeps its checkpoint in ``{path}/_checkpoints`` unless
another is named, so a second start with the same arguments goes on where the
first one stopped. A folder that a stream has written before is refused with
a new checkpoint: Spark's file sink would take the new stream's first batches
for ones it has already. Sinks without a folder need a checkpoint.

ODS table: :func:`ods_stream` appends typed rows with Spark's partitioned
parquet file sink (exactly-once through the sink's commit log).
:func:`partition_commit_stream` follows the committed files and marks a
partition ``(dt, hr)`` *complete* once the watermark - the largest event
time written so far minus the allowed lateness - has passed the
partition's time (the start of the hour) plus ``commit_delay``. Complete
partitions get a ``_SUCCESS`` file, a row in the commit log
``{path}/_ods_meta/commits`` and, when a catalog table is named,
``ALTER TABLE ... ADD IF NOT EXISTS PARTITION``. Late rows are never
dropped: they are appended even to a partition that is already marked, which
is then marked again with the next version; :func:`read_ods_as_marked` reads
the rows of a version.
The default delay of 61 minutes marks an hour once it is over; the
original job used 1 minute (``commit_delay='1 minute'``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from memberlens.operators.changes import ORDER_INFO_SCHEMA, cdc_route_topics, newest_changes, newest_per_key

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}   # fixed value: 5 s checkpoint cadence
ODS_PARTITIONS = ("dt", "hr")


# ----------------------------------------------------------------- folders

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the complete ``batch=N`` folders under ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[6:]) for n in names if n.startswith("batch=") and _exists(spark, f"{path}/{n}/_SUCCESS"))


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _writer(df: DataFrame, name: str, checkpoint: str | None, trigger: dict | None, path: str | None = None):
    """A named stream writer with its checkpoint; see the module text."""
    if checkpoint is None:
        if path is None:
            raise ValueError("name a checkpoint: this sink has no folder to keep one in")
        checkpoint = f"{path.rstrip('/')}/_checkpoints/{name}"
    spark = df.sparkSession
    if path and _exists(spark, f"{path}/_spark_metadata") and not _exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{path} was written by a stream whose checkpoint is not {checkpoint}; "
                         "name that checkpoint or another folder")
    return df.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER))


def rejects_stream(rejected: DataFrame, path: str, *, checkpoint: str | None = None, trigger: dict | None = None,
                   name: str = "cdc_rejects") -> StreamingQuery:
    """Append rejected records (text and reason) to a folder, partitioned by ``reason``."""
    return (_writer(rejected, name, checkpoint, trigger, path).format("json").partitionBy("reason")
            .option("path", path).start())


DEFAULT_TOPIC = "DEFAULT_DATA"   # fixed value: topic for rows without a table


def route_topics_stream(envelope: DataFrame, *, kafka_servers: str | None = None,
                        path: str | None = None, checkpoint: str | None = None,
                        trigger: dict | None = None, include_envelope: bool = False,
                        kafka_options: dict[str, str] | None = None,
                        fixed_topic: str | None = None, console: bool = False, key: str = "id",
                        name: str = "cdc_route_topics") -> StreamingQuery:
    """Send each change to the topic named after its table.

    With ``kafka_servers`` the Kafka sink routes rows by their ``topic``
    column, with the row's ``key`` as record key, so the changes of one row
    stay in order (at-least-once: pair with
    :func:`memberlens.operators.changes.cdc_dedup` downstream). Otherwise a JSON file sink partitioned by ``topic`` under
    ``path`` is written (exactly-once through the sink's commit log).
    """
    rows = cdc_route_topics(envelope, include_envelope, key if kafka_servers else None)
    rows = rows.withColumn("topic", F.coalesce(F.col("topic"), F.lit(DEFAULT_TOPIC)))
    if fixed_topic:
        # One topic for everything: the Kafka sink's ``topic`` option wins
        # over the column only when the column is absent.
        rows = rows.drop("topic")
    folder = None if console or kafka_servers else f"{path}/topic={fixed_topic}" if path and fixed_topic else path
    w = _writer(rows, name, checkpoint, trigger, folder)
    if console:
        return w.format("console").option("truncate", "false").start()
    if kafka_servers:
        w = w.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
        if fixed_topic:
            w = w.option("topic", fixed_topic)
        for k, v in (kafka_options or {}).items():
            w = w.option(k, v)
        return w.start()
    if not path:
        raise ValueError("give kafka_servers, path or console")
    if fixed_topic:
        return w.format("json").option("path", f"{path}/topic={fixed_topic}").start()
    return w.format("json").partitionBy("topic").option("path", path).start()


# ----------------------------------------------------------------- ODS sink

COMMIT_SCHEMA = "dt string, hr string, version int, rows long, files array<string>, watermark timestamp"
HOURS_SCHEMA = ("dt string, hr string, latest timestamp, version int, rows long, files array<string>, marked boolean, "
                "watermark timestamp")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _interval_seconds(text: str) -> float:
    """Seconds of a delay such as ``'5 seconds'`` or ``'1 hour 1 minute'``."""
    words = text.split()
    if not words or len(words) % 2:
        raise ValueError(f"bad delay {text!r}")
    total = 0.0
    for amount, unit in zip(words[::2], words[1::2]):
        total += float(amount) * _UNIT_SECONDS[unit.lower().rstrip("s")]
    return total


def ods_stream(rows: DataFrame, path: str, *, checkpoint: str | None = None,
               trigger: dict | None = None, name: str = "cdc_ods") -> StreamingQuery:
    """Append typed change rows (with ``dt``, ``hr``) to the ODS folder.

    Spark's file sink, partitioned by ``dt, hr``: exactly-once through the
    sink's own commit log, so a restarted query never writes a batch twice
    and readers only see committed files. Rows are rebalanced on the
    partition columns first, so each hour gets few files per batch and AQE
    splits an hour that holds most of a batch. No row is dropped for being
    late; the watermark only drives :func:`partition_commit_stream`.
    """
    data = rows.drop("event_time") if "event_time" in rows.columns else rows
    data = data.hint("rebalance", *ODS_PARTITIONS)
    return (_writer(data, name, checkpoint, trigger, path).format("parquet")
            .partitionBy(*ODS_PARTITIONS).option("path", path).start())


def commit_batch(batch: DataFrame, number: int, path: str, *, commit_delay: str = "61 minutes",
                 watermark_delay: str = "5 seconds", table: str | None = None,
                 success_file: bool = True, millis_column: str = "timestamp") -> list[tuple]:
    """Mark the hours that are complete after a batch of newly committed rows; returns them as ``(dt, hr, version)``.

    ``{path}/_ods_meta/hours/batch=N`` holds a row for each hour after batch N:
    its version (how often it was marked), and the rows and files that came
    since. An hour with new rows is marked once the watermark has passed it; an
    hour marked before that gets late rows is marked again, as its next version.
    A batch reads one such table and writes the next, so its work follows the
    hours, and its calls to the file system do not grow with the batches before
    it. Only the newly marked hours come to the driver. A replayed batch starts
    from the same table and overwrites its own results.
    """
    spark, meta = batch.sparkSession, f"{path}/_ods_meta"
    event_time = F.timestamp_millis(F.col(millis_column).cast("bigint"))
    timed = F.col("dt").isNotNull() & F.col("hr").isNotNull()         # rows without a time are in no hour
    file = F.when(timed, F.col("file")) if "file" in batch.columns else F.lit(None).cast("string")
    hours = (batch.withColumn("_file", file).groupBy(*ODS_PARTITIONS)
             .agg(F.max(event_time).alias("latest"), F.lit(0).alias("version"), F.count("*").alias("rows"),
                  F.collect_set("_file").alias("files")))
    before = [v for v in _versions(spark, f"{meta}/hours") if v < number]
    if before:
        none = F.array().cast("array<string>")
        held = spark.read.schema(HOURS_SCHEMA).parquet(f"{meta}/hours/batch={before[-1]}").select(
            *ODS_PARTITIONS, "latest", "version", F.when(F.col("marked"), F.lit(0)).otherwise(F.col("rows")).alias("rows"),
            F.when(F.col("marked"), none).otherwise(F.col("files")).alias("files"))
        hours = (hours.unionByName(held).groupBy(*ODS_PARTITIONS)
                 .agg(F.max("latest").alias("latest"), F.max("version").alias("version"), F.sum("rows").alias("rows"),
                      F.flatten(F.collect_list("files")).alias("files")))
    top = hours.agg((F.max("latest") - F.expr(f"interval {_interval_seconds(watermark_delay)} seconds")).alias("watermark"))
    start = F.try_to_timestamp(F.concat_ws(" ", "dt", "hr"), F.lit("yyyy-MM-dd HH"))
    over = start + F.expr(f"interval {_interval_seconds(commit_delay)} seconds") <= F.col("watermark")
    marked = F.coalesce((F.col("rows") > 0) & over, F.lit(False))     # never the hour without a time
    (hours.crossJoin(F.broadcast(top)).withColumn("marked", marked)
     .withColumn("version", F.col("version") + F.col("marked").cast("int"))
     .select("dt", "hr", "latest", "version", F.col("rows").cast("long").alias("rows"), "files", "marked", "watermark")
     .coalesce(1).write.mode("overwrite").parquet(f"{meta}/hours/batch={number}"))
    now = spark.read.schema(HOURS_SCHEMA).parquet(f"{meta}/hours/batch={number}").where("marked")
    complete = [(r["dt"], r["hr"], r["version"]) for r in now.select(*ODS_PARTITIONS, "version").collect()]
    if complete:
        (now.select("dt", "hr", "version", "rows", "files", "watermark").coalesce(1)
         .write.mode("overwrite").parquet(f"{meta}/commits/batch={number}"))
    if success_file and complete:
        # Marker files are metadata calls; they are issued side by side.
        with ThreadPoolExecutor(max_workers=min(16, len(complete))) as pool:
            list(pool.map(lambda r: _touch(spark, f"{path}/dt={r[0]}/hr={r[1]}/_SUCCESS"), complete))
    if table:
        for dt, hr, version in complete:
            if version == 1:
                spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (dt='{dt}', hr='{hr}')")
    for old in before[:-1]:
        _drop(spark, f"{meta}/hours/batch={old}")
    return complete


def partition_commit_stream(spark: SparkSession, path: str, *, checkpoint: str | None = None,
                            trigger: dict | None = None, commit_delay: str = "61 minutes",
                            watermark_delay: str = "5 seconds", table: str | None = None,
                            success_file: bool = True, millis_column: str = "timestamp",
                            schema: T.StructType = ORDER_INFO_SCHEMA,
                            name: str = "cdc_ods_commit") -> StreamingQuery:
    """Commit ODS partitions as the data behind them is committed.

    Reads the ODS folder as a stream (the file source reads only files the
    sink committed, and only new ones); :func:`commit_batch` does the rest.
    ``schema`` is that of the table's rows.
    """
    rows = (spark.readStream.schema(ods_schema(schema)).parquet(path)
            .select(*ODS_PARTITIONS, millis_column, F.col("_metadata.file_name").alias("file")))

    def on_batch(batch: DataFrame, number: int) -> None:
        commit_batch(batch, number, path, commit_delay=commit_delay, watermark_delay=watermark_delay, table=table,
                     success_file=success_file, millis_column=millis_column)

    checkpoint = checkpoint or f"{path.rstrip('/')}/_checkpoints/{name}"
    return _writer(rows, name, checkpoint, trigger).foreachBatch(on_batch).start()


def ods_schema(schema: T.StructType = ORDER_INFO_SCHEMA) -> T.StructType:
    """The columns of an ODS table whose change rows have ``schema``."""
    text = [T.StructField(c, T.StringType()) for c in ("timestamp", "op", *ODS_PARTITIONS)]
    return T.StructType([*schema.fields, *text])


def read_ods(spark: SparkSession, path: str, schema: T.StructType = ORDER_INFO_SCHEMA) -> DataFrame:
    """The ODS folder with ``dt``/``hr`` kept as strings (explicit schema, no inference)."""
    return spark.read.schema(ods_schema(schema)).parquet(path)


def read_commit_versions(spark: SparkSession, path: str) -> DataFrame:
    """Every marking of an hour: ``dt, hr, version, rows, files, watermark``; rows and files are those it added."""
    root = f"{path}/_ods_meta/commits"
    if not _exists(spark, root):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true").parquet(root)


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """The hours marked complete, as last marked: ``dt, hr, watermark, version, rows`` (all rows up to that version)."""
    return (read_commit_versions(spark, path).groupBy(*ODS_PARTITIONS)
            .agg(F.max("watermark").alias("watermark"), F.max("version").alias("version"), F.sum("rows").alias("rows")))


def read_ods_as_marked(spark: SparkSession, path: str, version: int | None = 1,
                       schema: T.StructType = ORDER_INFO_SCHEMA) -> DataFrame:
    """The rows of the marked hours, each hour as of its ``version`` (or its last, where it has fewer; None: the last).

    A reader that is pinned to a version sees the same rows whatever comes
    late: a version is made of the files that were there when it was marked.
    """
    commits = read_commit_versions(spark, path)
    if version is not None:
        commits = commits.where(F.col("version") <= version)
    files = commits.select(*ODS_PARTITIONS, F.explode("files").alias("_file")).distinct()
    rows = read_ods(spark, path, schema).withColumn("_file", F.col("_metadata.file_name"))
    return rows.join(files, [*ODS_PARTITIONS, "_file"], "left_semi").drop("_file")


# ----------------------------------------------------------------- state and dedup streams

STATE_SCHEMA = "database string, table string, {key} string, operation string, timestamp string, data map<string,string>, tie long"


MANIFEST_SCHEMA = "first long, last long, rows long"


def current_state_stream(envelope: DataFrame, path: str, *, key: str = "id",
                         tiebreak: str | None = None, checkpoint: str | None = None,
                         trigger: dict | None = None, compact_every: int = 20, ratio: float = 2.0,
                         name: str = "cdc_current_state") -> StreamingQuery:
    """Newest change per ``(database, table, key)``, kept as a tiered log; :func:`append_state` is one batch of it.

    :func:`read_current_state` resolves the log. Deletes stay in the state (a
    later re-insert must win over them).
    """
    def on_batch(batch: DataFrame, number: int) -> None:
        append_state(batch, number, path, key=key, tiebreak=tiebreak, compact_every=compact_every, ratio=ratio)

    checkpoint = checkpoint or f"{path.rstrip('/')}/_checkpoints/{name}"
    return _writer(envelope, name, checkpoint, trigger).foreachBatch(on_batch).start()


def append_state(batch: DataFrame, number: int, path: str, *, key: str = "id", tiebreak: str | None = None,
                 compact_every: int = 20, ratio: float = 2.0) -> None:
    """Add one batch of changes to the state log in ``path``.

    * The newest change of the keys that the batch touched goes to
      ``changes/batch=N``.
    * Every ``compact_every`` batches those since the last merge become a run
      ``runs/FIRST-LAST`` of files by key range, together with the older runs
      that have fewer than ``ratio`` times the rows to merge. A large state is
      thus written again only once a share of it has changed, and a change is
      written a number of times that grows with the logarithm of the state.
    * ``manifests/batch=N`` names the runs that hold all changes up to N. The
      last two manifests, their runs and the batches after the older one are
      kept, so a reader goes on through a merge, or reads the state of any
      batch after the older manifest.

    A batch that is replayed overwrites its own folders with the same rows;
    a merge that a manifest names already isn't done again.
    """
    spark = batch.sparkSession
    if _exists(spark, f"{path}/snapshots"):
        raise ValueError(f"{path} holds a state log in an older layout; start it again in another folder")
    newest_changes(batch, key, tiebreak).write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
    manifests = _versions(spark, f"{path}/manifests")
    covered = max((v for v in manifests if v < number), default=-1)
    if number in manifests or number - covered < compact_every:
        return
    runs = state_runs(spark, path, covered)
    log = spark.read.schema(STATE_SCHEMA.format(key=key))
    parts = [f"{path}/changes/batch={v}" for v in _versions(spark, f"{path}/changes") if covered < v <= number]
    first, rows = covered + 1, log.parquet(*parts).count()      # counted from the files' footers
    while runs and runs[-1][2] < ratio * rows:
        first, last, more = runs.pop()
        parts.append(f"{path}/runs/{first}-{last}")
        rows += more
    folder = f"{path}/runs/{first}-{number}"
    # A key is once in a part, so there is nothing to fold before the one shuffle, which makes the key ranges.
    ranges = log.parquet(*parts).repartitionByRange("database", "table", key)
    newest_per_key(ranges, F.col(key), F.col("tie")).sortWithinPartitions("database", "table", key).write.mode("overwrite").parquet(folder)
    runs.append((first, number, spark.read.schema(STATE_SCHEMA.format(key=key)).parquet(folder).count()))
    spark.createDataFrame(runs, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifests/batch={number}")
    _drop_covered(spark, path, [*(v for v in manifests if v < number), number])


def _drop_covered(spark: SparkSession, path: str, manifests: list[int]) -> None:
    """Drop what only manifests before the last two name."""
    if len(manifests) < 2:
        return
    for old in manifests[:-2]:
        _drop(spark, f"{path}/manifests/batch={old}")
    for old in _versions(spark, f"{path}/changes"):
        if old <= manifests[-2]:
            _drop(spark, f"{path}/changes/batch={old}")
    named = {f"{first}-{last}" for v in manifests[-2:] for first, last, _ in state_runs(spark, path, v)}
    fs, folder = _fs(spark, f"{path}/runs")
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in named:
            fs.delete(status.getPath(), True)


def state_runs(spark: SparkSession, path: str, manifest: int) -> list[tuple[int, int, int]]:
    """``(first, last, rows)`` of the runs that a manifest names, oldest first; their sizes fall by a ratio, so they are few."""
    if manifest < 0:
        return []
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifests/batch={manifest}").collect()
    return sorted(tuple(r) for r in rows)


def state_version(spark: SparkSession, path: str) -> int:
    """The number of the last batch in a state log; -1 where there is none."""
    return max((v for kind in ("manifests", "changes") for v in _versions(spark, f"{path}/{kind}")), default=-1)


def read_current_state(spark: SparkSession, path: str, key: str = "id", at: int | None = None) -> DataFrame:
    """Current rows from what :func:`current_state_stream` wrote (deletes removed).

    ``at`` reads the state as of a batch (:func:`state_version` names the
    last), as long as it is kept. A filter on database, table or key reaches
    the files, which hold key ranges.
    """
    manifests, batches = (_versions(spark, f"{path}/{kind}") for kind in ("manifests", "changes"))
    if at is not None and at not in (*manifests, *batches):
        raise ValueError(f"the state of batch {at} is not kept in {path}")
    base = max((v for v in manifests if at is None or v <= at), default=-1)
    parts = [f"{path}/runs/{first}-{last}" for first, last, _ in state_runs(spark, path, base)]
    parts += [f"{path}/changes/batch={v}" for v in batches if v > base and (at is None or v <= at)]
    schema = STATE_SCHEMA.format(key=key)
    log = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return newest_per_key(log, F.col(key), F.col("tie")).filter("operation <> 'delete'").drop("tie")


# ----------------------------------------------------------------- catalog table

def ensure_ods_table(spark: SparkSession, table: str, path: str, schema: T.StructType = ORDER_INFO_SCHEMA) -> None:
    """Create the ODS catalog table over ``path`` (and its database) if it does not exist; never dropped."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ods_schema(schema).fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) "
              f"USING parquet PARTITIONED BY (dt, hr) LOCATION '{path}'")
