"""Session helpers.

The library never sets a master and never carries credentials. Settings
that matter for correctness (UTC session time zone) and for scale (AQE,
skew-join splitting, partition coalescing) are applied only where the
cluster has not set them already.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults applied when the session does not set them itself.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_LOCAL_FALLBACK: dict[str, str] = {}


def get_session(app_name: str = "memberlens", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, hive: bool = False) -> SparkSession:
    """Return the active session, creating one if needed.

    ``master`` is only for tests and local runs; on a cluster leave it unset
    so the launcher decides. ``hive=True`` reads the shop tables from a Hive
    metastore (its address comes from the cluster's ``hive-site.xml``).
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: enforce UTC there too,
    # because day strings and hour partitions are derived from timestamps.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set to a shared file system that the driver
    and every executor see. Only when it is unset, as in local tests, a
    folder is created once per application and registered with the
    SparkContext, so streaming checkpoints and lineage cuts have a home.
    """
    try:
        sc = spark.sparkContext
        configured, master = sc.getConf().get("spark.checkpoint.dir", None), sc.master
    except Exception:  # a Spark Connect session has no SparkContext
        sc, master = None, "unknown"
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if sc is None:
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared "
                           "folder (e.g. on the distributed file system); a driver-local folder "
                           "would not survive a lost executor or a restarted driver")
    app = sc.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="memberlens-ckpt-")
        sc.setCheckpointDir(_LOCAL_FALLBACK[app])
    return _LOCAL_FALLBACK[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"



def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder.

    Use it between a large build and many consumers (the tag table before
    a batch of segment queries): consumers then read the checkpointed
    files instead of recomputing the build, and a lost executor costs a
    re-read, not a rebuild. Never a machine-local folder: the checkpoint
    goes to ``spark.checkpoint.dir``.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def scale_settings(input_bytes: int, cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Shuffle sizing for a job reading ``input_bytes`` on ``cores`` cores.

    Starts with enough shuffle partitions that each holds about
    ``target_partition_mb`` (at least three waves of tasks), lets AQE
    coalesce small ones to the same advisory size and split skewed ones,
    and caps scan splits at 256 MB so tasks fit executor memory. Apply with
    ``get_session(extra=scale_settings(...))`` or ``spark.conf.set``.
    """
    target = target_partition_mb * 1024 * 1024
    partitions = max(3 * cores, -(-input_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    }
