"""Session set-up and the shared working folder.

Everything the engine writes besides the destination log (frozen start
snapshots, audit and commit tables, quarantine, checkpoints) goes under one
*state root*.  On a cluster that root must be shared storage, so it is read
from the session (`spark.checkpoint.dir`, or the SparkContext checkpoint dir);
only when neither is set and the master is local (tests) is a fresh local
folder made; on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins with runtime sizes (this
# is the size check behind every broadcast of a derived table), coalesces the
# small shuffle outputs of metric aggregates and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.stateSchemaCheck": "true",
    # Let AQE coalesce partitions inside cached plans too (small cached
    # intermediates would otherwise run with the full shuffle partition count).
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The engine's settings on a builder (no master: spark-submit gives it)."""
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    return builder.config("spark.ui.enabled", "false")


def build_session(master: str = "local[*]", app: str = "spillway",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the engine's defaults; the UI stays off."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", os.environ.get("SPILLWAY_DRIVER_MEMORY", "8g")))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Metric times are wall-clock seconds in UTC, as the reference writes them."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (`local[n]`; not `local-cluster`)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def state_root(spark: SparkSession) -> str:
    """The shared folder for engine state.

    Order: `spark.checkpoint.dir` from the session conf, then the checkpoint
    dir already set on the SparkContext.  If neither is set, a local master
    (a test) gets a fresh local folder, registered as the checkpoint dir so
    that later calls agree; any other master raises, because each executor
    would write to a disk of its own.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    jsc = spark.sparkContext._jsc  # noqa: SLF001 - public getter via the Java context
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        # Spark appends a random sub-folder per application; use its parent so
        # that state survives a restart of the application.
        path = current.get()
        return path.rsplit("/", 1)[0] if "/" in path else path
    # `spark.checkpoint.dir` is a core setting that cannot change at run time;
    # the SparkContext checkpoint dir can, and later calls find it above.
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="spillway-state-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def under_state(spark: SparkSession, *parts: str) -> str:
    return "/".join([state_root(spark), *parts])
