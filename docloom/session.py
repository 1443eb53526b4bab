"""Session settings, kept in one place."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package assumes.  ANSI mode stays on (Spark 4
# default), hence the try_* functions throughout.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only below a size Spark measures at runtime (AQE); anything
    # larger falls back to a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # A repeated key inside one JSON object keeps its last value, as Python's
    # json module does; Spark's default would turn the whole document NULL.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # checkpoint files of DataFrames no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "docloom", extra: dict | None = None) -> SparkSession:
    """A session with this package's settings.  Master and shuffle partitions
    are set only if the caller names them, so spark-submit's stay in force."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - sessions without a SparkContext
        d = None
    return d or spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The configured checkpoint folder.  Where it is unset, a local session gets
    a folder of its own; on a cluster that is an error, as executors share none."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="docloom-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
            pass
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    except Exception:  # noqa: BLE001
        return d
