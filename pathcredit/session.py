"""Session helpers: a configured local session for tests/bench, and shared work dirs.

On a cluster the session is created by the platform; the library only *reads*
its settings.  The one exception is ``spark.checkpoint.dir``: it is set here
only when the session has none (local tests), never overridden.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_FALLBACK = "/tmp/pathcredit-checkpoints"


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, app: str = "pathcredit", extra_conf: dict | None = None
) -> SparkSession:
    """A local session tuned for small-data tests and the bench."""
    builder = SparkSession.builder
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            # A machine-local folder is not visible to other executors or a
            # restarted driver: refuse instead of guessing.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (checkpoints and work tables live there)")
        conf_dir = _LOCAL_CHECKPOINT_FALLBACK  # local sessions (tests) only
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for written intermediate tables and stream checkpoints.

    It lives under the cluster-wide checkpoint directory so that every executor
    (and a re-launched driver) sees it; never under a machine-local temp dir.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pathcredit-work/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    value = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(value))
    except ValueError:  # e.g. "auto" on some platforms
        return max(1, spark.sparkContext.defaultParallelism)


def materialize(df, name: str):
    """Write ``df`` once as a parquet table under the shared checkpoint folder
    and return the table.  Cuts the lineage like ``checkpoint()`` but computes
    the plan once (an eager checkpoint runs it again to write), and the
    read-back keeps column pruning and filter pushdown."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # known schema: no footer scan
