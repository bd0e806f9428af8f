"""Session construction and shared-folder helpers.

Every job that writes intermediate or output data puts it under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared store on a real cluster).
Only when that setting is absent -- local tests -- do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (hundreds of TB, ~1000 executors): many shuffle
# partitions that AQE coalesces to ~256 MB each, 512 MB scan splits, skew
# splitting on, a broadcast threshold that stays far below executor memory.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "millrace", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    With a ``master`` (``local[N]``) the local defaults apply; without one the
    cluster defaults do and spark-submit decides the rest. The session time
    zone is pinned to UTC because date/partition text must not depend on the
    machine running the driver. ``spark.checkpoint.dir`` should name a shared
    folder on a cluster (see :func:`shared_dir`). An already running session is
    returned unchanged apart from the settings passed explicitly.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        # a running session keeps its settings; only explicit ones are applied
        for key, value in conf.items():
            try:
                active.conf.set(key, value)
            except Exception:  # static settings cannot change at run time
                pass
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_LOCAL_DEFAULTS if master else CLUSTER_DEFAULTS)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = _context(spark)
    if context is not None:
        context.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. If it is unset (tests on a
    laptop) a fresh local folder is created and registered; on a cluster the
    setting must name a shared store (HDFS, object store): without it this raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not base and context is not None:
        base = context.getCheckpointDir()
    if not base and (context is None or not context.master.startswith("local")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="millrace-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if context is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the shared folder (not created yet)."""
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs neither compute it
    again nor go back beyond it when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unique_name(prefix: str) -> str:
    """A catalog-safe unique identifier (tables and views are session-global)."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
