"""Session settings the operators rely on.

* ANSI mode on: a bad text value aborts the load instead of turning NULL.
* Session time zone UTC: text without an offset is read as UTC and
  timestamp -> date conversion happens in UTC.
* AQE on, with skew-join splitting and runtime broadcast conversion, so a
  join side is broadcast only after its *measured* size is below the
  threshold; otherwise the sort-merge plan stays.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_URI = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")

# Settings every load depends on for correct results.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Generated code for wide projections can exceed HotSpot's 8000-bytecode
# JIT limit and would then run interpreted; let the JIT compile it.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"

# Settings for the physical plan (safe to override per cluster).
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # folders are listed by so many tasks, not by one task per folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # remove checkpoint files once the DataFrame that wrote them is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the runtime settings results depend on (ANSI casts, UTC)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def build_session(
    master: str | None = None,
    app_name: str = "tablesmith",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the library needs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **REQUIRED_CONF,
        **PLAN_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.extraJavaOptions": JVM_OPTIONS,
        "spark.executor.extraJavaOptions": JVM_OPTIONS,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialized intermediate data.

    Uses the cluster's ``spark.checkpoint.dir``. When that is unset, only a
    local session may fall back to a folder next to the warehouse: on a
    cluster it could be a folder that other executors do not see.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not _URI.match(root) and not root.startswith("/"):
        root = os.path.abspath(root)
    return root


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the folder.

    Keeps a folder the cluster already names; sets ``fallback`` (or the
    warehouse-relative default) only when none is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = fallback if fallback and not configured else checkpoint_root(spark)
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    Columnar and compressed: a fraction of what ``checkpoint()`` writes of wide
    rows, and a reader of few columns reads only these. The files are the
    caller's to remove."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
