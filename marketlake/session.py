"""Session construction and shared-folder helpers.

Cluster settings come from the session; this module only fills gaps for local
runs (tests, bench). Nothing here writes to a machine-local temp folder unless
the session has no shared checkpoint folder configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Settings every marketlake job relies on. AQE re-plans joins from measured
#: shuffle sizes (the broadcast decision is a runtime size check, with
#: sort-merge as the fallback), coalesces small partitions and splits skewed
#: ones.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # No broadcast from the planner's estimates: only sides that AQE has measured.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.parquet.filterPushdown": "true",
    # list many small landing folders in batches rather than one task per folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "marketlake") -> SparkSession:
    """A local session for tests and the bench (UI off, no extra ports)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARKETLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings that an existing (cluster) session leaves unset."""
    chosen = spark.conf.getAll
    for k, v in JOB_CONF.items():
        if k not in chosen:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only where unset (local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
    local = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for materialised intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
