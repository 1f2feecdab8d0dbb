"""Spark session helpers.

Library code never creates its own session: every operator takes DataFrames.
``get_session`` is for tests, the bench and command-line runs. On a cluster the
session comes from the platform and its settings win; we only fill gaps.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins with runtime sizes, merges
# tiny shuffle partitions and splits skewed ones; none of them change results.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "retentio",
                shuffle_partitions: int | None = None) -> SparkSession:
    """A session; what the platform (``spark-submit``, ``spark-defaults.conf``) has set
    stays as it is, and only arguments given here override it."""
    given = SparkConf()
    cpus = os.environ.get("BENCH_CPUS", "8")
    gaps = {"spark.master": f"local[{cpus}]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "16g"), **SCALE_CONF}
    if given.get("spark.master", master or "local").startswith("local"):
        gaps["spark.sql.shuffle.partitions"] = cpus  # a cluster's own setting, or Spark's default, holds elsewhere
    builder = SparkSession.builder.appName(app)
    for k, v in gaps.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and we use it as given.
    Only when it is unset and the master is local (tests) do we pick a scratch
    folder ourselves, through ``setCheckpointDir`` (the conf key itself is
    static). Executors of a cluster would not see such a folder, so there a
    missing setting is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    current = tempfile.mkdtemp(prefix="retentio-ckpt-")
    sc.setCheckpointDir(current)
    return current


def cluster_conf(input_bytes: int, executor_cores: int = 4, target_partition_bytes: int = 256 << 20) -> dict:
    """Suggested sizing for a large run (pass to ``spark-submit --conf`` or the builder).

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    of the largest shuffled input (AQE then merges small ones and splits skewed
    ones); scan splits stay at 256 MB so a task's input fits executor memory.
    """
    parts = max(executor_cores * 2, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
