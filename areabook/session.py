"""Session helpers: the settings every job relies on, and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

#: Set only where neither the submitter nor a running session has set them.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "areabook", stage_dir: str | None = None) -> SparkSession:
    """A session with DEFAULTS where nothing else is set: settings of the submitter (spark-submit
    --conf, spark-defaults) and of a session that already runs win. `shuffle_partitions` and
    `stage_dir` (the shared folder of staged tables) are explicit and apply. Small local defaults
    (memory, partitions) apply to local masters only."""
    running = SparkSession.getActiveSession()
    if running is not None:
        if shuffle_partitions:
            running.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
        if stage_dir:
            running.sparkContext.setCheckpointDir(stage_dir)
        return running
    SparkContext._ensure_initialized()       # from here SparkConf shows what the submitter set
    given = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = dict(DEFAULTS)
    if is_local(master or given.get("spark.master", "local[*]")):
        defaults["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
        defaults["spark.sql.shuffle.partitions"] = os.environ.get("BENCH_CPUS", "8")
    for k, v in defaults.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if stage_dir:
        builder = builder.config("spark.checkpoint.dir", stage_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """One process: driver and executors share its folders."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Where none is set, local sessions (tests) get a fresh
    folder; on a cluster that would be a folder other machines cannot read, so it is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir (or --stage-dir) to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="areabook-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
