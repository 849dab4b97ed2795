"""Session helpers: a local session for tests/bench, and the checkpoint folder.

The library never chooses a machine-local folder on a cluster: iterative
operators read ``spark.checkpoint.dir`` from the session.  Only a local
master without that setting (tests, the bench) gets a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "marginflow",
                  driver_memory: str = "8g", event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench.

    ``event_log_dir`` (or $MARGINFLOW_EVENT_LOG) writes Spark's event log
    there, for stage and task timings without the web UI.
    """
    builder = SparkSession.builder
    event_log_dir = event_log_dir or os.environ.get("MARGINFLOW_EVENT_LOG")
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true") \
                         .config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative training needs a "
            "shared folder (HDFS/S3/ABFS) that every executor can reach")
    folder = tempfile.mkdtemp(prefix="marginflow-ckpt-",
                              dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def shared_table(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    Cuts the lineage and lets later passes prune columns and split the files;
    a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_row(spark: SparkSession) -> DataFrame:
    """A one-row, one-partition relation to hang literals on."""
    return spark.range(0, 1, 1, 1)
