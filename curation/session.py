"""Spark session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Fixed run clock used by the registered queries (never ``now()``), so the
# batch results, the streaming results and the SQL oracle agree.
AS_OF = "2024-01-31 00:00:00"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "curation") -> SparkSession:
    """Local session with the settings the jobs assume (UTC, AQE, no UI)."""
    master = master or os.environ.get("CURATION_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
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
        # the literal bound of the budget's group limit (default budget)
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "4000")
        .config("spark.driver.memory", os.environ.get("CURATION_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when it is unset and driver and executors are one process
    (local tests) a private folder is created; elsewhere this fails.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="curation-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in any store Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and read it back
    (reliable ``checkpoint``: cuts lineage, survives executor loss); used
    where several outputs read the same narrow intermediate."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
