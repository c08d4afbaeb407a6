"""Session helpers.

The library never creates its own cluster settings: it reads what the session already has
(shuffle partitions, checkpoint directory) and only fills gaps for local runs and tests.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "propensity") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as is. Only when it is
    unset (a bare local session, as in tests) a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="propensity-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint directory (for tables written to cut lineage)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def materialize(df):
    """Cut lineage by writing a Parquet stage table under the shared checkpoint directory and reading it
    back. The rows are computed once (a bare reliable checkpoint would compute them twice), the table
    survives executor loss (unlike a local checkpoint), and later reads get column pruning and filter
    pushdown at the scan."""
    import uuid
    spark = df.sparkSession
    # scoped by application: an operator drops one folder per finished application
    path = shared_path(spark, "stage", spark.sparkContext.applicationId, uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
