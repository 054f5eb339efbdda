"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs rely on. Shuffle partitions stay the cluster's business: AQE coalesces
# small ones and splits skewed ones, so set them for the largest exchange.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Approved rows and rejected lines are written apart by one task without sorting the rows for it.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Without it PySpark notes the Python call site of every column expression, which makes
    # building a plan of some thousand expressions several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("casefile")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named in spark.checkpoint.dir.

    A machine-local folder is used only where the setting is missing and Spark is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="casefile-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the scratch root; nothing is ever written there twice."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
