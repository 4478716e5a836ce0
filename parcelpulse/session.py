"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for. Catalyst and AQE broadcast a side only when its
# measured size is below the thresholds, and split skewed partitions of the sort-merge
# join they use otherwise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call sites of column expressions cost driver time and only serve error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# For a cluster: partitions that fit executor memory, and enough of them for 100 TB.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("parcelpulse")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a fresh local folder only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        folder = context.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hold(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once, as a table in the shared folder, and read it from there.

    The table survives lost executors, cuts the lineage, and has a known size. That is the size
    of its files: rows that compress well are many times larger, so joins merge tables that
    grow with parcels times days.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
