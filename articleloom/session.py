"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Adaptive execution starts from so many bytes of input a shuffle partition, and merges small ones.
SHUFFLE_BYTES = 128 << 20
LEAST_PARTITIONS = 200


def size_shuffles(spark: SparkSession, path: str) -> int:
    """Set the number of shuffle partitions to start from by the size of the files below a folder, from their listing."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = listed.agg(F.sum("length")).first()[0] or 0
    partitions = max(LEAST_PARTITIONS, -(-size // SHUFFLE_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("articleloom")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
