"""Shared scratch space for tables that one job writes and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder the session names in ``spark.checkpoint.dir``, else under its warehouse.

    The folder must be one that the driver and all executors share: without a checkpoint folder, a warehouse in a local file system
    is refused unless the session is local.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        root = spark.conf.get(WAREHOUSE_DIR)
        if root.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return f"{root.rstrip('/')}/articleloom/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once and read back: the plan before them is not run again, also if executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
