"""Parquet in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleloom.schemas import ARTICLES


def read_partitioned_articles(spark: SparkSession, path: str) -> DataFrame:
    """The stored articles, with ``domain`` and ``year`` taken from directories as text."""
    return spark.read.schema(ARTICLES).parquet(path).select(*ARTICLES.names)


def read_parquet_tree(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every ``*.parquet`` file anywhere under ``path``; unreadable files are skipped: see ``skipped_files``.

    Directory names are not read as columns here: use ``read_partitioned_articles`` for that. If no file gives a
    row it is an error.
    """
    rows = _parquet_tree(spark, path, schema)
    if not rows.limit(1).count():
        raise ValueError(f"no file below {path} could be read")
    return rows


def skipped_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``path`` of the Parquet files under ``path`` that gave no row: unreadable ones, and empty ones.

    The files come from their listing, and of those that can be read only their names are.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(path).select(F.col("path").alias("file")))
    read = _parquet_tree(spark, path, schema).select(F.col("_metadata.file_path").alias("file")).distinct()
    # Two listings write the start of a path in different ways.
    name = F.regexp_replace("file", "^file:/+", "/")
    return listed.select(name.alias("path")).join(read.select(F.url_decode(name).alias("path")), "path", "left_anti")


def _parquet_tree(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", "true")
        .parquet(path)
    )


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column that a frame lacks is null for its rows."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
