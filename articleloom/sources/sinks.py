"""Parquet and JSON out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleloom.schemas import SUMMARY_COLUMNS

# The output sizing rule.
ROWS_PER_FILE = 50_000
MIN_FILES = 10
MAX_FILES = 200


def output_partition_count(rows: Column) -> Column:
    """Number of output partitions for so many rows: one per 50,000, within 10 and 200."""
    return F.greatest(F.lit(MIN_FILES), F.least(F.lit(MAX_FILES), F.floor(rows / ROWS_PER_FILE))).cast("int")


def output_partition_plan(df: DataFrame) -> DataFrame:
    """One row: how many rows there are and how many partitions the sizing rule gives them."""
    return df.agg(F.count("*").alias("row_count")).withColumn("partitions", output_partition_count(F.col("row_count")))


def write_articles(articles: DataFrame, path: str) -> None:
    """Gzip Parquet under ``domain=/year=`` directories, replacing what is there.

    REBALANCE brings the rows of a directory together, so there are few files per directory,
    and splits a directory that is far larger than the rest over several tasks, so one hot
    domain does not become one task. The row limit keeps the files of a hot one even.
    """
    (
        articles.hint("rebalance", "domain", "year")
        .write.mode("overwrite")
        .partitionBy("domain", "year")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .parquet(path)
    )


def article_summary(articles: DataFrame) -> DataFrame:
    """The six columns of the summary."""
    return articles.select(*SUMMARY_COLUMNS)


def write_summary(articles: DataFrame, path: str) -> None:
    """Gzip JSON summary under ``domain=`` directories, replacing what is there."""
    (
        article_summary(articles).hint("rebalance", "domain")
        .write.mode("overwrite")
        .partitionBy("domain")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .json(path)
    )
