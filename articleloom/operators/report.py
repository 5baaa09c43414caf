"""Reports over processed articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: rows shown of the report by year.
YEARS_SHOWN = 20


def domain_counts(articles: DataFrame) -> DataFrame:
    """Articles per domain, largest first."""
    return articles.groupBy("domain").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "domain")


def domain_overview(articles: DataFrame) -> DataFrame:
    """Articles and mean text length per domain, largest first."""
    return (
        articles.groupBy("domain")
        .agg(F.count("*").alias("document_count"), F.avg("text_length").alias("avg_length"))
        .orderBy(F.desc("document_count"), "domain")
    )


def year_counts(articles: DataFrame, shown: int = YEARS_SHOWN) -> DataFrame:
    """Articles per known year, the latest ``shown`` years."""
    return (
        articles.filter(F.col("year").isNotNull() & (F.col("year") != ""))
        .groupBy("year").agg(F.count("*").alias("count"))
        .orderBy(F.desc("year"))
        .limit(shown)
    )


def domain_sample_titles(articles: DataFrame) -> DataFrame:
    """One title per domain: that of the lowest text id, so that reruns agree."""
    return articles.groupBy("domain").agg(F.min_by("title", "text_id").alias("sample_title"))


def domain_count(articles: DataFrame, domain: str) -> DataFrame:
    """One row: articles of one domain. On the partitioned table only its directory is read."""
    return articles.filter(F.col("domain") == domain).agg(F.count("*").alias("document_count"))


def index_status(chunks: DataFrame) -> DataFrame:
    """One row: chunks and distinct articles in a chunk index."""
    return chunks.agg(F.count("*").alias("total_chunks"), F.count_distinct("pmid").alias("total_articles"))
