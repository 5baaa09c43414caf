"""The supplied tables in the shapes the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articleloom.operators.extract import EXTRACTED_COLUMNS
from articleloom.schemas import RAW_ARTICLE

# A lexicon whose words occur in the supplied texts.
LANGUAGE_LEXICON = [
    ("german", ["ü", "ß", "ung"]),
    ("spanish", ["ñ", "ción"]),
    ("french", ["ç", "eaux"]),
    ("english", ["The", "with", "other"]),
]
LANGUAGE_DEFAULT = "other"


def spread(df: DataFrame) -> DataFrame:
    """Deal out a bare scan that has fewer splits than the session has cores.

    A small file with one row group is one task however wide the cluster. A large input
    already has more splits than cores and is left alone: no shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def extracted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as extracted articles: copies of one text share a key, short texts lack a year."""
    documents = table(spark, sf_dir, "documents")
    year = (
        F.when(F.col("n_chars") < 100, F.lit(None))
        .when(F.col("n_chars") < 200, "")
        .otherwise((1990 + F.col("n_chars") % 35).cast("string"))
    )
    return documents.select(
        F.md5("text").alias("pmid"),
        F.concat(F.lit("Document "), F.col("doc_id"), F.lit(" in "), F.col("lang")).alias("article_title"),
        F.col("source").alias("journal"),
        year.alias("year"),
        F.col("text").alias("citation_text"),
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("ref_id"),
    ).select(*EXTRACTED_COLUMNS)


def extracted_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with keys that are unknown in German and null in Spanish documents."""
    key = (
        F.when(F.col("article_title").endswith(" in de"), "unknown")
        .when(F.col("article_title").endswith(" in es"), F.lit(None))
        .otherwise(F.col("pmid"))
    )
    return extracted_documents(spark, sf_dir).withColumn("pmid", key)


RAW_FIELDS = {
    "ids": """
        CASE WHEN n_chars < 100 THEN NULL
             WHEN n_chars < 200 THEN array(named_struct('_VALUE', '10.1/' || doc_id, '_pub-id-type', 'doi'))
             ELSE array(named_struct('_VALUE', '10.1/' || doc_id, '_pub-id-type', 'doi'),
                        named_struct('_VALUE', string(doc_id), '_pub-id-type', 'pmid')) END""",
    "dates": """
        CASE WHEN n_chars < 100 THEN NULL
             WHEN n_chars < 200 THEN array(named_struct('_pub-type', 'epub', 'year', '1989'))
             ELSE array(named_struct('_pub-type', 'epub', 'year', '1989'),
                        named_struct('_pub-type', 'ppub', 'year', string(1990 + n_chars % 35))) END""",
    "title": "CASE WHEN lang <> 'fr' THEN 'Part <i>' || doc_id || '</i>' END",
    "journal": "CASE WHEN lang <> 'fr' THEN source END",
    "abstract": r"""
        CASE WHEN lang <> 'es' THEN array(named_struct('p', CAST(NULL AS ARRAY<STRING>)),
                                          named_struct('p', split(text, '\n'))) END""",
    "body": "CASE WHEN lang <> 'de' THEN text END",
    "ref_id": "'doc-' || doc_id",
}

RAW_FRONT = """
    named_struct(
        'journal-meta', named_struct('journal-title-group', named_struct('journal-title', journal)),
        'article-meta', named_struct('article-id', ids, 'title-group', named_struct('article-title', title),
                                     'pub-date', dates, 'abstract', abstract))"""


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw nested articles with parts missing.

    Below 100 characters there is no article id and no date, below 200 only a DOI and an
    electronic date. German documents have no body, Spanish ones no abstract, French ones no title and
    no journal. The abstract is the lines of the text beside an abstract without paragraphs.
    """
    fields = table(spark, sf_dir, "documents").selectExpr(*(f"{sql} AS {name}" for name, sql in RAW_FIELDS.items()))
    return fields.select(F.expr(RAW_FRONT).cast(RAW_ARTICLE["front"].dataType).alias("front"), "body", "ref_id")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question"))


def vector_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored vector asks for its neighbours; how many depends on its label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("question_id"), "embedding", (F.col("label") % 3 + 4).alias("top_k"))
