"""The three jobs: store articles, build the chunk index, answer questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from articleloom.functions.lexicon import DEFAULT_DOMAIN, MEDICAL_DOMAINS, Lexicon
from articleloom.operators import context, report
from articleloom.operators.chunk import CHUNK_OVERLAP, CHUNK_SIZE
from articleloom.operators.extract import extract_fields
from articleloom.operators.index import append_to_index, open_chunk_index
from articleloom.operators.quality import drop_blank_content, funnel_counts, is_usable, keep_first_stored, with_dropped
from articleloom.operators.nearest import BATCH_BYTES
from articleloom.plans.articles import FIRST_BY, finish, with_fingerprint
from articleloom.plans.ask import retrieve
from articleloom.sources.articles_xml import read_articles_xml
from articleloom.sources.scratch import scratch_path
from articleloom.sources.sinks import write_articles, write_summary
from articleloom.sources.tables import read_partitioned_articles


def store_articles(
    spark: SparkSession, xml_path: str, articles_path: str, summary_path: str,
    lexicon: Lexicon = MEDICAL_DOMAINS, default: str = DEFAULT_DOMAIN, parsed_path: str | None = None,
) -> dict[str, int]:
    """Read, process and store articles; returns how many were read, kept, malformed and dropped.

    If nothing is kept nothing is written: what was stored before stays. The table of parsed articles, as large as the
    corpus, is left at ``parsed_path`` for the caller to remove; without one it goes to the scratch folder.

    The XML is parsed once, into a table in the shared scratch folder: a lost executor costs a
    read of that table and no parsing. The funnel is observed while it is written; the deduplication reads narrow
    columns of it, and the summary is written from the stored articles, so both outputs hold the same ids.
    """
    parsed, funnel = parse_articles(spark, xml_path, parsed_path or scratch_path(spark, "extracted"))
    if not funnel["kept_count"]:
        return funnel
    usable = parsed.filter("usable")
    survivors = keep_first_stored(usable, "row_id", "pmid", FIRST_BY)
    write_articles(finish(survivors, lexicon, default), articles_path)
    write_summary(read_partitioned_articles(spark, articles_path), summary_path)
    return funnel


def parse_articles(spark: SparkSession, xml_path: str, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Article XML as a stored table of extracted fields, and its quality funnel.

    The funnel is observed on the rows as they are written, so no further scan is needed for it. Each task of that one stage is
    counted once, when it succeeds.

    Beside them it has what later steps would otherwise read whole texts for: whether the
    article is usable, a fingerprint to break ties by, and a row id, which is fixed once stored.
    """
    extracted = (
        extract_fields(read_articles_xml(spark, xml_path)).transform(with_fingerprint)
        .withColumn("usable", is_usable())
        .withColumn("row_id", F.monotonically_increasing_id())
    )
    observed = Observation("funnel")
    extracted.observe(observed, *funnel_counts(extracted, F.col("usable"))).write.parquet(path)
    return spark.read.schema(extracted.schema).parquet(path), with_dropped(observed.get)


def report_articles(spark: SparkSession, articles_path: str, domain: str = "neurology") -> dict[str, DataFrame]:
    """The reports over the stored articles, by name."""
    articles = read_partitioned_articles(spark, articles_path)
    return {
        "overview": report.domain_overview(articles),
        "years": report.year_counts(articles),
        "sample_titles": report.domain_sample_titles(articles),
        "domain_count": report.domain_count(articles, domain),
    }


def build_index(
    spark: SparkSession, articles_path: str, index_path: str,
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
) -> None:
    """Chunk and embed the stored articles that are new or have changed."""
    append_to_index(
        drop_blank_content(read_partitioned_articles(spark, articles_path)), index_path, size=size, overlap=overlap)


def answer_questions(
    questions: DataFrame, index_path: str, hits_path: str, template: str = context.PROMPT_TEMPLATE,
    max_bytes: int = BATCH_BYTES, few_hits: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Prompts and references of a batch of questions.

    The retrieved chunks are stored at ``hits_path``, and both are made from that table. ``max_bytes`` bounds the
    questions sent to all tasks at once; without ``few_hits`` hits are joined and not sent, whatever their size.
    """
    spark = questions.sparkSession
    found = retrieve(questions, open_chunk_index(spark, index_path), max_bytes=max_bytes, few_hits=few_hits)
    found.write.mode("overwrite").parquet(hits_path)
    hits = spark.read.parquet(hits_path)
    return context.prompts(hits, template), context.references(hits)
