"""From raw articles to processed articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articleloom.functions.lexicon import DEFAULT_DOMAIN, MEDICAL_DOMAINS, Lexicon, classify
from articleloom.functions.text import clean, stable_id, unmarked
from articleloom.operators.extract import extract_fields
from articleloom.operators.quality import keep_first_of_source, keep_usable
from articleloom.schemas import ARTICLES
from articleloom.sources.scratch import stored


# Of articles with one key the one of the lowest file path survives, and within a file that
# of the lowest fingerprint.
FIRST_BY = ["ref_id", "fingerprint"]


def with_fingerprint(extracted: DataFrame) -> DataFrame:
    """Extracted articles with a hash of all that tells two of one file apart."""
    return extracted.withColumn("fingerprint", F.md5(F.concat_ws("\n", "citation_text", "article_title", "journal", "year")))


def finish(survivors: DataFrame, lexicon: Lexicon = MEDICAL_DOMAINS, default: str = DEFAULT_DOMAIN) -> DataFrame:
    """Clean and classify articles that are usable and have distinct keys. Row by row, no shuffle."""
    return (
        survivors.withColumnRenamed("article_title", "title")
        .withColumn("text_id", stable_id(F.col("ref_id"), F.col("pmid")))
        .withColumn("content", unmarked(clean(F.col("citation_text"))))
        .withColumn("domain", classify(F.col("content"), lexicon, default))
        .withColumn("text_length", F.length("content"))
        .withColumn("processed_time", F.current_timestamp())
        .select(*ARTICLES.names)
    )


def process_extracted(
    extracted: DataFrame, lexicon: Lexicon = MEDICAL_DOMAINS, default: str = DEFAULT_DOMAIN,
) -> DataFrame:
    """Filter, deduplicate, clean and classify; the schema is the same for no rows at all.

    Duplicates go first, so that only survivors are cleaned and classified. Keys, files and fingerprints decide which
    rows those are; texts are not sorted for it, and not shuffled if repeats are few. Of several articles
    with one key the first by ``FIRST_BY`` survives.
    """
    survivors = extracted.transform(keep_usable).transform(with_fingerprint).transform(
        keep_first_of_source, "pmid", FIRST_BY)
    return finish(survivors, lexicon, default)


def process_articles(raw: DataFrame, lexicon: Lexicon = MEDICAL_DOMAINS, default: str = DEFAULT_DOMAIN) -> DataFrame:
    """Raw nested articles to processed articles.

    The extracted fields are stored first: they are read several times to filter and deduplicate, and each time, for each condition
    of a filter, the XML would be parsed again.
    """
    return stored(extract_fields(raw), "extracted").transform(process_extracted, lexicon, default)
