"""Raw nested articles to flat fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleloom.functions.text import clean, text_or, unmarked

# The default, and below the paths of the elements.
UNKNOWN = "unknown"
META = "front.`article-meta`"

EXTRACTED_COLUMNS = ["pmid", "article_title", "journal", "year", "citation_text", "ref_id"]


def first_with_attribute(items: Column, attribute: str, value: str, field: str) -> Column:
    """``field`` of the first item whose attribute has the value; null if there is none."""
    return F.get(F.filter(items, lambda item: item[attribute] == value), F.lit(0))[field]


def article_key(ids: Column) -> Column:
    """The pmid: "unknown" without any id, null if there are ids but no pmid among them."""
    return F.when(F.size(ids) > 0, first_with_attribute(ids, "_pub-id-type", "pmid", "_VALUE")).otherwise(UNKNOWN)


def print_year(dates: Column) -> Column:
    """Year of print: "unknown" without any date, null if there are dates but none of print."""
    return F.when(dates.isNotNull(), first_with_attribute(dates, "_pub-type", "ppub", "year")).otherwise(UNKNOWN)


def abstract_text(paragraphs: Column) -> Column:
    """All paragraphs of all abstracts, joined by spaces; an abstract without paragraphs adds nothing."""
    present = F.filter(paragraphs, lambda group: group.isNotNull())
    return F.coalesce(F.concat_ws(" ", F.flatten(present)), F.lit(""))


def citation_text(abstract: Column, body: Column) -> Column:
    """Abstract and body, joined by a space."""
    return F.concat_ws(" ", abstract, F.coalesce(body, F.lit("")))


def extract_fields(raw: DataFrame) -> DataFrame:
    """One flat row per raw article; every absent part has a default, so no row is lost here.

    Inequality signs in ``citation_text`` stay marked until it is cleaned. ``malformed`` is passed on if it is there.
    """
    return raw.select(
        article_key(F.col(f"{META}.`article-id`")).alias("pmid"),
        text_or(unmarked(clean(F.col(f"{META}.`title-group`.`article-title`"))), UNKNOWN).alias("article_title"),
        text_or(unmarked(F.col("front.`journal-meta`.`journal-title-group`.`journal-title`")), UNKNOWN).alias("journal"),
        print_year(F.col(f"{META}.`pub-date`")).alias("year"),
        citation_text(abstract_text(F.col(f"{META}.abstract.p")), F.col("body")).alias("citation_text"),
        "ref_id",
        *(name for name in ["malformed"] if name in raw.columns),
    )
