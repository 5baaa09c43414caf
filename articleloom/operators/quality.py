"""Filters, the quality funnel and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from articleloom.functions.text import is_blank
from articleloom.operators.extract import UNKNOWN

# Fixed value: content must be longer than this many characters.
MIN_CONTENT_LENGTH = 50

REPEATED_BYTES = 64 << 20  # ids of repeated rows up to this size are sent to all tasks
REPEATED_ROW_BYTES = 24  # of one such id in a hash table
REPEATED_NAMES_BYTES = 256  # of one such row named by key, file and fingerprint


def has_enough_text(text: Column, minimum: int = MIN_CONTENT_LENGTH) -> Column:
    """More than ``minimum`` characters between leading and trailing spaces, before any cleaning."""
    return F.coalesce(F.length(F.trim(text)) > minimum, F.lit(False))


def has_key(key: Column) -> Column:
    """A key that is known."""
    return key.isNotNull() & (key != UNKNOWN)


def is_usable() -> Column:
    """Of an extracted article: enough text and a known key."""
    return has_enough_text(F.col("citation_text")) & has_key(F.col("pmid"))


def keep_usable(extracted: DataFrame) -> DataFrame:
    """Articles with enough text and a known key."""
    return extracted.filter(is_usable())


def drop_blank_content(df: DataFrame, column: str = "content") -> DataFrame:
    """Rows whose content holds something other than whitespace."""
    return df.filter(~is_blank(F.col(column)))


def funnel_counts(extracted: DataFrame, usable: Column | None = None) -> list[Column]:
    """The aggregates of the quality funnel, for an aggregation or for an observation of rows that pass by."""
    kept = is_usable() if usable is None else usable
    counts = [F.count(F.lit(1)).alias("initial_count"), F.count_if(kept).alias("kept_count")]
    if "malformed" in extracted.columns:
        counts.append(F.count_if("malformed").alias("malformed_count"))
    return counts


def with_dropped(counts: dict[str, int]) -> dict[str, int]:
    """Observed counts of the funnel with the number of those that were dropped."""
    return {**counts, "dropped_count": counts["initial_count"] - counts["kept_count"]}


def quality_funnel(extracted: DataFrame, usable: Column | None = None) -> DataFrame:
    """One row, one pass: articles read, kept and dropped. ``usable`` names the verdict if it is stored.

    If there is a column ``malformed``, the dropped ones that could not be parsed are counted by themselves as well.
    """
    return extracted.agg(*funnel_counts(extracted, usable)).withColumn("dropped_count", F.col("initial_count") - F.col("kept_count"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark applies the rank limit before the shuffle as well as after it, so of a key that
    holds a third of all rows each map task sends on one row only.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keep_first_stored(
    stored: DataFrame, row_id: str, key: str, order: Sequence[str], max_bytes: int = REPEATED_BYTES,
) -> DataFrame:
    """As ``keep_first``, for a stored table whose rows have a unique whole-number id.

    Only the named columns are read to find the rows that are not first. If they are few, they
    are sent to all tasks and the rest of the table is neither shuffled nor sorted; else it is shuffled
    once, by the row id, and not sorted. Keys must not be null.
    """
    narrow = stored.select(row_id, key, *order)
    rows, keys = narrow.agg(F.count("*"), F.count_distinct(key)).first()
    if rows == keys:
        return stored
    first = narrow.groupBy(key).agg(F.min(F.struct(*order, row_id)).alias("first")).select(f"first.{row_id}")
    repeated = narrow.select(row_id).join(first, row_id, "left_anti")
    few = (rows - keys) * REPEATED_ROW_BYTES <= max_bytes
    repeated = F.broadcast(repeated) if few else repeated.hint("shuffle_hash")
    return stored.join(repeated, row_id, "left_anti").select(*stored.columns)


def keep_first_of_source(
    df: DataFrame, key: str, order: Sequence[str], max_bytes: int = REPEATED_BYTES,
) -> DataFrame:
    """As ``keep_first``, for a frame that is cheap to read again and has no row id: key and order tell rows apart.

    The named columns alone decide which rows are not first. If these are few they are sent to all tasks, else the rows
    are moved once, by hash; the other columns are not sorted. Of rows that repeat in key and order, which nothing can tell
    apart, one is kept; only the rows of such keys go through ``keep_first``. Keys must not be null.
    """
    names = [key, *order]
    narrow = df.select(*names).groupBy(*names).agg(F.count("*").alias("rows"))
    distinct, rows, keys = narrow.agg(F.count("*"), F.sum("rows"), F.count_distinct(key)).first()
    if not distinct or rows == keys:
        return df
    kept = _without_later(df, narrow, key, order, rows - keys, max_bytes) if distinct > keys else df
    if rows == distinct:
        return kept
    repeated = narrow.filter("rows > 1").select(F.col(key).alias(f"_repeated_{key}")).distinct()
    few = (rows - distinct) * REPEATED_NAMES_BYTES <= max_bytes
    repeated, same = F.broadcast(repeated) if few else repeated.hint("shuffle_hash"), F.col(key) == F.col(f"_repeated_{key}")
    several = keep_first(kept.join(repeated, same, "left_semi"), [key], [F.col(name) for name in order])
    return kept.join(repeated, same, "left_anti").unionByName(several)


def _without_later(
    df: DataFrame, narrow: DataFrame, key: str, order: Sequence[str], later_rows: int, max_bytes: int,
) -> DataFrame:
    """The rows of each key that are first in the given order, by a join with those that are not."""
    names = [key, *order]
    first = narrow.groupBy(key).agg(F.min(F.struct(*order)).alias("first"))
    later = (
        narrow.select(*names).join(first, key).where(F.struct(*order) != F.col("first"))
        .select(*(F.col(name).alias(f"_later_{name}") for name in names)))
    few = later_rows * REPEATED_NAMES_BYTES <= max_bytes
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_later_{name}")) for name in names))
    return df.join(F.broadcast(later) if few else later.hint("shuffle_hash"), same, "left_anti")
