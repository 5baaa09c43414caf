"""Shards by a Feistel permutation of global row numbers.

A row's number is its place in the stored table: the rows of all files before its own, plus its
place in the file. The number is permuted by a Feistel network over the pairs (left, right) of
``rows x cols >= n`` numbers; results outside 0..n-1 are permuted again until they lie inside
(cycle walking). Shard and slot are the permuted number modulo and divided by the number of shards:
anyone who knows n and the seed can compute them, and back.

Law: ``rows``. Shards differ by at most one row, whatever the rows hold, so copies of a text are
dealt out like other rows and no key can be hot. Nothing is shuffled but one count per file.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from articleloom.sources.scratch import stored

SHARDS = 24
SEED = 20

# Two multipliers below 2**31 and a prime modulus; products stay below 2**62.
MODULUS = 2**31 - 1
MULTIPLIERS = (1103515245, 741103597)
DOUBLE_ROUNDS = 4

# Rows of the file table that are sent to all tasks; beyond it Spark plans a join.
MOST_FILES = 200_000


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Two keys for each double round, from the seed."""
    state, keys = (seed * 2 + 1) % MODULUS, []
    for _ in range(2 * DOUBLE_ROUNDS):
        state = (state * 48271 + 12345) % MODULUS
        keys.append(state)
    return list(zip(keys[::2], keys[1::2], strict=True))


def _mixed(value: Column, key: Column) -> Column:
    first = value.bitwiseXOR(key) % MODULUS * MULTIPLIERS[0] % MODULUS
    second = first.bitwiseXOR(F.shiftright(first, 15)) % MODULUS * MULTIPLIERS[1] % MODULUS
    return second.bitwiseXOR(F.shiftright(second, 13))


def domain(n: int) -> tuple[int, int]:
    """Rows and columns of the smallest near-square that holds n numbers."""
    rows = isqrt(max(n, 1) - 1) + 1
    return rows, -(-max(n, 1) // rows)


def _div(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor))


def feistel(number: Column, n: int, seed: int = SEED) -> Column:
    """One pass of the network: a permutation of the numbers below rows x cols of ``domain(n)``."""
    rows, cols = domain(n)
    keys = F.array(*(F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                     for a, b in round_keys(seed)))

    def double_round(state: Column, key: Column) -> Column:
        left = (state["left"] + _mixed(state["right"], key["a"])) % rows
        right = (state["right"] + _mixed(left, key["b"])) % cols
        return F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))

    start = F.struct(_div(number, cols).cast("long").alias("left"), (number % cols).cast("long").alias("right"))
    return F.aggregate(keys, start, double_round, lambda end: end["left"] * cols + end["right"])


def permuted(number: Column, n: int, walk: int, seed: int = SEED) -> Column:
    """Cycle walking: the network once, then up to ``walk`` times more while the result is outside 0..n-1."""
    once = feistel(number, n, seed)
    if not walk:
        return once
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(walk)), once,
        lambda place, _: F.when(place < n, place).otherwise(feistel(place, n, seed)))


def walk_length(spark: SparkSession, n: int, seed: int = SEED) -> int:
    """Passes after the first that bring every number back inside, found by walking all numbers outside.

    A walk that leaves 0..n-1 goes through numbers outside only, and there are fewer of those than the
    square root of n: they are walked as a small job, with twice the passes until all have come back.
    """
    rows, cols = domain(n)
    outside, walk = rows * cols - n if n else 0, 1
    while outside:
        left = spark.range(n, rows * cols).where(permuted(F.col("id"), n, walk - 1, seed) >= n).limit(1).count()
        if not left:
            return walk
        walk *= 2
    return 0


def numbered_rows(df: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """Columns of ``df``, an unfiltered scan of Parquet files, with ``row_number`` from 0, and the number of rows.

    Numbers follow the order of the files' names and the rows in each file. Counts come from file
    footers. The table of files is sent to all tasks up to ``MOST_FILES`` files and joined beyond.
    """
    place = df.metadataColumn("_metadata")
    counts = df.select(place["file_path"].alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    files, n = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    if files <= MOST_FILES:
        offsets = F.broadcast(offsets)
    rows = df.select(*columns, place["file_path"].alias("file"), place["row_index"].alias("index"))
    return rows.join(offsets, "file").select(*columns, (F.col("offset") + F.col("index")).alias("row_number")), n


def shard_table(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of every row of a stored table of ``doc_id, text``, read from its files unfiltered.

    ``size`` is the UTF-8 bytes of the text plus 8, ``text_crc32`` the unsigned CRC-32 of these bytes. A null
    text counts as empty; null and repeated ids, equal rows and very long texts are rows like any other;
    an empty table has no rows. Other columns of the table are not read, whatever their names.
    """
    spark = documents.sparkSession
    rows, n = numbered_rows(documents, "doc_id", "text")
    walk = walk_length(spark, n, seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = rows.select(
        "doc_id",
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "row_number",
        permuted(F.col("row_number"), n, walk, seed).alias("place"))
    return placed.select(
        "doc_id", "size", "text_crc32", "law",
        (F.col("place") % shards).cast("int").alias("shard"),
        _div(F.col("place"), shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number")


def shard(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``shard_table`` for any frame: it is stored first, and its rows are numbered as they were stored."""
    return shard_table(stored(documents.select("doc_id", "text"), "to_shard"), shards, seed)
