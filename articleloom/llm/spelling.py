"""Spelling variants by permuterm rotations.

A word is closed by a terminator and rotated: ``y$x`` for each cut of the word into x and y. Two words that differ by the
character between x and y, replaced or added, have rotations that begin with the same ``y$x``: of the one that has
no character there this is the whole rotation, of the others it is all but the last. Sorted rotations thus lie in groups, and a group
is scanned once: every member learns how many others there are and which is most frequent, from the best two of the group, without
its pairs being written out. A group has one whole rotation at most and as many others as the alphabet has letters.

A character of a run can be removed in as many ways as the run is long, always with the same result; the pair is counted where the
first of them goes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articleloom.sources.scratch import stored

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2  # a form is at least so many times as frequent
DAMAGED_ONE_IN = 97

WORDS_HELD = 500_000  # distinct words that a task counts before it passes them on
PLAIN_KEY = 64  # longer rotations are told apart by 122-bit hashes
END = "$"

# Latin letters and those of the range after them, A-Z lower-cased; the rest are gaps.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))

PRIME = 2**61 - 1
BASES = (1_000_003, 998_244_353)


def word_counts(documents: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n``: how often each word of at least ``least_length`` characters stands in the texts.

    A text is read as Latin-1, where a letter is a byte; all other characters are gaps. Where the checksum of document id
    and run says so, one character of the run is left out. A null text has no words, a null id is the empty text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            kept = [(word.decode("latin-1"), n) for word, n in counts.items() if n]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([word for word, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                letters = (text.as_py() or "").encode("latin-1", "replace").translate(LETTERS)
                runs = [run for run in letters.split() if len(run) >= least_length]
                counts.update(runs)
                start = crc32(f"{doc_id.as_py() or ''}:".encode())
                for run in set(runs):
                    checksum = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                    if checksum % DAMAGED_ONE_IN == 0:
                        times, gap = runs.count(run), checksum % len(run)
                        counts[run] -= times
                        if len(run) > least_length:
                            counts[run[:gap] + run[gap + 1:]] += times
                if len(counts) >= WORDS_HELD:
                    yield counted()
        yield counted()

    narrow = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return narrow.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with an ``id`` that grows in the order of their code points; stored, as ids are places in that table."""
    ordered = words.repartitionByRange("word").sortWithinPartitions("word")
    return stored(ordered.withColumn("id", F.monotonically_increasing_id()), "numbered_words")


def long_rotations(word: str) -> list[tuple[str, bool, bool]]:
    """Key, whether it is the whole rotation, and whether a pair is counted there, for each rotation of one word.

    Keys of up to ``PLAIN_KEY`` characters are the text itself. Others are two polynomial hashes of it, from those of the
    word's prefixes, so that work and memory grow with the word's length and not with its square.
    """
    size = len(word)
    hashes = []
    for base in BASES:
        power, prefix = [1], [0]
        for c in word:
            power.append(power[-1] * base % PRIME)
            prefix.append((prefix[-1] * base + ord(c)) % PRIME)
        power.append(power[-1] * base % PRIME)
        hashes.append((power, prefix))

    def key(cut: int, after: int) -> str:
        if size - after + 1 + cut <= PLAIN_KEY:
            return word[after:] + END + word[:cut]
        parts = []
        for power, prefix in hashes:
            tail = prefix[size] - prefix[after] * power[size - after]
            parts.append((tail * power[cut + 1] + ord(END) * power[cut] + prefix[cut]) % PRIME)
        return "#%016x%016x" % tuple(parts)

    return ([(key(i, i), True, False) for i in range(size + 1)]
            + [(key(i, i + 1), False, i == 0 or word[i] != word[i - 1]) for i in range(size)])


def rotations(words: DataFrame) -> DataFrame:
    """``id, n, key, whole, counted`` of each rotation: ``y$x`` for each place, and for each character that is skipped."""
    plain = words.filter(F.length("word") < PLAIN_KEY)
    place, word = F.col("place"), F.col("word")
    whole = plain.withColumn("place", F.explode(F.sequence(F.lit(0), F.length("word")))).select(
        "id", "n", F.concat(F.substring(word, place + 1, F.length(word)), F.lit(END), F.substring(word, F.lit(1), place)).alias("key"),
        F.lit(True).alias("whole"), F.lit(False).alias("counted"))
    repeats = (place > 0) & (F.substring(word, place + 1, F.lit(1)) == F.substring(word, place, F.lit(1)))
    skipped = plain.withColumn("place", F.explode(F.sequence(F.lit(0), F.length("word") - 1))).select(
        "id", "n", F.concat(F.substring(word, place + 2, F.length(word)), F.lit(END), F.substring(word, F.lit(1), place)).alias("key"),
        F.lit(False).alias("whole"), (~repeats).alias("counted"))

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, n, text in zip(*batch.columns, strict=True):
                keys, wholes, counted = zip(*long_rotations(text.as_py()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number.as_py()] * len(keys), pa.int64()), pa.array([n.as_py()] * len(keys), pa.int64()),
                     pa.array(keys), pa.array(wholes), pa.array(counted)], ["id", "n", "key", "whole", "counted"])

    longer = words.filter(F.length("word") >= PLAIN_KEY).select("id", "n", "word").mapInArrow(
        rotate, "id bigint, n bigint, key string, whole boolean, counted boolean")
    return whole.unionAll(skipped).unionAll(longer)


def near_words(words: DataFrame) -> DataFrame:
    """``id, n_near, near_n, near_id`` of each word that has a near one: how many, and the most frequent, of equal ones the lowest id."""
    group = Window.partitionBy("key")
    scan = group.orderBy("whole", F.desc("n"), "id")
    member = F.struct(F.col("n"), (-F.col("id")).alias("order"))
    others = F.count_if(~F.col("whole")).over(group)
    seen = (
        rotations(words).withColumn("place", F.row_number().over(scan))
        .withColumn("best", F.max(F.when(~F.col("whole") & (F.col("place") == 1), member)).over(group))
        .withColumn("second", F.max(F.when(~F.col("whole") & (F.col("place") == 2), member)).over(group))
        .withColumn("bare", F.max(F.when(F.col("whole"), member)).over(group))
        .withColumn("others", others)
        .withColumn("counted_others", F.count_if("counted").over(group)))
    for_skipped = F.struct(
        (F.col("others") - 1 + F.when(F.col("counted") & F.col("bare").isNotNull(), 1).otherwise(0)).alias("near"),
        F.greatest(F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("best")), F.col("bare")).alias("top"))
    for_whole = F.struct(F.col("counted_others").alias("near"), F.col("best").alias("top"))
    told = seen.filter("others > 0").select("id", F.when(F.col("whole"), for_whole).otherwise(for_skipped).alias("told"))
    near = told.filter("told.top IS NOT NULL").groupBy("id").agg(F.sum("told.near").alias("n_near"), F.max("told.top").alias("top"))
    return near.select("id", "n_near", F.col("top.n").alias("near_n"), (-F.col("top.order")).alias("near_id"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``id, root_id`` from ``id, form_id``: where the forms lead to.

    Every round follows twice as many forms as the one before. Counts double from form to form, so chains are no longer than
    the binary logarithm of the largest count, and a handful of rounds is enough.
    """
    reached = stored(forms.select("id", F.col("form_id").alias("root_id")), "forms")
    while True:
        onwards = reached.select(F.col("id").alias("root_id"), F.col("root_id").alias("further"))
        followed = stored(reached.join(onwards, "root_id", "left").select(
            "id", F.coalesce("further", "root_id").alias("root_id"), F.col("further").isNotNull().alias("moved")), "forms")
        if not followed.filter("moved").limit(1).count():
            return followed.select("id", "root_id")
        reached = followed.select("id", "root_id")


def spelling_variants(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word that stands ``least_count`` times in ``documents(doc_id, text)``.

    Near words differ by one character more, less or replaced. The form is the near word of largest n, of equal ones the first in code-
    point order, if that is at least ``ratio`` times as large; ``form`` and ``form_n`` are null without one, and ``root`` is then the word
    itself. Rows that repeat count again; other columns are not read; no texts give no words. ``ratio`` must be at least 2.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    counts = stored(word_counts(documents, least_length).filter(F.col("n") >= least_count), "words")
    words = numbered(counts)
    found = stored(words.join(near_words(words), "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("near_n") >= ratio * F.col("n"), F.col("near_id")).alias("form_id")), "near")
    roots = last_forms(found.filter("form_id IS NOT NULL"))
    form = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = roots.join(words.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id").select("id", "root")
    return (
        found.join(form, "form_id", "left").join(root, "id", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
