"""Quality rules: document statistics, and gradient-boosted trees over them.

The statistics of a text are counted in one pass over its bytes and words. Trees are grown on the driver from the
statistics of a bounded sample of labelled documents and are sent to the tasks as node arrays; every
document is scored in the task that counted it. No shuffle but of the sample.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articleloom.llm.boosting import Forest, grow

# Bound on the labelled documents that trees are grown from; the rest of the labels is not used.
SAMPLE = 12_000

# The least words, and the share in percent of words in repeated windows.
LEAST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Features, and the direction the verdict may take as each grows.
FEATURES = {
    "log_words": 1,
    "characters_per_word": 0,
    "symbols_per_word": -1,
    "duplicate_line_share": -1,
    "repeated_word_share": -1,
    "distinct_word_share": 0,
    "upper_share": -1,
    "digit_share": -1,
    "exclamations_per_word": -1,
    "stops_per_word": 0,
    "words_per_line": 0,
    "longest_run_share": -1,
    "beyond_ascii_share": 0,
}

_ODD = np.random.default_rng(5).integers(1, 2**62, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IN_SYMBOLS = np.isin(np.arange(256), list(SYMBOLS))
_IN_SPACES = np.isin(np.arange(256), list(SPACES))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words which occurs twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = codes[:n] * _ODD[0]
    for k in range(1, WINDOW):
        windows = windows + (codes[k:k + n] ^ (codes[k:k + n] >> np.uint64(29))) * _ODD[k]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    alike = np.zeros(n, bool)
    alike[order[1:][same]] = alike[order[:-1][same]] = True
    # Windows with equal hashes are compared by their words, so a collision is not counted.
    found = [(at, tuple(words[at:at + WINDOW])) for at in np.flatnonzero(alike).tolist()]
    often = Counter(window for _, window in found)
    again = np.zeros(n, bool)
    again[[at for at, window in found if often[window] > 1]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[WINDOW:] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The base counts of a text and its features."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0] * len(COUNTS), [0.0] * len(FEATURES)
    lines = [line for line in data.split(b"\n") if line.strip()]
    duplicates = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    histogram = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    points = int(histogram[:128].sum() + histogram[192:].sum())
    symbols = int(histogram[_IN_SYMBOLS].sum())
    characters = points - int(histogram[_IN_SPACES].sum())
    run = longest = 1
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        if run > longest:
            longest = run
    features = [
        float(np.log1p(n)), characters / n, symbols / n, duplicates / len(lines), repeats / n, len(set(words)) / n,
        float(histogram[65:91].sum()) / characters, float(histogram[48:58].sum()) / characters,
        float(histogram[33]) / n, float(histogram[46]) / n, n / len(lines), longest / n,
        float(histogram[192:].sum()) / characters]
    return [n, characters, symbols, duplicates, repeats], features


def document_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id``, the base counts and ``features array<double>`` of every whole text; a null text has no words."""

    @F.arrow_udf("struct<counts: array<bigint>, features: array<double>>")
    def count(texts: pa.Array) -> pa.Array:
        found = [statistics(text.as_py() or "") for text in texts]
        return pa.StructArray.from_arrays(
            [pa.array([c for c, _ in found], pa.list_(pa.int64())),
             pa.array([f for _, f in found], pa.list_(pa.float64()))], ["counts", "features"])

    counted = documents.select("doc_id", count(F.col("text")).alias("counted"))
    return counted.select(
        "doc_id", *(F.col("counted.counts")[i].alias(name) for i, name in enumerate(COUNTS)), "counted.features")


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` labelled ids, by the order of a hash of the id.

    Labels without an id or a value are left out; an id with several labels counts as its lowest. The sample of
    ids is bounded, so it is sent to the tasks that read the texts; of documents that repeat an id all are taken.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Forest | None:
    """Trees for ``quality`` from a bounded sample; None if no document or only one class is labelled."""
    sample = labelled_sample(documents, labels, "quality", most)
    known = sample.select(F.col("doc_id").alias("sample_id"), "label").distinct()
    rows = (
        document_statistics(sample).where(F.col("n_words") > 0)
        .join(known, F.col("doc_id") == F.col("sample_id")).select("doc_id", "features", "label")
        .orderBy("doc_id", "features").limit(2 * most).toPandas())
    if rows["label"].nunique() < 2:
        return None
    return grow(np.array(rows["features"].tolist()), rows["label"].to_numpy(float), list(FEATURES.values()))


def quality_verdicts(documents: DataFrame, forest: Forest | None) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``score`` and ``kept`` of every document.

    ``base_failed`` is fewer than ten words, or more than a fifth of the words in repeated windows. ``kept`` is false
    for these, else whether the trees put the chance of good quality at a half or more; without trees all are kept. Null
    and empty texts have no words and fail; ids may be null or repeat; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(None if forest is None else vars(forest))

    @F.arrow_udf("double")
    def score(features: pa.Array) -> pa.Array:
        trees = shared.value
        if trees is None:
            return pa.array(np.ones(len(features)))
        rows = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), len(FEATURES))
        return pa.array(1 / (1 + np.exp(-Forest(**trees).margin(rows))))

    counted = document_statistics(documents)
    scored = counted.withColumn("score", score(F.col("features")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= 0.5)).alias("kept"))
