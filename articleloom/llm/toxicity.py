"""Toxicity by compression distance.

Two zstandard dictionaries are made, one of toxic and one of ordinary text, and each window of a document, which is
one of its words, is compressed with both. A window counts as toxic if it is short with the toxic dictionary and at least
a margin shorter than with the ordinary one; both thresholds are calibrated on labelled documents.

Dictionary text is chosen from a bounded sample of labelled documents: toxic text is the words whose share of the
toxic documents stands out by their log-likelihood ratio, ordinary text the most frequent words of the others. Near copies
within the sample count once, as a word in twenty copies of one text is no evidence. The most telling words
come last in a dictionary, nearest to the window.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bound on the labelled documents of each class that are learnt from.
SAMPLE = 4000
FOLDS = 5

# Likelihood ratio from which a word is toxic text, and the sizes of the dictionaries.
RATIO = 25.0
TOXIC_WORDS = 4000
ORDINARY_WORDS = 6000
DICTIONARY_BYTES = 65_536
LEVEL = 19

SHINGLE = 5
KEYS = (2654435761, 2246822519, 3266489917)
STOPS = b".,;:!?\"'()[]#*$%&|"

# Words whose lengths a worker remembers; it starts anew when they are so many.
MOST_REMEMBERED = 700_000


def window(word: bytes) -> bytes:
    """A word between spaces, then backwards: long enough for zstandard to compress, and no repeat of itself."""
    spaced = b" " + word + b" "
    return spaced + spaced[::-1]


def dictionary(words: list[str]) -> bytes:
    """Raw dictionary content of words, most telling first in the list and last in the dictionary."""
    return b"".join(window(word.encode()) for word in reversed(words))[-DICTIONARY_BYTES:]


class Lengths:
    """Compressed lengths of words with the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.compress = [
            zstandard.ZstdCompressor(
                level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            ).compress for content in (toxic, ordinary)]
        self.known: dict[bytes, tuple[int, int]] = {}

    def of(self, word: bytes) -> tuple[int, int]:
        """Length with the toxic dictionary, and how much longer it is with the ordinary one."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MOST_REMEMBERED:
                self.known.clear()
            text = window(word.strip(STOPS))
            toxic, ordinary = (len(compress(text)) for compress in self.compress)
            found = toxic, ordinary - toxic
            if len(word) < 64:
                self.known[word] = found
        return found


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    longest: int
    margin: int
    weights: tuple[float, float, float]


def evidence(lengths: Lengths, text: str, longest: int, margin: int) -> tuple[int, int]:
    """The largest margin among a text's short windows, 0 if there are none, and its toxic windows."""
    best = count = 0
    for toxic, saved in map(lengths.of, text.lower().encode().split()):
        if saved > 0 and toxic <= longest:
            if saved > best:
                best = saved
            if saved >= margin:
                count += 1
    return best, count


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text has remainder 0; a null id is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``most`` ids of either label, by the order of a hash of the id.

    Held-out ids, null ids and null labels are not used; an id with several labels counts as its highest. Sent to all tasks are
    the ids of the sample, which are bounded.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    classes = [known.where(F.col("toxic") == label).orderBy(*order).limit(most) for label in (0, 1)]
    chosen = classes[0].unionAll(classes[1])
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _words_and_keys(sample: DataFrame) -> DataFrame:
    """The sample with its distinct words, near copies left out: of texts with a minimum of shingle hashes in common the lowest id stays."""

    @F.arrow_udf("struct<words: array<string>, keys: array<bigint>>")
    def split(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            words = (text.as_py() or "").lower().encode().split()
            shingles = np.fromiter(
                {zlib.crc32(b" ".join(words[i:i + SHINGLE])) for i in range(max(1, len(words) - SHINGLE + 1))}, np.uint64)
            distinct = {word.strip(STOPS) for word in words}
            rows.append({
                "words": sorted(w for word in distinct if word and (w := word.decode(errors="ignore"))),
                "keys": [int(((shingles * np.uint64(key)) % np.uint64(2**32)).min()) for key in KEYS]})
        return pa.array(rows, pa.struct([("words", pa.list_(pa.string())), ("keys", pa.list_(pa.int64()))]))

    rows = sample.select("doc_id", "toxic", split(F.col("text")).alias("s")).select("doc_id", "toxic", "s.*")
    for i in range(len(KEYS)):
        first = Window.partitionBy("toxic", F.col("keys")[i]).orderBy("doc_id")
        rows = rows.withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank")
    return rows.select("doc_id", "toxic", "words")


def likelihood_ratio(a: Column, b: Column, toxic: Column, ordinary: Column) -> Column:
    """Dunning's ratio for a word in ``a`` of ``toxic`` and ``b`` of ``ordinary`` documents."""
    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    every = toxic + ordinary
    with_toxic, with_ordinary = (a + b) * toxic / every, (a + b) * ordinary / every
    return 2 * (part(a, with_toxic) + part(b, with_ordinary)
                + part(toxic - a, toxic - with_toxic) + part(ordinary - b, ordinary - with_ordinary))


def train(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model | None:
    """Dictionaries, thresholds and weights from a bounded sample; None if either class has no document in it."""
    sample = labelled_sample(documents, labels, most)
    rows = _words_and_keys(sample)
    sizes = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return None
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    toxic, ordinary = F.lit(float(sizes[1])), F.lit(float(sizes[0]))
    counted = (
        rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .withColumn("ratio", likelihood_ratio(a, b, toxic, ordinary)))
    telling = counted.where((F.col("ratio") >= RATIO) & (F.length("word") >= 3) & (a / toxic > 5 * b / ordinary))
    toxic_words = [row["word"] for row in telling.orderBy(F.desc("ratio"), "word").limit(TOXIC_WORDS).collect()]
    frequent = counted.where(F.length("word") >= 2).orderBy(F.desc("b"), "word").limit(ORDINARY_WORDS)
    ordinary_words = [row["word"] for row in frequent.collect() if row["b"]]
    if not toxic_words:
        return None
    contents = dictionary(toxic_words), dictionary(ordinary_words)
    longest, margin = _thresholds(sample, contents)
    model = Model(*contents, longest, margin, (0.0, 0.0, 0.0))
    seen = _evidence(sample, model).select("toxic", "best", "count").toPandas()
    return Model(*contents, longest, margin, _weights(seen["best"], seen["count"], seen["toxic"], margin))


LONGEST, MARGINS = range(14, 27), range(3, 10)


def _thresholds(sample: DataFrame, contents: tuple[bytes, bytes]) -> tuple[int, int]:
    """The length and margin that tell the sample's documents apart best, by balanced accuracy."""
    toxic, ordinary = contents

    @F.arrow_udf("array<int>")
    def margins(texts: pa.Array) -> pa.Array:
        lengths, rows = Lengths(toxic, ordinary), []
        for text in texts:
            best = dict.fromkeys(LONGEST, 0)
            for short, saved in set(map(lengths.of, (text.as_py() or "").lower().encode().split())):
                for longest in LONGEST:
                    if short <= longest and saved > best[longest]:
                        best[longest] = saved
            rows.append(list(best.values()))
        return pa.array(rows, pa.list_(pa.int32()))

    found = sample.select("toxic", margins(F.col("text")).alias("best")).groupBy("toxic", "best").count().collect()
    best = np.array([row["best"] for row in found])
    count = np.array([row["count"] for row in found], float)
    label = np.array([row["toxic"] for row in found]) == 1
    scores = {}
    for i, longest in enumerate(LONGEST):
        for margin in MARGINS:
            said = best[:, i] >= margin
            hit = count[said & label].sum() / count[label].sum()
            wrong = count[said & ~label].sum() / count[~label].sum()
            # A wrong verdict on an ordinary document costs more: there are many more of them.
            scores[hit - 3 * wrong, margin, -longest] = longest, margin
    return scores[max(scores)]


def _evidence_udf(documents: DataFrame, model: Model):
    shared = documents.sparkSession.sparkContext.broadcast({"model": vars(model)})

    @F.arrow_udf("struct<best: int, count: int>")
    def found(texts: pa.Array) -> pa.Array:
        state = shared.value
        known = state["model"]
        if "lengths" not in state:
            state["lengths"] = Lengths(known["toxic"], known["ordinary"])
        rows = [evidence(state["lengths"], text.as_py() or "", known["longest"], known["margin"]) for text in texts]
        return pa.StructArray.from_arrays(
            [pa.array([best for best, _ in rows], pa.int32()), pa.array([count for _, count in rows], pa.int32())],
            ["best", "count"])

    return found


def _evidence(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``best`` and ``count`` in place of the text."""
    others = [name for name in documents.columns if name != "text"]
    found = _evidence_udf(documents, model)(F.col("text")).alias("found")
    return documents.select(*others, found).select(*others, "found.best", "found.count")


def _weights(best, count, toxic, margin: int) -> tuple[float, float, float]:
    """Logistic weights of a constant, the best margin beyond the threshold and the log of the toxic windows."""
    rows = np.stack([np.ones(len(best)), (np.asarray(best) - margin + 0.5) / 4, np.log1p(count)], axis=1)
    labels, weights = np.asarray(toxic, float), np.zeros(3)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-rows @ weights))
        curvature = (rows * (chance * (1 - chance))[:, None]).T @ rows + 0.1 * np.eye(3)
        weights -= np.linalg.solve(curvature, rows.T @ (chance - labels) + 0.1 * weights)
    return tuple(float(weight) for weight in weights)


def _chance(model: Model, best: Column, count: Column) -> Column:
    constant, by_margin, by_count = model.weights
    logit = constant + by_margin * (best - model.margin + 0.5) / 4 + by_count * F.log1p(count)
    return 1 / (1 + F.exp(-logit))


def toxicity(documents: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, score, predicted, best_margin, toxic_windows`` of every document, from its whole text.

    Scores depend on the text alone. Null and empty texts have no windows and get the score of a text without evidence;
    without a model every score is 0. Ids may be null (then held out) or repeat; other columns are not read.
    """
    held = held_out(F.col("doc_id")).alias("held_out")
    if model is None:
        return documents.select(
            "doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
            F.lit(0).alias("best_margin"), F.lit(0).alias("toxic_windows"))
    scored = _evidence(documents.select("doc_id", "text"), model).withColumn("score", _chance(model, F.col("best"), F.col("count")))
    return scored.select(
        "doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("best").alias("best_margin"), F.col("count").alias("toxic_windows"))


def without_toxic(documents: DataFrame, model: Model | None) -> DataFrame:
    """``documents`` whose score is below a half; all of them without a model."""
    if model is None:
        return documents
    found = _evidence_udf(documents, model)(F.col("text"))
    return documents.where(_chance(model, found["best"], found["count"]) < 0.5)
