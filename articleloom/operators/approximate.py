"""Approximate nearest vectors by hashing with random projections.

Of each vector several tables hold a key: the buckets of a few random projections together. Vectors that share a key with a question in
any table are its candidates, and these are measured exactly. How wide buckets are follows from a bounded sample: the chance that two
vectors share a key depends on their distance and the width alone, so the width is the least at which the sample's nearest
neighbours would be found as often as wanted.

Candidates are found and measured in the task that holds a block of vectors and a block of questions, and only the best few are kept: pairs
are neither joined nor shuffled, so that what is stored is bounded by the hits, however many vectors share a key.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleloom.operators.nearest import BATCH_BYTES, KEYS, Batch, BestSoFar, QuestionBatch, nearest_of, wanted_top_k
from articleloom.sources.scratch import stored

TABLES = 12
PROJECTIONS = 3  # of a table: its keys agree only where all of them do
WANTED_RECALL = 0.97  # of the nearest neighbours in the sample
SAMPLE = 2048  # vectors that the width is fitted on
SEED = 9
DENSE = 16  # more than one in so many pairs of a block share a key: all of them are compared in one matrix product


def collision(distance: np.ndarray, width: float, dims: int) -> np.ndarray:
    """The chance that two vectors at a distance fall into one bucket of a projection on a random direction of length one."""
    spread = np.maximum(distance, 1e-300) / math.sqrt(dims)
    ratio = np.minimum(width / spread, 1e6)
    below = np.array([0.5 * math.erfc(r / math.sqrt(2)) for r in ratio])
    return np.where(distance > 0, 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - np.exp(-(ratio**2) / 2)), 1.0)


def bucket_width(sample: np.ndarray, k: int, recall: float = WANTED_RECALL, tables: int = TABLES, projections: int = PROJECTIONS) -> float:
    """The least width by which the k nearest of each vector of the sample share a key with it as often as wanted.

    In the whole table neighbours are nearer than in the sample, so they are found more often.
    """
    squares = (sample * sample).sum(axis=1)
    near = np.maximum(squares[:, None] + squares - 2 * sample @ sample.T, 0)
    np.fill_diagonal(near, 0)
    k = min(k, len(sample))
    distance = np.sqrt(np.partition(near, k - 1, axis=1)[:, :k]).ravel() if len(sample) else np.zeros(1)
    low, high = 0.0, max(1e-9, float(distance.max()) * 4)
    for _ in range(40):
        middle = (low + high) / 2
        found = 1 - (1 - np.clip(collision(distance, middle, sample.shape[1]), 0, 1) ** projections) ** tables
        low, high = (low, middle) if found.mean() >= recall else (middle, high)
    return high


class ProjectionHash:
    """Keys of vectors in all tables, the same for questions and vectors."""

    def __init__(self, vectors: DataFrame, width: float, dims: int, tables: int = TABLES, projections: int = PROJECTIONS, seed: int = SEED):
        self.tables, self.projections = tables, projections
        # Buckets begin at zero in every projection. A common shift by many widths puts their limits anywhere in the data.
        self.shift = np.random.default_rng(seed).normal(size=dims) * width * 1000
        lsh = BucketedRandomProjectionLSH(
            inputCol="_vector", outputCol="_hashes", bucketLength=width, numHashTables=tables * projections, seed=seed)
        self.model = lsh.fit(self._shifted(vectors.limit(1)))

    def _shifted(self, df: DataFrame) -> DataFrame:
        shift = F.lit(self.shift.tolist())
        moved = F.zip_with(F.col("embedding").cast("array<double>"), shift, lambda x, s: x + s)
        return df.withColumn("_vector", array_to_vector(moved))

    def with_keys(self, df: DataFrame) -> DataFrame:
        """``df`` with an array of keys, one of each table, in which the table is part. Row by row, no shuffle."""
        hashes = F.transform(F.col("_hashes"), lambda h: vector_to_array(h)[0])
        hashed = self.model.transform(self._shifted(df)).select(*df.columns, hashes.alias("_hashes"))

        def key(table: Column) -> Column:
            return F.xxhash64(table, F.slice("_hashes", table * self.projections + 1, F.lit(self.projections)))

        return hashed.select(*df.columns, F.transform(F.sequence(F.lit(0), F.lit(self.tables - 1)), key).alias(KEYS))

    def keys(self, df: DataFrame, name: str) -> DataFrame:
        """A row for each table: ``name`` and the ``key``, in which the table is part."""
        return self.with_keys(df).select(name, F.explode(KEYS).alias("key"))


class BestOfSharing(BestSoFar):
    """The k best of the vectors that share a key with a question, by squared L2."""

    def __init__(self, questions: Batch, top_k: np.ndarray):
        super().__init__(questions, top_k, "l2")

    def _prepared(self, vectors: Batch) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each table the order of the vectors by key, and their keys in it."""
        orders = [np.argsort(keys, kind="stable") for keys in vectors.keys.T]
        return [(order, keys[order]) for order, keys in zip(orders, vectors.keys.T, strict=True)]

    def _candidates(self, part: slice, vectors: Batch, terms: np.ndarray, slack: np.ndarray, prepared: object) -> tuple[np.ndarray, np.ndarray]:
        asked, count = self.questions.keys[part], len(terms)
        spans = [(order, np.searchsorted(keys, asked[:, t], "left"), np.searchsorted(keys, asked[:, t], "right"))
                 for t, (order, keys) in enumerate(prepared)]
        shared = sum(int((high - low).sum()) for _, low, high in spans)
        if shared * DENSE <= len(asked) * count:
            pairs = [np.repeat(np.arange(len(asked)) * count, high - low) + order[_ranges(low, high)] for order, low, high in spans]
            rows, columns = np.divmod(np.unique(np.concatenate(pairs)), count)
            near = np.einsum("ij,ij->i", self.terms[part][rows], terms[columns])
            open_ = near <= (self.worst[part] - self.own[part] + slack)[rows]
            return rows[open_], columns[open_]
        allowed = np.zeros((len(asked), count), bool)
        for order, low, high in spans:
            for row in np.flatnonzero(high > low):
                allowed[row, order[low[row]:high[row]]] = True
        # Those without a common key are farther than any.
        near = np.where(allowed, self.terms[part] @ terms.T, np.inf)
        return self._close(part, near, vectors, slack, allowed)


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The whole numbers from each ``low`` up to its ``high``, one range after the other."""
    sizes = high - low
    return np.arange(sizes.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def nearest_approximate(
    questions: DataFrame, vectors: DataFrame, *, vector_id: str, recall: float = WANTED_RECALL, tables: int = TABLES,
    projections: int = PROJECTIONS, sample: int = SAMPLE, seed: int = SEED, max_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Of the vectors that share a key with a question the ``top_k`` nearest by squared L2: question_id, vector id, distance, rank.

    Distances are exact; a neighbour that shares no key is missed. ``vectors`` is read several times and should be stored. Of copies of
    a vector only as many as a question may want, those with the lowest ids, are hashed: the others cannot be among the nearest, and
    a vector that much of the table repeats makes no large bucket. Rows without a vector take no part. The width is fitted on
    at most ``sample`` vectors, those with the lowest hashes of their ids. ``max_bytes`` bounds what is sent to all tasks at once, as for ``nearest``.
    """
    asked = questions.filter("embedding IS NOT NULL").select(
        "question_id", "embedding", wanted_top_k(F.col("top_k") if "top_k" in questions.columns else F.lit(None)).alias("top_k")).filter("top_k > 0")
    most = asked.agg(F.max("top_k")).first()[0]
    present = vectors.filter("embedding IS NOT NULL").select(vector_id, "embedding")
    drawn = present.orderBy(F.xxhash64(vector_id)).limit(sample).toArrow()
    if not most or not drawn.num_rows:
        fields = [asked.schema["question_id"], present.schema[vector_id], T.StructField("distance", T.DoubleType()), T.StructField("rank", T.IntegerType())]
        return vectors.sparkSession.createDataFrame([], T.StructType(fields))
    matrix = Batch.of(drawn["embedding"].combine_chunks()).matrix
    width = bucket_width(matrix, int(most) + 1, recall, tables, projections)
    hashing = ProjectionHash(present, width, matrix.shape[1], tables, projections, seed)
    same = Window.partitionBy(F.xxhash64("embedding"), "embedding").orderBy(vector_id)
    first = present.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= int(most)).drop("copy")
    hashed = stored(hashing.with_keys(first), "distinct_vectors")
    batch = QuestionBatch.of(hashing.with_keys(asked), max_bytes)
    return nearest_of(batch, hashed, vector_id, BestOfSharing, max_bytes)


def recall_of(found: DataFrame, exact: DataFrame, vector_id: str) -> DataFrame:
    """One row: ``questions``, and the share of the exact hits that were found, by distance: a tie is as good. ``recall`` is 1 without hits."""
    furthest = exact.groupBy("question_id").agg(F.max("distance").alias("furthest"), F.count("*").alias("wanted"))
    met = furthest.join(found.select("question_id", "distance"), "question_id", "left")
    by_question = met.groupBy("question_id").agg(F.first("wanted").alias("wanted"), F.count_if(F.col("distance") <= F.col("furthest")).alias("met"))
    share = F.sum(F.least("met", "wanted")) / F.sum("wanted")
    return by_question.agg(F.count("*").alias("questions"), F.coalesce(share, F.lit(1.0)).alias("recall"))
