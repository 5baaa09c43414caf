"""Exact nearest vectors by a scan of vectors in bytes.

A vector is stored a second time as whole numbers of one byte with a common scale, and with the distance between the two. By the
triangle inequality that distance bounds how far a question's distance from the bytes can be off. The scan reads the bytes only: a
pair is left open if its least possible distance is not above the k-th smallest of the largest possible ones. Pairs left open are
measured on the vectors themselves, so the hits are those of ``nearest``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleloom.operators.nearest import (
    BATCH_BYTES,
    HIT_BYTES,
    HITS_BYTES,
    PAIRS_AT_ONCE,
    QUESTIONS_AT_ONCE,
    TASKS_PER_CORE,
    Batch,
    QuestionBatch,
    _exact,
    _place_in_group,
    _rounding,
    arrow_type,
    asked_of_slice,
    top_per_question,
)
from articleloom.sources.scratch import scratch_path

LEVELS = 127  # of a byte with its sign
SLACK = 1e-9  # by which bounds are widened, beyond what their own sums can be off


def with_bytes(vectors: DataFrame) -> DataFrame:
    """``vectors`` with ``code``, a byte for each component, ``scale``, ``error`` and ``same``, a hash that copies share.

    ``error`` is the length of what the bytes leave out, rounded up. A row without a vector has nulls; a component that is null or
    not finite is an error. Row by row, no shuffle.
    """

    @F.arrow_udf("struct<code: binary, scale: double, error: double, same: bigint>")
    def quantise(vectors: pa.Array) -> pa.Array:
        rows = []
        for vector in vectors:
            if not vector.is_valid:
                rows.append(None)
                continue
            exact = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(exact).all():
                raise ValueError("a component of a vector is null or not finite")
            scale = float(np.abs(exact).max(initial=0.0)) / LEVELS
            code = np.rint(exact / scale).astype(np.int8) if scale > 0 else np.zeros(len(exact), np.int8)
            error = float(np.sqrt(((exact - scale * code) ** 2).sum())) * (1 + SLACK)
            same = int.from_bytes(blake2b(exact.tobytes(), digest_size=8).digest(), "little", signed=True)
            rows.append({"code": code.tobytes(), "scale": scale, "error": error, "same": same})
        return pa.array(rows, pa.struct([("code", pa.binary()), ("scale", pa.float64()), ("error", pa.float64()), ("same", pa.int64())]))

    return vectors.withColumn("_bytes", quantise(F.col("embedding"))).select("*", "_bytes.*").drop("_bytes")


def write_quantised(vectors: DataFrame, path: str) -> None:
    """Vectors with their bytes as Parquet: columns of one table, of which a scan reads those it needs."""
    with_bytes(vectors).write.parquet(path)


class OpenPairs:
    """Pairs of questions and vectors that one task cannot rule out, kept by blocks of questions."""

    def __init__(self, questions: np.ndarray, top_k: np.ndarray):
        self.questions, self.top_k = questions, top_k
        self.squares = (questions * questions).sum(axis=1)
        self.bound = np.full(len(top_k), np.inf)  # the k-th smallest of the largest possible distances
        # Of each block of questions: the question, the vector's id, least and largest possible distance, the hash that copies share.
        self.blocks: dict[int, list[np.ndarray]] = {}

    def columns(self) -> list[np.ndarray]:
        """Questions, ids, least and largest possible distances of all pairs left open."""
        found = [block[:4] for _, block in sorted(self.blocks.items())]
        return [np.concatenate(parts) for parts in zip(*found, strict=True)] or [np.empty(0, np.int64), np.empty(0, object), np.empty(0), np.empty(0)]

    def add(self, codes: np.ndarray, scale: np.ndarray, error: np.ndarray, same: np.ndarray, ids: np.ndarray) -> None:
        step = max(1, PAIRS_AT_ONCE // QUESTIONS_AT_ONCE)
        for first in range(0, len(ids) if len(self.top_k) else 0, step):
            rows = slice(first, first + step)
            vectors = codes[rows] * scale[rows, None]
            squares = (vectors * vectors).sum(axis=1)
            # The share that rounding has of a squared distance; twice that, as the comparison below rounds as well.
            off = 2 * _rounding(vectors.shape[1], 1.0)
            terms = np.column_stack([vectors, squares * (1 - off) - error[rows] ** 2 * (1 + off), error[rows]])
            for start in range(0, len(self.top_k), QUESTIONS_AT_ONCE):
                self._add_block(start, vectors, squares, terms, off, error[rows], same[rows], ids[rows])

    def _add_block(
        self, start: int, vectors: np.ndarray, squares: np.ndarray, terms: np.ndarray, off: float, error: np.ndarray, same: np.ndarray, ids: np.ndarray,
    ) -> None:
        part = slice(start, start + QUESTIONS_AT_ONCE)
        bound = self.bound[part].copy()
        unknown, k = np.flatnonzero(np.isinf(bound)), int(self.top_k[part].max())
        if len(unknown) and len(ids) > k:
            near = self.squares[part][unknown, None] + squares - 2.0 * (self.questions[part][unknown] @ vectors.T)
            rounding = _rounding(vectors.shape[1], self.squares[part][unknown, None] + squares + 1.0)
            bound[unknown] = np.partition(np.sqrt(np.maximum(near, 0) + rounding) + error, k - 1, axis=1)[:, k - 1]
        bound = bound * (1 + SLACK)
        # Left open where near <= (bound + error) ** 2 and rounding. All that depends on the vector is in one matrix product.
        known = np.where(np.isinf(bound), 0.0, bound)
        asked = np.column_stack([-2.0 * self.questions[part], np.ones(len(bound)), -2.0 * known])
        limit = bound**2 + off * (self.squares[part] + bound**2 + 1.0) - self.squares[part]
        row, column = np.divmod(np.flatnonzero(asked @ terms.T <= limit[:, None]), len(ids))
        if not len(row):
            return
        near = self.squares[part][row] + squares[column] - 2.0 * np.einsum("ij,ij->i", self.questions[part][row], vectors[column])
        rounding = _rounding(vectors.shape[1], self.squares[part][row] + squares[column] + 1.0)
        most = np.sqrt(np.maximum(near, 0) + rounding) + error[column]
        least = np.maximum(np.sqrt(np.maximum(near - rounding, 0)) - error[column], 0)
        found = [row + start, ids[column], least, most, same[column]]
        held = self.blocks.get(start)
        self._thin(start, [np.concatenate(pair) for pair in zip(held, found, strict=True)] if held else found)

    def _thin(self, start: int, pairs: list[np.ndarray]) -> None:
        """Leave out what the k-th smallest bound rules out, and of copies of a vector all but the k with the lowest ids."""
        rows, ids, _, _, same = pairs
        order = np.lexsort((np.unique(ids, return_inverse=True)[1], same, rows))
        changes = (np.diff(rows[order]) != 0) | (np.diff(same[order]) != 0)
        group = np.concatenate([[0], np.cumsum(changes)])
        kept = order[_place_in_group(group) < self.top_k[rows[order]]]
        rows, ids, least, most, same = (column[kept] for column in pairs)
        order = np.lexsort((most, rows))
        sorted_rows = rows[order]
        last = _place_in_group(sorted_rows) == self.top_k[sorted_rows] - 1
        self.bound[sorted_rows[last]] = most[order][last]
        left = least <= self.bound[rows] * (1 + SLACK)
        self.blocks[start] = [column[left] for column in (rows, ids, least, most, same)]


def open_pairs(batch: QuestionBatch, number: int, table: DataFrame, vector_id: str) -> DataFrame:
    """``question_id``, vector id, ``top_k`` of the pairs of one slice of questions that the bytes leave open."""
    asked, top_k = asked_of_slice(batch, number)
    spark = table.sparkSession
    question_id, id_type = batch.frame.schema["question_id"].dataType, table.schema[vector_id].dataType
    spark_schema = T.StructType([
        T.StructField("question_id", question_id), T.StructField(vector_id, id_type), T.StructField("least", T.DoubleType()),
        T.StructField("distance", T.DoubleType()), T.StructField("top_k", T.IntegerType())])
    types = [arrow_type(question_id), arrow_type(id_type), pa.float64(), pa.float64(), pa.int32()]
    shared = spark.sparkContext.broadcast((asked.matrix, asked.columns, top_k))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, columns, top_k = shared.value
        found = OpenPairs(matrix, top_k)
        for rows in batches:
            rows = rows.filter(rows["code"].is_valid())
            if not rows.num_rows or not len(top_k):
                continue
            codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.int8).reshape(rows.num_rows, -1)
            if codes.shape[1] != matrix.shape[1]:
                raise ValueError(f"vectors differ in length: {[codes.shape[1], matrix.shape[1]]}")
            found.add(codes.astype(np.float64), *(rows[name].to_numpy() for name in ("scale", "error", "same")),
                      rows[vector_id].to_numpy(zero_copy_only=False))
        places, ids, least, most = found.columns()
        arrays = [Batch(matrix, columns).pick(places)[0], ids, least, most, top_k[places]]
        yield pa.RecordBatch.from_arrays([pa.array(a, kind) for a, kind in zip(arrays, types, strict=True)], spark_schema.names)

    scanned = table.select("code", "scale", "error", "same", vector_id)
    folded = scanned.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, "bounded_pairs")
    folded.mapInArrow(bounds, spark_schema).write.parquet(path)
    shared.destroy()
    pairs = spark.read.schema(spark_schema).parquet(path)
    # The k-th smallest of the largest possible distances of all tasks; without k of them every pair is open.
    best = top_per_question(pairs, vector_id, batch.most).join(pairs.select("question_id", "top_k").distinct(), "question_id")
    bound = best.groupBy("question_id").agg(F.count("*").alias("found"), F.max("top_k").alias("wanted"), F.max("distance").alias("bound"))
    limits = bound.select("question_id", F.when(F.col("found") >= F.col("wanted"), F.col("bound") * (1 + SLACK)).alias("limit"))
    left = pairs.join(limits, "question_id").filter("limit IS NULL OR least <= limit")
    return left.select("question_id", vector_id, "top_k")


def nearest_quantised(questions: DataFrame | QuestionBatch, table: DataFrame, *, vector_id: str, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """The ``top_k`` nearest vectors of each question by squared L2: question_id, vector id, distance, rank, as ``nearest`` gives them.

    ``table`` is one that ``write_quantised`` wrote. Its bytes are read once for each slice of questions. The pairs left open are few;
    their vectors are fetched by id: ids that are few are sent to all tasks, else both are joined by hash. Rows without a
    vector take no part; ties go to the lower id.
    """
    batch = questions if isinstance(questions, QuestionBatch) else QuestionBatch.of(questions, max_bytes)
    spark = table.sparkSession
    path = scratch_path(spark, "open_pairs")
    for number in range(batch.slices):
        open_pairs(batch, number, table, vector_id).write.mode("append").parquet(path)
    pairs = spark.read.parquet(path)

    @F.arrow_udf("double")
    def measured(left: pa.Array, right: pa.Array) -> pa.Array:
        asked, found = Batch.of(left).matrix, Batch.of(right).matrix
        return pa.array(_exact(asked, found, "l2"), pa.float64())

    few = pairs.count() * HIT_BYTES <= HITS_BYTES
    wanted = pairs.join(batch.frame.select("question_id", F.col("embedding").alias("asked")), "question_id")
    vectors = table.select(vector_id, "embedding")
    if few:
        ids = F.broadcast(pairs.select(vector_id).distinct())
        vectors = vectors.join(ids, vector_id, "left_semi")
    exact = wanted.join(vectors, vector_id).select(
        "question_id", vector_id, measured("asked", "embedding").alias("distance"), "top_k")
    return top_per_question(exact, vector_id, batch.most)
