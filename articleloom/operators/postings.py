"""The inverted form of a chunk index, and search by it.

Chunks are taken in blocks of some thousand. Of each block there is a row for each bucket that occurs in it, with the places of the
chunks that hold it and their counts, and a head row with the chunks' ids and squared lengths. The table is partitioned by batch
and bucket: a search reads the heads and the buckets its questions ask for. A bucket that most chunks hold is many rows in
several files, one row for each block of chunks.

A task goes through its blocks one by one and through the asked buckets of a block one by one, adding to the
dot products of the chunks that hold it. Counts are whole numbers, so the sums are exact and distances are those of a
scan of the vectors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articleloom.operators.nearest import (
    BATCH_BYTES,
    Batch,
    BestSoFar,
    QuestionBatch,
    asked_of_slice,
    pair_schemas,
    top_per_question,
)
from articleloom.schemas import POSTINGS
from articleloom.sources.scratch import scratch_path

BLOCK_CHUNKS = 4096
HEAD = -1  # in place of a bucket, in the row that names a block's chunks

_ARROW = pa.schema([
    ("block", pa.string()), ("bucket", pa.int32()), ("batch", pa.int64()), ("width", pa.int32()), ("places", pa.list_(pa.int32())),
    ("counts", pa.list_(pa.float32())), ("chunk_ids", pa.list_(pa.string())), ("squares", pa.list_(pa.float64()))])


def _block_rows(run: str, batch: int, ids: list[str], matrix: np.ndarray) -> pa.RecordBatch:
    """The head of a block and its buckets. The block is named by its first chunk, the batch and the run that wrote it."""
    buckets, places = np.nonzero(matrix.T)
    counts = matrix[places, buckets]
    found, starts = np.unique(buckets, return_index=True)
    rows = len(found) + 1
    ends = np.concatenate([[0, len(ids)], len(ids) + np.append(starts[1:], len(buckets))]).astype(np.int32) if len(found) else np.array([0, len(ids)], np.int32)
    squares = (matrix.astype(np.float64) ** 2).sum(axis=1)
    only_head = np.array([0, *[len(ids)] * rows], np.int32)
    not_head = np.concatenate([[0], ends[1:] - len(ids)]).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array([f"{ids[0]}@{batch}@{run}"] * rows), pa.array([HEAD, *found], pa.int32()), pa.array([batch] * rows, pa.int64()),
        pa.array([len(ids)] * rows, pa.int32()),
        pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.arange(len(ids)), places]), pa.int32())),
        pa.ListArray.from_arrays(not_head, pa.array(counts, pa.float32())),
        pa.ListArray.from_arrays(only_head, pa.array(ids, pa.string())),
        pa.ListArray.from_arrays(only_head, pa.array(squares))], schema=_ARROW)


def posting_rows(chunks: DataFrame, block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """The rows of the posting table of ``chunks(chunk_id, batch, embedding)``, which are read once and not shuffled.

    Embeddings are counts, all of one length; a chunk without one is in no block.
    """
    run = uuid.uuid4().hex

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list[str], list[np.ndarray]]] = {}
        for batch in batches:
            batch = batch.filter(batch["embedding"].is_valid())
            if not batch.num_rows:
                continue
            matrix = batch["embedding"].flatten().to_numpy().reshape(batch.num_rows, -1)
            for number, name, row in zip(batch["batch"].to_pylist(), batch["chunk_id"].to_pylist(), matrix, strict=True):
                ids, rows = waiting.setdefault(number, ([], []))
                ids.append(name)
                rows.append(row)
                if len(ids) == block_chunks:
                    yield _block_rows(run, number, ids, np.stack(rows))
                    del waiting[number]
        for number, (ids, rows) in waiting.items():
            yield _block_rows(run, number, ids, np.stack(rows))

    return chunks.select("chunk_id", "batch", "embedding").mapInArrow(cut, POSTINGS)


def write_postings(chunks: DataFrame, path: str, block_chunks: int = BLOCK_CHUNKS) -> None:
    """The posting table of these chunks, in place of what it held of their batches.

    The rows of a bucket are brought together, so that there are few files; one that is far larger than the others is split
    between tasks. What an overwritten batch leaves in a bucket that it does not hold any more has no head, and is not read as a chunk.
    """
    rows = posting_rows(chunks, block_chunks).hint("rebalance", "batch", "bucket")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch", "bucket").option("maxRecordsPerFile", BLOCK_CHUNKS).parquet(path))


def without_replaced(postings: DataFrame, replaced: DataFrame) -> DataFrame:
    """Postings whose heads name only the chunks of articles that were not replaced in their batch.

    The heads are taken apart for it, a narrow row for each chunk; a block's own rows, of which there is a bounded number, are
    brought together again. The counts of the others are left where they are, as no head names their places.
    """
    heads = postings.filter(F.col("bucket") == HEAD)
    chunks = heads.select("block", "batch", "width", F.explode(F.arrays_zip("places", "chunk_ids", "squares")).alias("chunk")).select(
        "*", F.regexp_replace("chunk.chunk_ids", "#[0-9]+$", "").alias("text_id"))
    kept = chunks.join(replaced, ["text_id", "batch"], "left_anti").groupBy("block", "batch", "width").agg(
        F.sort_array(F.collect_list("chunk")).alias("chunks"))
    named = kept.select(
        "block", F.lit(HEAD).alias("bucket"), "batch", "width", F.col("chunks.places").alias("places"),
        F.array().cast("array<float>").alias("counts"), F.col("chunks.chunk_ids").alias("chunk_ids"), F.col("chunks.squares").alias("squares"))
    return postings.filter(F.col("bucket") != HEAD).unionByName(named)


class BlockSums:
    """Dot products of questions with the chunks of one block after the other."""

    def __init__(self, questions: Batch, top_k: np.ndarray):
        self.best = BestSoFar(questions, top_k, "cosine")
        self.questions = questions.matrix
        self.squares = (self.questions * self.questions).sum(axis=1)
        self.block: str | None = None

    def start(self, block: str, width: int, places: np.ndarray, ids: pa.Array, squares: np.ndarray) -> None:
        self.finish()
        self.block, self.places, self.ids, self.chunk_squares = block, places, ids, squares
        self.dots = np.zeros((width, len(self.questions)))

    def add(self, block: str, bucket: int, places: np.ndarray, counts: np.ndarray) -> None:
        if block != self.block:
            return  # without a head: left over from a batch that was overwritten
        asking = np.flatnonzero(self.questions[:, bucket])
        if len(asking):
            self.dots[np.ix_(places, asking)] += counts[:, None].astype(np.float64) * self.questions[asking, bucket]

    def finish(self) -> None:
        if self.block is None or not len(self.places):
            return
        dots = self.dots[self.places].T
        norms = np.sqrt(self.squares[:, None] * self.chunk_squares)
        distances = 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
        self.best.add_measured(distances, self.ids)
        self.block = None


def nearest_by_postings(questions: DataFrame | QuestionBatch, postings: DataFrame, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """The ``top_k`` chunks of each question with the least cosine distance: question_id, chunk_id, distance, rank.

    The same rows as ``nearest`` gives for the chunks' embeddings. The rows of a block are brought together, heads first; of the
    buckets only those are read that a question of the slice asks for. Slices of questions are of bounded size, as there.
    """
    batch = questions if isinstance(questions, QuestionBatch) else QuestionBatch.of(questions, max_bytes)
    spark = postings.sparkSession
    path = scratch_path(spark, "hits_by_slice") if batch.slices > 1 else None
    for number in range(batch.slices):
        asked, top_k = asked_of_slice(batch, number)
        spark_schema, arrow_schema = pair_schemas(batch.frame.schema["question_id"].dataType, postings.select(F.lit("").alias("chunk_id")))
        shared = spark.sparkContext.broadcast((asked.matrix, asked.columns, top_k))

        def best(batches: Iterator[pa.RecordBatch], shared=shared, arrow_schema=arrow_schema) -> Iterator[pa.RecordBatch]:
            matrix, columns, top_k = shared.value
            sums = BlockSums(Batch(matrix, columns), top_k)
            for rows in batches:
                for block, bucket, width, places, counts, ids, squares in zip(*rows.columns, strict=True):
                    held = places.values.to_numpy()
                    if bucket.as_py() == HEAD:
                        sums.start(block.as_py(), width.as_py(), held, ids.values, squares.values.to_numpy())
                    else:
                        sums.add(block.as_py(), bucket.as_py(), held, counts.values.to_numpy())
            sums.finish()
            yield from sums.best.table(arrow_schema).to_batches()

        buckets = [HEAD, *np.flatnonzero(asked.matrix.any(axis=0)).tolist()] if len(top_k) else []
        read = postings.filter(F.col("bucket").isin(buckets)).select("block", "bucket", "width", "places", "counts", "chunk_ids", "squares")
        by_block = read.repartition("block").sortWithinPartitions("block", "bucket")
        found = top_per_question(by_block.mapInArrow(best, spark_schema), "chunk_id", batch.most)
        if path is None:
            return found
        found.write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(found.schema).parquet(path)
