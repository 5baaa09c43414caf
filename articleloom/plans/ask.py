"""From questions and a chunk index to prompts and references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articleloom.operators.context import valid_questions
from articleloom.operators.index import ChunkIndex, embed_questions
from articleloom.operators.nearest import BATCH_BYTES, QuestionBatch, nearest
from articleloom.operators.postings import nearest_by_postings
from articleloom.sources.scratch import stored

MOST_FILES = 10_000  # that are named in a filter


def search_chunks(questions: DataFrame, index: DataFrame, metric: str = "cosine") -> DataFrame:
    """The nearest chunks of each question: question_id, chunk_id, rank, distance."""
    return nearest(embed_questions(valid_questions(questions)), index, vector_id="chunk_id", metric=metric)


def search_postings(questions: DataFrame, index: ChunkIndex, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """As ``search_chunks`` by cosine, from the postings of an opened index: only the buckets that are asked for are read."""
    return nearest_by_postings(embed_questions(valid_questions(questions)), index.postings(), max_bytes)


def retrieve(
    questions: DataFrame, index: DataFrame, metric: str = "cosine", max_bytes: int = BATCH_BYTES, few_hits: bool = True,
) -> DataFrame:
    """The nearest chunks of each question in a stored index, with their content and metadata.

    The search reads ids and vectors, and its hits are stored with the files they lie in. Only those files are
    read for the content, unless they are more than ``MOST_FILES``. Hits that are few are sent to all tasks; else hits and chunks are
    joined on the chunk id. Both give the same rows.
    """
    asked = valid_questions(questions)
    batch = QuestionBatch.of(embed_questions(asked), max_bytes)
    located = index.select("chunk_id", "embedding", F.col("_metadata.file_path").alias("file"))
    hits = stored(nearest(batch, located, vector_id="chunk_id", metric=metric, carry=["file"]), "hits")
    files = [row["file"] for row in hits.select("file").distinct().limit(MOST_FILES + 1).collect()]
    # Beyond that many the files are left to the join, which tells their chunks apart in any case.
    chunks = index if len(files) > MOST_FILES else index.filter(F.col("_metadata.file_path").isin(files) if files else F.lit(False))
    chunks = chunks.select("chunk_id", "pmid", "title", "journal", "year", "source", "page_content")
    hits = hits.drop("file")
    if batch.has_few_hits and few_hits:
        hits = F.broadcast(hits)
    return chunks.join(hits, "chunk_id").join(asked.select("question_id", "question"), "question_id")
