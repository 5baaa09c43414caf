"""Search by the inverted index."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_ask import articles, changed

from articleloom.operators import index
from articleloom.operators.index import ChunkIndex, compact_index, invert_index
from articleloom.plans import ask

ASKED = [(1, "What of the heart valve?", 3), (2, "  ", 5), (3, "gene mutation in tumor cells", None), (4, None, 5),
         (5, "zzz qqq", 4), (6, "...", 2), (7, "new words", 100), (8, "brain", 0)]


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame(ASKED, "question_id int, question string, top_k int")


def rows(hits):
    return sorted((row["question_id"], row["rank"], row["chunk_id"], row["distance"]) for row in hits.collect())


@pytest.mark.parametrize("max_bytes", [index.ID_BYTES, 0])
def test_the_same_hits_as_by_vectors(spark, tmp_path, questions, max_bytes):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, *range(10)), path, max_bytes=max_bytes)
    assert invert_index(spark, path, block_chunks=7) == [0]
    assert invert_index(spark, path) == []

    def same():
        opened = ChunkIndex.open(spark, path, max_bytes)
        wanted = rows(ask.search_chunks(questions, opened.chunks()))
        assert rows(ask.search_postings(questions, opened)) == wanted
        assert rows(ask.search_postings(questions, opened, max_bytes=3000)) == wanted
        return wanted

    first = same()
    # Other texts under the same ids, new articles, and an article whose buckets are all others.
    index.append_to_index(changed(articles(spark, 2, 3, 7), "content", "new words " * 300), path, max_bytes=max_bytes)
    with pytest.raises(ValueError, match="without postings"):
        ChunkIndex.open(spark, path).postings()
    index.append_to_index(articles(spark, 11, 12), path, max_bytes=max_bytes)
    assert invert_index(spark, path, block_chunks=7) == [1, 2]
    second = same()
    assert second != first
    assert compact_index(spark, path) == [0]
    assert same() == second
    # A batch that is retired, and its successor.
    index.append_to_index(changed(articles(spark, 11, 12), "content", "gene " * 500), path, max_bytes=max_bytes)
    invert_index(spark, path)
    third = same()
    assert compact_index(spark, path) == [2] and same() == third


def test_only_asked_buckets_are_read(spark, tmp_path, questions):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, *range(10)), path)
    invert_index(spark, path)
    asked = questions.filter("question_id = 1")
    plan = plan_of(ask.search_postings(asked, ChunkIndex.open(spark, path)))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    filters = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    buckets = {int(bucket) for bucket in filters[filters.index("bucket#"):].split("IN (")[1].split(")")[0].split(",")}
    wanted = {bucket for row in index.embed_questions(asked).collect() for bucket, count in enumerate(row["embedding"]) if count}
    assert buckets == wanted | {-1} and len(wanted) == 5


def test_an_index_of_nothing_and_no_questions(spark, tmp_path, questions):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1).limit(0), path)
    invert_index(spark, path)
    assert ask.search_postings(questions, ChunkIndex.open(spark, path)).count() == 0
    index.append_to_index(articles(spark, 1), path)
    invert_index(spark, path)
    assert ask.search_postings(questions.limit(0), ChunkIndex.open(spark, path)).count() == 0
    assert ask.search_postings(questions.filter(F.col("question_id") == 1), ChunkIndex.open(spark, path)).count() == index.chunk_articles(articles(spark, 1)).count()
