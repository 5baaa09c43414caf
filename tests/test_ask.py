"""Index, retrieval, prompts and references."""

import hashlib
import math
import re
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from articleloom.operators import context, index
from articleloom.operators.index import open_chunk_index
from articleloom.operators.report import index_status
from articleloom.plans import ask

ARTICLE = "text_id string, pmid string, title string, journal string, year string, ref_id string, content string"


def articles(spark, *numbers):
    words = ["heart valve", "brain tissue", "tumor cells", "immune response", "gene mutation"]
    rows = [(f"t{n}", str(n), f"Title {n}", "J", "2000", f"f{n}", " ".join([words[n % 5]] * (n + 1) * 40)) for n in numbers]
    return spark.createDataFrame(rows, ARTICLE)


def test_term_vector_counts_hashed_tokens(spark):
    texts = ["The heart, the HEART; 2 hearts!", "", " ... ", "Épée épée naïve", None]
    df = spark.createDataFrame(list(enumerate(texts)), "question_id int, question string")
    for row in index.embed_questions(df).collect():
        counts = Counter(int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 256
                         for token in re.findall(r"\w+", (row["question"] or "").lower()))
        assert row["embedding"] == [float(counts[bucket]) for bucket in range(256)]


def test_weights_have_unit_length(spark):
    df = spark.createDataFrame([(1, "a b b c"), (2, "..")], "question_id int, question string")
    weights = index.term_weights(index.embed_questions(df), "question_id").collect()
    assert {row["question_id"] for row in weights} == {1}
    assert math.isclose(sum(row["weight"] ** 2 for row in weights), 1.0)


def test_appending_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1, 2), path)
    first = sorted(row["chunk_id"] for row in open_chunk_index(spark, path).collect())
    index.append_to_index(articles(spark, 1, 2), path)
    assert sorted(row["chunk_id"] for row in open_chunk_index(spark, path).collect()) == first
    index.append_to_index(articles(spark, 2, 3), path)
    stored = open_chunk_index(spark, path)
    assert stored.select("pmid").distinct().count() == 3
    assert stored.count() == stored.select("chunk_id").distinct().count()
    status = index_status(stored).first()
    assert (status["total_chunks"], status["total_articles"]) == (stored.count(), 3)


def changed(frame, column, value):
    return frame.withColumn(column, F.lit(value))


@pytest.mark.parametrize("max_bytes", [index.ID_BYTES, 0])
def test_changed_articles_replace_their_old_chunks(spark, tmp_path, max_bytes):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1, 2, 3), path, max_bytes=max_bytes)
    longer = changed(articles(spark, 2), "content", "new words " * 700)
    index.append_to_index(longer, path, max_bytes=max_bytes)
    stored = open_chunk_index(spark, path, max_bytes)
    assert stored.select("chunk_id").distinct().count() == stored.count()
    texts = [row["page_content"] for row in stored.filter("pmid = '2'").orderBy("chunk_ix").collect()]
    assert texts == [row["page_content"] for row in index.chunk_articles(longer).orderBy("chunk_ix").collect()]
    # Back to the first text, then another title, then another way to cut.
    index.append_to_index(articles(spark, 1, 2, 3), path, max_bytes=max_bytes)
    index.append_to_index(changed(articles(spark, 1), "title", "Other"), path, max_bytes=max_bytes)
    index.append_to_index(articles(spark, 3), path, size=100, overlap=10, max_bytes=max_bytes)
    stored = open_chunk_index(spark, path, max_bytes)
    assert stored.filter("pmid = '2'").count() == index.chunk_articles(articles(spark, 2)).count()
    assert {row["title"] for row in stored.filter("pmid = '1'").collect()} == {"Other"}
    assert stored.filter("pmid = '3'").count() == index.chunk_articles(articles(spark, 3), 100, 10).count()
    assert stored.select("_metadata.file_path").count() == stored.count()


def test_equal_ids_in_one_batch_are_one_article(spark, tmp_path):
    path = str(tmp_path / "index")
    batch = articles(spark, 1, 1, 2).unionAll(changed(articles(spark, 2), "title", "Other"))
    index.append_to_index(batch, path)
    stored = open_chunk_index(spark, path)
    assert stored.select("chunk_id").distinct().count() == stored.count()
    assert stored.count() == index.chunk_articles(articles(spark, 1, 2)).count()


def test_unchanged_articles_are_neither_chunked_nor_shuffled(spark, tmp_path):
    path = str(tmp_path / "index")
    articles(spark, 1, 2, 3).write.parquet(str(tmp_path / "articles"))
    stored = spark.read.parquet(str(tmp_path / "articles"))
    index.append_to_index(stored, path)
    held = index.ChunkIndex.open(spark, path)
    fresh, added, rows = index.new_articles(stored.unionByName(articles(spark, 4)), held)
    plan = plan_of(fresh)
    outer = plan[:plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in outer and "content" in outer and "sha2" not in outer
    assert rows == 1 and [tuple(row)[::2] for row in added.select("text_id", "version", "old").collect()] == [("t4", None)]
    assert index.append_to_index(stored, path) is None
    assert index.ChunkIndex.open(spark, path).batches == [0]


def test_opening_an_index_reads_no_chunks(spark, tmp_path):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1, 2), path)
    plan = plan_of(open_chunk_index(spark, path))
    assert "Aggregate" not in plan and "Join" not in plan
    index.append_to_index(changed(articles(spark, 2), "title", "Other"), path)
    plan = plan_of(open_chunk_index(spark, path))
    assert "Aggregate" not in plan and "Exchange hashpartitioning" not in plan and "PartitionFilters" in plan
    assert plan.count("FileScan") == 2  # chunks, and the table of replaced articles


def rows_of(spark, path):
    return sorted(tuple(row) for row in open_chunk_index(spark, path).select("chunk_id", "version", "batch", "page_content").collect())


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1, 2), path)
    index.append_to_index(articles(spark, 3), path)
    assert index.compact_index(spark, path) == []
    index.append_to_index(changed(articles(spark, 2, 3), "content", "new words " * 300), path)
    index.append_to_index(articles(spark, 4), path)
    before = rows_of(spark, path)
    assert index.compact_index(spark, path) == [0, 1]
    opened = index.ChunkIndex.open(spark, path)
    # Nothing is left of batch 1; no file of a batch that counts holds a replaced article.
    assert opened.batches == [0, 2, 3] and opened.replaced_rows == 0
    assert rows_of(spark, path) == before
    stored = spark.read.parquet(f"{path}/chunks").filter("batch IN (0, 2, 3)")
    assert stored.count() == len(before)
    assert index.compact_index(spark, path) == []
    # A later change of what was compacted, and of what was retired.
    index.append_to_index(articles(spark, 2, 3), path)
    assert {row["batch"] for row in open_chunk_index(spark, path).filter("pmid IN ('2', '3')").collect()} == {4}


def test_a_run_that_failed_counts_for_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1, 2), path)
    before = rows_of(spark, path)

    def broken(chunks):
        return chunks.withColumn("embedding", F.raise_error(F.lit("lost")).cast("array<float>"))

    with pytest.raises(Exception, match="lost"):
        index.append_to_index(changed(articles(spark, 2, 3), "title", "Other"), path, embed=broken)
    assert rows_of(spark, path) == before
    index.append_to_index(articles(spark, 3), path)
    assert index.ChunkIndex.open(spark, path).batches == [0, 2]
    assert len(rows_of(spark, path)) > len(before)


def test_an_interrupted_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1, 2), path)
    index.append_to_index(changed(articles(spark, 2), "title", "Other"), path)
    before = rows_of(spark, path)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(index, "_add_states", lost)
        with pytest.raises(RuntimeError):
            index.compact_index(spark, path)
    assert rows_of(spark, path) == before
    assert index.compact_index(spark, path) == [0]
    assert rows_of(spark, path) == before


def test_an_index_of_no_articles(spark, tmp_path):
    path = str(tmp_path / "index")
    index.append_to_index(articles(spark, 1).limit(0), path)
    assert open_chunk_index(spark, path).count() == 0
    index.append_to_index(articles(spark, 1), path)
    assert open_chunk_index(spark, path).count() > 0


def test_missing_index(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        open_chunk_index(spark, str(tmp_path / "nothing"))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "index")
    index.append_to_index(articles(spark, *range(10)), path)
    return open_chunk_index(spark, path)


@pytest.fixture(scope="module")
def questions(spark):
    rows = [(1, "What of the heart valve?", 3), (2, "  ", 5), (3, "gene {context} mutation", None), (4, None, 5)]
    return spark.createDataFrame(rows, "question_id int, question string, top_k int")


def test_blank_questions_are_dropped(questions):
    assert sorted(row[0] for row in context.valid_questions(questions).collect()) == [1, 3]


@pytest.fixture(scope="module", params=["few questions and hits", "several slices, hits joined"])
def hits(request, store, questions):
    options = {} if request.param == "few questions and hits" else {"max_bytes": 3000, "few_hits": False}
    return ask.retrieve(questions, store, **options).cache()


def test_retrieval_finds_the_right_articles(hits):
    rows = hits.orderBy("question_id", "rank").collect()
    assert [(row["question_id"], row["rank"]) for row in rows] == [(1, i) for i in (1, 2, 3)] + [(3, i) for i in range(1, 6)]
    assert {row["pmid"] for row in rows if row["question_id"] == 1} <= {"0", "5"}
    assert {row["pmid"] for row in rows if row["question_id"] == 3} <= {"4", "9"}


def test_prompt_holds_passages_in_rank_order(hits):
    rows = [row for row in hits.orderBy("rank").collect() if row["question_id"] == 3]
    prompts = {row["question_id"]: row["prompt"] for row in context.prompts(hits, "C={context}|Q={question}|A").collect()}
    assert prompts[3] == "C=" + "\n\n".join(row["page_content"] for row in rows) + "|Q=gene {context} mutation|A"
    assert sorted(prompts) == [1, 3]


def test_default_prompt_and_bad_template(hits):
    prompt = context.prompts(hits).filter("question_id = 1").first()["prompt"]
    assert "What of the heart valve?" in prompt and "{" not in prompt
    with pytest.raises(ValueError):
        context.prompts(hits, "only {question}")


def test_references(spark):
    hits = spark.createDataFrame(
        [(1, 1, "9", None, "x" * 301), (1, 2, None, "T", "short")],
        "question_id int, rank int, pmid string, title string, page_content string")
    refs = context.references(hits)
    rows = refs.orderBy("rank").collect()
    assert [tuple(row) for row in rows] == [(1, 1, "9", "No Title", "x" * 300 + "..."), (1, 2, "N/A", "T", "short")]
    labels = context.reference_labels(refs).orderBy("rank").collect()
    assert [row["label"] for row in labels] == ["[1] PMID: 9", "[2] PMID: N/A"]


def files_read(df) -> int:
    """Number of files in the scan of the chunk content, once the query has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaf for leaf in map(leaves.apply, range(leaves.size())) if "page_content" in leaf.toString()]
    assert len(scans) == 1
    return scans[0].metrics().apply("numFiles").value()


def test_only_files_with_hits_are_read_for_content(spark, tmp_path, questions):
    path = str(tmp_path / "index")
    for n in range(10):
        index.append_to_index(articles(spark, n).coalesce(1), path)
    stored = open_chunk_index(spark, path)
    all_files = stored.select("_metadata.file_path").distinct().count()
    asked = questions.filter("question_id = 1").select("question_id", "question", F.lit(1).alias("top_k"))
    assert all_files == 10
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for few_hits in (True, False):
            assert files_read(ask.retrieve(asked, stored, few_hits=few_hits)) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_chunk_table_is_not_shuffled_for_few_questions(store, questions):
    plan = plan_of(ask.retrieve(questions.select("question_id", "question"), store))
    content_scan = next(line for line in plan.splitlines() if "FileScan" in line and "page_content" in line)
    assert "embedding" not in content_scan.split("Batched")[0]
    assert plan.count("BroadcastHashJoin") >= 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_search_without_common_words_still_answers(spark, store):
    asked = spark.createDataFrame([(1, "zzz")], "question_id int, question string")
    rows = ask.search_chunks(asked, store).collect()
    assert len(rows) == 5
    assert all(0.0 <= row["distance"] <= 1.0 for row in rows)
