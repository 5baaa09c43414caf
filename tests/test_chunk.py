"""Chunking against a plain reading of its rules."""

import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from hypothesis import given, settings
from hypothesis import strategies as st

from articleloom.operators.chunk import _spans, chunk_articles, chunk_counts, chunk_texts

ARTICLE = "text_id string, pmid string, title string, journal string, year string, ref_id string, content string"


def expected_chunks(text, size, overlap):
    """Chunk by chunk and piece by piece, in quadratic time."""
    pieces = re.findall(r" [^ ]*|^[^ ]+", text)
    chunks = []
    run = []

    def close(run):
        start = 0
        while start < len(run):
            stop = start
            while stop < len(run) and len("".join(run[start:stop + 1])) <= size:
                stop += 1
            chunks.append("".join(run[start:stop]))
            if stop == len(run):
                return
            start += 1
            while len("".join(run[start:stop])) > overlap or len("".join(run[start:stop + 1])) > size:
                start += 1

    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
            continue
        close(run)
        run = []
        start = 0
        while True:
            chunks.append(piece[start:start + size])
            if start + size >= len(piece):
                break
            start += size - overlap
    close(run)
    return [chunk.strip() for chunk in chunks if chunk.strip()]


def random_text(rng, longest):
    words = ["".join(rng.choices("abcdé日🙂", k=rng.randint(1, rng.choice([3, 10, longest])))) for _ in range(rng.randint(1, 120))]
    return " ".join(words)


def run(spark, texts, size, overlap):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string").repartition(3)
    rows = df.select("id", chunk_texts(F.col("content"), size, overlap).alias("chunks")).collect()
    return [row["chunks"] for row in sorted(rows, key=lambda row: row["id"])]


@pytest.mark.parametrize("size, overlap, longest", [(50, 10, 9), (50, 10, 60), (50, 0, 120), (50, 49, 70), (20, 5, 20)])
def test_against_plain_rules(spark, size, overlap, longest):
    rng = random.Random(size * overlap + longest)
    texts = [random_text(rng, longest) for _ in range(200)]
    for text, chunks in zip(texts, run(spark, texts, size, overlap), strict=True):
        assert chunks == expected_chunks(text, size, overlap), text


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text("aé🙂", min_size=1, max_size=30), min_size=1, max_size=40), st.integers(2, 20), st.data())
def test_spans_of_any_words(words, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    text = " ".join(words)
    spans = _spans(text, size, overlap)
    assert [text[a:b].strip() for a, b in spans if text[a:b].strip()] == expected_chunks(text, size, overlap)
    assert max(b - a for a, b in spans) <= size
    covered = set().union(*(range(a, b) for a, b in spans))
    assert covered == set(range(len(text)))


@pytest.mark.parametrize("words", [[850], [990], [998], [999], [1000], [1001], [2500], [400, 2500, 400], [990, 990], [199, 800, 201]])
def test_long_words_at_full_size(spark, words):
    text = " ".join(chr(97 + i) * n for i, n in enumerate([5, *words, 5, 7]))
    assert run(spark, [text], 1000, 200)[0] == expected_chunks(text, 1000, 200)


def test_properties(spark):
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(3000))
    chunks = run(spark, [text], 1000, 200)[0]
    assert max(map(len, chunks)) <= 1000
    position = 0
    for before, after in zip(chunks, chunks[1:]):
        start = text.index(after, position + 1)
        assert position + len(before) - start <= 200
        assert start <= position + len(before) + 1
        position = start
    assert text.startswith(chunks[0]) and text.endswith(chunks[-1])


@settings(max_examples=1000, deadline=None)
@given(st.integers(2, 12), st.data())
def test_bound_on_the_number_of_chunks(size, data):
    """Words around the lengths where the rules change."""
    overlap = data.draw(st.integers(0, size - 1))
    lengths = sorted({0, 1, 2, overlap, size - 2, size - 1, size, size + 1, 2 * size - overlap})
    words = data.draw(st.lists(st.sampled_from(lengths), max_size=60))
    text = " ".join("a" * length for length in words)
    starts = [a for a, _ in _spans(text, size, overlap)]
    assert all(later - first >= size - overlap for first, later in zip(starts, starts[3:]))
    assert len(starts) <= -(-3 * len(text) // (size - overlap)) + 3


def test_edges(spark):
    assert run(spark, ["", None, "a", "x" * 1000, " ", " a ", "\u00a0 a \u3000"], 1000, 200) == [
        [], [], ["a"], ["x" * 1000], [], ["a"], ["a"]]


def test_overlap_must_be_smaller_than_size():
    with pytest.raises(ValueError):
        chunk_texts(F.lit("x"), 10, 10)


def test_one_row_per_chunk_with_metadata(spark):
    content = " ".join(["word"] * 500)
    df = spark.createDataFrame(
        [("t1", "1", "T", None, "2000", "f", content), ("t2", "2", None, "J", None, "g", "short"),
         ("t3", "3", "T", "J", "2000", "h", "")], ARTICLE)
    chunks = chunk_articles(df)
    rows = sorted(chunks.collect(), key=lambda row: row["chunk_id"])
    assert [row["chunk_id"] for row in rows] == ["t1#0", "t1#1", "t1#2", "t2#0"]
    assert {row["journal"] for row in rows if row["pmid"] == "1"} == {"N/A"}
    assert (rows[-1]["title"], rows[-1]["year"], rows[-1]["source"]) == ("N/A", "N/A", "g")
    assert dict(map(tuple, chunk_counts(chunks).collect())) == {"1": 3, "2": 1}


def test_missing_column_is_not_available(spark):
    df = spark.createDataFrame([("t1", "1", "a b")], "text_id string, pmid string, content string")
    row = chunk_articles(df).first()
    assert (row["title"], row["journal"], row["year"], row["source"]) == ("N/A",) * 4


def test_content_is_cut_once(spark):
    df = spark.createDataFrame([("t1", "1", "T", "J", "2000", "f", "a b")], ARTICLE)
    plan = plan_of(chunk_articles(df))
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


def test_few_texts_of_a_batch_are_held_as_python_objects(monkeypatch):
    import pyarrow as pa

    from articleloom.operators import chunk as module

    held = []
    few = module._cut_few
    monkeypatch.setattr(module, "_cut_few", lambda texts, *args: held.append(len(texts)) or few(texts, *args))
    texts = pa.array([None if i % 7 == 0 else f"{i} word " * (i % 50) for i in range(1000)])
    assert module.cut_batch(texts, 100, 20).to_pylist() == few(texts, 100, 20).to_pylist()
    assert sum(held) == 1000 and max(held) <= module.TEXTS_AT_ONCE
    assert module.cut_batch(texts[:0], 100, 20).to_pylist() == []
