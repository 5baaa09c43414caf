"""Classification by an automaton and embedding by a model."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_ask import articles

from articleloom.functions.automaton import automaton_of, classify_by_automaton
from articleloom.functions.embedding import term_vector
from articleloom.functions.lexicon import MEDICAL_DOMAINS, classify
from articleloom.functions.projection import embed_by_projection, projected_vector, write_projection
from articleloom.operators import index


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_same_domains_as_the_built_in_form(spark, seed):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choices("abcÉß ", k=k))
    lexicon = [(f"d{n}", [word(rng.randint(1, 5)) for _ in range(4)]) for n in range(8)] + [("none here", ["zzzz"]), ("no words", [])]
    if seed == 3:
        lexicon.insert(4, ("everything", ["", "a"]))
    texts = [(n, word(rng.randint(0, 12))) for n in range(300)] + [(900, None), (901, ""), (902, "zzzzz"), (903, "x" * 100_000)]
    df = spark.createDataFrame(texts, "id int, text string")
    for chosen in (lexicon, MEDICAL_DOMAINS, []):
        both = df.select("id", classify(F.col("text"), chosen, "other").alias("a"), classify(F.col("text"), chosen, "other", automaton=True).alias("b"))
        assert both.filter("a <> b OR a IS NULL OR b IS NULL").count() == 0


def test_keywords_that_say_nothing_new_are_left_out():
    automaton = automaton_of([["gene"], ["general", "art"], ["heart", "gen", "gene"]])
    assert {word: place for word, (place, _) in automaton.items()} == {"gene": 0, "art": 1, "gen": 2}


def test_too_large_a_lexicon_is_refused(monkeypatch):
    monkeypatch.setattr("articleloom.functions.automaton.LEXICON_BYTES", 3)
    with pytest.raises(ValueError, match="too large"):
        classify_by_automaton(None, [("d", ["word"])], "other")


def test_projection_is_a_product_with_signs(spark, tmp_path):
    path = str(tmp_path / "model")
    write_projection(spark, path, size=8)
    signs = {row["bucket"]: row["signs"] for row in spark.read.parquet(path).collect()}
    assert len(signs) == 256 and {sign for row in signs.values() for sign in row} == {1.0, -1.0}
    texts = [(1, "the heart and the brain"), (2, ""), (3, None), (4, "é " * 5000)]
    df = spark.createDataFrame(texts, "id int, text string")
    rows = df.select("id", term_vector(F.col("text")).alias("counts"), projected_vector(F.col("text"), path, batch=2).alias("vector")).collect()
    for row in rows:
        assert row["vector"] == [sum(count * signs[bucket][k] for bucket, count in enumerate(row["counts"])) for k in range(8)]


def test_an_index_of_projected_vectors(spark, tmp_path):
    model, path = str(tmp_path / "model"), str(tmp_path / "index")
    write_projection(spark, model)
    index.append_to_index(articles(spark, 1, 2), path, embed=lambda chunks: embed_by_projection(chunks, model))
    rows = index.open_chunk_index(spark, path).collect()
    assert rows and all(len(row["embedding"]) == 64 for row in rows)
    assert "Exchange" not in plan_of(embed_by_projection(index.chunk_articles(articles(spark, 1)), model))
