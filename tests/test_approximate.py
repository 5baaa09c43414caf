"""Approximate search against the exact one."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_of

from articleloom.operators import approximate, nearest


def frame(spark, matrix, name):
    return spark.createDataFrame([(n, None if row is None else [float(x) for x in row]) for n, row in enumerate(matrix)], f"{name} long, embedding array<float>")


def clustered(seed, count, dims=16, centres=40):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(centres, dims)) * 5)[rng.integers(0, centres, count)] + rng.normal(size=(count, dims))


def test_recall_and_candidates_on_clustered_vectors(spark, tmp_path):
    matrix = clustered(1, 3000)
    frame(spark, [*matrix, None, *[matrix[0]] * 500], "vec_id").write.parquet(str(tmp_path / "vectors"))
    vectors = spark.read.parquet(str(tmp_path / "vectors"))
    asked = frame(spark, [*matrix[:60], None], "question_id")
    found = nearest.nearest(asked, vectors, vector_id="vec_id")
    near = approximate.nearest_approximate(asked, vectors, vector_id="vec_id")
    row = approximate.recall_of(near, found, "vec_id").first()
    assert row["questions"] == 60 and row["recall"] >= 0.9
    # Every hit has its exact distance, and a question finds itself.
    exact = {(r["question_id"], r["vec_id"]): r["distance"] for r in found.collect()}
    rows = near.collect()
    assert all(exact.get((r["question_id"], r["vec_id"]), r["distance"]) == r["distance"] for r in rows)
    assert {r["question_id"] for r in rows if r["distance"] == 0} == set(range(60))
    # Of 500 copies only the lowest ids.
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["question_id"] == 0] == [0, 3001, 3002, 3003, 3004]
    hashing = approximate.ProjectionHash(vectors.filter("embedding IS NOT NULL"), approximate.bucket_width(matrix[:2000], 6), 16)
    pairs = hashing.keys(asked.filter("embedding IS NOT NULL"), "question_id").join(
        hashing.keys(vectors.filter("vec_id < 3000"), "vec_id"), "key").select("question_id", "vec_id").distinct().count()
    assert pairs < 0.5 * 60 * 3000


def test_collision_chance_is_that_of_the_hash(spark):
    rng = np.random.default_rng(2)
    directions = rng.normal(size=(20000, 16))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    for distance, width in ((1.0, 0.3), (2.0, 1.0), (0.5, 2.0)):
        moved = directions @ (np.eye(16)[0] * distance)
        met = np.maximum(0, 1 - np.abs(moved) / width).mean()
        assert abs(met - approximate.collision(np.array([distance]), width, 16)[0]) < 0.02


@pytest.mark.parametrize("top_k", [0, 3, 1000])
def test_odd_numbers_and_empty_tables(spark, top_k):
    vectors = frame(spark, clustered(3, 20), "vec_id")
    asked = frame(spark, clustered(3, 4), "question_id").selectExpr("*", f"{top_k} AS top_k")
    assert approximate.nearest_approximate(asked, vectors.limit(0), vector_id="vec_id").count() == 0
    assert approximate.nearest_approximate(asked.limit(0), vectors, vector_id="vec_id").count() == 0
    hits = approximate.nearest_approximate(asked, vectors, vector_id="vec_id")
    assert (hits.count() == 0) == (top_k == 0)


@pytest.mark.parametrize("dense", [0, 16, 10**9])
def test_only_vectors_that_share_a_key_are_hits(monkeypatch, dense):
    """Whether pairs are listed or compared in one product."""
    monkeypatch.setattr(approximate, "DENSE", dense)
    rng = np.random.default_rng(4)
    asked, vectors = rng.normal(size=(300, 5)), rng.normal(size=(700, 5))
    asked_keys, keys = rng.integers(0, 9, (300, 3)), rng.integers(0, 9, (700, 3))
    found = approximate.BestOfSharing(nearest.Batch(asked, (pa.array(range(300)),), asked_keys), np.full(300, 4))
    found.add(nearest.Batch(vectors, (pa.array(range(700)),), keys))
    exact = ((asked[:, None] - vectors) ** 2).sum(axis=2)
    exact[~(asked_keys[:, None] == keys).any(axis=2)] = np.inf
    assert found.columns[0].reshape(300, 4).tolist() == np.argsort(exact, axis=1)[:, :4].tolist()


def test_pairs_that_share_a_key_are_not_joined(spark, tmp_path):
    """Their number grows with the square of the table; they are measured where they are found."""
    frame(spark, clustered(5, 200), "vec_id").write.parquet(str(tmp_path / "vectors"))
    vectors = spark.read.parquet(str(tmp_path / "vectors"))
    plan = plan_of(approximate.nearest_approximate(frame(spark, clustered(5, 200), "question_id"), vectors, vector_id="vec_id"))
    assert "Join" not in plan and "MapInArrow" in plan
