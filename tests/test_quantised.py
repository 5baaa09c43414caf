"""Exact search by a scan of bytes."""

import numpy as np
import pytest

from articleloom.operators import nearest, quantised
from articleloom.operators.nearest import QuestionBatch


def frame(spark, matrix, name="vec_id", first=0):
    rows = [(first + n, None if row is None else [float(x) for x in row]) for n, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


def case(seed, count, dims=24):
    rng = np.random.default_rng(seed)
    vectors = list(rng.normal(size=(count, dims)).astype(np.float32))
    # Copies, near copies, zero, huge, tiny and missing vectors.
    vectors += [vectors[3]] * 40 + [vectors[3] * np.float32(1 + 1e-6)] * 3 + [np.zeros(dims, np.float32)] * 2
    vectors += [vectors[5] * np.float32(1e15), vectors[6] * np.float32(1e-15), None]
    return vectors


@pytest.mark.parametrize("max_bytes", [nearest.BATCH_BYTES, 3000])
def test_the_same_hits_as_by_vectors(spark, tmp_path, max_bytes):
    vectors = case(1, 600)
    asked = frame(spark, [*vectors[:30], *vectors[-6:], vectors[3]], "question_id", 1000).selectExpr("*", "int(question_id % 7) AS top_k")
    stored = frame(spark, vectors).repartition(6)
    quantised.write_quantised(stored, str(tmp_path / "bytes"))
    table = spark.read.parquet(str(tmp_path / "bytes"))
    found = quantised.nearest_quantised(asked, table, vector_id="vec_id", max_bytes=max_bytes)
    wanted = nearest.nearest(asked, stored, vector_id="vec_id")
    order = lambda df: sorted((r["question_id"], r["rank"], r["vec_id"], r["distance"]) for r in df.collect())
    assert order(found) == order(wanted) and found.count() > 50


def test_few_pairs_are_left_open(spark, tmp_path):
    vectors = case(2, 4000, 64)
    quantised.write_quantised(frame(spark, vectors).repartition(4), str(tmp_path / "bytes"))
    table = spark.read.parquet(str(tmp_path / "bytes"))
    batch = QuestionBatch.of(frame(spark, vectors[:50], "question_id"))
    pairs = quantised.open_pairs(batch, 0, table, "vec_id")
    # Five are wanted; of some thousand vectors a handful more cannot be ruled out.
    assert pairs.count() <= 50 * 15
    scan = next(line for line in table.select("code", "scale", "error", "same", "vec_id")._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "embedding" not in scan


def test_bounds_hold(spark):
    rows = quantised.with_bytes(frame(spark, case(3, 50))).collect()
    for row in rows:
        if row["embedding"] is None:
            assert row["code"] is None
            continue
        back = np.frombuffer(bytes(row["code"]), np.int8) * row["scale"]
        assert np.linalg.norm(np.array(row["embedding"], np.float64) - back) <= row["error"] or row["error"] == 0
    assert len({row["same"] for row in rows[50:90]}) == 1
    with pytest.raises(Exception, match="not finite"):
        quantised.with_bytes(frame(spark, [[1.0, float("nan")]])).collect()


def test_empty_tables(spark, tmp_path):
    vectors = frame(spark, case(4, 5))
    quantised.write_quantised(vectors.limit(0), str(tmp_path / "none"))
    quantised.write_quantised(vectors, str(tmp_path / "some"))
    asked = frame(spark, case(4, 5)[:3], "question_id")
    assert quantised.nearest_quantised(asked, spark.read.parquet(str(tmp_path / "none")), vector_id="vec_id").count() == 0
    some = spark.read.parquet(str(tmp_path / "some"))
    assert quantised.nearest_quantised(asked.limit(0), some, vector_id="vec_id").count() == 0
    assert quantised.nearest_quantised(asked.selectExpr("*", "9999 AS top_k"), some, vector_id="vec_id").count() == 3 * (len(case(4, 5)) - 1)


def test_pairs_are_thinned_out_by_blocks_of_questions(monkeypatch):
    """What is open for a few questions is not sorted together with that of all others."""
    sizes = []
    place = quantised._place_in_group
    monkeypatch.setattr(quantised, "_place_in_group", lambda groups: sizes.append(len(groups)) or place(groups))
    rng = np.random.default_rng(6)
    matrix = rng.normal(size=(4000, 16))
    scale = np.abs(matrix).max(axis=1) / quantised.LEVELS
    codes = np.rint(matrix / scale[:, None])
    error = np.sqrt(((matrix - codes * scale[:, None]) ** 2).sum(axis=1)) * (1 + quantised.SLACK)
    found = quantised.OpenPairs(matrix, np.full(4000, 3))
    for start in range(0, 4000, 1000):
        part = slice(start, start + 1000)
        found.add(codes[part], scale[part], error[part], np.arange(4000)[part], np.arange(4000)[part])
    rows, ids, least, most = found.columns()
    assert max(sizes) < len(rows)
    exact = np.sqrt(((matrix[:50, None] - matrix) ** 2).sum(axis=2))
    for row in range(50):
        assert set(np.argsort(exact[row])[:3]) <= set(ids[rows == row])
    measured = np.sqrt(((matrix[rows] - matrix[ids]) ** 2).sum(axis=1))
    assert (least <= measured + 1e-6).all() and (measured <= most + 1e-6).all()
