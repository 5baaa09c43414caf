"""Neighbours, shingle join, line join and the pipeline."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from articleloom.llm import ann, line_dedup, ngram_join
from articleloom.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS, EDGES

VECTORS = "vec_id long, embedding array<float>"


# Neighbours


def clustered(n, dims=16, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(20, dims))
    return (centres[draw.integers(0, 20, n)] + 0.6 * draw.normal(size=(n, dims))).astype(np.float32)


def exact(ids, vectors, k):
    rows = vectors.astype(np.float64)
    rows = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    found = {}
    for i in np.flatnonzero(np.array(ids) % 50 == 0):
        scores = rows @ rows[i]
        order = sorted((-scores[j], ids[j]) for j in range(len(ids)) if j != i)
        found[ids[i]] = order[:k]
    return found


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_SIZE", 40)
    monkeypatch.setattr(ann, "SEARCH_LISTS", 20)
    monkeypatch.setattr(ann, "BLOCK", 50)
    vectors = clustered(4000)
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(vectors)], VECTORS)
    found = {}
    for row in ann.nearest(frame).collect():
        found.setdefault(row["query_id"], {})[row["rank"]] = (row["vec_id"], row["score"])
    wanted = exact(list(range(4000)), vectors, 5)
    assert set(found) == set(wanted) and all(sorted(hits) == [1, 2, 3, 4, 5] for hits in found.values())
    hits = sum(len({vec for vec, _ in found[q].values()} & {vec for _, vec in near}) for q, near in wanted.items())
    assert hits / (5 * len(wanted)) >= 0.9
    for q, near in found.items():
        scores = [near[rank][1] for rank in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        a, b = vectors[q].astype(float), vectors[near[1][0]].astype(float)
        assert scores[0] == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-12)


def test_the_ratio_alone_bounds_the_lists_searched():
    """A thousand lists as far as each other, and some beyond the ratio; then two near ones among far ones."""
    close = np.concatenate([np.full(1000, 0.5), np.full(200, -0.5)])[None]
    assert ann.lists_to_search(close)[0].tolist() == [True] * 1000 + [False] * 200
    close = np.concatenate([np.full(2, 0.99), np.full(500, 0.1)])[None]
    assert ann.lists_to_search(close)[0].sum() == ann.SEARCH_LISTS


def test_blocks_cover_the_lists(monkeypatch):
    monkeypatch.setattr(ann, "SEARCH_LISTS", 1)
    centroids = np.eye(4, dtype=np.float32)
    first, last = np.array([0, 2, 2, 5]), np.array([2, 2, -1, 6])  # the third list has no members
    vectors = np.eye(4, dtype=np.float32)
    found = ann.blocks_to_search(vectors, centroids, first, last)
    assert [blocks.tolist() for blocks in found] == [[0, 1, 2], [2], [], [5, 6]]


def test_recall_of_a_large_table(spark, tmp_path):
    """Production parameters on 200,000 vectors without clusters: the lists that hold the nearest are far more than 64."""
    n, draw = 200_000, np.random.default_rng(7)
    vectors = draw.normal(size=(n, 64)).astype(np.float32)
    column = pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), 64).cast(pa.list_(pa.float32()))
    for part in range(8):
        pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": column}).slice(part * n // 8, n // 8), tmp_path / f"{part}.parquet")
    found = ann.nearest(spark.read.parquet(str(tmp_path)), step=500).toPandas().groupby("query_id")["vec_id"].agg(set)
    scaled = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for query in range(0, n, 500):
        scores = scaled @ scaled[query]
        scores[query] = -2
        hits += len(found[query] & set(np.argpartition(-scores, 5)[:5].tolist()))
    assert len(found) == 400
    print(f"recall {hits / 2000}")
    assert hits / 2000 >= 0.9


def test_copies_ties_and_vectors_that_take_no_part(spark):
    same, other = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(i, same) for i in range(0, 120)] + [(200, other), (200, other), (250, None), (300, [0.0] * 3), (350, [1.0, None, 0.0]),
            (400, [float("nan"), 0.0, 1.0]), (450, [float("inf"), 0.0, 1.0]), (None, same), (500, [1.0, 2.0]), (550, [])]
    found = {}
    for row in ann.nearest(spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit("x"))).orderBy("rank").collect():
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    assert set(found) == {0, 50, 100, 200}
    assert found[0] == [(i, 1.0) for i in (1, 2, 3, 4, 5)]
    assert found[50] == found[100] == [(i, 1.0) for i in (0, 1, 2, 3, 4)]
    assert found[200] == [(i, 0.0) for i in (0, 1, 2, 3, 4)]


def test_fewer_vectors_than_wanted(spark):
    rows = [(0, [1.0, 0.0]), (7, [1.0, 1.0]), (8, [-1.0, 0.0])]
    found = ann.nearest(spark.createDataFrame(rows, VECTORS)).orderBy("rank").collect()
    assert [(row["query_id"], row["rank"], row["vec_id"]) for row in found] == [(0, 1, 7), (0, 2, 8)]
    assert ann.nearest(spark.createDataFrame([], VECTORS)).collect() == []


# Shingles


def test_every_pair_within_the_difference_shares_what_it_needs():
    """The pigeonhole itself: random pairs at the edge of the similarity."""
    draw = np.random.default_rng(3)
    for _ in range(1500):
        size = int(draw.integers(1, 400)) if draw.random() < 0.5 else int(draw.integers(1, 30))
        common = draw.integers(0, 2**63, size, dtype=np.uint64)
        extra = int(draw.integers(0, size // 3 + 2))
        split = int(draw.integers(0, extra + 1))
        a = np.unique(np.concatenate([common, draw.integers(0, 2**63, split, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, draw.integers(0, 2**63, extra - split, dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 75 * (len(a) + len(b) - shared):
            continue
        (keys_a, need_a), (keys_b, need_b) = ngram_join.signatures(a), ngram_join.signatures(b)
        assert len(np.intersect1d(keys_a, keys_b)) >= max(need_a, need_b, 1)


def test_bands_hold_every_partner():
    for size in range(1, 500):
        for other in range(size, size * 4 // 3 + 1):
            assert ngram_join.band_top(other) in ngram_join.bands(size)


def near_copies(seed, count=160):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(draw.choice(words) for _ in range(55))
    base = [draw.choice(words) for _ in range(120)]
    rows = []
    for i in range(count):
        kind = i % 8
        if kind < 3:  # near copies of one text
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(len(text))] = draw.choice(words)
        elif kind == 3:  # texts that share a passage only
            text = [draw.choice(words) + str(i) for _ in range(draw.randint(0, 150))] + passage.split()
        elif kind == 4:  # short texts
            text = [draw.choice(words[:3]) for _ in range(draw.randint(1, 9))]
        elif kind == 5 and len(rows) > 20:  # copies, in other case and spacing
            text = (rows[draw.randrange(len(rows))][1] or "x").upper().split()
        else:
            text = [draw.choice(words) + str(i) for _ in range(draw.randint(1, 200))]
        rows.append((draw.randrange(10_000), draw.choice([" ", "\n", " \t"]).join(text)))
    return rows


def test_components_against_brute_force(spark):
    rows = near_copies(1) + EDGES
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCUMENTS).repartition(5)).collect()
    assert sorted(map(tuple, found), key=str) == brute.near_duplicates(rows)


def test_components_when_every_set_is_left_to_the_last_step(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "STAR_TURNS", 0)
    monkeypatch.setattr(ngram_join, "GATHERED", 500)
    monkeypatch.setattr(ngram_join, "MOST_SENT", 0)
    rows = near_copies(2, 100)
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCUMENTS).repartition(3)).collect()
    assert sorted(map(tuple, found), key=str) == brute.near_duplicates(rows)


def test_copies_below_the_similarity_are_not_paired_with_each_other(spark, monkeypatch):
    """Texts that share four fifths with one text that is not there: too little for a link, and too little to ask all the others."""
    draw = random.Random(5)
    base = [f"b{i}" for i in range(170)]
    rows = []
    for i in range(60):
        text = list(base)
        for k in range(7):
            text[10 + 23 * k + draw.randrange(8)] = f"own{i}x{k}"
        rows.append((i, " ".join(text)))
    rows += near_copies(6, 40)
    asked, probed = [], ngram_join._probed
    monkeypatch.setattr(ngram_join, "_probed", lambda members: asked.append(probed(members).count()) or probed(members))
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCUMENTS).repartition(3)).collect()
    assert sorted(map(tuple, found), key=str) == brute.near_duplicates(rows)
    assert sum(asked) < 60


def made_from_one_text(n, edits, seed=14):
    """Texts from which words were taken at many places, so that few pairs are similar and most share the larger part of what they have."""
    draw = random.Random(seed)
    source = [f"w{draw.randrange(10**6)}" for _ in range(300)]
    kept = [sorted(set(range(300)) - set(draw.sample(range(300), edits))) for _ in range(n)]
    return [(i, " ".join(source[k] for k in row)) for i, row in enumerate(kept)]


def test_texts_made_from_one_text_are_not_verified_pair_by_pair(spark, monkeypatch):
    rows = made_from_one_text(60, 18) + [(100 + i, text) for i, text in made_from_one_text(10, 5)]
    verified, links = [], ngram_join._links
    monkeypatch.setattr(ngram_join, "_links", lambda pairs, *rest: verified.append(pairs.count()) or links(pairs, *rest))
    frame = spark.createDataFrame(rows, DOCUMENTS)
    assert sorted(map(tuple, ngram_join.near_duplicates(frame).collect()), key=str) == brute.near_duplicates(rows)
    assert sum(verified) < 300


def test_parities_differ_in_no_more_places_than_sets():
    draw = np.random.default_rng(15)
    for size in (1, 7, 300, 3000):
        a = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
        b = np.union1d(a[size // 9:], draw.integers(0, 2**63, size // 12).astype(np.uint64))
        x, y = (np.array(ngram_join.parities(side), np.int64).view(np.uint64) for side in (a, b))
        assert 0 < np.bitwise_count(x ^ y).sum() + (size < 9) <= len(np.setxor1d(a, b)) + (size < 9)


def test_signatures_travel_with_few_names_of_sets(spark):
    """A set is named once in each part, so that the bytes sent grow with the parts; 160 MB of text have no more than 12 of them."""
    parts = []

    class Enough(Exception):
        pass

    def gather(documents, number):
        parts.append(number)
        raise Enough

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    frame = spark.range(160).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', 500000)").alias("text"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ngram_join, "_gather", gather)
        with pytest.raises(Enough):
            ngram_join.grouped(frame)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts and parts[0] <= 12


def test_able_sets_are_sent_by_one_number(spark):
    """Tables of two keys take a page of memory each in every executor."""
    rows = [(k, s, s, 1) for k in range(1, 40, 2) for s in range(5)]
    members = spark.createDataFrame(rows, "key long, set_id long, component long, weight long")
    needs = spark.createDataFrame([(s, True, 1, 1, 20) for s in range(5)], "set_id long, fine boolean, need int, small int, elements long")
    able = ngram_join._able(members, needs)
    plan = able._jdf.queryExecution().sparkPlan().toString()
    keys = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert able.count() == 5 and len(keys) == 1 and "fine" not in keys[0].split("]")[0]


def test_a_passage_that_texts_share_is_one_bucket(spark, monkeypatch):
    """Texts made of passages that others have too, none similar to another: a passage counts once, not once a shingle."""
    draw, entered, probed = random.Random(12), [], ngram_join._probed
    passages = [[f"p{k}x{i}" for i in range(40)] for k in range(12)]
    rows = [(i, " ".join(word for k in draw.sample(range(12), 5) for word in passages[k])) for i in range(50)] + near_copies(7, 24)
    monkeypatch.setattr(ngram_join, "_probed", lambda members: entered.append(members.count()) or probed(members))
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCUMENTS).repartition(3)).collect()
    assert sorted(map(tuple, found), key=str) == brute.near_duplicates(rows)
    assert entered and max(entered) < 50 * 5 * 36 / 4


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)], "a long, b long")
    found = dict(map(tuple, ngram_join.components(links).collect()))
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 103: 100}


def test_one_document_of_each_component(spark, edges, empty):
    rows = near_copies(3, 80)
    kept = ngram_join.one_of_each(spark.createDataFrame([(*row, "x") for row in rows], DOCUMENTS + ", component_id string"))
    ids = sorted(row["doc_id"] for row in kept.collect())
    assert ids == sorted({component for _, _, component in brute.near_duplicates(rows)})
    assert kept.columns == ["doc_id", "text", "component_id"]
    odd = ngram_join.one_of_each(edges).collect()
    assert Counter((row["doc_id"], row["text"]) for row in odd) == Counter(set(EDGES))
    assert ngram_join.near_duplicates(empty).collect() == [] and ngram_join.one_of_each(empty).collect() == []


# Lines


def lined(seed, count=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    lines = [[draw.choice(words) for _ in range(draw.randint(5, 40))] for _ in range(12)]
    rows = []
    for _ in range(count):
        text = []
        for _ in range(draw.randint(1, 6)):
            line = list(draw.choice(lines))
            for _ in range(draw.randint(0, 3)):
                line[draw.randrange(len(line))] = draw.choice(words)
            if draw.random() < 0.3:
                line = [draw.choice(words) for _ in range(draw.randint(1, 30))]
            text.append(" ".join(line) + draw.choice(["", " ", "\r"]))
        rows.append((draw.randrange(1000), "\n".join(text)))
    return rows


def check_lines(spark, rows):
    frame = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    hashes = {row["text"]: row["h"] for row in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    wanted = brute.removed_lines(rows, hashes)
    found = {(row["doc_id"], row["text_hash"]): row["removed"] for row in line_dedup.removed_lines(frame).collect()}
    assert found == {(doc_id, hashes[text]): lines for (doc_id, text), lines in wanted.items()}
    kept = {(row["doc_id"], row["text"]) for row in line_dedup.without_lines(frame).collect()}
    expected = set()
    for (doc_id, text), lines in wanted.items():
        if lines:
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in lines)
            if not text.strip(" \t\n\x0b\f\r"):
                continue
        expected.add((doc_id, text))
    assert kept == expected


def test_lines_against_brute_force(spark):
    check_lines(spark, lined(1) + EDGES)


def test_every_line_with_a_word_takes_part(spark, tmp_path):
    """Against brute force without a floor: short lines of two to nine words, most of them repeated exactly or nearly."""
    draw = random.Random(9)
    words = [f"w{i}" for i in range(14)]
    short = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 9))) for _ in range(60)]
    rows = [(i, "\n".join(draw.choice([draw.choice(short), f"{draw.choice(short)} own{i}", "", "Licensed under the Apache License, Version 2.0."])
                          for _ in range(6))) for i in range(60)] + lined(4, 30) + EDGES
    frame = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    hashes = {row["text"]: row["h"] for row in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    seen, wanted = [], {}
    for doc_id, text in sorted(set(rows), key=lambda row: (row[0] is None, row[0] or 0, hashes[row[1]])):
        gone = wanted.setdefault((doc_id, hashes[text]), [])
        for number, line in enumerate((text or "").encode().lower().split(b"\n")):
            if line_words := frozenset(line.split()):
                if any(100 * len(line_words & other) >= 80 * len(line_words | other) for other in seen):
                    gone.append(number)
                seen.append(line_words)
    assert sum(map(len, wanted.values())) > 200
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = {tuple(row)[::3] for row in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()}
    assert found == {(doc_id, ",".join(map(str, gone))) for (doc_id, _), gone in wanted.items()}


def test_lines_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LARGE_BUCKET", 2)
    monkeypatch.setattr(line_dedup, "MOST_SENT", 0)
    monkeypatch.setattr(line_dedup, "AT_ONCE", 300)
    monkeypatch.setattr(line_dedup, "GATHERED", 50)
    check_lines(spark, lined(2))


def test_unlike_lines_that_share_words_are_compared_where_they_are(spark, monkeypatch):
    """More lines than a bucket once could hold share a word, few are similar: no join of the bucket's members by Spark."""
    draw, named, stored = random.Random(11), [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: named.append(name) or stored(df, name))
    lines = [["shared"] + [f"w{draw.randrange(3000)}" for _ in range(12)] for _ in range(150)]
    lines += [[*line[:-1], "other"] for line in lines[:20]] + [[*line[:-4], "too", "many", "of", "them"] for line in lines[20:40]]
    lines += [["x" * 70 + "a"] * 3, ["x" * 70 + "b"], ["X" * 70 + "A"]]
    check_lines(spark, [(i, " ".join(line)) for i, line in enumerate(lines)])
    assert "line_pairs" in named and "large" not in named


def test_columns_stay_and_lengths_follow(spark, empty):
    line = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{line}\nshort", 999, "a", "x"), (2, f"own\n{line} more", 999, "b", "y"), (3, line, 999, "c", "z"), (4, None, None, None, None)]
    kept = line_dedup.without_lines(spark.createDataFrame(rows, DOCUMENTS + ", n_chars long, source string, line string"))
    assert sorted(map(tuple, kept.collect())) == [
        (1, f"{line}\nshort", len(line) + 6, "a", "x"), (2, "own", 3, "b", "y"), (4, None, None, None, None)]
    assert line_dedup.removed_lines(empty).collect() == [] and line_dedup.without_lines(empty).collect() == []


# The pipeline and the queries


def test_pipeline(spark, tmp_path):
    rows = [(i, text, "en", f"s{i % 3}", len(text)) for i, (_, text) in enumerate(near_copies(4, 60))]
    documents = spark.createDataFrame(rows, DOCUMENTS + ", lang string, source string, n_chars long")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == documents.columns, name
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(packed.columns) and packed.count() > 0
    assert {row["doc_id"] for row in packed.collect()} <= {row[0] for row in rows}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "best_fit_packing"]


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
