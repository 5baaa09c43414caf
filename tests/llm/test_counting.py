"""Sharding, token counts, mixing and packing."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from articleloom.llm import mixing, packing, sharding, token_counts
from tests.llm.conftest import DOCUMENTS, EDGES

BYTES, WORDS = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts(count):
    draw = random.Random(3)
    letters = ["a", "b", "B", " ", "\n", "\t", "'s", "é", "1", "23", "!", "<|endoftext|>", "\x1c", "\x85", " ", "́", "Σ", "　", "ab, "]
    return ["".join(draw.choice(letters) for _ in range(draw.randint(1, 30))) for _ in range(count)] + [t or "" for _, t in EDGES]


# Sharding


@pytest.mark.parametrize("n", [1, 2, 5, 24, 25, 100, 997])
def test_feistel_is_a_permutation(spark, n):
    walk = sharding.walk_length(spark, n)
    places = [row[0] for row in spark.range(n).select(sharding.permuted(F.col("id"), n, walk)).collect()]
    assert sorted(places) == list(range(n))
    if n > 90:
        assert places != sorted(places)


def test_walks_that_end_late_are_ended(spark):
    for seed in range(6):
        walk = sharding.walk_length(spark, 7, seed)
        assert sorted(row[0] for row in spark.range(7).select(sharding.permuted(F.col("id"), 7, walk, seed)).collect()) == list(range(7))


def check_shards(rows, shards):
    slots = {}
    for row in rows:
        slots.setdefault(row["shard"], []).append(row["slot"])
    sizes = [len(slots.get(shard, [])) for shard in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_shards_of_a_table_of_many_files(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), F.col("id").cast("int") % 5).alias("text")).repartition(7).write.parquet(str(tmp_path / "t"))
    rows = sharding.shard_table(spark.read.parquet(str(tmp_path / "t"))).collect()
    again = sharding.shard_table(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    check_shards(rows, 24)
    assert sorted(row["row_number"] for row in rows) == list(range(1000))
    for row in rows:
        text = ("é" * (row["doc_id"] % 5)).encode()
        assert (row["size"], row["text_crc32"], row["law"], row["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "rows", None)


def test_shards_are_native(spark, tmp_path):
    spark.createDataFrame(EDGES, DOCUMENTS).write.parquet(str(tmp_path / "t"))
    plan = sharding.shard_table(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_of_odd_rows(edges, empty):
    rows = sharding.shard(edges).collect()
    assert Counter(row["doc_id"] for row in rows) == Counter(doc_id for doc_id, _ in EDGES)
    check_shards(rows, 24)
    assert sharding.shard(empty).collect() == []


# Token counts


def test_counts_are_those_of_the_library():
    library = Tokenizer.from_file(BYTES)
    with open(BYTES, encoding="utf-8") as file:
        merges = token_counts.Merges(file.read())
    for text in odd_texts(5000):
        assert merges.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_REMEMBERED", 10)
    with open(BYTES, encoding="utf-8") as file:
        merges = token_counts.Merges(file.read())
    text = " ".join(f"word{i}" for i in range(300))
    assert merges.count(text) == len(Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids)
    assert len(merges.words) <= 10 and len(merges.pieces) <= 10


def test_token_counts(edges, empty):
    library = Tokenizer.from_file(BYTES)
    rows = token_counts.token_counts(edges, BYTES, limit=3).collect()
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in EDGES]
    assert sorted(map(str, (tuple(row)[:3] for row in rows))) == sorted(map(str, expected))
    assert all(row["over_limit"] == (row["n_tokens"] > 3) for row in rows)
    assert token_counts.token_counts(empty, BYTES).collect() == []


# Mixing


def poisson(mean, chance):
    term = total = np.exp(-mean)
    k = 0
    while total <= chance and k < 400:
        k += 1
        term *= mean / k
        total += term
    return k


def test_poisson_inversion(spark):
    chances = [0.0, 0.1, 0.367, 0.368, 0.5, 0.9, 0.999, 0.999999]
    for mean in (0.01, 0.7, 1.0, 3.5, 40.0):
        frame = spark.createDataFrame([(c,) for c in chances], "c double")
        found = [row[0] for row in frame.select(mixing.poisson(F.col("c"), F.lit(mean))).collect()]
        assert found == [poisson(mean, c) for c in chances]


def mix_rows(spark):
    rows = [(i, f"text {i} " * 5, "big" if i % 3 else ("small" if i % 2 else None)) for i in range(3000)]
    return spark.createDataFrame(rows, DOCUMENTS + ", source string")


def test_sources_come_near_their_weights(spark):
    documents = mix_rows(spark)
    mix = mixing.mixed(documents, {"big": 1.0, "small": 3.0})
    sizes = {row["source"]: row["size"] for row in mix.groupBy("source").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    assert None not in sizes
    assert abs(sizes["small"] / sizes["big"] - 3) < 0.4
    assert abs(sum(sizes.values()) / documents.agg(F.sum(F.octet_length("text"))).first()[0] - 1) < 0.1


def test_copies_are_numbered_and_in_order_of_their_keys(spark):
    rows = mixing.mixed(mix_rows(spark)).select("doc_id", "mix_copy", "mix_copies", "mix_key").collect()
    copies = Counter(row["doc_id"] for row in rows)
    assert all(copies[row["doc_id"]] == row["mix_copies"] and 1 <= row["mix_copy"] <= row["mix_copies"] for row in rows)
    keys = [row["mix_key"] for row in rows]
    assert keys == sorted(keys) and [row["doc_id"] for row in rows] != sorted(row["doc_id"] for row in rows)
    assert sorted(rows) == sorted(mixing.mixed(mix_rows(spark).repartition(5)).select("doc_id", "mix_copy", "mix_copies", "mix_key").collect())


def test_a_tiny_source_beside_a_very_large_one(spark):
    """A rate of thousands is drawn in parts; rates that were drawn at once stay as they were."""
    rows = [(i, "x" * 200, "big") for i in range(300)] + [(1000 + i, "y", "tiny") for i in range(30)]
    documents = spark.createDataFrame(rows, DOCUMENTS + ", source string")
    mix = mixing.mixed(documents, {"big": 1.0, "tiny": 1.0}).groupBy("doc_id", "source", "mix_rate").agg(
        F.count("*").alias("n"), F.max("mix_copies").alias("copies")).collect()
    tiny = {row["doc_id"]: row["n"] for row in mix if row["source"] == "tiny"}
    rate = next(row["mix_rate"] for row in mix if row["source"] == "tiny")
    assert rate == pytest.approx(60_030 / 2 / 30) and all(row["n"] == row["copies"] for row in mix)
    assert len(tiny) == 30 and len(set(tiny.values())) > 20
    assert abs(np.mean(list(tiny.values())) - rate) < 4 * (rate / 30) ** 0.5
    assert 0.4 < np.var(list(tiny.values())) / rate < 2
    chance = {row["doc_id"]: row["c"] for row in documents.select("doc_id", mixing.unit(F.lit(mixing.SEED), F.col("doc_id").cast("string")).alias("c")).collect()}
    big = {row["doc_id"]: row["n"] for row in mix if row["source"] == "big"}
    assert all(big.get(i, 0) == poisson(60_030 / 2 / 60_000, chance[i]) for i in range(300))


def test_mixing_odd_rows(edges, empty):
    rows = mixing.mixed(edges).collect()
    assert {row["doc_id"] for row in rows} <= {doc_id for doc_id, _ in EDGES}
    assert all(row["shard"] == "other" and isinstance(row["mix_copy"], int) for row in rows)
    assert mixing.mixed(empty).collect() == []


# Packing


def test_word_ids_are_those_of_the_library(monkeypatch):
    library = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as file:
        words = packing.WordIds(file.read())
    texts = odd_texts(5000)

    def ids(texts):
        flat, starts = words.of(texts)
        return [flat[a:b].tolist() for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False)]

    for found, text in zip(ids(texts), texts, strict=True):
        assert found == library.encode(text, add_special_tokens=False).ids, repr(text)
    monkeypatch.setattr(packing, "MOST_REMEMBERED", 5)
    assert ids(texts) == ids(texts[::-1])[::-1]
    assert ids([]) == [] and ids(["", " \n"]) == [[], []]


def test_other_kinds_of_tokenizers_are_refused(spark):
    documents = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="white space"):
        packing.document_pieces(documents, public_tokenizers.path("byte_bpe_50k.json"))


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [gap for gap in gaps if gap >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(5))
def test_runs_give_best_fit_decreasing(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 50 if seed % 2 else 20) for _ in range(600)]
    steps = packing.best_fit_runs(Counter(lengths), 50)
    filled, sequences = Counter(), set()
    counts = Counter(lengths)
    for k, (length, rank, first, offset) in enumerate(steps):
        last = steps[k + 1][1] if k + 1 < len(steps) and steps[k + 1][0] == length else counts[length]
        for sequence in range(first, first + last - rank):
            assert filled[sequence] == offset
            filled[sequence] += length
            sequences.add(sequence)
    assert max(filled.values()) <= 50 and sum(filled.values()) == sum(lengths)
    assert len(sequences) == best_fit_decreasing(lengths, 50)


def test_packed_pieces(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice(["the", "of", "strange", "word"]) for _ in range(draw.randint(0, 120)))) for i in range(200)]
    packed = packing.best_fit(spark.createDataFrame(rows, DOCUMENTS), WORDS, capacity=64, keep_ids=True)
    library = Tokenizer.from_file(WORDS)
    ids = {i: [*library.encode(text, add_special_tokens=False).ids, packing.END] for i, text in rows}
    pieces = packed.collect()
    for row in pieces:
        piece = ids[row["doc_id"]][row["start"]:row["start"] + row["length"]]
        assert row["start"] == 64 * row["piece"] and (row["length"] == 64 or row["start"] + row["length"] == len(ids[row["doc_id"]]))
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == row["ids_crc32"]
    assert sum(row["length"] for row in pieces) == sum(map(len, ids.values()))
    by_sequence = {}
    for row in sorted(pieces, key=lambda row: row["offset"]):
        place = by_sequence.setdefault(row["sequence_id"], [])
        assert row["offset"] == len(place)
        place += ids[row["doc_id"]][row["start"]:row["start"] + row["length"]]
    assert max(map(len, by_sequence.values())) <= 64
    whole = {row["sequence_id"]: np.frombuffer(row["ids"], np.uint32).tolist() for row in packing.sequences(packed).collect()}
    assert whole == by_sequence
    assert len(by_sequence) == best_fit_decreasing([row["length"] for row in pieces], 64)


def test_packing_odd_rows(edges, empty):
    rows = packing.best_fit(edges, WORDS).collect()
    assert Counter(row["doc_id"] for row in rows if row["piece"] == 0) == Counter(doc_id for doc_id, _ in EDGES)
    assert packing.best_fit(empty, WORDS).collect() == []
