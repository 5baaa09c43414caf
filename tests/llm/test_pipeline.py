"""The pipeline against plain versions of its operators, chained stage by stage."""

import hashlib
import math
import random
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from articleloom.llm import mixing, toxicity
from tests.llm import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, component string, rank int"
TOXIC = ["grumblefoul", "snarlwretch", "vilespit"]


def corpus():
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(3, 9))) for _ in range(400)]
    line = lambda k: " ".join(draw.choice(words) for _ in range(k))
    license_line = "Licensed under the Apache License, Version 2.0."
    rows, labels = [], []
    for n in range(260):
        parts = [line(draw.randint(3, 25)) for _ in range(draw.randint(1, 6))]
        if n % 3 == 0:
            parts.insert(draw.randrange(len(parts) + 1), license_line)
        if n % 9 == 0:
            parts = [p + " " + " ".join(draw.choice(TOXIC) for _ in range(3)) for p in parts]
        rows.append((n, "\n".join(parts)))
        labels.append((n, 1, int(n % 9 == 0)))
    base = " ".join(line(30) for _ in range(8)).split()
    for n in range(300, 330):  # near copies, one word in two hundred changed, on one line each
        copy = list(base)
        copy[draw.randrange(len(copy))] = draw.choice(words)
        cut = draw.randrange(1, len(copy))
        rows.append((n, " ".join(copy[:cut]) + "\n" + " ".join(copy[cut:])))
    rows += [(400 + n, rows[1][1]) for n in range(5)] + [(500, None), (501, ""), (502, " \n\t"), (503, line(30_000)), (504, license_line)]
    full = [(doc_id, text, None if n % 7 == 0 else "en", None if n % 50 == 0 else f"s{n % 3}", len(text or ""), "c", n)
            for n, (doc_id, text) in enumerate(rows)]
    return full, labels


def after_lines(rows, hashes):
    kept = []
    for (doc_id, text), gone in brute.removed_lines([row[:2] for row in rows], hashes).items():
        if gone:
            text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
            if not text.strip(" \t\n\x0b\f\r"):
                continue
        kept.append((doc_id, text))
    return kept


def one_of_each(rows):
    components = {doc_id: (size, component) for doc_id, size, component in brute.near_duplicates(rows)}
    return [(doc_id, text) for doc_id, text in rows if not components[doc_id][0] or components[doc_id][1] == doc_id]


def copies(rows, source_of):
    sizes = defaultdict(int)
    for doc_id, text in rows:
        sizes[source_of[doc_id]] += len((text or "").encode())
    weights = {source: size**mixing.POWER for source, size in sizes.items()}
    found = Counter()
    for doc_id, _ in rows:
        source = source_of[doc_id]
        rate = sum(sizes.values()) * weights[source] / sum(weights.values()) / sizes[source] if sizes[source] else 1.0
        chance = int(hashlib.md5(f"{mixing.SEED}/{doc_id}".encode()).hexdigest()[:12], 16) / 2**48
        k, term, total = 0, math.exp(-rate), math.exp(-rate)
        while total <= chance:
            k += 1
            term *= rate / k
            total += term
        found[doc_id] = k
    return found


def test_every_stage_against_plain_versions(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    documents = spark.read.parquet(str(tmp_path / "documents.parquet"))

    # Toxicity: what the model of the labels scores below a half stays, and no toxic document does.
    scored = toxicity.toxicity(documents, toxicity.train(documents, labels)).collect()
    clean = {row["doc_id"] for row in scored if row["predicted"] == 0}
    assert clean == {row[0] for row in rows} - {n for n in range(0, 260, 9)}
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["toxicity"](spark, documents, str(tmp_path))
    wanted = [row[:2] for row in rows if row[0] in clean]
    as_rows = lambda df: sorted(((row["doc_id"], row["text"]) for row in df.collect()), key=str)
    assert as_rows(docs) == sorted(wanted, key=str) and docs.columns == documents.columns

    hashes = {row["text"]: row["h"] for row in documents.select("text", F.xxhash64("text").alias("h")).collect()}
    lines = after_lines(wanted, hashes)
    assert len(lines) < len(wanted)
    docs = stages["line_dedup"](spark, docs, str(tmp_path))
    assert as_rows(docs) == sorted(lines, key=str) and docs.columns == documents.columns
    assert all(row["n_chars"] == (None if row["text"] is None else len(row["text"])) for row in docs.collect())

    singles = one_of_each(lines)
    assert len(singles) < len(lines)
    docs = stages["ngram_join"](spark, docs, str(tmp_path))
    assert as_rows(docs) == sorted(singles, key=str) and docs.columns == documents.columns

    source_of = {row[0]: row[3] for row in rows}
    drawn = copies(singles, source_of)
    docs = stages["mixing"](spark, docs, str(tmp_path))
    assert Counter(row["doc_id"] for row in docs.collect()) == +drawn and docs.columns == documents.columns

    # Packing, and with it the whole run.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = Counter()
    for doc_id, text in singles:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece in range(0, len(ids), 4096):
            part = ids[piece:piece + 4096]
            pieces[doc_id, piece // 4096, piece, len(part), zlib.crc32(array("I", part).tobytes())] += drawn[doc_id]
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == +pieces
    sequences = defaultdict(list)
    for row in packed:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for held in sequences.values():
        ends = 0
        for offset, length in sorted(held):
            assert offset == ends
            ends += length
        assert ends <= 4096


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
