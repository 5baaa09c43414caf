"""Archives, ranked search and spelling variants against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
import zstandard
from pyarrow.fs import FileSystem

from articleloom.llm import lexical, spelling, warc

# Archives

PAGES = "page_id long, url string, html string"
LONG = "<p>" + "words of a page " * 200 + "</p>"
PAGE_ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, "http://a/3\r\nX: y", LONG + "é"), (4, None, "short"), (5, "http://a/5", "short"),
    (6, "http://a/6", None), (7, "http://a/7", ""), (7, "http://a/7", ""), (8, "http://a/8", "x" * 999), (9, "http://a/9", "x" * 999),
    (10, "http://a/10", "x" * 1000), (11, "http://a/11", "x" * 1000), (11, "http://a/11", "x" * 1000), (None, None, LONG), (None, None, "z" * 2000),
    (12, "http://a/12", "y" * 300_000), (-5, "http://a/-5", "y" * 300_000)]


def plain_pages(rows):
    largest = defaultdict(lambda: None)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page_id is not None:
            largest[payload] = max(page_id, page_id if largest[payload] is None else largest[payload])
    found = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        holder = largest[payload] if len(payload) >= 1000 and largest[payload] != page_id else None
        found.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "response" if holder is None else "revisit", holder))
    return sorted(found, key=str)


def written(spark, folder, frame, **options):
    path = f"file://{folder}/warc"
    warc.write_archives(frame, path, **options)
    return path


@pytest.mark.parametrize("few", [True, False])
def test_pages_come_back(spark, tmp_path, monkeypatch, few):
    if not few:
        monkeypatch.setattr(warc, "SMALL_BYTES", 0)
    pages = spark.createDataFrame(PAGE_ROWS, PAGES).selectExpr("*", "'other' AS payload", "'other' AS key", "1 AS largest")
    path = written(spark, tmp_path, pages.repartition(3), archive_bytes=2000)
    records = warc.read_archives(spark, path)
    assert records.filter("problem IS NOT NULL").count() == 0
    assert sorted(map(tuple, warc.page_records(records).collect()), key=str) == plain_pages(PAGE_ROWS)
    texts = {(row["page_id"], bytes(row["payload"])) for row in records.filter("record_type = 'response'").collect()}
    assert texts == {(page_id, (html or "").encode()) for page_id, _, html in PAGE_ROWS} - {
        (1, LONG.encode()), (None, LONG.encode()), (10, b"x" * 1000), (-5, b"y" * 300_000)}
    addresses = {row["target_uri"] for row in records.collect()}
    assert "http://a/3%0D%0AX:%20y" in addresses


def test_no_pages_no_records(spark, tmp_path):
    path = written(spark, tmp_path, spark.createDataFrame([], PAGES))
    assert warc.page_records(warc.read_archives(spark, path)).count() == 0


def archive_of(folder, rows):
    files, local = FileSystem.from_uri(f"file://{folder}")
    writer = warc.ArchiveWriter(files, local, warc.DATE)
    for page_id, url, html in rows:
        writer.add(warc.page_record(page_id, url, html.encode(), None, warc.DATE))
    name, records, size = writer.close()
    data = (folder / name).read_bytes()
    assert len(data) == size
    return data, records


def many_pages(count=400):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    return [(n, f"http://a/{n}", "<p>" + " ".join(rng.choices(words, k=1000)) + "</p>") for n in range(count)]


def test_the_dictionary_leads_the_archive(tmp_path):
    data, records = archive_of(tmp_path, many_pages())
    assert data[:4] == warc.DICTIONARY_MAGIC
    found = list(warc.archive_records(data))
    assert len(found) == records == 401 and not any(record["problem"] for record in found)
    # Without it, frames cannot be read.
    bare = data[8 + int.from_bytes(data[4:8], "little"):]
    assert all(record["problem"] for record in warc.archive_records(bare))
    # It may be compressed itself.
    packed = zstandard.compress(data[8:8 + int.from_bytes(data[4:8], "little")])
    assert list(warc.archive_records(warc.DICTIONARY_MAGIC + len(packed).to_bytes(4, "little") + packed + bare)) == found


def test_damaged_records_cost_only_themselves(tmp_path):
    data, records = archive_of(tmp_path, many_pages())
    starts, place = [], 0
    while place < len(data):
        starts.append(place)
        place = warc.frame_end(memoryview(data), place)
    broken = bytearray(data)
    broken[(starts[10] + starts[11]) // 2] ^= 255
    found = list(warc.archive_records(bytes(broken)))
    assert len(found) == records and [k for k, record in enumerate(found) if record["problem"]] == [9]
    cut = list(warc.archive_records(data[:starts[21] - 5]))
    assert len(cut) == 20 and "cut off" in cut[-1]["problem"]
    assert "no frame" in list(warc.archive_records(data + b"rest of something"))[-1]["problem"]


@pytest.mark.parametrize("change, problem", [
    (lambda record: record.replace(b"WARC/1.1", b"WARC/9.9"), "no WARC header"),
    (lambda record: record.replace(b"WARC-Date", b"WARC-Data"), "warc-date is missing"),
    (lambda record: record + b"x", "in place of"),
    (lambda record: record.replace(b"a page", b"a pagf"), "another digest"),
    (lambda record: record.replace(b"a page", b"a pag"), "in place of"),
    (lambda record: record.replace(b"sha1:", b"md5:"), "no SHA-1"),
    (lambda record: record.replace(b"HTTP/1.1", b"HTTQ/1.1"), "no HTTP header"),
    (lambda record: record.replace(b"WARC-Type: response", b"WARC-Type: revisit"), "revisit with a payload"),
])
def test_records_are_validated(change, problem):
    record = warc.page_record(1, "http://a", b"a page", None, warc.DATE)
    assert warc.parsed_record(record)["payload"] == b"a page"
    with pytest.raises(ValueError, match=problem):
        warc.parsed_record(change(record))


def test_lost_archives_and_revisits_are_errors(spark, tmp_path):
    path = written(spark, tmp_path, spark.createDataFrame(PAGE_ROWS, PAGES).repartition(2))
    files = sorted((tmp_path / "warc" / "archives").glob("*.zst"))
    # A file that is in no manifest, as a repeated task leaves one.
    (files[0].parent / "left-over.warc.zst").write_bytes(files[0].read_bytes())
    assert warc.read_archives(spark, path).filter("record_type <> 'warcinfo'").count() == len(PAGE_ROWS)
    files[0].rename(tmp_path / "gone")
    assert [row["problem"] for row in warc.read_archives(spark, path).filter("problem IS NOT NULL").collect()] == ["archive is missing"]
    with pytest.raises(Exception, match="archive is missing"):
        warc.page_records(warc.read_archives(spark, path)).collect()
    records = warc.read_archives(spark, path).filter("problem IS NULL AND (record_type = 'revisit' OR payload_bytes < 1000)")
    if records.filter("record_type = 'revisit'").count():
        with pytest.raises(Exception, match="no such response"):
            warc.page_records(records).collect()


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(documents, items, top):
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in documents if plain_terms(text)]
    number, length = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(term for _, c in counted for term in c)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in counted:
            mean = 75 + 25 * sum(counts.values()) * number // length
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * holding[t] + 1)))
                        * (10**9 * counts[t] // (1000 * counts[t] + 12 * mean)) for t in plain_terms(text) if t in counts)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:top], 1)]
    return sorted(found, key=str)


def search_case(seed):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "été", "Été", "x1", "naïve", "日本", "of", "the", "a_b", "ﬁn"] + [f"w{n}" for n in range(40)]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" ", "\n", "-", "_", "\x7f", "  "]) for _ in range(k))
    documents = [(n, text(rng.randint(1, 60))) for n in range(120)]
    documents += [(200 + n, documents[3][1]) for n in range(30)] + [(None, documents[3][1]), (300, None), (301, ""), (302, "-- _"), (5, documents[5][1])]
    shared = text(8)
    items = [(n, shared + text(rng.randint(1, 10))) for n in range(12)]
    items += [(20, None), (21, ""), (22, items[0][1]), (0, items[1][1]), (23, "nowhere"), (None, "alpha"), (24, "the the the of")]
    return documents, items


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_against_plain_version(spark, seed, monkeypatch):
    documents, items = search_case(seed)
    if seed == 2:  # several blocks, and few documents at a time
        monkeypatch.setattr(lexical, "BLOCK_ITEMS", 5)
        monkeypatch.setattr(lexical, "CELLS_AT_ONCE", 4000)
    frame = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "1 AS n", "'other' AS terms").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS rank", "'other' AS item_key")
    for top in (3, 20):
        found = lexical.ranked_documents(frame, asked, top)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, found.collect()), key=str) == plain_ranks(documents, items, top)


def test_ranks_of_empty_tables_and_odd_texts(spark, edges, empty):
    items = spark.createDataFrame([(1, "same row one x"), (2, None)], "item_id long, text string")
    assert lexical.ranked_documents(empty, items).count() == 0
    assert lexical.ranked_documents(edges, items.limit(0)).count() == 0
    rows = [(row["doc_id"], row["text"]) for row in edges.select("doc_id", "text").collect()]
    asked = [(1, "same row one x"), (2, None)]
    assert sorted(map(tuple, lexical.ranked_documents(edges, items).collect()), key=str) == plain_ranks(rows, asked, 20)


def test_a_plan_shares_what_items_share():
    shared = "one two three four five six seven eight"
    items = [(n, f"{shared} own{n} other{n} two".encode()) for n in range(20)]
    plan = lexical.sharing_plan(items)
    alone = sum(len(lexical.terms(text)) - 1 for _, text in items)
    assert plan.additions < alone / 4
    rng = random.Random(3)
    values = [[rng.randint(0, 10**12) for _ in range(7)] for _ in plan.vocabulary]
    import numpy as np
    scores = lexical.evaluate(plan, np.array(values, np.int64))
    for (key, text), row in zip(items, scores, strict=True):
        assert list(row) == [sum(values[plan.vocabulary[t]][d] for t in lexical.terms(text)) for d in range(7)]


# Spelling variants


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            checksum = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            gap = checksum % len(run)
            counts[run[:gap] + run[gap + 1:] if checksum % 97 == 0 else run] += 1
    words = {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}
    near = {word: {other for other in words if one_edit(word, other)} for word in words}
    forms = {}
    for word, n in words.items():
        best = min(near[word], key=lambda other: (-words[other], other), default=None)
        forms[word] = best if best is not None and words[best] >= 2 * n else None

    def root(word):
        return word if forms[word] is None else root(forms[word])

    return sorted((word, forms[word], root(word), n, len(near[word]), words.get(forms[word])) for word, n in words.items())


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variant_rows(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcé", k=rng.randint(4, 7))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "x" * 70, "x" * 71, "y" * 63, "y" * 64, "y" * 65, "ab" * 40, "ab" * 39 + "aa"]
    words = stems + [w[:k] + rng.choice("abcéÿ") + w[k + rng.randint(0, 1):] for w in stems for k in (0, len(w) // 2, len(w))]
    rows = []
    for n in range(150):
        picked = [rng.choice(words) if rng.random() < 0.7 else rng.choice(words[:8]) for _ in range(60)]
        rows.append((n, " ".join(w.upper() if rng.random() < 0.1 else w for w in picked) + ", ×÷ Ω日本words1words"))
    return rows + [rows[0], (None, rows[1][1]), (700, None), (701, ""), (702, "Éµa Straße straße STRASSE")]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_against_plain_version(spark, seed):
    rows = variant_rows(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'other' AS word", "1 AS n", "2 AS id").repartition(4)
    found = spelling.spelling_variants(frame)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    result = sorted((tuple(row) for row in found.collect()), key=lambda row: row[0])
    assert result == plain_variants(rows)
    assert any(row[1] and row[2] != row[1] for row in result) or seed != 1


def test_variants_of_empty_tables_and_odd_texts(spark, edges, empty):
    assert spelling.spelling_variants(empty).count() == 0
    rows = [(row["doc_id"], row["text"]) for row in edges.select("doc_id", "text").collect()]
    assert sorted(map(tuple, spelling.spelling_variants(edges).collect())) == plain_variants(rows)
    with pytest.raises(ValueError):
        spelling.spelling_variants(edges, ratio=1)


def test_very_long_words_are_compared(spark):
    long = "abcde" * 4000
    rows = [(n, f"{long} {long} {long} {long[:-1]} {long[:7000]}z{long[7001:]}") for n in range(6)]
    found = {(len(row["word"]), row["n_near"]) for row in spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(20_000, 2), (19_999, 1), (20_000, 1)}


@pytest.mark.parametrize("word", ["abcde", "aabbb", "y" * 70, "abc" * 30])
def test_rotations_of_a_long_word_are_those_of_a_short_one(word):
    keys = spelling.long_rotations(word)
    size = len(word)
    plain = [word[i:] + "$" + word[:i] for i in range(size + 1)] + [word[i + 1:] + "$" + word[:i] for i in range(size)]
    for (key, _, _), text in zip(keys, plain, strict=True):
        assert key == text if len(text) <= spelling.PLAIN_KEY else key.startswith("#")
    assert len({key for key, _, _ in keys}) == len(set(plain))
