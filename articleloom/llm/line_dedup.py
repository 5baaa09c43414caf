"""Near-duplicate lines over the whole corpus: exact set-similarity join, later matches removed.

A line is the set of its distinct words. Words are ordered by rarity, rarest first, and a line is indexed by the first
few of them only: lines of similarity t share a word within their first n - ceil(t n) + 1 (prefix filter). Pairs in a bucket
are kept if their sizes allow the similarity (length filter), if enough words follow the shared one (positional filter)
and if the parities of their words in 128 bits differ in no more places than the sets may differ in words. What is left
is verified on the whole sets.

Rarity is the count over the whole corpus of a word's bucket among ``RARITY`` buckets, a table of bounded size. Any order
that all lines share makes the prefix filter exact; the counts only make it sharp.

Lines with equal sets are one set, first seen where its first line stands. A bucket is sorted by size and joined in the task that
holds it, each set with those up to a quarter larger, unless so many of the pairs would pass the filters that it must hold near copies,
or the sets of like size are too many. In such a large bucket a set is first compared with the likeliest of a few others, then
with the bucket's earliest line; those which that does not remove are joined by Spark, which splits hot buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleloom.llm.ngram_join import MOST_SENT, batches_of, mixed
from articleloom.sources.scratch import stored

# Similarity as a fraction, and the distinct words from which a line takes part unless the caller says otherwise: every line that has one.
SIMILAR = (80, 100)
LEAST_WORDS = 1

RARITY_BITS = 17
RARITY = 1 << RARITY_BITS

# Bytes of text for each part of the index, text that a task works on at once, and entries it gathers.
PART_BYTES = 8 << 20
AT_ONCE = 2_000_000
GATHERED = 2_000_000
# Pairs a set that pass the filters, as its nearest NEAR neighbours by size tell, and sets of like size, beyond which a bucket is large;
# pairs a set that its task still makes of a large one.
LARGE_BUCKET = 16
NEAR = 32
MOST_ALIKE = 8192
LIKELIEST = 4
# Pairs that a task compares at once.
COMPARED = 2_000_000
# Counts of words that travel as one row.
COUNTED = 2048
BATCH_ROWS = 2000
# Sizes from which an entry only says that a line is so long.
LARGEST = 60_000
# Bytes of a word up to which it is hashed by tables, a random number for each byte at each place.
SHORT = 64

_ONE = np.uint64(1)
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_TABLE = np.random.default_rng(10).integers(0, 2**64, (SHORT, 256), dtype=np.uint64)
_TABLE[:, ord("A"):ord("Z") + 1] = _TABLE[:, ord("a"):ord("z") + 1]


def least_overlap(n, m):
    """Common words that two similar lines of n and m words have at least."""
    low, high = SIMILAR
    return (low * (n + m) + low + high - 1) // (low + high)


def prefix_length(n):
    """Rarest words of a line of n that are indexed."""
    low, high = SIMILAR
    return n - (low * n + high - 1) // high + 1


def coded(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a text, A-Z lowered, and where each begins."""
    raw = np.frombuffer(data, np.uint8)
    word = ~_SPACE[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    begins = np.flatnonzero(first[word])
    chars = raw[word]
    lengths = np.diff(np.append(begins, len(chars)))
    place = np.minimum(np.arange(len(chars)) - np.repeat(begins, lengths), SHORT - 1)
    codes = np.add.reduceat(_TABLE.ravel()[(place << 8) | chars], begins)
    for k in np.flatnonzero(lengths > SHORT).tolist():
        codes[k] = xxhash.xxh3_64_intdigest(data[starts[k]:starts[k] + lengths[k]].lower())
    return codes, starts


def rarity(documents: DataFrame) -> tuple[np.ndarray, int]:
    """The place of each bucket of words when they are ordered by how often their words occur, and the bytes of all texts."""

    def count(batches):
        counts, texts, gathered, size = np.zeros(RARITY, np.int64), [], 0, 0
        for frame in batches:
            for text in frame.column(0):
                if text.is_valid:
                    texts.append(text.as_py().encode())
                    gathered += len(texts[-1])
                    if gathered > AT_ONCE:
                        counts += _buckets(b"\n".join(texts))
                        size += gathered
                        texts, gathered = [], 0
        counts += _buckets(b"\n".join(texts))
        yield blobs({-1: np.array([size + gathered]), **dict(enumerate(counts.reshape(-1, COUNTED)))})

    def total(batches):
        totals = {}
        for frame in batches:
            for chunk, counts in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                totals[chunk] = totals.get(chunk, 0) + np.frombuffer(counts, np.int64)
        yield blobs(totals)

    def blobs(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int32()), pa.array([found.tobytes() for found in counts.values()], pa.binary())], ["chunk", "counts"])

    kind, chunks = "chunk int, counts binary", RARITY // COUNTED
    counted = documents.select("text").mapInArrow(count, kind).repartition(chunks, "chunk").mapInArrow(total, kind)
    totals = {row["chunk"]: np.frombuffer(row["counts"], np.int64) for row in counted.collect()}  # RARITY counts
    if not totals:
        return np.arange(RARITY, dtype=np.uint64), 0
    counts = np.concatenate([totals[chunk] for chunk in range(chunks)])
    places = np.empty(RARITY, np.uint64)
    places[np.argsort(counts, kind="stable")] = np.arange(RARITY, dtype=np.uint64)
    return places, int(totals[-1][0])


def _buckets(data: bytes) -> np.ndarray:
    codes, _ = coded(data)
    return np.bincount((codes & np.uint64(RARITY - 1)).astype(np.int64), minlength=RARITY)


class Lines:
    """The lines of some texts that take part, as flat arrays: words by line, rarest first."""

    def __init__(self, texts: list[str], places: np.ndarray, least: int):
        data = "\n".join(texts).encode()
        self.line_counts = [text.count("\n") + 1 for text in texts]
        firsts = np.concatenate([[0], np.cumsum(self.line_counts)]).astype(np.int64)
        codes, starts = coded(data)
        line = np.searchsorted(np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n")), starts)
        place = places[(codes & np.uint64(RARITY - 1)).astype(np.int64)]
        codes = (place << np.uint64(64 - RARITY_BITS)) | (codes >> np.uint64(RARITY_BITS))
        order = np.argsort(codes)
        few = np.uint16 if firsts[-1] <= 1 << 16 else np.int64
        order = order[np.argsort(line[order].astype(few), kind="stable")]
        codes, line = codes[order], line[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (line[1:] != line[:-1])
        codes, line = codes[new], line[new]
        sizes = np.bincount(line, minlength=firsts[-1])
        kept = sizes >= max(least, 1)
        on = kept[line]
        self.words, self.sizes = codes[on], sizes[kept]
        numbers = np.flatnonzero(kept)
        self.owners = np.searchsorted(firsts, numbers, side="right") - 1
        self.numbers = numbers - firsts[self.owners]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        if len(self.sizes):
            spread = mixed(self.words)
            at = self.starts[:-1]
            sums = np.add.reduceat(spread, at) + self.sizes.astype(np.uint64)
            self.ids = mixed(sums).view(np.int64)
            bit, half = _ONE << (spread >> np.uint64(58)), (spread >> np.uint64(57)) & _ONE
            self.parity, self.other = np.bitwise_xor.reduceat(bit * half, at), np.bitwise_xor.reduceat(bit * (half ^ _ONE), at)
            self.spread = spread
        else:
            self.ids = np.empty(0, np.int64)
            self.parity = self.other = self.spread = np.empty(0, np.uint64)


GATHER = "part int, keys binary, doc_id bigint, text_hash bigint, lines int, numbers binary, sets binary"
MET = ("kind int, a bigint, b bigint, key bigint, place int, size int, parity bigint, other bigint, differ int, "
       "doc_id bigint, text_hash bigint, lines int, numbers array<int>, sets array<bigint>")

# An entry of the index: a set and one of its rarest words.
ENTRY = np.dtype([("id", np.int64), ("key", np.uint32), ("parity", np.uint64), ("other", np.uint64), ("size", np.uint16), ("place", np.uint8)])


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(),
             "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _gather(documents: DataFrame, places: np.ndarray, parts: int, least: int) -> DataFrame:
    """Index blobs for each part, and a row for each document with the numbers and sets of its lines that take part."""
    shared = documents.sparkSession.sparkContext.broadcast(places)
    schema = _schema(GATHER)

    def gather(batches):
        places, seen, entries = shared.value, set(), []
        spread = TaskContext.get().partitionId()

        def blobs():
            if not entries:
                return
            index = np.concatenate([found for found, _ in entries])
            part = np.concatenate([found for _, found in entries])
            entries.clear()
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            for k in range(parts):
                if edges[k] < edges[k + 1]:
                    yield _batch(schema, 1, part=[k], keys=[index[order[edges[k]:edges[k + 1]]].tobytes()])

        def work(ids, texts, hashes):
            nonlocal spread
            lines = Lines(texts, places, least)
            n = len(texts)
            edges = np.searchsorted(lines.owners, np.arange(n + 1)).tolist()
            cuts = list(zip(edges, edges[1:], strict=False))
            # Documents are dealt out over the parts evenly, whichever sets they hold.
            yield _batch(schema, n, part=(np.arange(spread, spread + n) % parts).astype(np.int32), doc_id=ids, text_hash=hashes,
                         lines=lines.line_counts, numbers=[lines.numbers[a:b].astype(np.int32).tobytes() for a, b in cuts],
                         sets=[lines.ids[a:b].tobytes() for a, b in cuts])
            spread += n
            # A task indexes each distinct set once.
            _, firsts = np.unique(lines.ids, return_index=True)
            fresh = [k for k, identity in zip(firsts.tolist(), lines.ids[firsts].tolist(), strict=True) if identity not in seen]
            seen.update(lines.ids[fresh].tolist())
            if not fresh:
                return
            fresh = np.array(fresh)
            counts = prefix_length(lines.sizes[fresh])
            ends = np.cumsum(counts)
            place = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
            key = mixed(lines.spread[np.repeat(lines.starts[fresh], counts) + place])
            found = np.empty(len(key), ENTRY)
            found["id"], found["key"] = np.repeat(lines.ids[fresh], counts), key.astype(np.uint32)
            found["parity"], found["other"] = np.repeat(lines.parity[fresh], counts), np.repeat(lines.other[fresh], counts)
            # Of longer lines and later places the filters only know that they are at least so large.
            found["size"], found["place"] = np.minimum(np.repeat(lines.sizes[fresh], counts), LARGEST), np.minimum(place, 255)
            entries.append((found, ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)))

        size, group = 0, ([], [], [])
        for frame in batches:
            for doc_id, text, text_hash in zip(*(frame.column(i) for i in range(3)), strict=True):
                for values, value in zip(group, (doc_id.as_py(), text.as_py() or "", text_hash.as_py()), strict=True):
                    values.append(value)
                size += len(group[1][-1])
                if size > AT_ONCE:
                    yield from work(*group)
                    size, group = 0, ([], [], [])
                    if sum(len(found) for found, _ in entries) > GATHERED:
                        yield from blobs()
        if group[0]:
            yield from work(*group)
        yield from blobs()

    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(gather, GATHER)


def passes(size_a, size_b, place_a, place_b, differ):
    """Length, positional and parity filter for two lines that share a word at these places."""
    low, high = SIMILAR
    overlap = least_overlap(size_a, size_b)
    short, long_ = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    return (long_ >= LARGEST) | (
        (high * short >= low * long_) & (np.minimum(size_a - place_a, size_b - place_b) >= overlap)
        & (differ <= size_a + size_b - 2 * overlap))


def compared(entries: np.ndarray, lengths: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of entries that pass the filters with one of the ``lengths`` next entries, those first skipped, and in how many bits they differ."""
    size, place = entries["size"].astype(np.int64), entries["place"].astype(np.int64)
    parity, other = entries["parity"].copy(), entries["other"].copy()
    found, ends, at = [], np.cumsum(lengths), 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARED, side="right")))
        n = lengths[at:to]
        here = np.repeat(np.arange(at, to), n)
        there = here + 1 + skip + np.arange(len(here)) - np.repeat(np.cumsum(n) - n, n)
        differ = np.bitwise_count(parity[here] ^ parity[there]).astype(np.int64) + np.bitwise_count(other[here] ^ other[there])
        good = passes(size[here], size[there], place[here], place[there], differ)
        found.append((here[good], there[good], differ[good]))
        at = to
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def candidates(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of entries, sorted by key and size, that share a key and pass the filters; last, which entries are in large buckets.

    Of a large bucket there are only the likeliest pairs with sets next by size.
    """
    key, size = entries["key"].astype(np.int64), entries["size"].astype(np.int64)
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    counts = np.diff(np.append(starts, len(key)))
    bucket = np.repeat(np.arange(len(starts)), counts)
    reach = np.minimum(size * SIMILAR[1] // SIMILAR[0], LARGEST)
    alike = np.searchsorted((key << 16) | size, (key << 16) | reach, side="right") - np.arange(len(key)) - 1
    near = np.minimum(alike, NEAR)
    here, there, differ = compared(entries, near, 0)
    passed = np.bincount(bucket[here], minlength=len(starts))
    expected = passed * np.add.reduceat(alike, starts) / np.maximum(np.add.reduceat(near, starts), 1)
    large = ((expected > LARGE_BUCKET * counts) | (np.maximum.reduceat(alike, starts) > MOST_ALIKE))[bucket]

    order = np.lexsort((differ, here))
    here, there, differ = here[order], there[order], differ[order]
    rank = np.arange(len(here)) - np.searchsorted(here, here)
    kept = ~large[here] | (rank < LIKELIEST)
    rest = compared(entries, np.where(large, 0, alike - near), NEAR)
    return *(np.concatenate([column[kept], more]) for column, more in zip((here, there, differ), rest, strict=True)), large


def _meet(gathered: DataFrame, parts: int) -> DataFrame:
    """Kind 0: the documents; kind 1: pairs that pass the filters; kind 2: members of large buckets, whose pairs are not all there."""
    schema = _schema(MET)

    def meet(batches):
        blobs: dict[int, list] = {}
        for frame in batches:
            for row in frame.filter(frame.column("keys").is_valid()).select(["part", "keys"]).to_pylist():
                blobs.setdefault(row["part"], []).append(row["keys"])
            rest = frame.filter(frame.column("keys").is_null())
            n = rest.num_rows
            if n:
                arrays = {name: [np.frombuffer(row.as_py(), kind) for row in rest.column(name)]
                          for name, kind in (("numbers", np.int32), ("sets", np.int64))}
                yield _batch(schema, n, kind=np.zeros(n, np.int32), **arrays,
                             **{name: rest.column(name) for name in ("doc_id", "text_hash", "lines")})
        for part, found in blobs.items():
            entries = np.concatenate([np.frombuffer(blob, ENTRY) for blob in found])
            found.clear()
            # The same set comes from several tasks.
            entries = entries[np.lexsort((entries["id"], (entries["key"].astype(np.int64) << 16) | entries["size"]))]
            new = np.ones(len(entries), bool)
            new[1:] = (entries["id"][1:] != entries["id"][:-1]) | (entries["key"][1:] != entries["key"][:-1])
            entries = entries[new]
            ids = entries["id"]
            here, there, differ, large = candidates(entries)
            for at in range(0, len(here), 100_000):
                a, b = ids[here[at:at + 100_000]], ids[there[at:at + 100_000]]
                yield _batch(schema, n := len(a), kind=np.ones(n, np.int32), a=np.minimum(a, b), b=np.maximum(a, b),
                             differ=differ[at:at + n].astype(np.int32))
            if large.any():
                members = entries[large]
                yield _batch(schema, n := len(members), kind=np.full(n, 2, np.int32), a=members["id"],
                             key=(np.int64(part) << np.int64(32)) + members["key"].astype(np.int64), place=members["place"].astype(np.int32),
                             size=members["size"].astype(np.int32), parity=members["parity"].astype(np.int64),
                             other=members["other"].astype(np.int64))

    return gathered.repartition(parts, "part").mapInArrow(meet, MET)


def _contents(documents: DataFrame, places: np.ndarray, involved: DataFrame) -> DataFrame:
    """``set_id, words binary`` of sets (``set_id, first``), each from its first line."""
    shared = documents.sparkSession.sparkContext.broadcast(places)
    wanted = stored(
        involved.groupBy(F.col("first.text_hash").alias("text_hash")).agg(F.sort_array(F.collect_set("first.line")).alias("numbers")),
        "wanted_lines")

    def make(batches):
        seen = set()
        for frame in batches:
            for start in range(0, frame.num_rows, 200):
                part = frame.slice(start, 200)
                texts, numbers = (part.column(i).to_pylist() for i in (0, 1))
                # Of texts that are stored often a task reads one.
                new = [k for k, found in enumerate(part.column(2).to_pylist()) if not (found in seen or seen.add(found))]
                split = [(texts[k] or "").split("\n") for k in new]
                lines = Lines(["\n".join(map(text.__getitem__, numbers[k])) for k, text in zip(new, split, strict=True)], shared.value, 1)
                words = [lines.words[a:b].tobytes() for a, b in zip(lines.starts, lines.starts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(lines.ids, pa.int64()), pa.array(words, pa.binary())], ["set_id", "words"])

    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    texts = documents.withColumn("text_hash", F.xxhash64("text")).join(wanted, "text_hash").select("text", "numbers", "text_hash")
    made = texts.mapInArrow(make, "set_id bigint, words binary")
    return made.groupBy("set_id").agg(F.first("words").alias("words"))


@F.arrow_udf(T.BooleanType())
def _similar(a: pa.Array, b: pa.Array) -> pa.Array:
    low, high = SIMILAR
    found = []
    for first, second in zip(a, b, strict=True):
        x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (first, second))
        common = len(np.intersect1d(x, y, assume_unique=True))
        found.append(high * common >= low * (len(x) + len(y) - common))
    return pa.array(found, pa.bool_())


def _oriented(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Pairs (a, b, differ) as (``early, late, differ``) by their first lines."""
    a = firsts.select(F.col("set_id").alias("a"), F.col("first").alias("of_a"))
    b = firsts.select(F.col("set_id").alias("b"), F.col("first").alias("of_b"))
    ordered = pairs.join(a, "a").join(b, "b").withColumn("straight", F.col("of_a") < F.col("of_b"))
    return ordered.select(
        F.when(F.col("straight"), F.col("a")).otherwise(F.col("b")).alias("early"),
        F.when(F.col("straight"), F.col("b")).otherwise(F.col("a")).alias("late"), "differ")


def _similar_late(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """``set_id`` of the late sets that are similar to their early one, by comparing the whole sets."""
    early = contents.select(F.col("set_id").alias("early"), F.col("words").alias("of_early"))
    late = contents.select(F.col("set_id").alias("late"), F.col("words").alias("of_late"))
    return pairs.join(early, "early").join(late, "late").where(_similar("of_early", "of_late")).select(
        F.col("late").alias("set_id")).distinct()


def _gone(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """``set_id`` of every set that is similar to an early one of its pairs (``early, late, differ``).

    Each set is compared with its likeliest partner first, and only those that this does not settle with all others.
    """
    likeliest = pairs.groupBy("late").agg(F.min(F.struct("differ", "early")).alias("best"))
    first = stored(likeliest.select(F.col("best.early").alias("early"), "late"), "likeliest")
    gone = stored(_similar_late(first, contents), "gone")
    others = pairs.select("early", "late").join(gone, F.col("late") == F.col("set_id"), "left_anti").join(first, ["early", "late"], "left_anti")
    return stored(gone.union(_similar_late(others.distinct(), contents)), "gone")


def line_verdicts(documents: DataFrame, least: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Two tables: the lines that are removed (``doc_id, text_hash, line``), and the documents (``doc_id, text_hash, lines``).

    Lines are parted by line feeds and counted from 0. A line of ``least`` distinct words or more is removed if an earlier such
    line is similar to it, that is if their sets of words reach 0.8, whether or not the earlier one stays. Lines are ordered by id of the
    document, then hash of its text, then their place; null ids come last. Shorter lines always stay; by default every line
    that has a word takes part. Rows that repeat both id and text
    are one document. Null texts have one empty line. Other columns are not read.
    """
    with batches_of(documents.sparkSession, BATCH_ROWS):
        return _line_verdicts(documents.select("doc_id", "text"), max(least, 1))


def _line_verdicts(documents: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places, size = rarity(documents)
    parts = max(2 * partitions, size // PART_BYTES + 1)
    met = stored(_meet(_gather(documents, places, parts, least), parts), "lines")
    rows = met.where("kind = 0").select("doc_id", "text_hash", "lines", "numbers", "sets")
    lines = rows.select("doc_id", "text_hash", F.explode(F.arrays_zip("numbers", "sets")).alias("at")).select(
        "doc_id", "text_hash", F.col("at.numbers").alias("line"), F.col("at.sets").alias("set_id"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "line").alias("place")
    sets = stored(lines.groupBy("set_id").agg(F.min(place).alias("first")), "line_sets")

    small = met.where("kind = 1").groupBy("a", "b").agg(F.min("differ").alias("differ"))
    small = stored(small, "line_pairs")
    members = met.where("kind = 2").select(F.col("a").alias("set_id"), "key", "place", "size", "parity", "other")
    involved = small.select(F.col("a").alias("set_id")).union(small.select("b")).union(members.select("set_id")).distinct()
    firsts = stored(sets.join(involved, "set_id"), "firsts")
    contents = stored(_contents(documents, places, firsts), "contents")
    gone = _gone(stored(_oriented(small, firsts), "ordered_pairs"), contents)

    # In large buckets the earliest line is compared with all others, then what that leaves with all earlier ones.
    if members.limit(1).count():
        members = stored(members.join(firsts, "set_id"), "large")
        earliest = members.groupBy("key").agg(F.min(F.struct("first", "set_id", "place", "size", "parity", "other")).alias("pivot"))
        overlap = F.expr(f"({SIMILAR[0]} * (a.size + b.size) + {sum(SIMILAR) - 1}) div {sum(SIMILAR)}")
        differ = F.expr("bit_count(a.parity ^ b.parity) + bit_count(a.other ^ b.other)")
        good = F.expr(f"greatest(a.size, b.size) >= {LARGEST}") | (
            F.expr(f"{SIMILAR[1]} * least(a.size, b.size) >= {SIMILAR[0]} * greatest(a.size, b.size)")
            & (F.least(F.expr("a.size - a.place"), F.expr("b.size - b.place")) >= overlap)
            & (differ <= F.expr("a.size + b.size") - 2 * overlap))
        found = [F.col("a.set_id").alias("early"), F.col("b.set_id").alias("late"), differ.alias("differ")]
        still = members.join(gone, "set_id", "left_anti")
        star = still.alias("b").join(earliest.select("key", "pivot.*").alias("a"), "key").where(
            good & F.expr("a.set_id <> b.set_id")).select(*found).distinct()
        gone = stored(gone.union(_gone(stored(star, "star_pairs"), contents)), "gone")
        still = members.join(gone, "set_id", "left_anti")
        every = still.alias("b").join(members.alias("a"), "key").where(good & (F.col("a.first") < F.col("b.first"))).select(*found).distinct()
        gone = stored(gone.union(_gone(stored(every, "large_pairs"), contents)), "gone")

    marked = stored(
        sets.join(gone.distinct().withColumn("gone", F.lit(True)), "set_id", "left").select(
            "set_id", "first", F.coalesce("gone", F.lit(False)).alias("gone")), "marked_sets")
    removed = lines.join(marked, "set_id").where(F.col("gone") | (place != F.col("first"))).select("doc_id", "text_hash", "line")
    return removed.distinct(), rows.select("doc_id", "text_hash", "lines")


def removed_lines(documents: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, text_hash, lines, removed array<int>`` of every document; see ``line_verdicts``."""
    removed, rows = line_verdicts(documents, least)
    by_document = stored(removed.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("line")).alias("removed")), "removed")
    by_document = by_document.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), "removed")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & F.col("text_hash").eqNullSafe(F.col("hash"))
    return rows.join(by_document, same, "left").select(
        "doc_id", "text_hash", "lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_lines(documents: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``documents`` without the removed lines; ``n_chars`` follows the text if there is such a column.

    A document stays if it had no line removed or has a line with a word left.
    """
    removed, _ = line_verdicts(documents, least)
    by_document = stored(removed.groupBy("doc_id", "text_hash").agg(F.collect_list("line").alias("removed")), "removed")
    by_document = by_document.select(F.col("doc_id").alias("__of"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__removed"))
    same = F.col("doc_id").eqNullSafe(F.col("__of")) & F.xxhash64("text").eqNullSafe(F.col("__hash"))
    joined = documents.join(by_document, same, "left")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("__removed", i)), "\n")
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(kept)
    joined = joined.withColumn("text", text).where(F.col("__removed").isNull() | F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    if "n_chars" in documents.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return joined.select(*documents.columns)
