"""Exact self-join of documents by the Jaccard similarity of their word shingles, and the components of its links.

Method: universe partition and pigeonhole. Two sets of sizes r and s that reach similarity t differ in at most
(1 - t) / (1 + t) * (r + s) elements. Sets fall in bands by size; for each band a set may share with a partner, the space of
shingle hashes is cut into m segments, m being more than the largest difference H in that band. Two similar sets agree
in at least m - H segments, so each set is indexed by the subsets it has in the segments.

Which segments are spent on which set follows their cost:

* Empty segments are never indexed. A set with N segments that are not empty meets every partner in N - H of them or more;
  sets for which that leaves none also index the one-deletion neighbourhoods of their segments (a budget of two
  differences in place of one), and in the last resort single shingles.
* A set that is in fewer shared buckets than it meets every partner in has no partner, and leaves all its buckets; this
  is done again as buckets empty. Most sets that share only a passage go here.
* What a set still has to look into is all its buckets but need - 1, and it skips the fullest ones.

Every pair that is left and whose sets' parities in 512 bits differ in no more places than similar sets may in shingles is verified
on its whole sets. First, for some turns, each bucket's components are compared
with one pivot only, and buckets that hold one component are closed: a group of thousands of near copies costs a
comparison a copy, not one a pair. Pairs inside one component are not looked for, all others are.

Signatures travel from task to task as arrays, a blob for each part of the signature space; sets are kept nowhere, those
of the few documents to be compared are made again from their texts.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleloom.sources.scratch import stored

SHINGLE = 5
# Similarity as a fraction: links need SIMILAR[1] * intersection >= SIMILAR[0] * union.
SIMILAR = (75, 100)

# Bytes of text for each part of the signature space. A set is named once in each part it has signatures in, so that parts are few; they are
# sorted in one task, a slice at a time.
PART_BYTES = 16 << 20
SLICES = 4
# Signatures a task gathers before it sends them on.
GATHERED = 1_500_000
# Rows of a batch of texts or sets that a task holds.
BATCH_ROWS = 400
# Pairs whose larger set is in a band up to this size are found by single shingles.
FINE_BAND = 512
# Turns in which buckets are compared with a pivot before all pairs that are left.
STAR_TURNS = 2
# Ids of sets to be read again that are sent to all tasks; beyond it the texts are joined.
MOST_SENT = 2_000_000

# Parities of a set: of its shingles in each of 512 classes, as numbers of 64 bits.
PARITIES = [f"p{k}" for k in range(8)]

_FACTORS = np.random.default_rng(9).integers(1, 2**62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SINGLES = 1 << 20
_ODD = np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text: words split at ASCII white space, A-Z lowered."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, SHINGLE)
    rows = n - width + 1
    total = np.full(rows, width, np.uint64)
    for k in range(width):
        total = mixed(total + codes[k:k + rows] * _FACTORS[k])
    return np.unique(total)


def _tag(number: int) -> np.uint64:
    return np.uint64(number * int(_FACTORS[4]) % 2**64)


def set_id(elements: np.ndarray) -> int:
    """A 64-bit hash of a whole set, as a signed number."""
    if not len(elements):
        return 0
    folded = mixed(np.array([mixed(elements + _FACTORS[0]).sum(), np.uint64(len(elements))], np.uint64))
    return int(mixed(folded[:1] ^ (folded[1:] * _FACTORS[1])).view(np.int64)[0])


def parities(elements: np.ndarray) -> list[int]:
    """Whether a set has an odd number of elements in each of 512 classes: two sets' differ in as many places as the sets in elements, at most."""
    classes = (mixed(elements + _FACTORS[1]) >> np.uint64(55)).astype(np.int64)
    return np.packbits(np.bincount(classes, minlength=512) % 2 == 1).view(np.int64).tolist()


def most_difference(r: int, s: int) -> int:
    """The largest symmetric difference of similar sets of these sizes."""
    low, high = SIMILAR
    return (high - low) * (r + s) // (high + low)


def band_top(size: int) -> int:
    """The largest size in the band of a size: sizes up to 8 are bands of their own, above them bands double."""
    return size if size <= 8 else 1 << (size - 1).bit_length()


def bands(size: int) -> list[int]:
    """Bands, by their largest size, of the larger set in a pair with a set of this size."""
    low, high = SIMILAR
    largest, found = size * high // low, [band_top(size)]
    while (following := band_top(found[-1] + 1)) and found[-1] < largest:
        found.append(following)
    return found


def segment_count(top: int) -> int:
    """Segments for a band: more than the largest difference, with some to spare for empty and skipped ones."""
    return most_difference(top, top) + 2 + int(0.04 * top + 0.5 * top**0.5)


def least_shared(n: int) -> int:
    """Elements that a set of n shares with a similar one at least, whatever its size."""
    return -(-SIMILAR[0] * n // SIMILAR[1])


def signatures(elements: np.ndarray) -> tuple[np.ndarray, int]:
    """Bucket numbers of a set, and in how many of them it meets every partner at least (0 or less: by neighbourhoods).

    Odd numbers are single shingles, for partners in bands up to ``FINE_BAND``; of these it meets a partner in ``least_shared``. Even ones
    are segments, for the other bands, and if it has such the second result counts them.
    """
    n = len(elements)
    parts, needs = [], []
    hashed = mixed(elements + _FACTORS[2])
    if n <= FINE_BAND:
        parts.append(mixed(hashed + _tag(_SINGLES)) | _ODD)
        needs.append(least_shared(n))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed)])
    largest = n * SIMILAR[1] // SIMILAR[0]
    for top in bands(n):
        if top <= FINE_BAND:
            continue
        count = segment_count(top)
        segment = (elements >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(segment, prepend=np.uint64(count)))
        ends = np.append(starts[1:], n)
        tag = segment[starts] * _FACTORS[3] + _tag(top)
        parts.append(mixed(sums[ends] - sums[starts] + tag) & ~_ODD)
        need = len(starts) - most_difference(n, min(top, largest))
        needs.append(need)
        if need <= 0:
            several = ends - starts >= 2
            each = np.repeat(np.arange(len(starts)), ends - starts)
            each_in = several[each]
            parts.append(mixed((sums[ends] - sums[starts] + tag)[each][each_in] - hashed[each_in]) & ~_ODD)
            if need + several.sum() <= 0:
                parts.append(mixed(hashed + _tag(_SINGLES + top)) & ~_ODD)
    return np.concatenate(parts), min(needs)


GATHER = ("part int, ids binary, counts binary, keys binary, doc_id bigint, set_id bigint, n_shingles bigint, "
          "need int, text_hash bigint, " + ", ".join(f"{name} bigint" for name in PARITIES))


class _Gathered:
    """Signatures of the sets of a task, by part of the signature space."""

    def __init__(self, parts: int):
        self.parts, self.ids, self.keys, self.size = parts, [], [], 0

    def add(self, identity: int, keys: np.ndarray) -> None:
        self.ids.append(identity)
        self.keys.append(keys)
        self.size += len(keys)

    def blobs(self):
        if not self.ids:
            return
        ids = np.array(self.ids, np.int64)
        owner = np.repeat(np.arange(len(ids)), [len(keys) for keys in self.keys])
        keys = np.concatenate(self.keys)
        part = ((keys >> np.uint64(32)) * np.uint64(self.parts) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(self.parts + 1))
        for k in range(self.parts):
            mine = order[edges[k]:edges[k + 1]]
            if len(mine):
                own, counts = np.unique(owner[mine], return_counts=True)
                yield k, ids[own].tobytes(), counts.astype(np.int32).tobytes(), keys[mine].astype(np.uint32).tobytes()
        self.__init__(self.parts)


def _gather(documents: DataFrame, parts: int) -> DataFrame:
    """Rows of two kinds: a blob of signatures for each part, and a row for each document."""
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 9]
    names = [field.split()[0] for field in GATHER.split(", ")]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], schema=schema)

    def gather(batches):
        gathered, seen = _Gathered(parts), set()
        spread = TaskContext.get().partitionId()
        for frame in batches:
            rows = []
            for doc_id, text, text_hash in zip(*(frame.column(i) for i in range(3)), strict=True):
                elements = shingles(text.as_py())
                identity = set_id(elements)
                need = 0
                if len(elements):
                    # A task indexes each distinct set once, however many copies it holds.
                    keys, need = signatures(elements)
                    if identity not in seen:
                        seen.add(identity)
                        gathered.add(identity, keys)
                spread += 1
                rows.append((spread % parts, None, None, None, doc_id.as_py(), identity, len(elements), need, text_hash.as_py(),
                             *parities(elements)))
                if gathered.size >= GATHERED:
                    for blob in gathered.blobs():
                        yield batch([(*blob, *[None] * 13)])
            if rows:
                yield batch(rows)
        for blob in gathered.blobs():
            yield batch([(*blob, *[None] * 13)])

    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(gather, GATHER)


MET = "key bigint, set_id bigint, pivot bigint, doc_id bigint, n_shingles bigint, need int, text_hash bigint, " + ", ".join(
    f"{name} bigint" for name in PARITIES)


def _meet(gathered: DataFrame, parts: int) -> DataFrame:
    """Members of buckets with two sets or more, with the bucket's pivot, and the documents' rows as they were."""
    kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.int64()] * 9
    schema = pa.schema(list(zip([field.split()[0] for field in MET.split(", ")], kinds, strict=True)))

    def meet(batches):
        blobs: dict[int, list] = {}
        for frame in batches:
            for row in frame.filter(frame.column("keys").is_valid()).to_pylist():
                blobs.setdefault(row["part"], []).append((row["ids"], row["counts"], row["keys"]))
            documents = frame.filter(frame.column("keys").is_null())
            if documents.num_rows:
                empty = pa.nulls(documents.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [empty, documents.column("set_id"), empty, *(documents.column(name) for name in (
                        "doc_id", "n_shingles", "need", "text_hash", *PARITIES))], schema=schema)
        for part, found in blobs.items():
            for k in range(SLICES):
                yield from buckets(part, *of_slice(found, k))
            found.clear()

    def of_slice(found, k):
        slices = [(np.frombuffer(c, np.uint32).astype(np.uint64) * np.uint64(SLICES) >> np.uint64(32)) == k for *_, c in found]
        ids = [np.repeat(np.frombuffer(a, np.int64), np.frombuffer(b, np.int32))[mine] for (a, b, _), mine in zip(found, slices, strict=True)]
        keys = [np.frombuffer(c, np.uint32)[mine] for (*_, c), mine in zip(found, slices, strict=True)]
        return np.concatenate(ids), np.concatenate(keys)

    def buckets(part, ids, keys):
        order = np.lexsort((ids, keys))
        ids, keys = ids[order], keys[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
        ids, keys = ids[new], keys[new]
        starts = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
        sizes = np.diff(np.append(starts, len(keys)))
        shared = np.repeat(sizes >= 2, sizes)
        pivots = np.repeat(ids[starts], sizes)[shared]
        numbers = (np.int64(part) << np.int64(32)) + keys[shared].astype(np.int64)
        for at in range(0, len(pivots), 100_000):
            n = len(pivots[at:at + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[at:at + n]), pa.array(ids[shared][at:at + n]), pa.array(pivots[at:at + n]),
                 *(pa.nulls(n, kind) for kind in kinds[3:])], schema=schema)

    return gathered.repartitionById(parts, "part").mapInArrow(meet, MET)


def _contents(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set_id, elements binary`` of the sets whose texts have one of the wanted hashes."""

    def make(batches):
        seen = set()
        for frame in batches:
            ids, elements = [], []
            for text in frame.column(0):
                found = shingles(text.as_py())
                identity = set_id(found)
                if identity not in seen:
                    seen.add(identity)
                    ids.append(identity)
                    elements.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(elements, pa.binary())], ["set_id", "elements"])

    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    texts = documents.withColumn("text_hash", F.xxhash64("text")).join(wanted, "text_hash", "left_semi").select("text")
    made = texts.mapInArrow(make, "set_id bigint, elements binary")
    return made.groupBy("set_id").agg(F.first("elements").alias("elements"))


@F.arrow_udf(T.BooleanType())
def _similar(a: pa.Array, b: pa.Array) -> pa.Array:
    low, high = SIMILAR
    found = []
    for first, second in zip(a, b, strict=True):
        x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (first, second))
        common = len(np.intersect1d(x, y, assume_unique=True))
        found.append(high * common >= low * (len(x) + len(y) - common))
    return pa.array(found, pa.bool_())


def _links(pairs: DataFrame, documents: DataFrame, sets: DataFrame) -> DataFrame | None:
    """The stored pairs (a, b) whose sets are similar, by comparing the whole sets; None if there are none."""
    if not pairs.limit(1).count():
        return None
    involved = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    wanted = stored(sets.join(involved, "set_id", "left_semi").select("text_hash").distinct(), "wanted")
    contents = stored(_contents(documents, wanted), "contents")
    first = contents.select(F.col("set_id").alias("a"), F.col("elements").alias("of_a"))
    second = contents.select(F.col("set_id").alias("b"), F.col("elements").alias("of_b"))
    found = stored(pairs.join(second, "b").join(first, "a").where(_similar("of_a", "of_b")).select("a", "b"), "links")
    return found if found.limit(1).count() else None


def _alike(size_x: str, size_y: str, x: str, y: str) -> Column:
    """Whether sets of these sizes can be similar by their parities, columns that begin with ``x`` and ``y``."""
    low, high = SIMILAR
    differ = " + ".join(f"bit_count({x}{name} ^ {y}{name})" for name in PARITIES)
    return F.expr(f"{differ} <= ({high - low} * ({size_x} + {size_y})) div {high + low}")


def _of(parity: DataFrame, side: str) -> DataFrame:
    return parity.select(F.col("set_id").alias(side), *(F.col(name).alias(f"{side}_{name}") for name in ("size", *PARITIES)))


def _likely(pairs: DataFrame, parity: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets can be similar by their parities."""
    both = pairs.join(_of(parity, "a"), "a").join(_of(parity, "b"), "b")
    return both.where(_alike("a_size", "b_size", "a_", "b_")).select("a", "b")


def _needs(sets: DataFrame) -> DataFrame:
    """``set_id, fine, need, small, elements``: in how many buckets of a kind a set meets every partner, and every one not smaller than itself.

    Buckets of single shingles are ``fine``. Similar sets of n and m elements share (n + m) * 3 / 7 or more, which is six sevenths of the smaller
    one; of segments the smaller set has no more to ask for.
    """
    low, high = SIMILAR
    fine = sets.where(f"size <= {FINE_BAND}").select(
        "set_id", F.lit(True).alias("fine"), F.expr(f"CAST(({low} * size + {high - 1}) div {high} AS int)").alias("need"),
        F.expr(f"CAST(({2 * low} * size + {low + high - 1}) div {low + high} AS int)").alias("small"), F.col("size").alias("elements"))
    need = F.greatest("need", F.lit(1))
    coarse = sets.where(f"size * {high} div {low} > {FINE_BAND}").select(
        "set_id", F.lit(False).alias("fine"), need.alias("need"), need.alias("small"), F.col("size").alias("elements"))
    return fine.unionAll(coarse)


def _able(members: DataFrame, needs: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, of sets that are in as many of these as they need.

    Buckets with the same sets, as those of a passage that some texts share, are one bucket from then on, with their number as its weight.
    A set meets each partner in ``need`` buckets of a kind or more. If it is in fewer that hold another component, it has no
    partner left to find there and leaves all of them.
    """
    holding = (
        members.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"), F.min("weight").alias("weight"),
            F.bit_xor(F.xxhash64("set_id")).alias("sets"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("again"))
        .where("low <> high").groupBy((F.col("key") % 2 != 0).alias("fine"), "size", "sets", "again")
        .agg(F.min("key").alias("key"), F.sum("weight").alias("weight")))
    held = stored(members.select("key", "set_id", "component").join(holding.select("key", "fine", "size", "weight"), "key"), "held")
    able = held.groupBy("set_id", "fine").agg(F.sum("weight").alias("met")).join(needs, ["set_id", "fine"]).where("met >= need")
    able = stored(able.select("set_id", "fine", "need", "small", "met", "elements"), "able")
    if able.count() <= MOST_SENT:
        able = F.broadcast(able)
    # With one number as its key the table takes what its rows do; with two it takes a whole page of memory, in each executor and for each job.
    return held.join(able.withColumnRenamed("fine", "of"), "set_id").where(F.expr("IF(fine, of, NOT of)")).select(
        "key", "set_id", "component", "fine", "need", "small", "met", "size", "weight", "elements")


def _star(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each bucket's pivot with one set of each other component in it; another choice each turn.

    In the first turn every set is a component, and pairs must share the buckets they need. The pivot is then the set that shares most of what
    it has, as the text does of which the others are copies. The number of pairs is at most that of the members.
    """
    chance = F.struct((F.lit(0.0) if turn else -F.col("met") / F.col("elements")).alias("rest"), F.xxhash64("set_id", F.lit(turn)).alias("chance"))
    pivots = members.groupBy("key").agg(F.min(F.struct(chance.alias("chance"), "set_id", "component", "elements")).alias("pivot"))
    others = members
    if turn:
        others = members.groupBy("key", "component").agg(
            F.min(F.struct(chance.alias("chance"), "set_id", "elements")).alias("first"), F.lit(1).alias("need"), F.min("weight").alias("weight"))
        others = others.select("key", "component", "first.set_id", "first.elements", "need", "weight", (F.col("key") % 2 != 0).alias("fine"))
    pairs = others.join(pivots, "key").where(F.col("component") != F.col("pivot.component"))
    pairs = pairs.where(_sizes_fit("elements", "pivot.elements"))
    pairs = pairs.groupBy(
        F.least("set_id", "pivot.set_id").alias("a"), F.greatest("set_id", "pivot.set_id").alias("b"), "fine").agg(
        F.sum("weight").alias("shared"), F.max("need").alias("need"))
    return pairs.where("shared >= need").select("a", "b").distinct()


def _sizes_fit(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return SIMILAR[1] * F.least(a, b) >= SIMILAR[0] * F.greatest(a, b)


def _probed(members: DataFrame) -> DataFrame:
    """All pairs (a, b) of different components that can still be similar, each found where it is cheapest.

    Both sets of a pair look into all but ``need - 1`` of their buckets, the smallest ones. In the order of all buckets by size the first one that
    they share is among those of either. The smaller set of a pair needs more of them than the larger, and so looks into fewer. Where a pair
    first meets, as many buckets as it has to share are left to both. Texts made from one text share most of their buckets without being similar:
    their pairs are ruled out by their parities, where they meet.
    """
    before = Window.partitionBy("set_id", "fine").orderBy("size", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = members.withColumn("rest", F.col("met") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    placed = stored(placed.where("rest >= need"), "placed")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(
            "key", F.col("set_id").alias(name), F.col("component").alias(f"of_{name}"), F.col("elements").alias(f"size_{name}"),
            F.col("rest").alias(f"rest_{name}"), *(F.col(p).alias(f"{name}_{p}") for p in PARITIES))

    left, right = side(placed.where("rest >= small"), "x"), side(placed, "y")
    low, high = SIMILAR
    # Buckets with odd numbers are fine.
    enough = F.expr(f"key % 2 = 0 OR least(rest_x, rest_y) * {low + high} >= {low} * (size_x + size_y)")
    met = left.join(right, "key").where(
        F.expr("of_x <> of_y AND size_x <= size_y") & _sizes_fit("size_x", "size_y") & enough & _alike("size_x", "size_y", "x_", "y_"))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of the links (a, b): the smallest node it can reach.

    Each round a node takes the smallest label among its neighbours, then the label of its label, so long chains
    close in logarithmically many rounds. Labels are written each round.
    """
    edges = stored(links.union(links.select("b", "a")).toDF("a", "b").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("component")), "labels")
    while True:
        heard = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("heard"))
        lower = stored(labels.join(heard, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "heard").alias("component")), "lower")
        of_label = lower.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = stored(lower.join(of_label, "component").select(
            "node", F.col("next").alias("component"), "before"), "labels")
        if not labels.where("component <> before").limit(1).count():
            return labels.select("node", "component")


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most so many rows for the jobs run within: long texts and sets come by the batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def grouped(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component`` of every document; the component is a set's id, null for an empty set."""
    with batches_of(documents.sparkSession, BATCH_ROWS):
        return _grouped(documents)


def _grouped(documents: DataFrame) -> DataFrame:
    documents = documents.select("doc_id", "text")
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(partitions, size // PART_BYTES + 1)
    met = stored(_meet(_gather(documents, parts), parts), "buckets")
    rows = met.where(F.col("key").isNull()).select("doc_id", "set_id", "n_shingles", "need", "text_hash", *PARITIES)
    members = met.where(F.col("key").isNotNull()).select("key", "set_id", "pivot")
    filled = rows.where("n_shingles > 0")
    sets = filled.groupBy("set_id").agg(
        F.min("need").alias("need"), F.min("n_shingles").alias("size"), F.min("text_hash").alias("text_hash"),
        *(F.min(name).alias(name) for name in PARITIES))

    needs = stored(_needs(sets), "needs")
    members = members.select("key", "set_id", F.col("set_id").alias("component"), F.lit(1).cast("long").alias("weight"))
    members = _able(_able(members, needs), needs)
    parity = sets.join(members.select("set_id").distinct(), "set_id", "left_semi").select("set_id", "size", *PARITIES)
    parity = stored(parity, "parity")
    links = tried = members.select(F.col("set_id").alias("a"), F.col("set_id").alias("b")).limit(0)
    of = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for turn in range(STAR_TURNS + 1):
        if not members.limit(1).count():
            break
        last = turn == STAR_TURNS
        pairs = _probed(members.join(parity.drop("size"), "set_id")) if last else _likely(_star(members, turn), parity)
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti") if turn else pairs, "pairs")
        tried = tried.unionAll(pairs)
        found = _links(pairs, documents, sets)
        if found is not None:
            links = links.unionAll(found)
            of = components(links)
        if found is not None and not last:
            members = members.select("key", "set_id", "weight").join(of.withColumnRenamed("node", "set_id"), "set_id", "left").select(
                "key", "set_id", F.coalesce("component", "set_id").alias("component"), "weight")
            members = _able(members, needs)

    named = filled.join(of.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("component", "set_id").alias("component"))
    empty = rows.where("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("component"))
    return stored(named.unionAll(empty), "grouped")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    ``component_id`` is the smallest id among the documents that can be reached by links of similarity 0.75 or more on sets of
    five-word shingles, its own included. A text of fewer words is one shingle; a null text or one without words has an
    empty set, is linked with nothing and keeps its own id. Equal sets are linked whatever their ids; rows that repeat
    an id are documents of their own. A document with a null id takes part, and its component id is that of the others, or null.
    An empty table has no rows; other columns are not read.
    """
    found = grouped(documents)
    smallest = stored(found.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    return found.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component: the smallest id, then the smallest hash of its text; null ids come last.

    Rows with an empty set are no component and all stay, but of rows that repeat both id and text one stays.
    """
    found = grouped(documents)
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash").alias("row")
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(row).alias("row")).select("row.*")
    kept = stored(first.unionAll(found.where("component IS NULL").select(row).select("row.*")).distinct(), "kept")
    kept = kept.select(F.col("doc_id").alias("__of"), F.col("text_hash").alias("__hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__of")) & (F.xxhash64("text") == F.col("__hash"))
    joined = documents.join(kept, same, "left_semi")
    if found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        joined = joined.withColumn("__hash", F.xxhash64("text")).dropDuplicates(["doc_id", "__hash"])
    return joined.select(*documents.columns)
