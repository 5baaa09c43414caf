"""Ranked lexical search of a batch of items over all documents, with what the items share evaluated once.

The items of a block make one plan. Term occurrences that stand in just the same items are one leaf: a set of terms mined as
shared. Leaves, and sums of leaves, that stand together in several items are paired, the pair in most items first, round by
round; each pair is a node whose value is computed once. What is left of an item is a sum of a few nodes: the items are the
ends of one directed acyclic graph of partial sums.

Documents are split into terms once and stored as their length and the counts of the terms that items ask for. The statistics
come from that table. A task then takes some hundred documents at a time: term impacts, leaves, nodes level by level, items; each
level is one addition of integer arrays, so a partial accumulator serves every item above it and the sums are exact. Only the
best few of a task leave it.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articleloom.sources.scratch import stored

TOP = 20
BLOCK_ITEMS = 512  # distinct texts in a block: the documents are read once for each block
BLOCK_BYTES = 512 << 10  # of their texts
PAIRED_AT_ONCE = 4096  # columns whose pairs are counted in one round, those in most items first
CELLS_AT_ONCE = 1 << 22  # of all arrays of one step in a task
GROUPS = 64  # the bests of tasks are thinned out in so many groups an item

# Bytes of terms. ASCII letters and digits, and all bytes of other characters; the rest are gaps.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, A-Z lower-cased."""
    return text.translate(TERM_BYTES).split()


@dataclass
class SharingPlan:
    """What to add up: leaves from terms, nodes from two earlier ones, items from nodes.

    ``leaf_terms`` and ``leaf_times`` are the terms of all leaves in a row with their multiplicities, cut at ``leaf_starts``.
    Nodes are numbered from the leaves on; ``levels`` are arrays of pairs that need only what comes before them.
    ``item_nodes`` are cut at ``item_starts`` in the order of ``items``.
    """

    vocabulary: dict[bytes, int]
    items: list
    leaf_terms: np.ndarray
    leaf_times: np.ndarray
    leaf_starts: np.ndarray
    item_nodes: np.ndarray
    item_starts: np.ndarray
    levels: list[np.ndarray] = field(default_factory=list)

    @property
    def nodes(self) -> int:
        return len(self.leaf_starts) + sum(map(len, self.levels))

    @property
    def additions(self) -> int:
        """Additions a document needs, those within leaves included."""
        return (len(self.leaf_terms) - len(self.leaf_starts) + sum(map(len, self.levels))
                + len(self.item_nodes) - len(self.item_starts))


def disjoint_pairs(held: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of columns of an items x columns table that stand together in two items or more, each column once, best first."""
    together = np.triu(held.T.astype(np.float32) @ held.astype(np.float32), 1)
    left, right = np.nonzero(together >= 2)
    order = np.argsort(-together[left, right], kind="stable")
    used, pairs = np.zeros(held.shape[1], bool), []
    for a, b in zip(left[order].tolist(), right[order].tolist(), strict=True):
        if not (used[a] or used[b]):
            used[a] = used[b] = True
            pairs.append((a, b))
    return pairs


def sharing_plan(items: list[tuple[object, bytes]]) -> SharingPlan:
    """The plan of a block of (key, UTF-8 text); items without terms are left out."""
    vocabulary: dict[bytes, int] = {}
    keys, holders = [], defaultdict(list)
    for key, text in items:
        counts = Counter(terms(text))
        if counts:
            for term, times in counts.items():
                number = vocabulary.setdefault(term, len(vocabulary))
                for time in range(times):
                    holders[number, time].append(len(keys))
            keys.append(key)
    leaves: dict[tuple, Counter] = defaultdict(Counter)
    for (term, _), held_by in holders.items():
        leaves[tuple(held_by)][term] += 1
    needs = [set() for _ in keys]
    for leaf, held_by in enumerate(leaves):
        for item in held_by:
            needs[item].add(leaf)
    nodes, levels = len(leaves), []
    while True:
        often = Counter(node for need in needs for node in need)
        columns = [node for node, times in often.most_common(PAIRED_AT_ONCE) if times > 1]
        place = {node: k for k, node in enumerate(columns)}
        held = np.zeros((len(keys), len(columns)), bool)
        for item, need in enumerate(needs):
            held[item, [place[node] for node in need if node in place]] = True
        pairs = [(columns[a], columns[b]) for a, b in disjoint_pairs(held)]
        if not pairs:
            break
        for number, (a, b) in enumerate(pairs, nodes):
            for need in needs:
                if a in need and b in need:
                    need -= {a, b}
                    need.add(number)
        levels.append(np.array(pairs))
        nodes += len(pairs)
    sizes = [len(counts) for counts in leaves.values()]
    return SharingPlan(
        vocabulary, keys,
        np.array([term for counts in leaves.values() for term in counts], np.int64),
        np.array([times for counts in leaves.values() for times in counts.values()], np.int64),
        np.cumsum([0, *sizes])[:-1], np.array([node for need in needs for node in sorted(need)], np.int64),
        np.cumsum([0, *map(len, needs)])[:-1], levels)


def evaluate(plan: SharingPlan, impacts: np.ndarray) -> np.ndarray:
    """Scores, items x documents, of the terms' impacts, terms x documents; every node is computed once."""
    values = np.empty((plan.nodes, impacts.shape[1]), np.int64)
    done = len(plan.leaf_starts)
    values[:done] = np.add.reduceat(impacts[plan.leaf_terms] * plan.leaf_times[:, None], plan.leaf_starts)
    for level in plan.levels:
        np.add(values[level[:, 0]], values[level[:, 1]], out=values[done:done + len(level)])
        done += len(level)
    return np.add.reduceat(values[plan.item_nodes], plan.item_starts)


class Best:
    """The best few documents of each item so far: higher scores first, then lower ids, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.rows = np.empty((4, 0), np.int64)  # item, score, id, whether the id is null

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        if scores.shape[1] > self.top:
            least = np.maximum(np.partition(scores, -self.top)[:, -self.top], 1)[:, None]
        else:
            least = 1
        item, document = np.nonzero(scores >= least)
        found = np.stack([item, scores[item, document], ids[document], no_id[document].astype(np.int64)])
        rows = np.concatenate([self.rows, found], 1)
        rows = rows[:, np.lexsort((rows[2], rows[3], -rows[1], rows[0]))]
        starts = np.searchsorted(rows[0], np.arange(len(scores)))
        self.rows = rows[:, np.arange(rows.shape[1]) - starts[rows[0]] < self.top]


def document_terms(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, times`` of each document that has a term: how many it has, and those of the vocabulary with their counts."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            places, sizes, ends, numbers, times = [], [], [0], [], []
            for place, text in enumerate(batch["text"]):
                found = terms(text.as_py() or b"")
                if not found:
                    continue
                places.append(place)
                sizes.append(len(found))
                for term, often in Counter(found).items():
                    if term in known:
                        numbers.append(known[term])
                        times.append(often)
                ends.append(len(numbers))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(places, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], ["doc_id", "n", "terms", "times"])

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, times array<int>")


def _ranked_block(documents: DataFrame, plan: SharingPlan, top: int) -> DataFrame:
    """``item, doc_id, score``: the best documents of each task for each item of one block."""
    counted = stored(document_terms(documents, plan.vocabulary), "document_terms")
    number, length = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    weights = np.zeros(len(plan.vocabulary), np.int64)
    for term, holding in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = math.floor(1000 * math.log((2 * number + 2) / (2 * holding + 1)))
    shared = documents.sparkSession.sparkContext.broadcast((plan, weights, number, length))
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights, number, length = shared.value
        step = max(1, CELLS_AT_ONCE // (len(weights) + 2 * len(plan.leaf_terms) + 2 * plan.nodes + len(plan.items)))
        best = Best(top)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                held, times = batch["terms"].flatten().to_numpy(), batch["times"].flatten().to_numpy().astype(np.int64)
                if not len(held):
                    continue
                document = np.repeat(np.arange(batch.num_rows), np.diff(batch["terms"].offsets.to_numpy()))
                mean = 75 + 25 * batch["n"].to_numpy() * number // length
                impacts = np.zeros((len(weights), batch.num_rows), np.int64)
                impacts[held, document] = weights[held] * (10**9 * times // (1000 * times + 12 * mean[document]))
                ids = batch["doc_id"]
                best.add(evaluate(plan, impacts), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        item, scores, ids, no_id = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=no_id.astype(bool)), pa.array(scores, pa.int64())], schema=schema)

    return counted.mapInArrow(score, "item int, doc_id bigint, score bigint")


def _first(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def ranked_documents(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each row of ``items(item_id, text)``.

    Scores are those of the contract; rows of ``documents`` are documents of their own, also if they repeat; null ids come last
    among equal scores. Null texts and texts without terms neither find nor are found. Items of equal text are evaluated once; every
    row of ``items`` gets its ranks, whatever its id. Items are taken in blocks of bounded size, one on the driver at a
    time; the documents are read once for each block. Extra columns are not read. Empty tables give no rows.
    """
    spark = documents.sparkSession
    asked = items.select(F.col("item_id"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")
    asked = asked.withColumn("item_key", F.sha2("text", 256))
    texts = asked.groupBy("item_key").agg(F.first("text").alias("text"))
    rows, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    found = []
    for block in range(blocks):
        own = texts.filter(F.pmod(F.xxhash64("item_key"), F.lit(blocks)) == block).orderBy("item_key")
        plan = sharing_plan([(row["item_key"], bytes(row["text"])) for row in own.collect()])
        if not plan.items:
            continue
        ranked = _ranked_block(documents, plan, top).withColumn(
            "group", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)))
        ranked = _first(_first(ranked, ["item", "group"], top), ["item"], top)
        keys = F.lit(plan.items)
        found.append(stored(ranked.select(F.get(keys, "item").alias("item_key"), "rank", "doc_id", "score"), "ranked"))
    if not found:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    results = found[0]
    for more in found[1:]:
        results = results.unionAll(more)
    return asked.select("item_id", "item_key").join(results, "item_key").select("item_id", "rank", "doc_id", "score")
