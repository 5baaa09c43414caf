"""Approximate nearest neighbours in balanced posting lists.

Centroids come from a bounded sample by balanced splitting: a cell with too many members is cut in two by 2-means with
halves of equal size, until every cell is small. A graph over the centroids, held in memory, is searched greedily from
a few entry points to find the centroids near a vector. Each vector is posted to the nearest list and, if it lies
near a boundary, to further lists whose centroid is at most ``POST_RATIO`` times as far and not nearer to a list already
chosen than to the vector. A query searches every list whose centroid is at most ``SEARCH_RATIO`` times as far as the
nearest, however many these are: queries are few, so they are compared with all centroids instead of by the graph.

Vectors are scaled to length one, so Euclidean order is that of the cosine. Equal vectors are one
candidate with its few smallest ids: none of the others can be among the nearest. Lists stand in the order in which cells were
split and are cut into blocks of even size, so a block holds lists near each other, or a part of one, and neither a
list nor a hot vector is one task; a query goes to a block once and is compared with all of it. The best of the blocks are
scored again on the original vectors in double precision.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articleloom.sources.scratch import stored

NEAREST = 5
QUERY_STEP = 50

# Bound on the vectors that centroids are fitted to, and on the centroids sent to all tasks.
SAMPLE = 20_000
CENTROIDS = 5_000
LIST_SIZE = 250

GRAPH_LINKS = 24
BEAM = 80
ENTRIES = 16
POST_LISTS = 4
POST_RATIO = 1.1
# Lists that a query searches at least; the ratio decides on all others.
SEARCH_LISTS = 64
SEARCH_RATIO = 1.3
# Blocks that a table is cut into, more if they would hold more vectors than ``BLOCK``, and queries that a task compares with one.
BLOCKS = 64
BLOCK = 32_768
ASKED = 50_000


def split_evenly(points: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of two halves of equal size: 2-means on directions, cut at the median of the difference."""
    random = np.random.default_rng(seed)
    a, b = points[random.choice(len(points), 2, replace=False)]
    for _ in range(8):
        order = np.argsort(points @ (a - b), kind="stable")
        low, high = order[:len(order) // 2], order[len(order) // 2:]
        a, b = points[high].mean(axis=0), points[low].mean(axis=0)
    return low, high


def balanced_centroids(points: np.ndarray, cells: int) -> np.ndarray:
    """Means of ``cells`` or a few more balanced cells of the points, scaled to length one."""
    most = max(1, ceil(len(points) / max(1, cells)))
    pending, means = [np.arange(len(points))], []
    while pending:
        members = pending.pop()
        if len(members) <= most or len(members) < 2:
            means.append(points[members].mean(axis=0))
        else:
            pending.extend(members[half] for half in split_evenly(points[members], len(pending) + len(means)))
    centroids = np.stack(means)
    lengths = np.linalg.norm(centroids, axis=1, keepdims=True)
    return (centroids / np.where(lengths > 0, lengths, 1)).astype(np.float32)


def centroid_graph(centroids: np.ndarray, links: int = GRAPH_LINKS) -> np.ndarray:
    """Neighbours of each centroid: half the nearest, half dealt out over all so that every part is reached."""
    n = len(centroids)
    near = min(links // 2, n - 1)
    random = np.random.default_rng(1)
    graph = np.empty((n, near + (links - links // 2)), np.int64)
    for start in range(0, n, 1024):
        close = centroids[start:start + 1024] @ centroids.T
        close[np.arange(len(close)), np.arange(start, start + len(close))] = -np.inf
        graph[start:start + 1024, :near] = np.argpartition(-close, near - 1, axis=1)[:, :near] if near else 0
    graph[:, near:] = random.integers(0, n, (n, graph.shape[1] - near))
    return graph


def near_centroids(vectors: np.ndarray, centroids: np.ndarray, graph: np.ndarray, beam: int = BEAM) -> tuple:
    """Lists and cosines of about the nearest centroids of each vector, nearest first: a best-first search of the graph.

    All vectors of a batch take their steps together. A step follows the links of the best centroid not yet
    followed; the search of a vector ends when the ``beam`` best have all been followed.
    """
    n, size = len(vectors), len(centroids)
    if size <= beam:
        order = np.argsort(-(vectors @ centroids.T), axis=1, kind="stable")
        return order, np.take_along_axis(vectors @ centroids.T, order, axis=1)
    rows = np.arange(n)
    entries = np.unique(np.linspace(0, size - 1, ENTRIES).astype(np.int64))
    seen = np.zeros((n, size), bool)
    ids = np.full((n, beam), -1, np.int64)
    close = np.full((n, beam), -np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    ids[:, :len(entries)] = entries
    close[:, :len(entries)] = vectors @ centroids[entries].T
    seen[:, entries] = True
    for _ in range(4 * beam):
        open_close = np.where(done, -np.inf, close)
        best = open_close.argmax(axis=1)
        active = np.flatnonzero(open_close[rows, best] > -np.inf)
        if not len(active):
            break
        done[active, best[active]] = True
        found = graph[ids[active, best[active]]]
        new = ~seen[active[:, None], found]
        seen[active[:, None], found] = True
        scores = np.einsum("nd,nkd->nk", vectors[active], centroids[found])
        scores[~new] = -np.inf
        # A link may be listed twice: the second is dropped.
        order = np.argsort(found, axis=1, kind="stable")
        twice = np.zeros_like(new)
        np.put_along_axis(twice, order[:, 1:], np.diff(np.take_along_axis(found, order, axis=1), axis=1) == 0, axis=1)
        scores[twice] = -np.inf
        every = np.concatenate([close[active], scores], axis=1)
        keep = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
        close[active] = np.take_along_axis(every, keep, axis=1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], found], axis=1), keep, axis=1)
        flags = np.concatenate([done[active], np.zeros_like(new)], axis=1)
        done[active] = np.take_along_axis(flags, keep, axis=1)
        done[close == -np.inf] = True
    order = np.argsort(-close, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(close, order, axis=1)


def lists_to_post(ids: np.ndarray, close: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which of the near lists a vector is posted to: the nearest, and lists across a boundary."""
    away = np.sqrt(np.maximum(2 - 2 * close, 0))
    chosen = np.zeros(ids.shape, bool)
    chosen[:, 0] = True
    for k in range(1, min(ids.shape[1], 2 * POST_LISTS)):
        fits = (away[:, k] <= POST_RATIO * away[:, 0] + 1e-6) & (chosen.sum(axis=1) < POST_LISTS)
        for j in range(k):
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,nd->n", centroids[ids[:, k]], centroids[ids[:, j]]), 0))
            fits &= ~chosen[:, j] | (between > away[:, k] * 0.7)
        chosen[:, k] = fits & (ids[:, k] >= 0)
    return chosen


def lists_to_search(close: np.ndarray) -> np.ndarray:
    """Which lists a query searches, by its cosines with all centroids: those not much farther than the nearest."""
    away = np.sqrt(np.maximum(2 - 2 * close, 0))
    chosen = away <= SEARCH_RATIO * away.min(axis=1, keepdims=True) + 1e-6
    least = min(SEARCH_LISTS, close.shape[1])
    np.put_along_axis(chosen, np.argpartition(away, least - 1, axis=1)[:, :least], True, axis=1)
    return chosen


def blocks_to_search(vectors: np.ndarray, centroids: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """The blocks that hold any part of the lists each vector searches; ``first`` and ``last`` are a list's blocks."""
    found, most = [], int(last.max()) + 2
    for start in range(0, len(vectors), 1024):
        for row in lists_to_search(vectors[start:start + 1024] @ centroids.T):
            row &= last >= first  # not those without members
            opened = np.bincount(first[row], minlength=most) - np.bincount(last[row] + 1, minlength=most)
            found.append(np.flatnonzero(np.cumsum(opened) > 0))
    return found


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding`` as doubles, of vectors that take part: no null id, no null or non-finite component, not zero."""
    return (
        embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        .where(F.exists("embedding", lambda x: x != 0)))


def distinct_vectors(vectors: DataFrame, k: int, step: int) -> DataFrame:
    """One row for each distinct vector: ``vector, ids`` (its k + 1 smallest), ``embedding, size, asks`` (an id of it is a query).

    The rank limit is applied before the shuffle, so a vector that holds a third of all rows sends few of them.
    """
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = vectors.distinct().withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank")
    asking = vectors.where(F.col("vec_id") % step == 0).select(F.lit(None).cast("long").alias("vec_id"), "embedding").distinct()
    rows = few.withColumn("asks", F.lit(False)).unionByName(asking.withColumn("asks", F.lit(True)))
    grouped = rows.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"), F.max("asks").alias("asks"))
    return stored(grouped.select(
        F.monotonically_increasing_id().alias("vector"), "ids", "embedding", F.size("embedding").alias("size"), "asks"),
        "vectors")


def _rows(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0))


def _scaled(rows: np.ndarray) -> np.ndarray:
    # The largest component first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def cosine(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of each query with its rows in double precision; the sum of a row does not depend on the rows beside it."""
    lengths = np.sqrt((rows * rows).sum(axis=2)) * np.sqrt((queries * queries).sum(axis=1))[:, None]
    return (rows * queries[:, None]).sum(axis=2) / lengths


def best_of_block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k + 1 best vectors of a block for each query of it: ``query, score, ids``."""
    found = [pd.DataFrame({"query": np.empty(0, np.int64), "score": np.empty(0), "ids": np.empty(0, object)})]
    if len(vectors) and len(queries):
        # A vector may be posted to several lists of the block.
        vectors = vectors.drop_duplicates("vector")
        rows, ids = _rows(vectors["embedding"]), vectors["ids"].to_numpy()
        lowest = np.array([each[0] for each in ids])
        scaled = _scaled(rows)
        for start in range(0, len(queries), 512):
            part = queries.iloc[start:start + 512]
            asked = _rows(part["asked"])
            close = _scaled(asked) @ scaled.T
            # A few more than asked for by single precision, then the best of them by double.
            most = min(k + 9, len(rows))
            near = np.argpartition(-close, most - 1, axis=1)[:, :most]
            scores = cosine(asked, rows[near])
            best = np.lexsort((lowest[near], -scores), axis=1)[:, :k + 1]
            found.append(pd.DataFrame({
                "query": np.repeat(part["query"].to_numpy(), best.shape[1]),
                "score": np.take_along_axis(scores, best, axis=1).ravel(),
                "ids": ids[np.take_along_axis(near, best, axis=1).ravel()]}))
    return pd.concat(found, ignore_index=True) if len(found) > 1 else found[0]


def _search(distinct: DataFrame, size: int, count: int, k: int) -> DataFrame:
    """``query, near``: for each asking vector the candidates found, best first, as (score, vec_id)."""
    spark = distinct.sparkSession
    own = distinct.where(F.col("size") == size)
    part = max(1, count // SAMPLE)
    sample = own.where(F.pmod(F.xxhash64("embedding"), F.lit(part)) == 0).orderBy("vector").limit(2 * SAMPLE)
    points = _scaled(_rows(sample.select("embedding").toPandas()["embedding"]))
    centroids = balanced_centroids(points, min(CENTROIDS, ceil(count / LIST_SIZE), max(1, len(points) // 4)))
    shared = spark.sparkContext.broadcast((centroids, centroid_graph(centroids)))

    def post(frames):
        centroids, graph = shared.value
        for frame in frames:
            if not len(frame):
                continue
            ids, close = near_centroids(_scaled(_rows(frame["embedding"])), centroids, graph)
            posted = lists_to_post(ids, close, centroids)
            frame["posted"] = [row[on].tolist() for row, on in zip(ids, posted, strict=True)]
            yield frame

    placed = stored(own.select("vector", "ids", "embedding", "asks").mapInPandas(
        post, "vector bigint, ids array<bigint>, embedding array<double>, asks boolean, "
              "posted array<bigint>"), "posting_lists")
    members = placed.select("vector", "ids", "embedding", F.explode("posted").alias("list"))
    # About CENTROIDS rows, of which the driver adds up where each list starts.
    sizes = members.groupBy("list").agg(F.count(F.lit(1)).alias("rows")).toPandas()
    rows = np.zeros(len(centroids), np.int64)
    rows[sizes["list"].to_numpy()] = sizes["rows"].to_numpy()
    starts = np.cumsum(rows) - rows
    most = int(min(BLOCK, ceil(rows.sum() / BLOCKS)))
    lists = F.broadcast(spark.createDataFrame(
        [(k, int(start), int(n)) for k, (start, n) in enumerate(zip(starts, rows, strict=True)) if n], "list bigint, start bigint, rows bigint"))
    known = spark.sparkContext.broadcast((starts // most, np.where(rows > 0, starts + rows - 1, -1) // most))
    slices = ceil(placed.where("asks").count() / ASKED)

    def ask(frames):
        for frame in frames:
            if len(frame):
                blocks = blocks_to_search(_scaled(_rows(frame["asked"])), shared.value[0], *known.value)
                yield frame.assign(blocks=[found.astype(np.int32) for found in blocks])

    members = members.join(lists, "list").select(
        F.floor((F.col("start") + F.pmod(F.xxhash64("vector"), F.col("rows"))) / most).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(max(slices, 1) - 1))).alias("slice"), "vector", "ids", "embedding")
    queries = (
        placed.where("asks").select(F.col("vector").alias("query"), F.col("embedding").alias("asked"))
        .mapInPandas(ask, "query bigint, asked array<double>, blocks array<int>")
        .select(F.explode("blocks").alias("block"),
                F.pmod(F.xxhash64("query"), F.lit(max(slices, 1))).cast("int").alias("slice"), "query", "asked"))

    def search(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return best_of_block(vectors, asked, k)

    found = members.groupBy("block", "slice").cogroup(queries.groupBy("block", "slice")).applyInPandas(
        search, "query bigint, score double, ids array<bigint>")
    each = found.select("query", F.explode("ids").alias("vec_id"), (-F.col("score")).alias("away")).distinct()
    rank = F.row_number().over(Window.partitionBy("query").orderBy("away", "vec_id"))
    best = each.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("away", "vec_id"))).alias("near"))


def nearest(embeddings: DataFrame, k: int = NEAREST, step: int = QUERY_STEP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every vector whose id is divisible by ``step``.

    The score is the cosine in double precision on the original vectors; ties go to the smaller id. Vectors of
    different lengths are compared with their own kind only. Rows that repeat an id and vector are one candidate. Vectors that
    are null, zero or hold null or non-finite components, and null ids, take no part; an empty table gives no rows. Other
    columns are not read.
    """
    vectors = usable(embeddings)
    distinct = distinct_vectors(vectors, k, step)
    sizes = distinct.groupBy("size").agg(F.count(F.lit(1)).alias("rows")).orderBy("size").collect()
    if not sizes:
        return embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = _search(distinct, sizes[0]["size"], sizes[0]["rows"], k)
    for row in sizes[1:]:
        found = found.unionAll(_search(distinct, row["size"], row["rows"], k))
    asking = vectors.where(F.col("vec_id") % step == 0).distinct()
    known = distinct.where("asks").select(F.col("vector").alias("query"), "embedding").join(found, "query")
    others = F.slice(F.filter("near", lambda hit: hit["vec_id"] != F.col("query_id")), 1, k)
    ranked = asking.withColumnRenamed("vec_id", "query_id").join(known, "embedding").select(
        "query_id", F.posexplode(others).alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "hit.vec_id", (-F.col("hit.away")).alias("score"))
