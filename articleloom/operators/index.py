"""The stored chunk index: chunks with their vectors, in versions.

Below the path of an index lie

* ``chunks/batch=N``: the chunks that run N added;
* ``articles/batch=N``: id and version of the articles they are of, one narrow row each;
* ``replaced/batch=N``: the articles of earlier batches that run N replaced, with the ``old`` batch they lie in;
* ``postings/batch=N/bucket=B``: the inverted form of the batches it was written for;
* ``batches``: what became of each batch, a row when it is started, added in full, inverted and retired.

A run takes its number by starting a batch and adds it last, so what a failed run leaves counts for nothing. An index is opened by
reading the small tables; no chunk is read for it.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articleloom.functions.embedding import DIMS, term_vector, vector_length
from articleloom.operators.chunk import CHUNK_OVERLAP, CHUNK_SIZE, chunk_articles
from articleloom.operators import postings
from articleloom.schemas import ARTICLE_VERSIONS, BATCHES, CHUNK_INDEX, POSTINGS, REPLACED_ARTICLES
from articleloom.sources.scratch import stored

ID_BYTES = 64 << 20  # ids of articles up to this size are sent to all tasks
ARTICLE_ID_BYTES = 256  # of one such id in a hash table: two hashes

STARTED, ADDED, INVERTED, RETIRED = "started", "added", "inverted", "retired"


def embed_chunks(chunks: DataFrame, dims: int = DIMS) -> DataFrame:
    """Chunks with their term counts as ``embedding``. Row by row, no shuffle."""
    return chunks.withColumn("embedding", term_vector(F.col("page_content"), dims))


def embed_questions(questions: DataFrame, dims: int = DIMS) -> DataFrame:
    """Questions with their term counts as ``embedding``, made as those of the chunks are."""
    return questions.withColumn("embedding", term_vector(F.col("question"), dims))


def term_weights(embedded: DataFrame, key: str) -> DataFrame:
    """One row per text and non-empty bucket, with weights of unit length per text."""
    # The outer form keeps Catalyst from deriving a filter that computes the vectors again.
    return (
        embedded.select(key, "embedding", vector_length(F.col("embedding")).alias("length"))
        .select(key, "length", F.posexplode_outer("embedding").alias("bucket", "count"))
        .filter(F.col("count") > 0)
        .select(key, "bucket", (F.col("count").cast("double") / F.col("length")).alias("weight"))
    )


def with_version(articles: DataFrame, size: int, overlap: int) -> DataFrame:
    """Articles with ``version``: a hash of all that their chunks hold and how they are cut."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) if name in articles.columns else F.lit("")
             for name in ("pmid", "title", "journal", "year", "ref_id", "content")]
    return articles.withColumn("version", F.sha2(F.concat_ws("\n", F.lit(size), F.lit(overlap), *parts), 256))


def _send(ids: DataFrame, rows: int, max_bytes: int) -> DataFrame:
    """Ids of articles for a join: sent to all tasks if they are few, else joined by hash."""
    return F.broadcast(ids) if rows * ARTICLE_ID_BYTES <= max_bytes else ids.hint("shuffle_hash")


@dataclass
class ChunkIndex:
    """An opened index: which of its batches count, and how many of their articles were replaced since."""

    spark: SparkSession
    path: str
    batches: Collection[int]
    inverted: Collection[int]  # those of them that have postings
    replaced_rows: int
    last: int  # the highest number of a batch, whatever became of it; -1 without one
    max_bytes: int = ID_BYTES

    @staticmethod
    def open(spark: SparkSession, path: str, max_bytes: int = ID_BYTES) -> ChunkIndex:
        """Read the small tables; a missing path is an error."""
        states = spark.read.schema(BATCHES).parquet(f"{path}/batches").groupBy("batch").agg(F.collect_set("state").alias("states")).collect()
        batches = sorted(row["batch"] for row in states if ADDED in row["states"] and RETIRED not in row["states"])
        inverted = {row["batch"] for row in states if INVERTED in row["states"]} & set(batches)
        index = ChunkIndex(spark, path, batches, inverted, 0, max((row["batch"] for row in states), default=-1), max_bytes)
        index.replaced_rows = index.replaced().count()
        return index

    def _of_batches(self, name: str, schema, batches: Collection[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return rows.filter(F.col("batch").isin(list(self.batches if batches is None else batches)))

    def replaced(self) -> DataFrame:
        """``text_id, batch``: the articles that a later batch replaced, in the batch they lie in."""
        rows = self._of_batches("replaced", REPLACED_ARTICLES).filter(F.col("old").isin(list(self.batches)))
        return rows.select("text_id", F.col("old").alias("batch"))

    def current(self, rows: DataFrame) -> DataFrame:
        """The rows, by their ``text_id`` and ``batch``, of articles that were not replaced."""
        if not self.replaced_rows:
            return rows
        return rows.join(_send(self.replaced(), self.replaced_rows, self.max_bytes), ["text_id", "batch"], "left_anti")

    def articles(self) -> DataFrame:
        """``text_id, version, batch`` of each article as it is now: a narrow table."""
        return self.current(self._of_batches("articles", ARTICLE_VERSIONS))

    def chunks(self) -> DataFrame:
        """The chunks of each article as it is now, with the ``_metadata`` of their files as a column.

        Without replaced articles the table is scanned as it is. Else these are taken out by a join that shuffles no chunks if they
        are few.
        """
        # As a column, as a join would hide it.
        return self.current(self._of_batches("chunks", CHUNK_INDEX).select("*", "_metadata"))


    def postings(self) -> DataFrame:
        """The inverted form of the index; every batch must have one: see ``invert_index``."""
        missing = set(self.batches) - set(self.inverted)
        if missing:
            raise ValueError(f"batches without postings: {sorted(missing)}")
        rows = self._of_batches("postings", POSTINGS)
        if not self.replaced_rows:
            return rows
        return postings.without_replaced(rows, _send(self.replaced(), self.replaced_rows, self.max_bytes))


def _index_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(BATCHES).parquet(f"{path}/batches")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def new_articles(articles: DataFrame, index: ChunkIndex | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                 max_bytes: int = ID_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """Articles that the index does not hold as they are now, each id once; ``text_id, version, old`` of these; how many they are.

    ``old`` is the batch of the version that one replaces, null for an article that is new.

    Ids and versions decide, before anything is chunked: they are computed once and compared with the narrow table of the index,
    and what is new is stored. If the new ones are few they are sent to all tasks, and the texts of the articles are not shuffled. Of several
    versions of one id in a batch the lowest is taken; only the rows of such ids are brought together.
    """
    versions = with_version(articles, size, overlap).select("text_id", "version")
    narrow = versions.groupBy("text_id").agg(F.min("version").alias("version"), F.count("*").alias("times"))
    if index is None:
        narrow = narrow.withColumn("old", F.lit(None).cast("long"))
    else:
        held = index.articles().select("text_id", F.col("version").alias("held"), F.col("batch").alias("old"))
        narrow = narrow.join(held, "text_id", "left").filter("held IS NULL OR held <> version").drop("held")
    fresh = stored(narrow, "fresh_articles")
    rows, repeated = fresh.agg(F.count("*"), F.count_if(F.col("times") > 1)).first()
    # The version comes with the id, so that it is not computed again; where ids repeat it tells which row is meant.
    wanted = fresh.select("text_id", "version")
    found = articles.drop("version")
    if not repeated:
        return found.join(_send(wanted, rows, max_bytes), "text_id"), fresh, rows
    repeats = fresh.filter("times > 1").select("text_id", "version")
    single = found.join(_send(fresh.filter("times = 1").select("text_id", "version"), rows - repeated, max_bytes), "text_id")
    several = with_version(found, size, overlap).join(_send(repeats, repeated, max_bytes), ["text_id", "version"], "left_semi")
    return single.unionByName(several.dropDuplicates(["text_id"])), fresh, rows


def append_to_index(
    articles: DataFrame, path: str, embed: Callable[[DataFrame], DataFrame] = embed_chunks,
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, max_bytes: int = ID_BYTES,
) -> int | None:
    """Chunk, embed and add the articles that the index at ``path`` does not hold as they are now, creating it if need be.

    Running it again, or over articles that overlap an earlier run, adds nothing twice. An article whose text or
    metadata has changed, or that is cut in another way, is added anew under its id; readers take the newest version.
    Returns the number of the batch, None if nothing was new. One run at a time may write to an index.
    """
    spark = articles.sparkSession
    index = ChunkIndex.open(spark, path, max_bytes) if _index_exists(spark, path) else None
    fresh, added, rows = new_articles(articles, index, size, overlap, max_bytes)
    if index is not None and not rows:
        return None
    batch = 0 if index is None else index.last + 1
    _add_states(spark, path, [batch], STARTED)
    chunks = chunk_articles(fresh, size, overlap)
    for name, rows_of_table in [
        ("chunks", embed(chunks).select(*(name for name in CHUNK_INDEX.names if name != "batch"))),
        # An article without a chunk is known as well, so that it is not looked at again.
        ("articles", added.select("text_id", "version")),
        ("replaced", added.filter("old IS NOT NULL").select("text_id", "old")),
    ]:
        # Into the batch's directory by name: as a partition column the batch would have the rows sorted by it.
        rows_of_table.write.parquet(f"{path}/{name}/batch={batch}")
    _add_states(spark, path, [batch], ADDED)
    return batch


def _overwrite_batches(rows: DataFrame, path: str) -> None:
    """Rows with a ``batch`` in place of what the directories of their batches held; other directories stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def _add_states(spark: SparkSession, path: str, batches: Collection[int], state: str) -> None:
    rows = spark.createDataFrame([(batch, state) for batch in batches], BATCHES)
    rows.coalesce(1).write.mode("append").parquet(f"{path}/batches")


def invert_index(spark: SparkSession, path: str, block_chunks: int = postings.BLOCK_CHUNKS) -> list[int]:
    """Write the postings of the batches that have none; returns their numbers."""
    index = ChunkIndex.open(spark, path)
    missing = [batch for batch in index.batches if batch not in index.inverted]
    if missing:
        postings.write_postings(index._of_batches("chunks", CHUNK_INDEX, missing), f"{path}/postings", block_chunks)
        _add_states(spark, path, missing, INVERTED)
    return missing


def compact_index(spark: SparkSession, path: str, max_bytes: int = ID_BYTES) -> list[int]:
    """Take the replaced articles out of the files of an index; returns the batches that were written anew or retired.

    Only batches that hold replaced articles are read and overwritten, each directory by itself. A batch of which nothing is left is
    retired. Readers find the same rows before and after, also if a run is cut short: what was replaced is taken out by a join
    until the last step forgets it, when no file holds it. Files of retired batches belong to no reader.
    """
    index = ChunkIndex.open(spark, path, max_bytes)
    if not index.replaced_rows:
        return []
    touched = sorted(row["batch"] for row in index.replaced().select("batch").distinct().collect())  # not more than batches
    kept = stored(index.current(index._of_batches("articles", ARTICLE_VERSIONS, touched)), "kept_articles")
    left = {row["batch"] for row in kept.select("batch").distinct().collect()}
    chunks = index.current(index._of_batches("chunks", CHUNK_INDEX, left))
    _overwrite_batches(chunks.select(*CHUNK_INDEX.names), f"{path}/chunks")
    _overwrite_batches(kept, f"{path}/articles")
    inverted = [batch for batch in index.inverted if batch in left]
    if inverted:
        postings.write_postings(index._of_batches("chunks", CHUNK_INDEX, inverted), f"{path}/postings")
    _add_states(spark, path, [batch for batch in touched if batch not in left], RETIRED)
    spark.createDataFrame([], REPLACED_ARTICLES).write.mode("overwrite").parquet(f"{path}/replaced")
    return touched


def open_chunk_index(spark: SparkSession, path: str, max_bytes: int = ID_BYTES) -> DataFrame:
    """The chunks in the stored index, of the newest version of each article; a missing path is an error."""
    return ChunkIndex.open(spark, path, max_bytes).chunks()
