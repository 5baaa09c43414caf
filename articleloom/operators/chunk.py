"""Overlapping chunks of article content."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleloom.functions.text import text_or

# Chunk size and overlap in characters.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200

MISSING = "N/A"

TEXTS_AT_ONCE = 256  # of an Arrow batch, held as Python objects


def _spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of each chunk, in time linear in the text.

    The text is cut into pieces before every space. Chunks are runs of whole pieces, as many
    as fit in ``size``; the next chunk takes back as many pieces as fit in ``overlap`` and leave
    room for the piece that did not fit. A piece of ``size`` or more is a run by itself, cut
    every ``size - overlap`` characters.
    """
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) == 32)
    cuts = np.concatenate([spaces if len(spaces) and spaces[0] == 0 else np.append(0, spaces), [len(text)]])
    oversize = np.flatnonzero(np.diff(cuts) >= size).tolist()
    edges = cuts.tolist()
    pieces = len(edges) - 1
    spans = []
    first = 0
    for stop in [*oversize, pieces]:
        # Pieces first..stop-1 are all shorter than a chunk; edges[i + 1] ends piece i.
        while first < stop:
            last = bisect_right(edges, edges[first] + size, first + 1, stop + 1) - 1
            spans.append((edges[first], edges[last]))
            if last == stop:
                break
            first = bisect_left(edges, max(edges[last] - overlap, edges[last + 1] - size), first + 1, last)
        if stop < pieces:
            a, b = edges[stop], edges[stop + 1]
            spans.extend((cut, min(cut + size, b)) for cut in range(a, b - overlap, size - overlap))
        first = stop + 1
    return spans


def _cut_few(texts: pa.Array, size: int, overlap: int) -> pa.Array:
    chunks = []
    for text in texts.to_pylist():
        parts = (text[a:b].strip() for a, b in _spans(text, size, overlap)) if text else ()
        chunks.append([part for part in parts if part])
    return pa.array(chunks, pa.list_(pa.string()))


def cut_batch(texts: pa.Array, size: int, overlap: int) -> pa.Array:
    """The chunks of an Arrow batch of texts, of which few at a time are Python objects."""
    cuts = [_cut_few(texts.slice(start, TEXTS_AT_ONCE), size, overlap) for start in range(0, len(texts), TEXTS_AT_ONCE)]
    return pa.concat_arrays(cuts) if cuts else pa.array([], pa.list_(pa.string()))


def chunk_texts(content: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """The chunks of cleaned content as ``array<string>``; empty or null content has none.

    Where a chunk starts depends on where the one before ended, so this is a loop over one
    text. As a fold over Spark arrays it takes substrings by character position, which costs
    the square of the text length; here Arrow batches of whole texts are cut in linear time.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        return cut_batch(texts, size, overlap)

    return cut(content)


def chunk_articles(articles: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk with the article's metadata as text; "N/A" where it is missing."""

    def metadata(name: str, alias: str) -> Column:
        column = F.col(name) if name in articles.columns else F.lit(None)
        return text_or(column, MISSING).alias(alias)

    return (
        articles.select(
            "text_id",
            *(name for name in ["version"] if name in articles.columns),
            metadata("pmid", "pmid"),
            metadata("title", "title"),
            metadata("journal", "journal"),
            metadata("year", "year"),
            metadata("ref_id", "source"),
            chunk_texts(F.col("content"), size, overlap).alias("chunks"),
        )
        # The outer form keeps Catalyst from deriving a size filter on the chunks, which
        # would compute them a second time below the generator.
        .select("*", F.posexplode_outer("chunks").alias("chunk_ix", "page_content"))
        .filter(F.col("page_content").isNotNull())
        .select(
            F.concat_ws("#", "text_id", F.col("chunk_ix").cast("string")).alias("chunk_id"),
            "text_id", *(name for name in ["version"] if name in articles.columns),
            "pmid", "title", "journal", "year", "source", "chunk_ix", "page_content",
        )
    )


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Chunks per article."""
    return chunks.groupBy("pmid").agg(F.count("*").alias("chunk_count"))
