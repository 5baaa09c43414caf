"""Hashed term counts: the stand-in for an external embedding model.

A text becomes a vector of ``dims`` term counts, each token counted in the bucket its
md5 names. The counts are whole numbers, so dot products and squared norms are exact and
cosine similarity does not depend on the order of summation.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from articleloom.functions.text import tokens

DIMS = 256


def token_bucket(token: str, dims: int = DIMS) -> int:
    """Bucket of one token: the first 32 bits of its md5, modulo ``dims``."""
    return int.from_bytes(md5(token.encode(), usedforsecurity=False).digest()[:4], "big") % dims


def term_vector(text: Column, dims: int = DIMS) -> Column:
    """Term counts of the text as ``array<float>`` of length ``dims``; a text without tokens is all zero.

    Tokens are split by Spark's functions. An Arrow batch of them is counted by numpy, and each
    distinct token of the batch is hashed once: hashing every token as a Spark expression and
    counting took 16 s for what takes 7 s so (409,000 chunks, 8 cores). No shuffle.
    """

    @F.arrow_udf("array<float>")
    def count_terms(tokens: pa.Array) -> pa.Array:
        words = tokens.flatten().dictionary_encode()
        buckets = np.array([token_bucket(word, dims) for word in words.dictionary.to_pylist()], dtype=np.int64)
        rows = np.repeat(np.arange(len(tokens)), np.diff(tokens.offsets.to_numpy()))
        cells = rows * dims + buckets[words.indices.to_numpy()]
        counts = np.bincount(cells, minlength=len(tokens) * dims).astype(np.float32)
        return pa.ListArray.from_arrays(np.arange(len(tokens) + 1, dtype=np.int32) * dims, counts)

    return count_terms(F.coalesce(tokens(text), F.array().cast("array<string>")))


def vector_length(vector: Column) -> Column:
    """Euclidean length; exact up to the square root for a vector of counts."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, count: total + count.cast("double") * count))
