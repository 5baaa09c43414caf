"""Embedding by a model that workers load from shared storage, with a hashed random projection as the model.

The model is a matrix of signs, a row for each bucket of the term counts. ``predict_batch_udf`` loads it once in a Python worker and
gives it batches of counts; another model is another ``make_predict_fn`` over its own files.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow.dataset as ds
from pyarrow.fs import FileSystem
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleloom.functions.embedding import DIMS, term_vector

PROJECTED = 64
BATCH = 1024


def write_projection(spark: SparkSession, path: str, size: int = PROJECTED, dims: int = DIMS) -> None:
    """Write the model: of each bucket its signs, by the first bit of the md5 of bucket and position."""
    def sign(position: Column) -> Column:
        digest = F.md5(F.concat_ws("/", F.col("id"), position).cast("binary"))
        return F.when(F.substring(digest, 1, 1) < "8", 1.0).otherwise(-1.0).cast("float")

    signs = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), sign)
    spark.range(dims).coalesce(1).select(F.col("id").cast("int").alias("bucket"), signs.alias("signs")).write.parquet(path)


def projection_model(path: str) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """What a worker does first: read the model; then, for each batch of counts, multiply."""

    def make_predict_fn() -> Callable[[np.ndarray], np.ndarray]:
        files, local = FileSystem.from_uri(path)
        rows = ds.dataset(local, filesystem=files, format="parquet").to_table().sort_by("bucket")
        matrix = np.stack(rows["signs"].to_numpy())

        def predict(counts: np.ndarray) -> np.ndarray:
            return counts @ matrix

        return predict

    return make_predict_fn


def projected_vector(text: Column, path: str, dims: int = DIMS, batch: int = BATCH) -> Column:
    """The model's vector of a text as ``array<float>``; a null text is one without terms, which is all zero.

    The counts are whole numbers and the model's entries are signs, so the vectors are exact.
    """
    model = predict_batch_udf(
        projection_model(path), return_type=T.ArrayType(T.FloatType()), batch_size=batch, input_tensor_shapes=[[dims]])
    return model(term_vector(text, dims))


def embed_by_projection(chunks: DataFrame, path: str) -> DataFrame:
    """Chunks with the model's vectors as ``embedding``, as ``append_to_index`` takes a way to embed. No shuffle."""
    return chunks.withColumn("embedding", projected_vector(F.col("page_content"), path))
