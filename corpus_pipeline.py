"""The corpus pipeline: stages that each apply one operator to all that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. ``run``
writes each stage as Parquet and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import articleloom
from articleloom.llm import line_dedup as lines
from articleloom.llm import mixing as mix
from articleloom.llm import ngram_join as join
from articleloom.llm import packing
from articleloom.llm import toxicity as toxic
from articleloom.sources.scratch import stored

# Tasks get the package's functions by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(articleloom)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by the model learnt from the labels of the rows at hand."""
    model = toxic.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic.without_toxic(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is similar to; one that loses all its words goes."""
    return lines.without_lines(docs, least=1)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return join.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in shuffled order."""
    return mix.mixed(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of 4,096 tokens; each copy of a document is packed."""
    return packing.best_fit(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

# Tokens of a library's vocabulary cannot be counted in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
