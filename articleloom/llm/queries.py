"""One query for each operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articleloom.llm import (
    ann, lexical, line_dedup, mixing, ngram_join, packing, pii, quality_rules, sharding, spelling, token_counts, toxicity, warc)
from articleloom.sources.scratch import scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(_documents(spark, sf_dir)).drop("row_number")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return toxicity.toxicity(documents, toxicity.train(documents, _labels(spark, sf_dir)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return pii.span_digest(pii.personal_data(documents, pii.train(documents)))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    forest = quality_rules.train(documents, _labels(spark, sf_dir))
    return quality_rules.quality_verdicts(documents, forest)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies in the order of their keys, without the texts."""
    mix = mixing.mixed(_documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mix.select("doc_id", "source", "mix_copy", "mix_copies", F.round("mix_rate", 6).alias("mix_rate"), "mix_key")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the lines that are removed from each document, as text; every line that has a word takes part."""
    found = line_dedup.removed_lines(_documents(spark, sf_dir), least=1)
    return found.select(
        "doc_id", F.col("lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
        F.array_join("removed", ",").alias("removed_lines"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, sf_dir))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives hold when they are read back; payloads are checked there and not carried on."""
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.page_records(warc.read_archives(spark, path, payloads=False))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_sharding, op2_toxicity, op3_token_counts, op4_personal_data, op5_quality_rules,
        op6_nearest_neighbours, op7_mixing, op8_best_fit_packing, op9_ngram_join, op10_line_dedup,
        op11_spelling_variants, op12_warc, op13_lexical_search)
}
