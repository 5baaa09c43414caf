"""Explicit schemas: nothing is inferred, so types never drift with the data."""

from __future__ import annotations

from pyspark.sql import types as T

# Elements with inline markup (titles, paragraphs, body) are declared as strings:
# the XML source then returns their inner markup in document order.
# The elements' names.
RAW_ARTICLE = T.StructType([
    T.StructField("front", T.StructType([
        T.StructField("journal-meta", T.StructType([
            T.StructField("journal-title-group", T.StructType([
                T.StructField("journal-title", T.StringType()),
            ])),
        ])),
        T.StructField("article-meta", T.StructType([
            T.StructField("article-id", T.ArrayType(T.StructType([
                T.StructField("_VALUE", T.StringType()),
                T.StructField("_pub-id-type", T.StringType()),
            ]))),
            T.StructField("title-group", T.StructType([
                T.StructField("article-title", T.StringType()),
            ])),
            T.StructField("pub-date", T.ArrayType(T.StructType([
                T.StructField("_pub-type", T.StringType()),
                T.StructField("year", T.StringType()),
            ]))),
            T.StructField("abstract", T.ArrayType(T.StructType([
                T.StructField("p", T.ArrayType(T.StringType())),
            ]))),
        ])),
    ])),
    T.StructField("body", T.StringType()),
])

# A year is text everywhere: "unknown" is no number. The names of the columns.
ARTICLES = T.StructType([
    T.StructField("text_id", T.StringType()),
    T.StructField("ref_id", T.StringType()),
    T.StructField("pmid", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("journal", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("text_length", T.IntegerType()),
    T.StructField("processed_time", T.TimestampType()),
])

# Fixed values.
SUMMARY_COLUMNS = ["text_id", "pmid", "title", "domain", "year", "journal"]

SUMMARY = T.StructType([T.StructField(name, T.StringType()) for name in SUMMARY_COLUMNS])

# One row per chunk. `version` names what the article was when it was cut, `batch` the run that added it.
CHUNK_INDEX = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("text_id", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("pmid", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("journal", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("chunk_ix", T.IntegerType()),
    T.StructField("page_content", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

# The inverted form of the index: a row for each block of chunks and each bucket in it, and a head row for each block.
POSTINGS = T.StructType([
    T.StructField("block", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("batch", T.LongType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("places", T.ArrayType(T.IntegerType())),
    T.StructField("counts", T.ArrayType(T.FloatType())),
    T.StructField("chunk_ids", T.ArrayType(T.StringType())),
    T.StructField("squares", T.ArrayType(T.DoubleType())),
])

# The small tables of an index: articles by batch, those that a batch replaced and the batch they lie in, and what became of batches.
ARTICLE_VERSIONS = T.StructType([
    T.StructField("text_id", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("batch", T.LongType()),
])

REPLACED_ARTICLES = T.StructType([
    T.StructField("text_id", T.StringType()),
    T.StructField("old", T.LongType()),
    T.StructField("batch", T.LongType()),
])

BATCHES = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("state", T.StringType()),
])
