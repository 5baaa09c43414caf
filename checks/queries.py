"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articleloom.functions import text
from articleloom.functions.lexicon import classify
from articleloom.functions.projection import projected_vector, write_projection
from articleloom.functions.text import clean, stable_id
from articleloom.operators import approximate, chunk, context, extract, index, nearest, quality, quantised, report
from articleloom.plans import jobs
from articleloom.plans.articles import process_articles, process_extracted
from articleloom.plans.ask import retrieve, search_chunks, search_postings
from articleloom.schemas import RAW_ARTICLE, SUMMARY
from articleloom.sources import articles_xml, keys, mixed, sinks, tables
from articleloom.sources.scratch import scratch_path, stored
from checks.inputs import (
    LANGUAGE_DEFAULT,
    LANGUAGE_LEXICON,
    extracted_documents,
    extracted_with_gaps,
    questions,
    raw_documents,
    table,
    vector_questions,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_documents(spark, sf_dir).transform(process_extracted)


def processed_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_documents(spark, sf_dir).transform(process_extracted, LANGUAGE_LEXICON, LANGUAGE_DEFAULT)


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir).transform(chunk.chunk_articles)


def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk index of all documents, written once and opened again; articles come from a table, as in the job."""
    path = scratch_path(spark, "chunk_index")
    index.append_to_index(stored(processed(spark, sf_dir), "articles"), path)
    return index.open_chunk_index(spark, path)


# Flagship


@query
def processed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir).drop("processed_time")


# Sources and sinks


def folder_of(ref_id: str) -> Column:
    """The language in the path of a file that ``write_xml`` wrote by language."""
    return F.regexp_extract(ref_id, "lang=([a-z]+)/", 1)


@query
def sample_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one file for each language, of which the first holds German."""
    path = scratch_path(spark, "articles_xml")
    write_xml(by_language(spark, sf_dir).coalesce(1), path)
    sample = articles_xml.sample_articles(spark, path)
    return sample.select(
        folder_of("ref_id").alias("lang"),
        F.array_join("article_ids", "|").alias("article_ids"),
        "article_title",
        F.array_join(F.flatten(F.filter("abstract", lambda p: p.isNotNull())), "|").alias("abstract"),
    )


def as_xml() -> Column:
    """A raw article as XML text; the mark-up in titles, which the writer takes for text, is mark-up again."""
    xml = F.to_xml(F.struct("front", "body"), {"rowTag": "article", "attributePrefix": "_"})
    return F.regexp_replace(xml, "&lt;(/?i)(&gt;|>)", "<$1>")


def write_xml(raw: DataFrame, path: str) -> None:
    """Raw articles as XML files, below a folder for each language if there is such a column."""
    folders = [name for name in ["lang"] if name in raw.columns]
    raw.select(as_xml().alias("value"), *folders).write.partitionBy(*folders).text(path)


def by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents with their language, which ``ref_id`` leads back to."""
    languages = table(spark, sf_dir, "documents").select(F.format_string("doc-%d", "doc_id").alias("ref_id"), "lang")
    return raw_documents(spark, sf_dir).join(languages, "ref_id")


def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as article XML files and read back."""
    path = scratch_path(spark, "articles_xml")
    write_xml(raw_documents(spark, sf_dir), path)
    return articles_xml.read_articles_xml(spark, path)


@query
def xml_roundtrip_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = xml_documents(spark, sf_dir).transform(extract.extract_fields)
    return fields.select("pmid", "article_title", "journal", "year")


@query
def xml_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way from XML files to processed articles."""
    return xml_documents(spark, sf_dir).transform(process_articles).drop("text_id", "ref_id", "processed_time")


@query
def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from XML files to the stored articles."""
    xml, articles, summary = (scratch_path(spark, name) for name in ("articles_xml", "articles", "summary"))
    write_xml(raw_documents(spark, sf_dir), xml)
    jobs.store_articles(spark, xml, articles, summary)
    return tables.read_partitioned_articles(spark, articles).drop("text_id", "ref_id", "processed_time")


@query
def store_empty_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents are stored, then a run without a usable article: the first rows are still there."""
    xml, empty, articles, summary = (scratch_path(spark, name) for name in ("articles_xml", "empty_xml", "articles", "summary"))
    raw = raw_documents(spark, sf_dir)
    write_xml(raw, xml)
    write_xml(raw.withColumn("body", F.lit(None).cast("string")).withColumn("front", F.lit(None).cast(raw.schema["front"].dataType)), empty)
    for path in (xml, empty):
        jobs.store_articles(spark, path, articles, summary)
    return tables.read_partitioned_articles(spark, articles).drop("text_id", "ref_id", "processed_time")


@query
def xml_ref_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each article with the file it came from, of which there is one folder for each language."""
    path = scratch_path(spark, "articles_xml")
    write_xml(by_language(spark, sf_dir), path)
    fields = articles_xml.read_articles_xml(spark, path).transform(extract.extract_fields)
    return fields.select(folder_of("ref_id").alias("lang"), "pmid")


@query
def xml_inequalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents between inequality signs, which are escaped in XML: nothing between them is lost."""
    path = scratch_path(spark, "articles_xml")
    body = F.concat(F.lit("p < 0.05 in "), F.col("body"), F.lit(" and age > 60"))
    write_xml(raw_documents(spark, sf_dir).filter("body IS NOT NULL").withColumn("body", body), path)
    return articles_xml.read_articles_xml(spark, path).transform(process_articles).select("pmid", "content")


@query
def xml_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel over files in which French articles lack an end tag, observed while the parsed articles are written."""
    path = scratch_path(spark, "articles_xml")
    broken = F.when(F.col("lang") == "fr", F.replace(as_xml(), F.lit("</front>"), F.lit(""))).otherwise(as_xml())
    by_language(spark, sf_dir).select(broken.alias("value")).write.text(path)
    _, funnel = jobs.parse_articles(spark, path, scratch_path(spark, "extracted"))
    return spark.createDataFrame([funnel], ", ".join(f"{name} bigint" for name in funnel))


@query
def processed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir).select("pmid", F.col("processed_time").isNotNull().alias("is_stamped"))


@query
def report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports of the job over the stored articles, in one table."""
    path = scratch_path(spark, "articles")
    sinks.write_articles(processed_by_language(spark, sf_dir), path)
    reports = jobs.report_articles(spark, path, "french")
    shapes = {
        "overview": ("domain", F.concat_ws(" ", "document_count", F.round("avg_length", 3).cast("decimal(20,3)"))),
        "years": ("year", F.col("count").cast("string")),
        "sample_titles": ("domain", F.col("sample_title")),
        "domain_count": (F.lit("french"), F.col("document_count").cast("string")),
    }
    frames = [reports[name].select(F.lit(name).alias("report"), F.lit(key).alias("key") if not isinstance(key, str) else F.col(key).alias("key"),
                                   value.alias("value")) for name, (key, value) in shapes.items()]
    return tables.union_sources(frames)


@query
def xml_roundtrip_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_documents(spark, sf_dir)
    as_xml = F.to_xml(F.struct("front", "body"), {"rowTag": "article", "attributePrefix": "_"})
    parsed = raw.select("ref_id", as_xml.alias("xml")).select(
        "ref_id", F.from_xml("xml", RAW_ARTICLE, articles_xml.READ_OPTIONS).alias("article"))
    return (
        parsed.select("article.*", "ref_id").transform(extract.extract_fields)
        .select("ref_id", "year", "pmid")
    )


@query
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "articles")
    sinks.write_articles(processed_by_language(spark, sf_dir), path)
    return tables.read_partitioned_articles(spark, path).drop("processed_time")


@query
def parquet_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below nested folders are read as they are; the folders' names are no columns."""
    path = scratch_path(spark, "tree")
    documents = table(spark, sf_dir, "documents")
    documents.select("doc_id", "text", "lang", "source").write.partitionBy("lang", "source").parquet(path)
    return tables.read_parquet_tree(spark, path, documents.select("doc_id", "text", "source").schema)


@query
def tree_mixed_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in files by language, with columns that differ in type and order or are missing."""
    path = scratch_path(spark, "tree")
    documents = stored(table(spark, sf_dir, "documents"), "documents")
    shapes = {
        "de": ["int(doc_id) AS doc_id", "text", "n_chars / 4 AS size", "source"],
        "fr": ["source", "string(doc_id) AS label", "n_chars AS size", "doc_id"],
        "es": ["doc_id", "smallint(n_chars % 1000) AS size", "n_chars > 500 AS label", "array(text, source) AS text"],
    }
    documents.filter(~F.col("lang").isin(list(shapes))).selectExpr("doc_id", "text", "n_chars AS size").write.parquet(f"{path}/rest")
    for lang, columns in shapes.items():
        documents.filter(F.col("lang") == lang).selectExpr(*columns).write.parquet(f"{path}/deep/{lang}")
    return mixed.read_mixed_tree(spark, path).rows


@query
def skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of the one file among the documents' that cannot be read."""
    path = scratch_path(spark, "tree")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    documents.write.partitionBy("lang").parquet(path)
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(f"{path}/lang=de/broken.parquet")
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file)
    stream.write(bytearray(b"no Parquet file"))
    stream.close()
    skipped = tables.skipped_files(spark, path, documents.drop("lang").schema)
    return skipped.select(F.element_at(F.split("path", "/"), -1).alias("file"))


@query
def summary_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    sinks.write_summary(processed_by_language(spark, sf_dir), path)
    return spark.read.schema(SUMMARY).json(path).select(*SUMMARY.names)


@query
def output_partition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.output_partition_plan(table(spark, sf_dir, "lineitem"))


@query
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("key"), clean(F.col("text")).alias("content"),
        F.col("source").alias("journal"))
    pages = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("key"), clean(F.col("html")).alias("content"), "url")
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("origin"), F.col("conv_id").alias("key"), clean(F.col("text")).alias("content"))
    return tables.union_sources([documents, pages, turns])


@query
def index_incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are added, then documents and pages together: only the pages are new."""
    path = scratch_path(spark, "chunk_index")
    documents = stored(processed(spark, sf_dir), "articles")
    pages = table(spark, sf_dir, "pages").select(
        stable_id(F.lit("page"), F.col("page_id").cast("string")).alias("text_id"),
        F.col("page_id").cast("string").alias("pmid"), clean(F.col("html")).alias("content"), F.col("url").alias("ref_id"))
    for articles in (documents, tables.union_sources([documents, pages])):
        index.append_to_index(articles, path)
    return index.open_chunk_index(spark, path).groupBy("pmid", "title", "source").agg(
        F.count("*").alias("chunk_count"), F.sum(F.length("page_content")).alias("characters"))


@query
def index_changed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are added, then again with German texts changed: each article has the chunks of its latest text."""
    path = scratch_path(spark, "chunk_index")
    documents = stored(processed(spark, sf_dir), "articles")
    german = F.col("title").endswith(" in de")
    changed = documents.withColumn("content", F.when(german, F.concat(F.lit("neu und "), F.col("content"))).otherwise(F.col("content")))
    for articles in (documents, changed):
        index.append_to_index(articles, path)
    return index.open_chunk_index(spark, path).select("pmid", "chunk_ix", "page_content")


@query
def index_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``index_changed_articles``, from files out of which the replaced articles were taken."""
    path = scratch_path(spark, "chunk_index")
    documents = stored(processed(spark, sf_dir), "articles")
    german = F.col("title").endswith(" in de")
    changed = documents.withColumn("content", F.when(german, F.concat(F.lit("neu und "), F.col("content"))).otherwise(F.col("content")))
    for articles in (documents, changed):
        index.append_to_index(articles, path)
    index.compact_index(spark, path)
    return index.open_chunk_index(spark, path).select("pmid", "chunk_ix", "page_content")


def built_index(spark: SparkSession, sf_dir: str) -> str:
    """The path of an index that the job built from stored articles."""
    articles, path = scratch_path(spark, "articles"), scratch_path(spark, "chunk_index")
    sinks.write_articles(processed_by_language(spark, sf_dir), articles)
    jobs.build_index(spark, articles, path)
    return path


@query
def index_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.open_chunk_index(spark, built_index(spark, sf_dir)).select("pmid", "chunk_ix", "page_content")


@query
def corpus_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.index_status(stored_index(spark, sf_dir))


# Extraction and cleaning


@query
def extract_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_documents(spark, sf_dir).transform(extract.extract_fields).select(
        "ref_id", "pmid", "article_title", "journal", "year")


@query
def abstract_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_documents(spark, sf_dir).transform(extract.extract_fields).select("ref_id", "citation_text")


@query
def stable_text_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_documents(spark, sf_dir).select(
        "ref_id", stable_id(F.col("ref_id"), F.col("pmid")).alias("text_id"))


@query
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", clean(F.col("html")).alias("content"))


@query
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clean(F.col("text")).alias("content"))


@query
def text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pages(spark, sf_dir).select("page_id", F.length("content").alias("text_length"))


@query
def classify_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(spark, sf_dir).select("doc_id", classify(F.col("content")).alias("domain"))


@query
def classify_custom_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(spark, sf_dir).select(
        "doc_id", classify(F.col("content"), LANGUAGE_LEXICON, LANGUAGE_DEFAULT).alias("domain"))


def large_lexicon(spark: SparkSession, sf_dir: str) -> list[tuple[str, list[str]]]:
    """A domain for each brand of part with the parts' names, then one for each first letter with the longer words of benchmark items."""
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("domain"), F.col("p_name").alias("word"))
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), 0)).alias("word"))
    entries = parts.unionByName(words.select(F.concat(F.lit("Letter "), F.substring("word", 1, 1)).alias("domain"), "word")).distinct()
    found = entries.groupBy("domain").agg(F.sort_array(F.collect_list("word")).alias("words")).orderBy("domain").collect()
    return [(row["domain"], row["words"]) for row in found]


@query
def classify_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = large_lexicon(spark, sf_dir)
    return clean_documents(spark, sf_dir).select("doc_id", classify(F.col("content"), lexicon, "none", automaton=True).alias("domain"))


@query
def title_from_citation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(spark, sf_dir).select("doc_id", text.title_from_citation(F.col("content")).alias("title"))


# Filters, funnel, deduplication


@query
def filter_min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_documents(spark, sf_dir).filter(quality.has_enough_text(F.col("citation_text"))).select("ref_id")


@query
def filter_valid_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_with_gaps(spark, sf_dir).filter(quality.has_key(F.col("pmid"))).select("ref_id", "pmid")


@query
def drop_blank_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German content is blanked and Spanish content is null beforehand."""
    content = F.when(F.col("lang") == "de", " \t\n").when(F.col("lang") != "es", F.col("text"))
    articles = table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return articles.transform(quality.drop_blank_content)


@query
def questions_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the system says in a conversation is blanked beforehand."""
    asked = F.when(F.col("role") == "system", "  ").otherwise(F.col("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", asked.alias("question"))
    return context.valid_questions(turns)


@query
def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_with_gaps(spark, sf_dir).transform(quality.quality_funnel)


@query
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extracted_documents(spark, sf_dir)
    return quality.keep_first(extracted, ["pmid"], [F.col("ref_id")]).select("pmid", "ref_id", "article_title")


@query
def dedup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a stored table, where texts are not shuffled for it."""
    path = scratch_path(spark, "extracted")
    extracted_documents(spark, sf_dir).withColumn("row_id", F.monotonically_increasing_id()).write.parquet(path)
    survivors = quality.keep_first_stored(spark.read.parquet(path), "row_id", "pmid", ["ref_id"])
    return survivors.select("pmid", "ref_id", "article_title", "citation_text")


@query
def dedup_stored_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As if the repeats were too many to send to all tasks."""
    path = scratch_path(spark, "extracted")
    extracted_documents(spark, sf_dir).withColumn("row_id", F.monotonically_increasing_id()).write.parquet(path)
    survivors = quality.keep_first_stored(spark.read.parquet(path), "row_id", "pmid", ["ref_id"], max_bytes=0)
    return survivors.select("pmid", "ref_id", "article_title", "citation_text")


@query
def dedup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all but French documents, then one over all of them: of each key the first row of the first run that has it."""
    known = keys.KeySet.open(spark, scratch_path(spark, "keys"), "pmid", buckets=8)
    documents = extracted_documents(spark, sf_dir)
    path = scratch_path(spark, "survivors")
    for number, rows in enumerate((documents.filter(~F.col("article_title").endswith(" in fr")), documents)):
        found = stored(keys.keep_unknown(rows, known, [F.col("ref_id")]), "unknown")
        known.add(found)
        found.select(F.lit(number).alias("run"), "pmid", "ref_id", "article_title").write.mode("append").parquet(path)
    return spark.read.parquet(path)


# Reports


@query
def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_by_language(spark, sf_dir).transform(report.domain_counts)


@query
def domain_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    overview = processed_by_language(spark, sf_dir).transform(report.domain_overview)
    return overview.withColumn("avg_length", F.round("avg_length", 6))


@query
def year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir).transform(report.year_counts)


@query
def domain_sample_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_by_language(spark, sf_dir).transform(report.domain_sample_titles)


@query
def domain_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the stored table, where it reads one directory."""
    path = scratch_path(spark, "articles")
    sinks.write_articles(processed_by_language(spark, sf_dir), path)
    return report.domain_count(tables.read_partitioned_articles(spark, path), "french")


# Chunks and vectors


@query
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("text_id"), clean(F.col("text")).alias("content"))
    return articles.transform(chunk.chunk_articles).select("chunk_id", "chunk_ix", "page_content")


@query
def chunk_long_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without white space: words of a chunk and more."""
    articles = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("text_id"), F.replace(clean(F.col("text")), F.lit(" "), F.lit("")).alias("content"))
    return articles.transform(chunk.chunk_articles).select("chunk_id", "chunk_ix", "page_content")


@query
def chunk_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir).drop("journal").transform(chunk.chunk_articles).select(
        "chunk_id", "pmid", "title", "journal", "year", "source", "chunk_ix")


@query
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_chunks(spark, sf_dir).transform(chunk.chunk_counts)


def _rounded(weights: DataFrame) -> DataFrame:
    return weights.withColumn("weight", F.round("weight", 6))


@query
def chunk_term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = index.embed_chunks(document_chunks(spark, sf_dir))
    return _rounded(index.term_weights(embedded, "chunk_id"))


@query
def question_term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(index.term_weights(index.embed_questions(questions(spark, sf_dir)), "question_id"))


@query
def chunk_projected_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a model of 16 signs for each bucket, read by the workers from shared storage."""
    path = scratch_path(spark, "projection")
    write_projection(spark, path, 16)
    vectors = document_chunks(spark, sf_dir).select("chunk_id", projected_vector(F.col("page_content"), path).alias("embedding"))
    return vectors.select("chunk_id", F.posexplode("embedding").alias("position", "value")).withColumn("value", F.col("value").cast("double"))


# Search


def _nearest(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    hits = nearest.nearest(vector_questions(spark, sf_dir), vectors, vector_id="vec_id", **options)
    return hits.withColumn("distance", F.round("distance", 6))


@query
def knn_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, metric="l2")


@query
def knn_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, metric="cosine")


def in_slices(spark: SparkSession, sf_dir: str) -> int:
    """A bound that cuts the vectors into three slices or four."""
    return max(1, table(spark, sf_dir, "embeddings").count() * 72 * 8 // 3)


@query
def knn_l2_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As for a batch of questions that is too large to send to all tasks at once: in several slices."""
    return _nearest(spark, sf_dir, metric="l2", max_bytes=in_slices(spark, sf_dir))


@query
def knn_cosine_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, metric="cosine", max_bytes=in_slices(spark, sf_dir))


@query
def knn_fifty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More neighbours than a page shows."""
    vectors = table(spark, sf_dir, "embeddings")
    asked = vector_questions(spark, sf_dir).withColumn("top_k", F.lit(50))
    return nearest.nearest(asked, vectors, vector_id="vec_id").withColumn("distance", F.round("distance", 6))


@query
def knn_quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a scan of bytes, with what their bounds leave open measured on the vectors."""
    path = scratch_path(spark, "quantised")
    quantised.write_quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), path)
    hits = quantised.nearest_quantised(vector_questions(spark, sf_dir), spark.read.parquet(path), vector_id="vec_id")
    return hits.withColumn("distance", F.round("distance", 6))


@query
def knn_approximate_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether hashing finds nine tenths of the nearest neighbours of all vectors, found by the exact search."""
    vectors = stored(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vectors")
    asked = vector_questions(spark, sf_dir)
    exact = stored(nearest.nearest(asked, vectors, vector_id="vec_id"), "exact")
    found = approximate.nearest_approximate(asked, vectors, vector_id="vec_id")
    return approximate.recall_of(found, exact, "vec_id").select("questions", (F.col("recall") >= 0.9).alias("reached"))


@query
def knn_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors nearest to the mean of all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    means = (
        vectors.select(F.posexplode("embedding").alias("position", "value"))
        .groupBy("position").agg(F.avg(F.col("value").cast("double")).alias("mean"))
        .orderBy("position").collect()  # one row per component
    )
    hits = nearest.nearest_to_one(vectors, [row["mean"] for row in means], vector_id="vec_id")
    return hits.withColumn("distance", F.round("distance", 6))


@query
def text_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = index.embed_chunks(document_chunks(spark, sf_dir))
    hits = search_chunks(questions(spark, sf_dir), chunks)
    return hits.withColumn("distance", F.round("distance", 6))


@query
def text_search_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hits from the inverted index, to which French texts were added in another form first."""
    path = scratch_path(spark, "chunk_index")
    documents = stored(processed(spark, sf_dir), "articles")
    french = documents.filter(F.col("title").endswith(" in fr")).withColumn("content", F.upper("content"))
    for articles in (french, documents):
        index.append_to_index(articles, path)
    index.invert_index(spark, path)
    hits = search_postings(questions(spark, sf_dir), index.ChunkIndex.open(spark, path))
    return hits.withColumn("distance", F.round("distance", 6))


def _retrieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve(questions(spark, sf_dir), stored_index(spark, sf_dir))


@query
def rag_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.prompts(_retrieved(spark, sf_dir))


@query
def reference_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.references(_retrieved(spark, sf_dir))


@query
def answered_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The references of the whole job, with questions in slices and hits as if they were too many to send."""
    path = built_index(spark, sf_dir)
    _, references = jobs.answer_questions(
        questions(spark, sf_dir), path, scratch_path(spark, "answers"), max_bytes=50_000, few_hits=False)
    return references


@query
def reference_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.reference_labels(context.references(_retrieved(spark, sf_dir)))
