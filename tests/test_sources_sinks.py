"""Tables in and out."""

import gzip
import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from articleloom.operators.report import domain_count
from articleloom.schemas import ARTICLES, SUMMARY
from articleloom.sources import scratch, sinks, tables
from checks.inputs import spread


def articles(spark, rows):
    df = spark.createDataFrame(rows, "text_id string, domain string, year string")
    for name in ("ref_id", "pmid", "title", "journal", "content"):
        df = df.withColumn(name, F.concat(F.lit(f"{name} "), "text_id"))
    return (df.withColumn("text_length", F.length("content")).withColumn("processed_time", F.current_timestamp())
            .select(*ARTICLES.names))


ROWS = [("1", "neurology", "2001"), ("2", "neurology", "unknown"), ("3", "oncology", ""), ("4", "oncology", None)]


def test_partitioned_roundtrip(spark, tmp_path):
    path = str(tmp_path / "articles")
    written = articles(spark, ROWS)
    sinks.write_articles(written, path)
    read = tables.read_partitioned_articles(spark, path)
    assert read.schema["year"].dataType.simpleString() == "string"
    assert read.columns == ARTICLES.names
    assert sorted((row["text_id"], row["domain"], row["year"]) for row in read.collect()) == [
        ("1", "neurology", "2001"), ("2", "neurology", "unknown"), ("3", "oncology", None), ("4", "oncology", None)]
    assert all(file.name.endswith(".gz.parquet") for file in (tmp_path / "articles").rglob("part-*"))
    sinks.write_articles(written.limit(1), path)
    assert tables.read_partitioned_articles(spark, path).count() == 1


def test_domain_filter_reads_one_directory(spark, tmp_path):
    path = str(tmp_path / "articles")
    sinks.write_articles(articles(spark, ROWS), path)
    counted = domain_count(tables.read_partitioned_articles(spark, path), "neurology")
    scan = next(line for line in plan_of(counted).splitlines() if "FileScan" in line)
    assert "domain" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert counted.first()[0] == 2


def test_hot_domain_is_written_by_several_tasks(spark, tmp_path):
    """Small limits stand for large data: one directory gets most rows and more than one task."""
    path = str(tmp_path / "articles")
    df = spark.range(0, 20_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text_id"),
        F.when(F.col("id") % 10 == 0, "oncology").otherwise("neurology").alias("domain"), F.lit("2001").alias("year"))
    for name in ("ref_id", "pmid", "title", "journal", "content"):
        df = df.withColumn(name, F.sha2("text_id", 512))
    df = df.withColumn("text_length", F.lit(1)).withColumn("processed_time", F.current_timestamp())
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1MB")
    try:
        sinks.write_articles(df.select(*ARTICLES.names), path)
    finally:
        spark.conf.set(size, before)
    files = {domain: len(list((tmp_path / "articles" / f"domain={domain}").rglob("part-*"))) for domain in ("neurology", "oncology")}
    assert files["neurology"] > 3
    assert tables.read_partitioned_articles(spark, path).count() == 20_000


def test_rows_per_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 10)
    sinks.write_articles(articles(spark, [(str(i), "neurology", "2001") for i in range(35)]), str(tmp_path / "a"))
    assert len(list((tmp_path / "a").rglob("part-*"))) == 4


def test_summary_json(spark, tmp_path):
    path = tmp_path / "summary"
    sinks.write_summary(articles(spark, ROWS), str(path))
    files = list(path.rglob("part-*"))
    assert files and all(file.name.endswith(".json.gz") for file in files)
    line = json.loads(gzip.open(next((path / "domain=oncology").glob("part-*"))).readline())
    assert set(line) <= {"text_id", "pmid", "title", "year", "journal"}
    read = spark.read.schema(SUMMARY).json(str(path)).select(*SUMMARY.names)
    assert sorted(map(tuple, read.collect()), key=str) == sorted(
        map(tuple, sinks.article_summary(articles(spark, ROWS)).collect()), key=str)


@pytest.mark.parametrize("rows, partitions", [(0, 10), (499_999, 10), (550_000, 11), (10_000_000, 200), (10**12, 200)])
def test_sizing_rule(spark, rows, partitions):
    assert spark.range(1).select(sinks.output_partition_count(F.lit(rows))).first()[0] == partitions


def test_tree_of_files_skips_what_cannot_be_read(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",)], "content string").write.parquet(str(tmp_path / "x" / "y"))
    spark.createDataFrame([("c",)], "content string").write.parquet(str(tmp_path / "z"))
    (tmp_path / "x" / "broken.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    (tmp_path / "x" / "note.txt").write_text("not parquet")
    schema = spark.createDataFrame([], "content string, year string").schema
    rows = tables.read_parquet_tree(spark, str(tmp_path), schema).collect()
    assert sorted(map(tuple, rows)) == [("a", None), ("b", None), ("c", None)]
    skipped = {row["path"] for row in tables.skipped_files(spark, str(tmp_path), schema).collect()}
    # The others hold no row: tasks without any write such files.
    assert str(tmp_path / "x" / "broken.parquet") in skipped
    assert not skipped & set(tables.read_parquet_tree(spark, str(tmp_path), schema).select(
        F.regexp_replace("_metadata.file_path", "^file:/+", "/")).distinct().toPandas().iloc[:, 0])
    with pytest.raises(ValueError, match="could be read"):
        (tmp_path / "only").mkdir()
        (tmp_path / "only" / "broken.parquet").write_bytes(b"no parquet")
        tables.read_parquet_tree(spark, str(tmp_path / "only"), schema)


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, title string")
    b = spark.createDataFrame([("y", 2)], "journal string, id int")
    assert sorted(map(tuple, tables.union_sources([a, b, a]).collect())) == [(1, "x", None), (1, "x", None), (2, None, "y")]


def test_wide_scans_are_not_shuffled(spark, tmp_path):
    spark.range(100).repartition(12).write.parquet(str(tmp_path / "wide"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        wide = spark.read.parquet(str(tmp_path / "wide"))
        assert "Exchange" not in plan_of(spread(wide))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert "Exchange" in plan_of(spread(spark.read.parquet(str(tmp_path / "wide")).coalesce(1)))


def test_scratch_is_under_the_checkpoint_folder(spark):
    path = scratch.scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path.endswith("/x")
    assert scratch.scratch_path(spark, "x") != path


def test_scratch_without_the_setting_is_in_the_warehouse():
    conf = SimpleNamespace(get=lambda key, default=None: "file:/shared/warehouse/" if key == scratch.WAREHOUSE_DIR else default)
    session = lambda master: SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
    path = scratch.scratch_path(session("local[2]"), "x")
    assert path.startswith("file:/shared/warehouse/articleloom/") and path.endswith("/x")
    with pytest.raises(ValueError, match="all executors share"):
        scratch.scratch_path(session("spark://host:7077"), "x")
