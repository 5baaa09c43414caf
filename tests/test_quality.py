"""Filters, funnel, deduplication, reports and text columns."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from articleloom.functions.text import snippet, title_from_citation
from articleloom.operators import quality, report
from articleloom.plans.articles import process_extracted

EXTRACTED = "pmid string, article_title string, journal string, year string, citation_text string, ref_id string"


def extracted(spark, rows):
    return spark.createDataFrame([(key, "t", "j", "2000", text, ref) for key, text, ref in rows], EXTRACTED)


ROWS = [
    ("1", "x" * 50, "a"), ("2", "x" * 51, "b"), ("3", " " * 60 + "x" * 50, "c"), (None, "x" * 60, "d"),
    ("unknown", "x" * 60, "e"), ("4", None, "f"), ("2", "y" * 51, "a"), ("5", "<" + "p" * 60 + ">", "g"),
]


def test_kept_rows(spark):
    kept = quality.keep_usable(extracted(spark, ROWS)).select("pmid", "ref_id").collect()
    assert sorted(map(tuple, kept)) == [("2", "a"), ("2", "b"), ("5", "g")]


def test_funnel_adds_up(spark):
    row = quality.quality_funnel(extracted(spark, ROWS)).first()
    assert tuple(row) == (8, 3, 5)


def test_lowest_reference_survives_and_again(spark):
    df = extracted(spark, ROWS).transform(quality.keep_usable)
    once = quality.keep_first(df, ["pmid"], [F.col("ref_id")])
    twice = quality.keep_first(once, ["pmid"], [F.col("ref_id")])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert {row["pmid"]: row["ref_id"] for row in once.collect()} == {"2": "a", "5": "g"}


def test_content_may_be_empty_after_cleaning(spark):
    rows = {row["pmid"]: row for row in process_extracted(extracted(spark, ROWS)).collect()}
    assert (rows["5"]["content"], rows["5"]["text_length"], rows["5"]["domain"]) == ("", 0, "general_medicine")


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all rows share a key: one row of it leaves each map task."""
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("pmid"),
        F.format_string("%06d", "id").alias("ref_id"))
    result = quality.keep_first(rows, ["pmid"], [F.col("ref_id")])
    plan = plan_of(result)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert result.count() == 20_001
    assert result.filter("pmid = 'hot'").first()["ref_id"] == "000000"


def stored_rows(spark, path, hot):
    """Rows with a unique id; one row in twenty repeats a key, or a third of them share one."""
    key = F.when(F.col("id") % 3 == 0, -1) if hot else F.when(F.col("id") % 20 == 0, F.col("id") + 1)
    rows = spark.range(0, 3000, 1, 6).select(
        F.coalesce(key, F.col("id")).cast("string").alias("pmid"),
        F.format_string("%05d", F.col("id") * 7919 % 1000).alias("ref_id"),
        F.monotonically_increasing_id().alias("row_id"), F.repeat(F.lit("text "), 20).alias("citation_text"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("max_bytes", [quality.REPEATED_BYTES, 0])
def test_stored_rows_keep_the_same_first(spark, tmp_path, hot, max_bytes):
    stored = stored_rows(spark, str(tmp_path / "rows"), hot)
    expected = quality.keep_first(stored, ["pmid"], [F.col("ref_id"), F.col("row_id")])
    found = quality.keep_first_stored(stored, "row_id", "pmid", ["ref_id"], max_bytes)
    assert found.columns == stored.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert "Window" not in plan_of(found)
    assert not any("citation_text" in line for line in plan_of(found).splitlines() if "Sort " in line)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("max_bytes", [quality.REPEATED_BYTES, 0])
def test_rows_without_an_id_keep_the_same_first(spark, tmp_path, hot, max_bytes):
    rows = stored_rows(spark, str(tmp_path / "rows"), hot).withColumn("fingerprint", F.md5(F.col("row_id").cast("string"))).drop("row_id")
    expected = quality.keep_first(rows, ["pmid"], [F.col("ref_id"), F.col("fingerprint")])
    found = quality.keep_first_of_source(rows, "pmid", ["ref_id", "fingerprint"], max_bytes)
    assert found.columns == rows.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    plan = plan_of(found)
    assert "Window" not in plan
    assert not any("citation_text" in line for line in plan.splitlines() if "Sort " in line)


def test_rows_that_nothing_tells_apart(spark):
    rows = spark.createDataFrame([("1", "a", "t"), ("1", "a", "t"), ("2", "b", "u")], "pmid string, ref_id string, citation_text string")
    assert sorted(map(tuple, quality.keep_first_of_source(rows, "pmid", ["ref_id"]).collect())) == [("1", "a", "t"), ("2", "b", "u")]
    empty = rows.filter("pmid = '9'")
    assert quality.keep_first_of_source(empty, "pmid", ["ref_id"]).collect() == []


def test_stored_texts_are_not_shuffled_for_few_repeats(spark, tmp_path):
    stored = stored_rows(spark, str(tmp_path / "rows"), hot=False)
    plan = plan_of(quality.keep_first_stored(stored, "row_id", "pmid", ["ref_id"]))
    below_join = plan[:plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in below_join and "citation_text" in below_join
    assert "Exchange hashpartitioning" not in below_join
    single = stored.dropDuplicates(["pmid"])
    assert quality.keep_first_stored(single, "row_id", "pmid", ["ref_id"]) is single


def test_blank_content(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \t\n"), (4, "  "), (5, " a ")], "id int, content string")
    assert [row["id"] for row in quality.drop_blank_content(df).collect()] == [5]


@pytest.fixture(scope="module")
def articles(spark):
    rows = [("c", "A", "neurology", "2001", 10), ("a", "B", "neurology", "2003", 20), ("b", "C", "oncology", "", 5),
            ("d", "D", "neurology", None, 30), ("e", "E", "genetics", "unknown", 1)]
    return spark.createDataFrame(rows, "text_id string, title string, domain string, year string, text_length int")


def test_reports(articles):
    assert [tuple(row) for row in report.domain_counts(articles).collect()] == [
        ("neurology", 3), ("genetics", 1), ("oncology", 1)]
    assert [tuple(row) for row in report.domain_overview(articles).collect()] == [
        ("neurology", 3, 20.0), ("genetics", 1, 1.0), ("oncology", 1, 5.0)]
    assert [tuple(row) for row in report.year_counts(articles).collect()] == [("unknown", 1), ("2003", 1), ("2001", 1)]
    assert [tuple(row) for row in report.year_counts(articles, 2).collect()] == [("unknown", 1), ("2003", 1)]
    assert dict(map(tuple, report.domain_sample_titles(articles).collect())) == {
        "neurology": "B", "oncology": "C", "genetics": "E"}
    assert report.domain_count(articles, "neurology").first()[0] == 3
    assert report.domain_count(articles, "cardiology").first()[0] == 0


def test_year_report_is_a_top_k(articles):
    assert "TakeOrderedAndProject" in plan_of(report.year_counts(articles))


def test_reports_aggregate_before_the_shuffle(articles):
    for frame in (report.domain_counts(articles), report.domain_overview(articles)):
        assert "partial_count" in plan_of(frame)


@pytest.mark.parametrize("text, expected", [
    ("A. Title here. Rest", " Title here"), ("no stop", "no stop"), ("ends.", ""), (".x.", "x"), ("", ""),
])
def test_title_from_citation(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(title_from_citation(F.col("c"))).first()[0] == expected


@pytest.mark.parametrize("length, expected", [(300, 300), (301, 303), (0, 0)])
def test_snippet(spark, length, expected):
    df = spark.createDataFrame([("é" * length,)], "c string")
    value = df.select(snippet(F.col("c"))).first()[0]
    assert len(value) == expected and value.endswith("...") == (length > 300)


def test_texts_are_neither_sorted_nor_shuffled_for_few_repeats(spark, tmp_path):
    extracted(spark, ROWS).write.parquet(str(tmp_path / "x"))
    plan = plan_of(process_extracted(spark.read.parquet(str(tmp_path / "x"))))
    outer = plan[:plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in outer and "Sort " not in outer and "citation_text" in outer
