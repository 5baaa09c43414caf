"""The jobs end to end, from XML files to prompts."""

import os
import subprocess
import sys
from pathlib import Path

from pytest import MonkeyPatch

from articleloom import session
from articleloom.operators.index import open_chunk_index
from articleloom.plans import jobs
from articleloom.plans.articles import process_articles
from articleloom.schemas import SUMMARY
from articleloom.sources.articles_xml import read_articles_xml
from articleloom.sources.tables import read_partitioned_articles

WORDS = ["heart valve disease", "brain tissue", "tumor growth", "plain matter"]


def write_xml(folder: Path, count: int = 12) -> None:
    folder.mkdir()
    for n in range(count):
        text = " ".join([WORDS[n % 4]] * 200)
        pmid = n if n < 10 else n - 10  # the last two repeat the first two
        year = f"<pub-date pub-type='ppub'><year>{2000 + n % 3}</year></pub-date>" if n != 5 else ""
        (folder / f"{n:02d}.xml").write_text(
            f"<article><front><article-meta><article-id pub-id-type='pmid'>{pmid}</article-id>"
            f"<title-group><article-title>Title {n}</article-title></title-group>{year}</article-meta></front>"
            f"<body><p>{text}</p></body></article>")
    (folder / "short.xml").write_text("<article><body>short</body></article>")


def test_jobs(spark, tmp_path):
    write_xml(tmp_path / "xml")
    paths = {name: str(tmp_path / name) for name in ("xml", "articles", "summary", "index", "hits")}
    funnel = jobs.store_articles(spark, paths["xml"], paths["articles"], paths["summary"])
    assert funnel == {"initial_count": 13, "kept_count": 12, "malformed_count": 0, "dropped_count": 1}
    articles = read_partitioned_articles(spark, paths["articles"])
    assert articles.count() == 10
    assert articles.filter("pmid = '0'").first()["title"] == "Title 0"
    summary = spark.read.schema(SUMMARY).json(paths["summary"])
    ids = {row["text_id"] for row in articles.select("text_id").collect()}
    assert {row["text_id"] for row in summary.select("text_id").collect()} == ids

    reports = jobs.report_articles(spark, paths["articles"], "cardiology")
    assert reports["domain_count"].first()[0] == 3
    assert [row["year"] for row in reports["years"].collect()] == ["unknown", "2002", "2001", "2000"]
    assert reports["overview"].count() == reports["sample_titles"].count() == 4

    jobs.build_index(spark, paths["articles"], paths["index"])
    chunks = open_chunk_index(spark, paths["index"]).count()
    jobs.build_index(spark, paths["articles"], paths["index"])
    assert open_chunk_index(spark, paths["index"]).count() == chunks

    questions = spark.createDataFrame([(1, "brain tissue?", 2), (2, "", 5)], "question_id int, question string, top_k int")
    prompts, references = jobs.answer_questions(questions, paths["index"], paths["hits"])
    assert [row["question_id"] for row in prompts.collect()] == [1]
    assert {row["pmid"] for row in references.collect()} <= {"1", "5", "9"}
    assert references.count() == 2


def test_a_run_that_keeps_nothing_leaves_the_store_as_it_is(spark, tmp_path):
    write_xml(tmp_path / "xml", 3)
    paths = {name: str(tmp_path / name) for name in ("xml", "articles", "summary")}
    jobs.store_articles(spark, *paths.values())
    (tmp_path / "nothing").mkdir()
    (tmp_path / "nothing" / "short.xml").write_text("<article><body>short</body></article><article><body></article>")
    funnel = jobs.store_articles(spark, str(tmp_path / "nothing"), paths["articles"], paths["summary"])
    assert funnel == {"initial_count": 2, "kept_count": 0, "malformed_count": 1, "dropped_count": 2}
    assert read_partitioned_articles(spark, paths["articles"]).count() == 3
    assert spark.read.schema(SUMMARY).json(paths["summary"]).count() == 3


def test_job_and_plan_keep_the_same_articles(spark, tmp_path):
    """Also of several articles with one key in one file, however the job drops the others."""
    folder = tmp_path / "xml"
    write_xml(folder, 4)
    one = (folder / "01.xml").read_text()
    (folder / "many.xml").write_text("".join(one.replace("Title 1", f"Title m{n}").replace(">1<", f">{50 + n % 2}<") for n in range(9)))
    jobs.store_articles(spark, str(folder), str(tmp_path / "articles"), str(tmp_path / "summary"))
    columns = ["pmid", "title", "text_id", "ref_id", "year", "content"]
    stored = read_partitioned_articles(spark, str(tmp_path / "articles")).select(columns)
    planned = process_articles(read_articles_xml(spark, str(folder))).select(columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, planned.collect()))
    assert stored.count() == 6


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"x" * 1000)
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_shuffles(spark, str(tmp_path)) == session.LEAST_PARTITIONS == int(spark.conf.get(name))
        with MonkeyPatch.context() as patch:
            patch.setattr(session, "SHUFFLE_BYTES", 3)
            assert session.size_shuffles(spark, str(tmp_path)) == 334
    finally:
        spark.conf.unset(name)


def test_command_line_needs_a_job():
    run = subprocess.run(
        [sys.executable, "-m", "articleloom"], capture_output=True, text=True, check=False,
        cwd=Path(__file__).resolve().parent.parent, env={**os.environ})
    assert run.returncode == 2 and "usage" in run.stderr
