"""Article XML in, flat and processed articles out."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from articleloom.functions.lexicon import classify
from articleloom.functions.text import clean
from articleloom.operators.extract import extract_fields
from articleloom.plans.articles import process_articles
from articleloom.schemas import ARTICLES, RAW_ARTICLE
from articleloom.sources.articles_xml import read_articles_xml, sample_articles

LONG = "Plain text of an article that is long enough to be kept by the filter."


def article(ids="", title="", dates="", abstracts="", body="", journal="") -> str:
    return (
        f"<article><front><journal-meta><journal-title-group>{journal}</journal-title-group></journal-meta>"
        f"<article-meta>{ids}<title-group>{title}</title-group>{dates}{abstracts}</article-meta></front>{body}</article>"
    )


def pmid(value) -> str:
    return f'<article-id pub-id-type="pmid">{value}</article-id>'


DOI = '<article-id pub-id-type="doi">10.1/x</article-id>'
PPUB = '<pub-date pub-type="ppub"><year>2001</year></pub-date>'
EPUB = '<pub-date pub-type="epub"><year>1999</year></pub-date>'

FILES = {
    "plain": article(DOI + pmid(1), "<article-title>Plain</article-title>", EPUB + PPUB,
                     "<abstract><p>one</p><p>two</p></abstract><abstract><p>three</p></abstract>",
                     f"<body>{LONG}</body>", "<journal-title>J</journal-title>"),
    "no_pmid": article(DOI, body=f"<body>{LONG}</body>"),
    "no_ids": article(body=f"<body>{LONG}</body>"),
    "no_ppub": article(pmid(4), dates=EPUB, body=f"<body>{LONG}</body>"),
    "no_date": article(pmid(5), body=f"<body>{LONG}</body>"),
    "mixed_title": article(pmid(6), "<article-title>Mixed <italic>title</italic> here</article-title>",
                           body=f"<body>{LONG}</body>"),
    "inline_abstract": article(pmid(7), abstracts=f"<abstract><p>First <bold>b</bold> &amp; x. {LONG}</p></abstract>"),
    "bare_abstract": article(pmid(8), abstracts=f"<abstract><sec>s</sec></abstract><abstract><p>{LONG}</p></abstract>"),
    "no_front": f"<article><body>{LONG}</body></article>",
    "fifty": article(pmid(9), body=f"<body>{'x' * 50}</body>"),
    "fifty_one": article(pmid(10), body=f"<body>{'x' * 51}</body>"),
    "same_1": article(pmid(11), "<article-title>First</article-title>", body=f"<body>{LONG}</body>"),
    "same_2": article(pmid(11), "<article-title>Second</article-title>", body=f"<body>{LONG}</body>"),
    "several": "<articles>" + "".join(article(pmid(n), body=f"<body>{LONG}</body>") for n in (12, 13)) + "</articles>",
    "no_root": "\n".join(article(pmid(n), body=f"<body>{LONG}</body>") for n in (16, 17)),
    "one_broken": "<articles>" + article(pmid(18), body=f"<body>{LONG}</body>") + f"<article><front>{pmid(19)}</article>"
                  + article(pmid(20), body=f"<body>{LONG}</body>") + "</articles>",
    "empty": article(pmid(15), "<article-title></article-title>", '<pub-date pub-type="ppub"><year></year></pub-date>',
                     f"<abstract><p></p><p>{LONG}</p></abstract>", "<body></body>", "<journal-title> </journal-title>"),
    "malformed": f'<article><front><article-meta>{pmid(14)}</article-meta></front><body>{LONG}',
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("xml")
    for name, text in FILES.items():
        (path / f"{name}.xml").write_text(text)
    return str(path)


@pytest.fixture(scope="module")
def extracted(spark, folder):
    rows = extract_fields(read_articles_xml(spark, folder)).collect()
    return {row["ref_id"].rsplit("/", 1)[1].removesuffix(".xml"): row for row in rows}


@pytest.fixture(scope="module")
def processed(spark, folder):
    return {row["pmid"]: row for row in process_articles(read_articles_xml(spark, folder)).collect()}


def test_plain_fields(extracted):
    row = extracted["plain"]
    assert (row["pmid"], row["article_title"], row["journal"], row["year"]) == ("1", "Plain", "J", "2001")
    assert row["citation_text"] == f"one two three {LONG}"


def test_keys(extracted):
    assert extracted["no_pmid"]["pmid"] is None
    assert extracted["no_ids"]["pmid"] == "unknown"
    assert extracted["no_front"]["pmid"] == "unknown"


def test_years(extracted):
    assert extracted["no_ppub"]["year"] is None
    assert extracted["no_date"]["year"] == "unknown"


def test_defaults(extracted):
    row = extracted["no_front"]
    assert (row["article_title"], row["journal"], row["year"]) == ("unknown", "unknown", "unknown")
    assert row["citation_text"] == f" {LONG}"
    assert extracted["bare_abstract"]["citation_text"] == f"{LONG} "


def test_empty_elements_are_absent(extracted):
    row = extracted["empty"]
    assert (row["article_title"], row["journal"], row["year"]) == ("unknown", "unknown", None)
    assert row["citation_text"] == f"{LONG} "


def test_inline_markup_keeps_its_order(extracted, processed):
    assert extracted["mixed_title"]["article_title"] == "Mixed title here"
    assert processed["7"]["content"] == f"First b & x. {LONG}"


def test_only_usable_articles_are_kept(processed):
    assert sorted(processed, key=int) == ["1", "4", "5", "6", "7", "8", "10", "11", "12", "13", "15", "16", "17", "18", "20"]


def test_lowest_file_survives(processed):
    assert processed["11"]["title"] == "First"


def test_articles_of_one_file_share_ref_id_only(processed):
    first, second = processed["12"], processed["13"]
    assert first["ref_id"] == second["ref_id"]
    assert first["text_id"] != second["text_id"]


def test_ids_do_not_change_between_runs(spark, folder, processed):
    again = process_articles(read_articles_xml(spark, folder))
    assert {row["pmid"]: row["text_id"] for row in again.collect()} == {
        key: row["text_id"] for key, row in processed.items()}


def test_schema(spark, folder):
    processed = process_articles(read_articles_xml(spark, folder))
    assert [(f.name, f.dataType) for f in processed.schema] == [(f.name, f.dataType) for f in ARTICLES]
    row = processed.filter("pmid = '10'").first()
    assert row["text_length"] == 51 and row["processed_time"] is not None


def test_no_rows_have_the_same_schema(spark):
    raw = spark.createDataFrame([], RAW_ARTICLE).withColumn("ref_id", F.lit("x"))
    processed = process_articles(raw)
    assert processed.columns == ARTICLES.names
    assert processed.groupBy("domain").count().collect() == []


def test_sample(spark, folder):
    rows = sample_articles(spark, folder, 3).collect()
    assert [row["ref_id"].rsplit("/", 1)[1] for row in rows] == ["bare_abstract.xml", "empty.xml", "fifty.xml"]
    assert rows[0]["article_ids"] == ["8"]
    assert rows[0]["abstract"] == [None, [LONG]]


def test_sample_reads_the_first_files_only(spark, folder):
    sample = sample_articles(spark, folder, 3)
    assert len(sample.inputFiles()) == 3
    assert len(sample_articles(spark, folder, 1000).inputFiles()) == len(FILES)


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    count = 2000
    articles = (article(pmid(n), body=f"<body>{LONG} {n}</body>") for n in range(count))
    (tmp_path / "large.xml").write_text("<articles>" + "\n".join(articles) + "</articles>")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "50KB")
    try:
        raw = read_articles_xml(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 5
        rows = extract_fields(raw).collect()
    finally:
        spark.conf.set(size, before)
    assert {(row["pmid"], row["citation_text"]) for row in rows} == {(str(n), f" {LONG} {n}") for n in range(count)}


def test_inequality_signs_are_no_tags(spark, tmp_path):
    text = "significant (p &lt; 0.05) in the heart group. <b>Mean</b> age &#62; 60 and x &#x3C; y &amp;lt; z did worse."
    (tmp_path / "a.xml").write_text(article(pmid(1), f"<article-title>a &lt;i&gt; b</article-title>", body=f"<body>{text}</body>"))
    row = process_articles(read_articles_xml(spark, str(tmp_path))).first()
    assert row["content"] == "significant (p < 0.05) in the heart group. Mean age > 60 and x < y &lt; z did worse."
    assert row["title"] == "a <i> b" and row["domain"] == "cardiology"


def test_malformed_articles_are_marked(spark, folder):
    rows = read_articles_xml(spark, folder).filter("malformed").collect()
    assert sorted(row["ref_id"].rsplit("/", 1)[1] for row in rows) == ["malformed.xml", "one_broken.xml"]


def one(spark, column):
    return spark.range(1).select(column.alias("value")).first()["value"]


@pytest.mark.parametrize("text, expected", [
    ("<p>a</p><p>b</p>", "a b"),
    ("  a \r\n\t b  ", "a b"),
    ("a < b", "a < b"),
    ("<>", "<>"),
    ("<p>\n</p>", ""),
    ("a<br/>b", "a b"),
])
def test_clean(spark, text, expected):
    assert one(spark, clean(F.lit(text))) == expected


@pytest.mark.parametrize("text, expected", [
    ("HEART of the brain", "cardiology"),
    ("the brain and cancer", "neurology"),
    ("in general", "genetics"),
    ("Genetics", "genetics"),
    ("enzyme", "biochemistry"),
    ("nothing", "general_medicine"),
    ("", "general_medicine"),
])
def test_classify(spark, text, expected):
    assert one(spark, classify(F.lit(text))) == expected


def test_classify_order_and_default(spark):
    lexicon = [("late", ["b"]), ("early", ["a", "ab"])]
    assert one(spark, classify(F.lit("ab"), lexicon, "none")) == "late"
    assert one(spark, classify(F.lit("A"), lexicon, "none")) == "early"
    assert one(spark, classify(F.lit("x"), [], "none")) == "none"


def test_xml_is_parsed_once(spark, folder):
    """What follows the extraction reads the stored fields: no filter and no join parses articles again."""
    files = process_articles(read_articles_xml(spark, folder)).inputFiles()
    assert files and all("/extracted/" in file for file in files)


def test_all_keywords_are_looked_for_in_one_pass(spark):
    """No search of its own for each keyword, with the results of one; odd keywords and domains without any among them."""
    lexicon = [("none", []), ("signs", ["a.c", "(x)", "p|q", "tab\there", "line\nfeed", "$"]), ("inner", ["gene", "eneral"]), ("outer", ["general", "Über"])]
    texts = ["abc", "A.C", "p", "p|Q", "(X)", "x", "tab\tHERE", "line\nfeed", "a $ b", "Generally", "a generation", "ÜBER", "", None, "ener"]
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id int, text string")
    found = df.select("id", classify(F.col("text"), lexicon, "other").alias("domain"))
    assert "Contains" not in plan_of(found)
    wanted = [next((name for name, words in lexicon if text is not None and any(word.lower() in text.lower() for word in words)), "other") for text in texts]
    assert [row["domain"] for row in found.orderBy("id").collect()] == wanted
    assert one(spark, classify(F.lit("x"), [("every", [""])], "none")) == "every"


def test_single_spaces_are_not_replaced_by_themselves(spark):
    pieces = [" ", "  ", "\t", "\n ", " \r\n", "\x0b", "\f", " \t x", "\u00a0", "<b> ", "x", "\u2003"]
    rows = [(f"{a}u{b}v{c}",) for a in pieces for b in pieces for c in pieces]
    df = spark.createDataFrame(rows, "text string")
    plain = F.trim(F.regexp_replace(F.regexp_replace("text", "<[^>]+>", " "), r"[\r\n\s]+", " "))
    assert df.where(~clean(F.col("text")).eqNullSafe(plain)).count() == 0
    assert r"[\r\n\s]+" not in plan_of(df.select(clean(F.col("text"))))
