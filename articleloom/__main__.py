"""Command line: spark-submit --py-files articleloom.zip articleloom/__main__.py <job> ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from articleloom.plans import jobs
from articleloom.session import SETTINGS, size_shuffles
from articleloom.sources.scratch import scratch_path


# What each job reads most of.
INPUT = {"store": "xml", "report": "articles", "index": "articles", "ask": "index"}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="articleloom", description="Process articles and answer questions about them.")
    commands = parser.add_subparsers(dest="job", required=True)

    store = commands.add_parser("store", help="article XML to partitioned Parquet and a JSON summary")
    store.add_argument("--xml", required=True)
    store.add_argument("--articles", required=True)
    store.add_argument("--summary", required=True)

    reports = commands.add_parser("report", help="reports over the stored articles")
    reports.add_argument("--articles", required=True)
    reports.add_argument("--domain", default="neurology")

    index = commands.add_parser("index", help="stored articles to the chunk index")
    index.add_argument("--articles", required=True)
    index.add_argument("--index", required=True)

    ask = commands.add_parser("ask", help="JSON lines of question_id, question, top_k to prompts and references")
    ask.add_argument("--questions", required=True)
    ask.add_argument("--index", required=True)
    ask.add_argument("--prompts", required=True)
    ask.add_argument("--references", required=True)
    return parser.parse_args()


def main() -> None:
    arguments = _arguments()
    builder = SparkSession.builder.appName(f"articleloom {arguments.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    size_shuffles(spark, getattr(arguments, INPUT[arguments.job]))
    if arguments.job == "store":
        print(jobs.store_articles(spark, arguments.xml, arguments.articles, arguments.summary))
    elif arguments.job == "report":
        for name, frame in jobs.report_articles(spark, arguments.articles, arguments.domain).items():
            print(name)
            frame.show(truncate=False)
    elif arguments.job == "index":
        jobs.build_index(spark, arguments.articles, arguments.index)
    else:
        schema = "question_id string, question string, top_k int"
        questions = spark.read.schema(schema).json(arguments.questions)
        prompts, references = jobs.answer_questions(questions, arguments.index, scratch_path(spark, "hits"))
        prompts.write.mode("overwrite").json(arguments.prompts)
        references.write.mode("overwrite").json(arguments.references)
    spark.stop()


if __name__ == "__main__":
    main()
