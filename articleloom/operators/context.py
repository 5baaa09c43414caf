"""What an answer is made from: prompts and references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articleloom.functions.text import snippet, text_or

SEPARATOR = "\n\n"

PROMPT_TEMPLATE = (
    "Answer the question as a medical research assistant, in English, using only the passages below. "
    "Say that you do not know if they hold no answer, and write no markup tags.\n\n"
    "Passages:\n{context}\n\nQuestion:\n{question}\n\nAnswer:"
)


def valid_questions(questions: DataFrame) -> DataFrame:
    """Questions that are not blank."""
    return questions.filter(F.col("question").rlike(r"(?U)\S"))


def prompts(hits: DataFrame, template: str = PROMPT_TEMPLATE) -> DataFrame:
    """One prompt per question: its retrieved passages in rank order, and the question.

    The template is cut at its placeholders beforehand, so braces in a passage stay text. A
    list collected per question is as long as the passages it asked for.
    """
    before, found, rest = template.partition("{context}")
    between, asked, after = rest.partition("{question}")
    if not found or not asked:
        raise ValueError("the template needs {context} and after it {question}")
    ranked = F.array_sort(F.collect_list(F.struct("rank", "page_content")))
    passages = F.array_join(F.transform(ranked, lambda hit: hit["page_content"]), SEPARATOR)
    return (
        hits.groupBy("question_id", "question")
        .agg(passages.alias("context"))
        .select(
            "question_id",
            F.concat(F.lit(before), F.col("context"), F.lit(between), F.col("question"), F.lit(after)).alias("prompt"),
        )
    )


def references(hits: DataFrame) -> DataFrame:
    """One row per retrieved chunk: whose it is and how it begins."""
    return hits.select(
        "question_id",
        "rank",
        text_or(F.col("pmid"), "N/A").alias("pmid"),
        text_or(F.col("title"), "No Title").alias("title"),
        snippet(F.col("page_content")).alias("content"),
    )


def reference_labels(refs: DataFrame) -> DataFrame:
    """References with the label they are shown under."""
    return refs.select(
        "question_id", "rank",
        F.format_string("[%d] PMID: %s", F.col("rank"), F.col("pmid")).alias("label"), "title",
    )
