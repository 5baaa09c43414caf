"""Keyword lexicon for domain classification."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

Lexicon = Sequence[tuple[str, Sequence[str]]]

# The domains in the order they are tried, with their substrings.
MEDICAL_DOMAINS: Lexicon = [
    ("cardiology", ["cardiology", "heart", "cardiac", "cardiovascular", "coronary"]),
    ("neurology", ["neurology", "brain", "neural", "neurological", "alzheimer", "parkinson", "demyelinating"]),
    ("oncology", ["oncology", "cancer", "tumor", "malignant", "chemotherapy", "carcinoma"]),
    ("immunology", ["immunology", "immune", "antibody", "immunoregulatory", "autoreactive", "vaccination"]),
    ("genetics", ["genetics", "genomics", "dna", "gene", "mutation"]),
    ("biochemistry", ["biochemistry", "molecular", "protein", "enzyme"]),
]

DEFAULT_DOMAIN = "general_medicine"


def _shortest_only(keywords: Sequence[str]) -> list[str]:
    """Drop a keyword that contains another one: whoever holds the long one holds the short one."""
    return [word for word in keywords
            if not any(other != word and other in word for other in keywords)]


def classify(content: Column, lexicon: Lexicon = MEDICAL_DOMAINS, default: str = DEFAULT_DOMAIN, automaton: bool = False) -> Column:
    """First domain, in lexicon order, with a keyword anywhere inside the lower-cased content.

    The match is on substrings, so "gene" also finds "general". The built-in form looks for all keywords of the lexicon at once, and in
    the texts that hold one for those of each domain in turn: a pass over the text where Spark's ``contains`` took one for each
    keyword. That is best for a few dozen; with ``automaton`` it is one pass in any case, for lexicons of thousands.
    """
    if automaton:
        from articleloom.functions.automaton import classify_by_automaton  # its library may not be there

        return classify_by_automaton(content, lexicon, default)
    patterns = [
        (domain, "|".join(re.escape(word) for word in _shortest_only([keyword.lower() for keyword in keywords])))
        for domain, keywords in lexicon if keywords]
    if not patterns:
        return F.lit(default)

    @F.arrow_udf("string")
    def found(texts: pa.Array) -> pa.Array:
        return first_match(texts, patterns, default)

    return found(F.lower(content))


def first_match(texts: pa.Array, patterns: Sequence[tuple[str, str]], default: str) -> pa.Array:
    """The name of the first pattern that occurs in each text, ``default`` where none does or the text is null."""
    names = np.array([*(name for name, _ in patterns), default], dtype=object)
    places = np.full(len(texts), len(patterns))
    open_rows = _rows_with(texts, np.arange(len(texts)), "|".join(pattern for _, pattern in patterns))
    for place, (_, pattern) in enumerate(patterns):
        if not len(open_rows):
            break
        hits = _rows_with(texts, open_rows, pattern)
        places[hits] = place
        open_rows = np.setdiff1d(open_rows, hits, assume_unique=True)
    return pa.array(names[places], pa.string())


def _rows_with(texts: pa.Array, rows: np.ndarray, pattern: str) -> np.ndarray:
    """Those of the rows in whose text the pattern occurs."""
    some = texts if len(rows) == len(texts) else texts.take(pa.array(rows))
    return rows[pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(some, pattern), False)).to_numpy()]
