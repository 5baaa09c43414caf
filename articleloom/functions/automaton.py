"""Classification by one pass of an Aho-Corasick automaton, for lexicons of thousands of keywords."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEXICON_BYTES = 64 << 20  # of keywords: they are sent to all tasks


def automaton_of(domains: Sequence[Sequence[str]]) -> ahocorasick.Automaton:
    """An automaton that gives the first domain of each keyword; keywords are lower case and not empty.

    A keyword within which another one of the same or an earlier domain lies says nothing new and is left out.
    """
    first: dict[str, int] = {}
    for place, keywords in enumerate(domains):
        for word in keywords:
            first.setdefault(word, place)

    def built(words: dict[str, int]) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for word, place in words.items():
            automaton.add_word(word, (place, len(word)))
        if words:
            automaton.make_automaton()
        return automaton

    whole = built(first)
    return built({
        word: place for word, place in first.items()
        if not any(size < len(word) and other <= place for _, (other, size) in whole.iter(word))})


def first_domain(automaton: ahocorasick.Automaton, text: str, limit: int) -> int:
    """The lowest domain of the keywords in a text, ``limit`` if there is none below it."""
    best = limit
    for _, (place, _) in automaton.iter(text):
        if place < best:
            best = place
            if not best:
                break
    return best


def classify_by_automaton(content: Column, lexicon: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """As ``classify``: the first domain, in lexicon order, with a keyword anywhere inside the lower-cased content.

    Each text is gone through once, however many keywords there are; a task builds the automaton for itself.
    """
    domains = [[word.lower() for word in keywords] for _, keywords in lexicon]
    if sum(len(word.encode()) for words in domains for word in words) > LEXICON_BYTES:
        raise ValueError("the lexicon is too large to be sent to all tasks")
    names = [domain for domain, _ in lexicon]
    # An empty keyword is in every text.
    always = next((place for place, words in enumerate(domains) if "" in words), len(names))
    answers = [*names, default]

    @F.arrow_udf("string")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = automaton_of([[word for word in words if word] for words in domains[:always]])
        for texts in batches:
            places = [
                first_domain(automaton, text, always) if text is not None and len(automaton) else always if text is not None else len(names)
                for text in texts.to_pylist()]
            yield pa.array([answers[place] for place in places], pa.string())

    return found(F.lower(content))
