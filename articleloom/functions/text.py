"""Text functions built from Spark's own string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNIPPET_LENGTH = 300


# Stand-ins for an escaped "<" and ">" of XML text until tags are stripped: private-use characters, one for one, so
# that lengths are those of the text.
LESS, GREATER = "\ue03c", "\ue03e"


def marked(xml: Column) -> Column:
    """XML with its escaped inequality signs marked, so that no parser turns them into what looks like a tag."""
    less = F.regexp_replace(xml, "&(lt|#0*60|#[xX]0*3[cC]);", LESS)
    return F.regexp_replace(less, "&(gt|#0*62|#[xX]0*3[eE]);", GREATER)


def unmarked(text: Column) -> Column:
    """Text with the inequality signs themselves, once its tags are gone."""
    return F.translate(text, LESS + GREATER, "<>")


def clean(text: Column) -> Column:
    """Tags become spaces, whitespace runs become one space, ends are trimmed - in that order."""
    # Both patterns. The second is [\r\n\s]+ without the single spaces, which would be replaced by themselves.
    untagged = F.regexp_replace(text, "<[^>]+>", " ")
    return F.trim(F.regexp_replace(untagged, r" \s+|[\t\n\x0B\f\r]\s*", " "))


def is_blank(text: Column) -> Column:
    """Null, or nothing but whitespace of any kind."""
    return text.isNull() | ~text.rlike(r"(?U)\S")


def title_from_citation(citation: Column) -> Column:
    """The part between the first and second full stop; the whole citation if it has none."""
    return F.when(F.contains(citation, F.lit(".")), F.get(F.split(citation, r"\."), F.lit(1))).otherwise(citation)


def text_or(column: Column, default: str) -> Column:
    """The column as text, or ``default`` where it is null."""
    return F.coalesce(column.cast("string"), F.lit(default))


def snippet(content: Column, length: int = SNIPPET_LENGTH) -> Column:
    """Content longer than ``length`` is shown by its beginning and an ellipsis."""
    return F.when(F.length(content) > length, F.concat(F.substring(content, 1, length), F.lit("..."))).otherwise(content)


def stable_id(*parts: Column) -> Column:
    """An id that depends on the values only, so that a rerun or a lost executor gives the same one."""
    return F.sha2(F.concat_ws("#", *parts), 256)


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda token: token != "")
