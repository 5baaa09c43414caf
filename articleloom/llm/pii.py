"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The field labels whole spans. Candidates are spans of a few neighbouring tokens that hold a digit or an at sign;
each gets a score for each kind from features of the span as a whole (digits and how they are grouped, check sums, marks, the
word before). A path over the tokens of a cluster is a sequence of single tokens outside and spans of bounded length; dynamic
programming finds the best path, so boundaries and kinds are chosen together. Weights maximise the
likelihood of paths on a bounded sample of documents whose spans the patterns give, with altered forms of them
(other separators, a missing plus, an at sign in words) as further examples.

The patterns' spans always stay; spans of the field are added where they touch none of them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")

# Bounds on what weights are learnt from: documents, characters of each around its digits and at signs, and clusters of tokens.
SAMPLE = 4000
EXCERPT = 2000
TRAINING_CLUSTERS = 2000

LONGEST_SPAN = 5
LONGEST_TOKEN = 80
REACH = 14

# The base patterns. A match can only start where a run starts, so runs are not tried from their middle.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Whether digits pass the Luhn check."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> list[tuple[int, int]]:
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the fixed patterns, by kind as listed, then start; code points, end exclusive."""
    spans = [("email", start, end) for start, end in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


_HIT = re.compile(r"[0-9@]+")
_EDGE = "\"'`,;:!?.<>[]{}|*=&#$%"
_AT_WORD = re.compile(r"\s?[\[({<]\s?at\s?[\])}>]\s?", re.IGNORECASE)
_DOT_WORD = re.compile(r"\s?[\[({<]\s?dot\s?[\])}>]\s?", re.IGNORECASE)


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs without white space around a digit or an at sign, no farther than ``LONGEST_TOKEN`` to either side."""
    found, end = [], 0
    for hit in _HIT.finditer(text):
        if hit.start() < end:
            continue
        start = hit.start()
        while start > end and hit.start() - start < LONGEST_TOKEN and not text[start - 1].isspace():
            start -= 1
        end = hit.end()
        while end < len(text) and end - hit.end() < LONGEST_TOKEN and not text[end].isspace():
            end += 1
        found.append((start, end))
    for hit in _AT_WORD.finditer(text):
        start, end = hit.start(), hit.end()
        while start > 0 and hit.start() - start < LONGEST_TOKEN and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and end - hit.end() < LONGEST_TOKEN and not text[end].isspace():
            end += 1
        found.append((start, end))
    found.sort()
    merged = []
    for start, end in found:
        if merged and start < merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    found = merged
    return found


def clusters(text: str) -> list[list[tuple[int, int]]]:
    """Tokens in groups whose members are at most ``REACH`` characters apart."""
    groups: list[list[tuple[int, int]]] = []
    for token in tokens(text):
        if groups and token[0] - groups[-1][-1][1] <= REACH:
            groups[-1].append(token)
        else:
            groups.append([token])
    return groups


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the marks at its edges."""
    while start < end and text[start] in _EDGE:
        start += 1
    while end > start and text[end - 1] in _EDGE:
        end -= 1
    return start, end


FEATURES = (
    "bias", "digits<7", "digits=7", "digits 8-9", "digits 10-11", "digits 12-15", "digits 16", "digits 17-19", "digits>19",
    "luhn", "plus", "parentheses", "grouped", "one group", "three dots", "octets", "octet too large", "at", "at in words",
    "domain", "letters", "only letters around", "foreign mark", "token inside", "wide gap", "equals before",
    "groups of four", "phone groups")
_INDEX = {name: i for i, name in enumerate(FEATURES)}


def span_features(text: str, start: int, end: int, width: int) -> list[int]:
    """Indices of the features that hold for the span of ``width`` tokens from start to end."""
    span = text[start:end]
    groups = [len(group) for group in re.findall(r"[0-9]+", span)]
    n = sum(groups)
    on = ["bias"]
    on.append("digits<7" if n < 7 else "digits=7" if n == 7 else "digits 8-9" if n < 10 else "digits 10-11" if n < 12
              else "digits 12-15" if n < 16 else "digits 16" if n == 16 else "digits 17-19" if n < 20 else "digits>19")
    letters = any(c.isalpha() for c in span)
    if 13 <= n <= 19 and luhn(_digits(span)):
        on.append("luhn")
    if span.startswith("+"):
        on.append("plus")
    if "(" in span and ")" in span:
        on.append("parentheses")
    on.append("grouped" if len(groups) > 1 else "one group")
    parts = span.split(".")
    if len(parts) == 4 and all(part.isdigit() and part.isascii() for part in parts):
        on.append("three dots")
        on.append("octets" if all(len(part) <= 3 and int(part) <= 255 for part in parts) else "octet too large")
    at_words = _DOT_WORD.sub(".", _AT_WORD.sub("@", span)) if letters else span
    if "@" in span:
        on.append("at")
    elif "@" in at_words:
        on.append("at in words")
    if "@" in at_words and _DOMAIN.fullmatch(at_words.rpartition("@")[2]) and at_words.partition("@")[0]:
        on.append("domain")
    if letters:
        on.append("letters")
    elif (start == 0 or not text[start - 1].isdigit()) and (end == len(text) or not text[end].isdigit()):
        on.append("only letters around")
    if not letters and re.search(r"[^0-9 ().+-]", span):
        on.append("foreign mark")
    if width > 1:
        on.append("token inside")
    if re.search(r"\s{2}|\n", span) or (width > 1 and re.search(r"[^\W\d_]{2}", span) and "@" not in at_words):
        on.append("wide gap")
    if start and text[start - 1] in "=_\"#/":
        on.append("equals before")
    if groups == [4, 4, 4, 4]:
        on.append("groups of four")
    if len(groups) in (3, 4) and groups[-3:] == [3, 3, 4]:
        on.append("phone groups")
    return [_INDEX[name] for name in on]


def segments(text: str, group: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list[int]]]:
    """Candidates of a cluster: first token, token after the last, start, end, features."""
    found = []
    for i in range(len(group)):
        for j in range(i + 1, min(i + LONGEST_SPAN, len(group)) + 1):
            start, end = trimmed(text, group[i][0], group[j - 1][1])
            if start < end:
                found.append((i, j, start, end, span_features(text, start, end, j - i)))
    return found


def decode(text: str, weights: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans of the best path of every cluster."""
    spans = []
    table = weights.tolist()
    for group in clusters(text):
        by_end: dict[int, list] = {}
        for i, j, start, end, on in segments(text, group):
            scores = [sum(row[f] for f in on) for row in table]
            kind = max(range(len(KINDS)), key=scores.__getitem__)
            if scores[kind] > 0:
                by_end.setdefault(j, []).append((i, scores[kind], kind, start, end))
        best, back = [0.0], [None]
        for j in range(1, len(group) + 1):
            value, step = best[j - 1], None
            for i, score, kind, start, end in by_end.get(j, ()):
                if best[i] + score > value:
                    value, step = best[i] + score, (i, kind, start, end)
            best.append(value)
            back.append(step)
        j = len(group)
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind, start, end = back[j]
                spans.append((KINDS[kind], start, end))
                j = i
    return spans


def altered(kind: str, span: str) -> list[str]:
    """Other forms in which the same datum is written."""
    if kind == "email":
        local, _, domain = span.rpartition("@")
        return [f"{local} [at] {domain}", f"{local}(at){domain}", f"{local}[at]{domain.replace('.', '[dot]')}"]
    digits = _digits(span)
    if kind == "card" and len(digits) == 16:
        return [sep.join(digits[i:i + 4] for i in range(0, 16, 4)) for sep in " -."]
    if kind == "phone" and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]
    return []


def training_paths(texts: list[str], most: int = TRAINING_CLUSTERS) -> list[tuple[int, list, list]]:
    """Clusters as (tokens, candidates, true spans as (candidate, kind)), from the base patterns and their altered forms.

    If there are more than ``most``, each kind and the clusters without a span get an equal share, what one does not use goes to
    the others, and each share is spread evenly over the texts in their order.
    """
    sorted_out: dict[str | None, list] = {kind: [] for kind in (*KINDS, None)}

    def add(text: str, spans: list[tuple[str, int, int]]) -> None:
        wanted = {(start, end): KINDS.index(kind) for kind, start, end in spans}
        for group in clusters(text):
            first, last = group[0][0], group[-1][1]
            inside = [kind for kind, start, end in spans if first <= start and end <= last]
            # The rarest kinds first, so that a cluster of two kinds counts for the one that needs it more.
            sorted_out[min(inside, key=lambda kind: len(sorted_out[kind])) if inside else None].append((text, group, wanted))

    for text in texts:
        spans = base_spans(text)
        add(text, spans)
        for kind, start, end in spans:
            for form in altered(kind, text[start:end]):
                before, after = text[max(0, start - 40):start], text[end:end + 40]
                if not re.search(r"[0-9@]", before + after):
                    add(before + form + after, [(kind, len(before), len(before) + len(form))])
    paths, left = [], most
    for shares, found in zip(range(len(sorted_out), 0, -1), sorted(sorted_out.values(), key=len), strict=True):
        taken = min(len(found), left // shares)
        left -= taken
        for k in range(taken):
            text, group, wanted = found[k * len(found) // taken]
            candidates = segments(text, group)
            true = [(c, wanted[start, end]) for c, (_, _, start, end, _) in enumerate(candidates) if (start, end) in wanted]
            paths.append((len(group), candidates, true))
    return paths


def learn(paths: list[tuple[int, list, list]], rounds: int = 20, rate: float = 0.3, ridge: float = 1e-3) -> np.ndarray:
    """Weights, kinds x features, by gradient ascent on the likelihood of the paths, with forward and backward sums."""
    weights = np.zeros((len(KINDS), len(FEATURES)))
    weights[:, 0] = -1.0
    squares = np.full_like(weights, 1e-6)
    for _ in range(rounds if paths else 0):
        gradient = -ridge * len(paths) * weights
        for size, found, true in paths:
            if not found:
                continue
            scores = np.array([weights[:, on].sum(axis=1) for *_, on in found])
            forward = np.full(size + 1, -np.inf)
            forward[0] = 0.0
            for j in range(1, size + 1):
                ways = [forward[j - 1]]
                ways += [forward[i] + np.logaddexp.reduce(scores[k]) for k, (i, e, *_) in enumerate(found) if e == j]
                forward[j] = np.logaddexp.reduce(ways)
            backward = np.full(size + 1, -np.inf)
            backward[size] = 0.0
            for i in range(size - 1, -1, -1):
                ways = [backward[i + 1]]
                ways += [backward[e] + np.logaddexp.reduce(scores[k]) for k, (s, e, *_) in enumerate(found) if s == i]
                backward[i] = np.logaddexp.reduce(ways)
            for k, (i, j, _, _, on) in enumerate(found):
                chance = np.exp(forward[i] + scores[k] + backward[j] - forward[size])
                gradient[:, on] -= chance[:, None]
            for k, kind in true:
                gradient[kind, found[k][4]] += 1
        squares += gradient**2
        weights += rate * 4 * gradient / np.sqrt(squares)
    return weights


def train(documents: DataFrame, most: int = SAMPLE) -> np.ndarray:
    """Weights from at most ``most`` distinct texts that hold a digit or an at sign, those with the lowest hashes.

    The hashes alone are sorted; texts are read in a second scan, and what comes to the driver is the surroundings of digits and at
    signs, cut to ``EXCERPT`` characters a text.
    """

    @F.arrow_udf("string")
    def near(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            text = text.as_py() or ""
            parts = [text[max(0, group[0][0] - 50):group[-1][1] + 50] for group in clusters(text)]
            rows.append("\n\n\n".join(parts)[:EXCERPT])
        return pa.array(rows, pa.string())

    hashed = documents.select("text", F.xxhash64("text").alias("hash"))
    holding = F.col("text").rlike("[0-9@]")
    lowest = hashed.where(holding).select("hash").distinct().orderBy("hash").limit(most).collect()
    if not lowest:
        return learn([])
    chosen = hashed.where((F.col("hash") <= lowest[-1]["hash"]) & holding)
    excerpts = chosen.select("hash", near(F.col("text")).alias("near")).groupBy("hash").agg(F.min("near").alias("near"))
    found = [row["near"] for row in sorted(excerpts.collect())]
    return learn(training_paths(found))


def find_spans(text: str, weights: np.ndarray) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans, and those of the field that touch none of them."""
    base = base_spans(text)
    if "@" not in text and not _DIGIT.search(text) and not _AT_WORD.search(text):
        return base, []
    taken = sorted((start, end) for _, start, end in base)
    added, k = [], 0
    for kind, start, end in sorted(decode(text, weights), key=lambda x: x[1]):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        # A base span of one kind may cover an earlier one of another kind, so the neighbours are looked at as well.
        if not any(s < end and start < e for s, e in taken[max(0, k - 4):k + 4]):
            added.append((kind, start, end))
    return base, added


def personal_data(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end, base>>`` of every whole text.

    A null text counts as empty and has no spans. Ids may be null or repeat; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("array<struct<kind: string, start: int, end: int, base: boolean>>")
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            base, added = find_spans(text.as_py() or "", shared.value)
            rows.append([{"kind": k, "start": s, "end": e, "base": known}
                         for known, spans in ((True, base), (False, added)) for k, s, e in spans])
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        return pa.array(rows, pa.list_(span))

    return documents.select("doc_id", find(F.col("text")).alias("spans"))


def span_digest(found: DataFrame) -> DataFrame:
    """``doc_id``, the base spans' counts and hash, and all spans as text, from ``personal_data``."""
    order = F.array(*(F.lit(kind) for kind in KINDS))

    def listed(spans):
        ranked = F.array_sort(F.transform(spans, lambda span: F.struct(
            F.array_position(order, span["kind"]).alias("rank"), span["start"].alias("start"), span["end"].alias("end"),
            span["kind"].alias("kind"))))
        return F.array_join(F.transform(ranked, lambda span: F.concat_ws(
            ":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))), ",")

    base = F.filter("spans", lambda span: span["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
