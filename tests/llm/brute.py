"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))


def near_duplicates(rows):
    """Sorted (doc_id, n_shingles, component_id) of rows (doc_id, text)."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, elements in enumerate(sets):
        common = Counter(j for element in elements for j in holders[element])
        for j, shared in common.items():
            if 100 * shared >= 75 * (len(elements) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
        for element in elements:
            holders[element].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    smallest = {root: min((x for x in found if x is not None), default=None) for root, found in ids.items()}
    return sorted(((doc_id, len(sets[i]), smallest[find(i)]) for i, (doc_id, _) in enumerate(rows)), key=str)


def removed_lines(rows, text_hash, least=1):
    """{(doc_id, text): removed line numbers} for lines similar to an earlier one."""
    order = sorted(set(rows), key=lambda row: (row[0] is None, row[0] or 0, text_hash[row[1]]))
    seen, removed = [], defaultdict(set)
    for doc_id, text in order:
        for number, line in enumerate((text or "").encode().lower().split(b"\n")):
            words = frozenset(line.split())
            if len(words) < least:
                continue
            if any(100 * len(words & other) >= 80 * len(words | other) for other in seen):
                removed[doc_id, text].add(number)
            seen.append(words)
    return {row: sorted(removed.get(row, ())) for row in order}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(numbers):
    doubled = [x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(numbers))]
    return sum(doubled) % 10 == 0


def base_spans(text):
    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text)
              if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return found + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def quality_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i for k, window in enumerate(windows) if often[window] > 1 for i in range(k, k + 5)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]
