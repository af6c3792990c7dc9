"""Brute-force versions the operators are held against, in plain Python."""

from __future__ import annotations

import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# What every operator is shown: nulls, empty and blank texts, ties, repeats, a very long one.
EDGES = [None, "", " \t\n", "x", "same text here now", "same text here now", "aa " * 30_000, "z" * 50_000, "1 2", "é́ ß 😀 \x00 end"]


def shingle_set(text, size):
    words = [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def base_stats(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (d * 2 - 9 if d >= 5 else d * 2)
    return total % 10 == 0


def _digits(text):
    return re.sub("[^0-9]", "", text)


PII = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m)) <= 15),
)


def base_spans(text):
    return sorted(
        (m.start(), order, m.end()) for order, (pattern, valid) in enumerate(PII) for m in re.finditer(pattern, text or "") if valid(m.group(0))
    )


def removed(docs, length):
    """n_bytes, n_removed, n_spans, kept bytes by id."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        out[doc] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out
