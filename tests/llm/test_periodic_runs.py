"""Periodic runs, against brute force over all periods and edge cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tillhouse.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """Every run by (start, period): all maximal stretches of every period, the smallest of equal stretches."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    values = np.array([names[w] for w in words], np.int64)
    n, found = len(values), {}
    for q in range(1, n // 3 + 1):
        same = np.concatenate(([False], values[:-q] == values[q:], [False]))
        starts, ends = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s + q >= max(24, 3 * q):
                found.setdefault((s, e - s + q), q)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    return [w for i, w in enumerate(words) if i not in gone]


def made(rng, n):
    """Words with runs inside of runs, broken runs, and runs that touch."""
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    out = []
    while len(out) < n:
        unit = [rng.choice("abc" if kind == 1 else [str(i) for i in range(50)]) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 16, 31, 40]))]
        for _ in range(rng.randrange(3)):
            unit = unit * rng.randrange(1, 12) + [rng.choice("abc")] * rng.randrange(3)
            unit = unit[: n // 3 + 1]
        out += (unit * rng.randrange(1, 7))[: rng.randrange(1, n)]
        if rng.random() < 0.3:
            out.insert(rng.randrange(len(out) + 1), "x")
    return out[:n]


@pytest.mark.parametrize("seed", range(8))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    docs = [[w.encode() for w in made(rng, rng.choice([0, 5, 23, 24, 25, 60, 150, 400, 900]))] for _ in range(60)]
    for words, runs in zip(docs, periodic_runs.find_in_batch(docs)):
        expected = brute_runs(words)
        assert [tuple(r) for r in runs.tolist()] == expected
        assert periodic_runs.collapse(words, runs).split() == brute_collapse(words, expected)


def test_runs_of_powers_with_a_break():
    """A long repetition inside each period: candidates come from where it ends."""
    for inner in (7, 8, 30, 64, 100, 127):
        for extra in (["b"], ["b", "c"], ["b"] + ["a"] * 9 + ["c"]):
            words = [w.encode() for w in ((["a"] * inner + extra) * 4)[inner // 2 :]]
            (runs,) = periodic_runs.find_in_batch([words])
            assert [tuple(r) for r in runs.tolist()] == brute_runs(words)


def test_long_repetition_is_quick():
    words = [b"aa"] * 300_000 + [b"x"] + [b"%d" % (i % 1000) for i in range(100_000)]
    (runs,) = periodic_runs.find_in_batch([words])
    assert runs.tolist() == [[0, 300_000, 1], [300_001, 100_000, 1000]]


def test_query(spark):
    """The registered query, all of its columns, over a whole table."""
    expected = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        expected[r.doc_id] = (len(runs), *best, milli, sha(lines.encode()), sha(b" ".join(brute_collapse(words, runs))))
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = queries.QUERIES["op12_periodic_runs"](spark, SF).collect()
    assert {r.doc_id: tuple(r[c] for c in names) for r in rows} == expected
    assert sum(e[0] for e in expected.values()) > 5


def test_edges(spark, edges, nothing):
    clash = edges.withColumnRenamed("kept", "runs")
    rows = periodic_runs.find_runs(clash).collect()
    assert len(rows) == edges.count() and set(clash.columns) | {"collapsed"} == set(rows[0].asDict())
    for r in rows:
        words = (r.text or "").encode().split()
        runs = brute_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert [tuple(x) for x in r.runs] == runs and r.collapsed.encode().split() == brute_collapse(words, runs)
    assert periodic_runs.find_runs(nothing).count() == 0
    blanks = spark.createDataFrame([("a\x1cb\x85c d\x00 e",)], "text string")
    assert periodic_runs.find_runs(blanks).first().collapsed == "a\x1cb\x85c d\x00 e"
    odd = spark.createDataFrame([(i, None) for i in range(40)] + [(None, "a b")], "doc_id long, text string")
    assert {r[0] for r in odd.select(periodic_runs.planted(odd.doc_id, odd.text)).collect()} == {None, "a b"}
