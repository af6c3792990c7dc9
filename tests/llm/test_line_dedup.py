"""Lines that several documents hold, against brute force and edge cases."""

import random
from collections import defaultdict

from tillhouse.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key_of(line):
    return line.strip(BLANKS).translate(str.maketrans(UPPER, LOWER))


def brute(docs, min_chars=10, min_docs=2):
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        gone = [doc is not None and len(holders[key_of(x)]) >= min_docs and doc > min(holders[key_of(x)]) for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def found(frame, **options):
    rows = line_dedup.drop_repeated_lines(frame, **options).collect()
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows], key=repr)


def test_against_brute_force(spark):
    random.seed(13)
    pool = [f"{'Line' if i % 2 else 'line'} number {i % 40} É{'x' * (i % 4)}" for i in range(80)] + ["", "short", "  \t", "exactly 10", "ninechars", "ÀÀÀÀÀÀÀÀÀÀ", "😀" * 9]
    pad = lambda s: random.choice(["", " ", "\t\r"]) + s + random.choice(["", "\x0b", " \x1c"])
    docs = [(i * 3 - 50, "\n".join(pad(random.choice(pool)) for _ in range(random.randint(0, 12)))) for i in range(120)]
    # One line in every document is frequent: its key is broadcast.
    docs += [(1000 + i, f"the line of all\nown line number {i}\nthe line of all\n") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(frame) == brute(docs)
    assert found(frame, min_docs=3, min_chars=1) == brute(docs, 1, 3)


def test_edges(edges, nothing):
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(edges) == brute(docs)
    result = line_dedup.drop_repeated_lines(edges)
    assert set(edges.columns) < set(result.columns) and len(result.columns) == len(set(result.columns))
    assert line_dedup.drop_repeated_lines(nothing).count() == 0


def test_rows_that_repeat_an_id(spark):
    """Equal rows lose the same lines, other texts of the id lose their own; they are one document."""
    rows = [(1, "first holder line"), (2, "first holder line\na"), (2, "first holder line\na"), (2, "b\nfirst holder line\nc"), (3, "twice in one doc\ntwice in one doc"), (None, "first holder line")]
    frame = spark.createDataFrame([(i, t, 1, "x", 0) for i, t in rows], "doc_id long, text string, id int, gone string, n_lines int")
    assert found(frame) == brute(rows)


def test_very_many_lines(spark):
    """Putting a text together again takes time in proportion to its lines."""
    text = "\n".join(f"line number {i}" for i in range(200_000))
    frame = spark.createDataFrame([(1, "\n".join(f"line number {i}" for i in range(0, 200_000, 2))), (2, text)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(frame).collect()}
    assert (got[2].n_lines, got[2].n_dropped) == (200_000, 100_000)
    assert got[2].kept == "\n".join(f"line number {i}" for i in range(1, 200_000, 2))
