"""Scoring, languages, repeats, copies: against brute force, and on edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tillhouse.llm import language_id, lm_scoring, minmax_dedup, queries, rolling, substring_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- language models ---------------------------------------------------------------


def _grams(text):
    symbols = [lm_scoring.START] * 3 + [int(lm_scoring.CLASSES[b]) for b in (text or "").encode()]
    return [tuple(symbols[i : i + 4]) for i in range(len(symbols) - 3)]


class Model:
    def __init__(self, texts):
        self.n = {k: Counter(g[4 - k :] for t in texts for g in _grams(t)) for k in (1, 2, 3, 4)}

    def p(self, gram):
        if len(gram) == 1:
            return (self.n[1][gram] + 1) / (sum(self.n[1].values()) + lm_scoring.SYMBOLS)
        seen = [v for g, v in self.n[len(gram)].items() if g[:-1] == gram[:-1]]
        if not seen:
            return self.p(gram[1:])
        known = max(self.n[len(gram)][gram] - lm_scoring.DISCOUNT, 0)
        return (known + lm_scoring.DISCOUNT * len(seen) * self.p(gram[1:])) / sum(seen)


def test_scores(spark):
    texts = ["the cat", "The CAT sat", "", None, "dog 12", "ein é", "the cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    target = spark.createDataFrame([(0,), (1,), (1,), (None,)], "doc_id long")
    found = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(docs, target).collect()}
    models = Model(texts[:2]), Model(texts)
    for i, text in enumerate(texts):
        grams = _grams(text)
        assert found[i].n_tokens == len(grams)
        if not grams:
            assert found[i].score is None and found[i].target_loss is None
            continue
        t, b = (-sum(math.log2(m.p(g)) for g in grams) / len(grams) for m in models)
        assert found[i].target_loss == pytest.approx(t, abs=1e-4) and found[i].score == pytest.approx(b - t, abs=1e-4)


def test_scoring_edges(spark, edges, nothing):
    target = edges.select("doc_id").where("doc_id = 4")
    assert lm_scoring.cross_entropy_difference(edges, target).count() == edges.count()
    assert lm_scoring.cross_entropy_difference(edges, target.where("false")).count() == edges.count()
    assert lm_scoring.cross_entropy_difference(nothing, target).count() == 0


def test_scores_tell_all_bytes_apart(spark):
    """Digits, case, marks and letters beyond ASCII are symbols of their own, so texts that differ in them alone score apart."""
    pairs = [("1111 1111", "2222 2222"), ("abcd abcd", "ABCD ABCD"), ("#### ####", "$$$$ $$$$"), ("\u4e00" * 5, "\u4e18" * 5)]
    docs = spark.createDataFrame([(2 * i + j, t) for i, pair in enumerate(pairs) for j, t in enumerate(pair)], "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm_scoring.cross_entropy_difference(docs, docs.where("doc_id % 2 = 0")).collect()}
    assert all(found[2 * i] > found[2 * i + 1] + 0.1 for i in range(len(pairs)))


def test_scores_of_many_blocks(spark, docs, monkeypatch):
    """Blocks of four documents, cut by tasks and files, against the model written down."""
    monkeypatch.setattr(lm_scoring, "BLOCK_BITS", 2)
    monkeypatch.setattr(lm_scoring, "AT_ONCE", 3)
    rng = random.Random(5)
    texts = ["".join(rng.choices("aB1\u00e9 ", k=rng.randrange(12))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    blocks = lm_scoring.in_blocks(rows, rows.where("doc_id < 20"))
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert sum(sizes) == 60 and max(sizes) <= 4
    models = Model(texts[:20]), Model(texts)
    for r in lm_scoring.cross_entropy_difference(rows, rows.where("doc_id < 20")).collect():
        if grams := _grams(texts[r.doc_id]):
            t, b = (-sum(math.log2(m.p(g)) for g in grams) / len(grams) for m in models)
            assert r.target_loss == pytest.approx(t, abs=1e-4) and r.background_loss == pytest.approx(b, abs=1e-4)


def test_probabilities_of_all_next_symbols(spark):
    """They sum to one after histories that were counted, by one model or both, and after one that was not."""
    rows = spark.createDataFrame([(0, "abca"), (1, "abcb abd")], "doc_id long, text string")
    counts = lm_scoring.fit(lm_scoring.count(lm_scoring.in_blocks(rows, rows.where("doc_id = 0"))))
    n, histories = lm_scoring.SYMBOLS, [b"abc", b" ab", b"xyz"]
    starts = [sum(int(c) * n ** (2 - i) for i, c in enumerate(h)) * n for h in histories]
    asked = spark.createDataFrame([(s + k,) for s in starts for k in range(n)], "code long")
    sums = lm_scoring.probabilities(asked, counts).groupBy(F.expr(f"code div {n}")).agg(F.sum("target").alias("t"), F.sum("background").alias("b"))
    assert [(r.t, r.b) for r in sums.collect()] == [(pytest.approx(1), pytest.approx(1))] * 3


# --- languages -----------------------------------------------------------------------


def test_phrases_are_longest_matches():
    random.seed(1)
    samples = [(k, "".join(random.choices("ab c", k=60))) for k in ("u", "v")]
    parser = language_id.Parser(samples)
    texts = ["".join(random.choices("abcd", k=random.randint(0, 100))) for _ in range(40)]
    found = parser.phrases([parser.symbols(t) for t in texts])
    for row, text in zip(found, texts):
        own = bytes(parser.symbols(text))
        for k, (_, sample) in enumerate(samples):
            known, n, i = bytes(parser.symbols(sample)), 0, 0
            while i < len(own):
                j = i
                while j < len(own) and own[i : j + 1] in known:
                    j += 1
                # A character the language has not goes with the phrase before it.
                i, n = j + (j < len(own) and own[j : j + 1] not in known), n + 1
            assert row[k] == n


def test_languages(spark, docs, edges, nothing):
    samples = language_id.learn(docs.where(~language_id.held_out(docs.doc_id)))
    rows = language_id.identify(docs.select("doc_id", "lang", "text"), samples).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    found = {r.doc_id: r for r in language_id.identify(edges.withColumnRenamed("kept", "score"), samples).collect()}
    assert [found[i].lang_pred for i in (0, 1, 2, 8)] == ["und"] * 4 and found[6].lang_pred != "und"
    assert language_id.identify(nothing, samples).count() == 0
    assert language_id.learn(nothing) == []
    assert {r.lang_pred for r in language_id.identify(edges, []).collect()} == {"und"}


def test_many_letters_and_equal_openings(spark):
    """Languages that share their openings and differ in letters far beyond the most frequent."""
    rng = random.Random(3)
    common = [chr(0x4E00 + i) for i in range(150)]
    own = {"p": [chr(0x5200 + i) for i in range(200)], "q": [chr(0x5600 + i) for i in range(200)]}
    opening = "licensed under the terms that everyone knows " * 10

    def text(lang):
        return opening + "".join(rng.choice(common) if rng.random() < 0.9 else rng.choice(own[lang]) for _ in range(2000))

    rows = [(i, text("pq"[i % 2]), "pq"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language_id.learn(docs.where(~language_id.held_out(docs.doc_id)))
    assert any(c in sample for _, sample in samples for c in common)
    assert len(set().union(*(set(sample) for _, sample in samples))) > 300
    found = language_id.identify(docs, samples).where(language_id.held_out(F.col("doc_id"))).collect()
    assert found and all(r.lang == r.lang_pred for r in found)


def test_registered_languages(spark, docs):
    found = {r.doc_id: r for r in queries.op3_cross_parsing(spark, SF).collect()}
    known = docs.select("doc_id", "lang").collect()
    held = [r for r in known if found[r.doc_id].held_out]
    assert len(found) == len(known) and all(found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in known)
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)


# --- repeated substrings ---------------------------------------------------------------


def test_maximal_repeats():
    random.seed(5)
    for _ in range(60):
        base = bytes(random.choices(b"ab", k=400))
        texts = []
        for _ in range(random.randint(1, 12)):
            a = random.randint(0, 300)
            own = bytearray(base[a : a + random.randint(0, 80)])
            if own:
                own[random.randrange(len(own))] = random.choice(b"abc")
            texts.append(bytes(own))
        windows: dict[bytes, set] = {}
        for i, t in enumerate(texts):
            for s in range(len(t) - 19):
                windows.setdefault(t[s : s + 20], set()).add((i, s))
        groups: dict[tuple, set] = {}
        for number, size, which, place in zip(*(x.tolist() for x in substring_dedup.maximal_repeats(texts, 20))):
            groups.setdefault((number, size), set()).add((which, place))
        found: dict[bytes, set] = {}
        for (_, size), places in groups.items():
            assert len({texts[i][s : s + size] for i, s in places}) == 1
            i, s = min(places)
            for d in range(size - 19):
                found.setdefault(texts[i][s + d : s + d + 20], set()).update((j, p + d) for j, p in places)
        assert found == {w: p for w, p in windows.items() if len(p) > 1}


@pytest.mark.parametrize("many", [1000, 1])
def test_removal(spark, docs, edges, nothing, many, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MANY", many)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wanted = brute.removed(rows, 100)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substring_dedup.remove(docs).collect()}
    assert got == wanted
    known = edges.where("doc_id is not null").dropDuplicates(["doc_id"])
    wanted = brute.removed([(r.doc_id, r.text) for r in known.select("doc_id", "text").collect()], 100)
    got = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in substring_dedup.remove(edges).collect()]
    assert len(got) == edges.count() and all(value == wanted[doc] for doc, value in got if doc is not None)
    assert substring_dedup.remove(nothing).count() == 0


# --- near duplicates ---------------------------------------------------------------------


def test_estimates_are_unbiased():
    rng = np.random.default_rng(3)
    a = rolling.mix(rng.integers(0, 2**62, 400).astype(np.uint64))
    b = np.concatenate([a[:300], rolling.mix(rng.integers(0, 2**62, 100).astype(np.uint64))])
    same = (minmax_dedup.signature(a) == minmax_dedup.signature(b)).mean()
    assert abs(same - 300 / 500) < 0.1


def test_near_duplicates(spark, nothing, edges):
    random.seed(2)
    vocabulary = [f"w{i}" for i in range(500)]
    base = random.choices(vocabulary, k=150)
    rows = []
    for i in range(120):
        words = list(base) if i % 2 else random.choices(vocabulary, k=80)
        for _ in range(random.randint(0, 5)):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        rows.append((i, " ".join(words).upper() if i % 3 else " \n".join(words)))
    rows += [(200 + i, t) for i, t in enumerate(brute.EDGES)] + [(300, rows[1][1])]
    sets = {i: brute.shingle_set(t, 5) for i, t in rows}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    wanted = brute.roots(sets, [(a, b) for a, b in linked if sets[b]])
    found = minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {i: (len(sets[i]), c, c == i) for i, c in wanted.items()}
    assert minmax_dedup.near_duplicates(nothing).count() == 0
    odd = minmax_dedup.near_duplicates(edges).collect()
    assert len(odd) == edges.count() and [r.kept for r in odd if r.doc_id is None] == [True]
    assert {r.component_id for r in odd if r.doc_id in (4, 5)} == {4}
