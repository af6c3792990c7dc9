"""Periodic runs of words by internal pattern matching.

A run is a stretch of words that repeats with smallest period q (words q apart are identical),
is at least max(24, 3q) words long and cannot be extended. Runs are found as follows, for many
documents at a time:

1. Only stretches in which every 8 words stand elsewhere in the document, too, can hold a
   run; the rest of a text is left out. Stretches are strings of their own from here on.
2. Names of all substrings of 1, 2, 4, … words, by order, give the suffix array, the interval of
   each dyadic block in it, and common extensions of two positions in both directions.
3. A dyadic block of m = 2^k words looks for its occurrences up to 2m - 1 words behind it. A
   wavelet tree over the suffix array tells how many of its interval lie in a window, and
   which is the first, second or last (range successor). Four windows of m/2 words are asked.
4. Occurrences within m/2 words form a progression whose difference is the block's own period.
   One or two of them are taken as they are. Of a longer progression the distances between the ends
   of the block's own repetition and of the progression's are taken, left and right.
5. Each distance is a candidate period: it is extended both ways and kept where that is long enough.

Why this finds every run [s, e) of period q: with m = 8 for q < 16, else m <= q < 2m, there is a block
start i with s <= i <= e - q - m, as e - s >= q + 2m - 1; so the block stands at i + q as well. If that is
in a progression of three or more with difference d <= m/2, the repetition of period d round
i does not cover both [s, s + q) and [e - 2q, e - q), or d would divide q and be the smaller
period; so it ends inside the run on one side, and ends q words later there as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import ship, words

#: A run has at least so many words, and so many periods.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words of the smallest blocks. A run of MIN_WORDS holds one with its occurrence up to 8 words on.
BLOCK = 8
#: Words worked on at a time; a longer document is worked on alone.
BATCH_WORDS = 200_000
#: Rows taken out of an Arrow batch at a time.
ROWS = 256

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


# --- substrings by name --------------------------------------------------------------------


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Ranks of keys from 1, equal ones alike."""
    order = np.argsort(keys)
    ordered = keys[order]
    steps = np.ones(len(keys), np.int32)
    steps[1:] = ordered[1:] != ordered[:-1]
    ranks = np.empty(len(keys), np.int32)
    ranks[order] = np.cumsum(steps, dtype=np.int32)
    return ranks


class Substrings:
    """Names of all substrings of 2^k words: equal names, equal substrings; ordered alike.

    A substring that reaches over its string's end is cut off there. Symbols of different
    strings differ, so nothing matches across strings.
    """

    def __init__(self, symbols: np.ndarray, first: np.ndarray, last: np.ndarray):
        """`first` and `last` are the bounds (end exclusive) of each position's string."""
        self.n, self.first, self.last = len(symbols), first, last
        self.names = [np.append(_ranks(symbols), np.int32(0))]
        at = np.arange(self.n)
        longest = int((last - first).max(initial=0))
        width = 1
        # From the longest string's width on every name is unique.
        while width < longest:
            names = self.names[-1]
            if names.max() == self.n:
                break
            then = np.where(at + width < last, names[np.minimum(at + width, self.n)], 0)
            self.names.append(np.append(_ranks(names[:-1].astype(np.int64) * (self.n + 1) + then), np.int32(0)))
            width *= 2
        self.suffixes = np.empty(self.n, np.int32)
        self.suffixes[self.names[-1][:-1] - 1] = at

    def interval(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds in the suffix array of the substrings of 2^level words at some positions."""
        names = self.names[min(level, len(self.names) - 1)]
        ordered = names[self.suffixes]
        return np.searchsorted(ordered, names[at], "left"), np.searchsorted(ordered, names[at], "right")

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are equal, for a < b of one string."""
        start = b
        # The widest names are all unique, so every width is taken once at most.
        for level in range(len(self.names) - 1, -1, -1):
            step = (self.names[level][a] == self.names[level][b]).astype(np.int64) << level
            a, b = a + step, b + step
        return b - start

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b are equal, for a < b of one string."""
        start, low = a, self.first[a]
        for level in range(len(self.names) - 1, -1, -1):
            names, room = self.names[level], a - (1 << level) >= low
            before, after = np.where(room, a - (1 << level), 0), np.where(room, b - (1 << level), self.n)
            step = (names[before] == names[after]).astype(np.int64) << level
            a, b = a - step, b - step
        return start - a


class WaveletTree:
    """Counts and picks values of any stretch of an array by their size."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(values.max(initial=0)).bit_length(), 1)
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1
            self.zeros.append(np.concatenate(([0], np.cumsum(1 - ones, dtype=np.int32))))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of [left, right) are less than the bound."""
        every, count = bound >= 1 << self.bits, np.zeros(len(left), np.int64)
        width = right - left
        for level, zeros in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            a, b = zeros[left], zeros[right]
            count += np.where(one, b - a, 0)
            left, right = np.where(one, zeros[-1] + left - a, a), np.where(one, zeros[-1] + right - b, b)
        return np.where(every, width, count)

    def pick(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of [left, right) that so many others there are less than."""
        value, rank = np.zeros(len(left), np.int64), rank.copy()
        for level, zeros in enumerate(self.zeros):
            a, b = zeros[left], zeros[right]
            one = rank >= b - a
            rank -= np.where(one, b - a, 0)
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            left, right = np.where(one, zeros[-1] + left - a, a), np.where(one, zeros[-1] + right - b, b)
        return value


# --- runs ----------------------------------------------------------------------------------


def _repetitive(symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Stretches that may hold runs, as (start, end) rows: all their 8 words in a row stand twice.

    Compared by hash, so a stretch may be taken for nothing but none is missed.
    """
    n = len(symbols)
    if n < MIN_WORDS:
        return np.zeros((0, 2), np.int64)
    values = symbols.astype(np.uint64) + np.uint64(1)
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    hashes = np.zeros(n - BLOCK + 1, np.uint64)
    for j in range(BLOCK):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + values[j : n - BLOCK + 1 + j]
    whole = np.arange(n - BLOCK + 1) + BLOCK <= last[: n - BLOCK + 1]
    ordered = np.sort(hashes[whole])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros((0, 2), np.int64)
    at = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
    marked = np.concatenate(([False], whole & (twice[at] == hashes), [False]))
    starts, ends = np.flatnonzero(~marked[:-1] & marked[1:]), np.flatnonzero(marked[:-1] & ~marked[1:])
    long = ends - starts >= MIN_WORDS - BLOCK + 1
    return np.stack([starts[long], ends[long] + BLOCK - 1], axis=1)


def _candidates(strings: Substrings, tree: WaveletTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and the distances at which their words may go on to repeat."""
    at = np.arange(strings.n)
    offset, room = at - strings.first, strings.last - at
    width, level = BLOCK, BLOCK.bit_length() - 1
    while True:
        starts = at[(offset % width == 0) & (room >= width)]
        if not len(starts):
            return
        left, right = strings.interval(level, starts)
        # A block that stands nowhere else, most often, is done.
        more = right - left > 1
        starts, left, right = starts[more], left[more], right[more]
        nearest = 1 if width == BLOCK else width
        half = width // 2
        for window in range(nearest, 2 * width, half):
            low, high = starts + window, np.minimum(starts + window + half, starts + 2 * width)
            before, upto = tree.below(left, right, low), tree.below(left, right, high)
            some = upto > before
            i, a, b, before, upto = starts[some], left[some], right[some], before[some], upto[some]
            if not len(i):
                continue
            one = tree.pick(a, b, before)
            yield i, one - i
            more = upto - before > 1
            i, a, b, before, upto, one = i[more], a[more], b[more], before[more], upto[more], one[more]
            if not len(i):
                continue
            two = tree.pick(a, b, before + 1)
            pair = upto - before == 2
            yield i[pair], (two - i)[pair]
            i, one, step = i[~pair], one[~pair], (two - one)[~pair]
            if not len(i):
                continue
            # The block's own repetition, and that of the progression.
            ends = strings.forward(one, one + step) + one - strings.forward(i, i + step) - i
            begins = one - strings.backward(one, one + step) - i + strings.backward(i, i + step)
            yield i[ends > 0], ends[ends > 0]
            yield i[begins > 0], begins[begins > 0]
        width, level = width * 2, level + 1


def runs_of(symbols: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All runs as (start, length, period) rows by start, then period.

    `symbols` are the words of documents one after the other, as numbers that differ between
    documents; `first` and `last` the bounds of each word's document.
    """
    none = np.zeros((0, 3), np.int64)
    parts = _repetitive(symbols, last)
    if not len(parts):
        return none
    # The stretches as strings of their own. Marks of 8 words may join two documents' ends.
    sizes = parts[:, 1] - parts[:, 0]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    place = np.repeat(parts[:, 0] - begins, sizes) + np.arange(ends[-1])
    part = np.repeat(np.arange(len(parts)), sizes)
    strings = Substrings(part.astype(np.int64) * (int(symbols.max()) + 1) + symbols[place], begins[part], ends[part])
    tree = WaveletTree(strings.suffixes)
    found = [none]
    for at, period in _candidates(strings, tree):
        fits = period * MIN_PERIODS <= sizes[part[at]]
        at, period = at[fits], period[fits]
        fits = at + period < strings.last[at]
        at, period = at[fits], period[fits]
        start = at - strings.backward(at, at + period)
        length = at + period + strings.forward(at, at + period) - start
        long = length >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
        found.append(np.stack([place[start[long]], length[long], period[long]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)
    # A stretch found with several periods is one run of the smallest, which divides the others.
    same = np.zeros(len(runs), bool)
    same[1:] = (runs[1:, :2] == runs[:-1, :2]).all(axis=1)
    runs = runs[~same]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def find_in_batch(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each list of words, as (start, length, period) rows."""
    counts = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(counts)
    numbers, base = [], 0
    for t in texts:
        # Words get numbers per document, so that those of two documents differ.
        own = {w: i for i, w in enumerate(dict.fromkeys(t), base)}
        numbers.append(np.fromiter(map(own.__getitem__, t), np.int64, len(t)))
        base += len(own)
    if not base:
        return [np.zeros((0, 3), np.int64)] * len(texts)
    first, last = np.repeat(ends - counts, counts), np.repeat(ends, counts)
    runs = runs_of(np.concatenate(numbers), first, last)
    cuts = np.searchsorted(runs[:, 0], ends - counts)
    out = []
    for a, b, at in zip(cuts, np.append(cuts[1:], len(runs)), ends - counts):
        own = runs[a:b].copy()
        own[:, 0] -= at
        out.append(own)
    return out


def collapse(tokens: list[bytes], runs: np.ndarray) -> bytes:
    """The words except those behind the first period of a run, joined by one space."""
    if not len(runs):
        return b" ".join(tokens)
    change = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    inside = np.cumsum(change[:-1]) > 0
    return b" ".join([w for w, gone in zip(tokens, inside.tolist()) if not gone])


# --- documents -----------------------------------------------------------------------------


def _groups(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of about BATCH_WORDS words."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > BATCH_WORDS:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with `runs` (start, length, period in words, by start, then period) and `collapsed`.

    Words are the stretches without ASCII blanks of the whole text. `collapsed` has those that no run
    holds behind its first period, joined by one space. A null or blank text has no runs and collapses
    to an empty text. Rows, repeated or not, stay as they are; columns named `runs` or `collapsed`
    are replaced. One row's words must fit in a task.
    """
    ship(docs.sparkSession)
    rows = docs.drop("runs", "collapsed")
    at = rows.columns.index(text_col)
    added = [T.StructField("runs", T.ArrayType(RUN, False), False), T.StructField("collapsed", T.StringType(), False)]
    schema = T.StructType([*rows.schema.fields, *added])
    long = pa.int64()
    item = pa.struct([pa.field(c, long, False) for c in RUN.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                # Bytes split at ASCII blanks only.
                texts = [t.encode().split() if t else [] for t in part.column(at).to_pylist()]
                for a, b in _groups(texts):
                    found = find_in_batch(texts[a:b])
                    offsets = np.zeros(b - a + 1, np.int32)
                    np.cumsum([len(f) for f in found], out=offsets[1:])
                    flat = np.concatenate(found)
                    structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(item))
                    runs = pa.ListArray.from_arrays(pa.array(offsets), structs, type=pa.list_(pa.field("element", item, False)))
                    kept = pa.array([collapse(t, f).decode() for t, f in zip(texts[a:b], found)], pa.string())
                    yield pa.RecordBatch.from_arrays([*part.slice(a, b - a).columns, runs, kept], names=schema.names)

    return rows.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; of equals the first, then the smallest period."""
    none = F.lit(None).cast(RUN)

    def better(best: Column, r: Column) -> Column:
        wins = best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
        return F.when(wins, r).otherwise(best)

    return F.reduce(runs, none, better)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, in one document of ten (by its id) with its words from some place on repeated.

    With h the crc32 of the id in decimal and g = floor(h / 10): where h % 10 = 0, each word
    i >= a becomes word a + (i - a) % p, with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(given: Column) -> Column:
        n = F.size(given)
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(given, place(i).cast("int"))), " ")

    # One element, so that the words are bound once for the lambda within.
    once = F.transform(F.array(words(text)), lambda w: F.when(F.size(w) > 0, repeated(w)))
    return F.when(h % 10 == 0, F.coalesce(F.get(once, 0), text)).otherwise(text)
