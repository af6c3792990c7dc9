"""Repeated substrings over all documents, by common-prefix interval trees.

A byte is removed when it lies in a string of `length` bytes that also starts earlier: in
a document with a smaller id, or in the same one further to the front.

1. Anchors. In every stretch of `length` bytes the gram (half as long) with the smallest hash
   is an anchor, so equal stretches have equal anchors at the same place. Anchors, about
   one in 26 bytes, are dealt out by their gram; those whose gram occurs once end there.
2. Copies. Occurrences of an anchor with the same surroundings (all that a stretch with this
   anchor can reach) form one repeat; its first stands for the rest.
3. Interval trees. Different surroundings of the same gram come together as text. An
   enhanced suffix array over them is scanned with a stack: every interval of suffixes with a
   common prefix of at least `length`, and with more than one left neighbour, is a maximal
   repeat. It is put out with all its occurrences.

All occurrences of a repeat but the first are removed over its whole length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import cut, ship
from tillhouse.llm.rolling import Ranges, mix

#: Contexts whose suffixes are sorted together.
TOGETHER = 4000
OCCURRENCE = "repeat long, length int, doc_id long, start long, first boolean"


# --- anchors ---------------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) of each run of `width` values."""
    done = 1
    while 2 * done <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return pick(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place, gram hash, hash of the surroundings and reach to the right of each anchor."""
    gram = length // 2
    reach = length - gram
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none
    ranges = Ranges(data)
    grams = ranges.sliding(gram)
    least = _sliding(grams, reach + 1, np.minimum)
    # An anchor is least in one of the stretches around it: in the best of them.
    padded = np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)])
    at = np.flatnonzero(_sliding(padded, reach + 1, np.maximum) == grams)
    left, right = np.minimum(at, reach), np.minimum(len(data) - at, length)
    around = mix(ranges.of(at - left, at + right) + left.astype(np.uint64))
    return at, grams[at], around, right


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """`key, around, doc_id, place`: anchors of all documents.

    `place` holds the position, the reach to the right, and whether an equal one stands
    before it in the same batch. Those are settled: they go anywhere, so that the
    copies of one passage do not all meet in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                found = [anchors(np.frombuffer((t or "").encode(), np.uint8), length) for t in part.column(1).to_pylist()]
                at, key, around, right = (np.concatenate([f[i] for f in found]) for i in range(4))
                doc = np.repeat(np.array(part.column(0).to_pylist(), np.int64), [len(f[0]) for f in found])
                order = np.lexsort((at, doc, around, key))
                at, key, around, right, doc = (x[order] for x in (at, key, around, right, doc))
                again = np.zeros(len(at), bool)
                again[1:] = (key[1:] == key[:-1]) & (around[1:] == around[:-1])
                place = (at * 256 + right) * 2 + again
                key = np.where(again, mix(doc.view(np.uint64) + mix(at.view(np.uint64))), key)
                arrays = [key.view(np.int64), around.view(np.int64), doc, place]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["key", "around", "doc_id", "place"])

    return docs.select("doc_id", "text").mapInArrow(run, "key long, around long, doc_id long, place long")


def _settle_copies(rows: DataFrame, length: int) -> DataFrame:
    """`kind, key` and an occurrence's fields: repeats with equal surroundings (kind 1), and
    the first of each surroundings where a gram has several (kind 0).

    Rows come sorted, so only the last gram is carried from one batch to the next.
    """
    reach = length - length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first of the last gram's surroundings, while it is the only one
        last_key = last_around = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, around, doc, place = (batch.column(i).to_numpy() for i in range(4))
            again, right, at = place & 1, (place >> 1) & 255, place >> 9
            same_key = np.concatenate([[key[0] == last_key], key[1:] == key[:-1]])
            same = same_key & np.concatenate([[around[0] == last_around], around[1:] == around[:-1]])
            left = np.minimum(at, reach)
            copy = (same | (again == 1)) & (left + right >= length)
            leads = np.flatnonzero(~same & (again == 0))
            # A lead is open when another surroundings of its gram comes before or after it.
            opens = same_key[leads]
            follows = np.concatenate([opens[1:], [False]])
            out = leads[opens | follows]
            kinds = [np.ones(int(copy.sum()), np.int8), np.zeros(len(out), np.int8)]
            pick = np.concatenate([np.flatnonzero(copy), out])
            columns = [np.concatenate(kinds), key[pick], around[pick], (left + right)[pick], doc[pick], (at - left)[pick], at[pick]]
            if held is not None and len(leads) and opens[0]:
                columns = [np.append(c, h) for c, h in zip(columns, held)]
                held = None
            if len(leads):
                i = leads[-1]
                alone = not (opens[-1])
                held = (0, key[i], around[i], left[i] + right[i], doc[i], at[i] - left[i], at[i]) if alone else None
            last_key, last_around = key[-1], around[-1]
            types = [pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "key", "around", "length", "doc_id", "start", "at"])

    dealt = rows.repartition("key").sortWithinPartitions("key", "around", "doc_id", "place")
    return dealt.mapInArrow(run, "kind byte, key long, around long, length int, doc_id long, start long, at long")


# --- interval trees ----------------------------------------------------------------


def suffix_ranks(symbols: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Ranks of all suffixes by their first 7, 14, 28 ... symbols, until 224.

    Symbols are below 512. The last ranks order suffixes as far as a context reaches.
    """
    n = len(symbols)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([symbols, np.zeros(7, symbols.dtype)])
    for i in range(7):
        key = key << 9 | padded[i : i + n]
    levels, width = [], 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if n else 0
        levels.append((width, rank))
        if width >= 224:
            return levels
        key = rank * (n + 1)
        key[: max(0, n - width)] += rank[width:] + 1
        width *= 2


def _common_prefix(levels: list[tuple[int, np.ndarray]], symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at a and b share, up to what the levels tell."""
    n = len(symbols)
    shared = np.zeros(len(a), np.int64)
    for width, rank in reversed(levels[:-1]):
        i, j = np.minimum(a + shared, n - 1), np.minimum(b + shared, n - 1)
        shared += width * ((rank[i] == rank[j]) & (np.maximum(a, b) + shared < n))
    for _ in range(6):
        i, j = np.minimum(a + shared, n - 1), np.minimum(b + shared, n - 1)
        shared += (symbols[i] == symbols[j]) & (np.maximum(a, b) + shared < n)
    return shared


def maximal_repeats(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats of at least `length` bytes among some texts of up to 224 bytes.

    Gives, per occurrence: number of the repeat, its length, the text, and the place in it.
    """
    sizes = np.array([len(c) for c in contexts])
    raw = np.frombuffer(b"\0".join([*contexts, b""]), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    symbols = raw.astype(np.int64) + 1
    symbols[ends] = 0
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    left_over = ends[owner] - np.arange(len(raw))
    levels = suffix_ranks(symbols)
    # Suffixes with room for a repeat, in order, and what neighbours share.
    room = np.flatnonzero(left_over >= length)
    array = room[np.argsort(levels[-1][1][room], kind="stable")]
    none = np.zeros(0, np.int64)
    if len(array) < 2:
        return none, none, none, none
    a, b = array[:-1], array[1:]
    shared = np.zeros(len(a), np.int64)
    wide = next(rank for width, rank in levels if width > length // 2)
    near = np.flatnonzero(wide[a] == wide[b])
    shared[near] = _common_prefix(levels, symbols, a[near], b[near])
    shared = np.minimum(np.minimum(shared, left_over[a]), left_over[b])
    shared[shared < length] = 0
    # What stands to the left; at the front of a text that is not known, so never the same.
    first = np.concatenate([[0], ends[:-1] + 1])
    left = np.concatenate([[0], symbols[:-1]])
    left[first] = 1000 + np.arange(len(first))
    left = left[array]
    # Runs of suffixes that share enough; those with one common length are one interval.
    inner = np.concatenate([[False], shared > 0, [False]])
    starts = np.flatnonzero(inner[1:] & ~inner[:-1])
    stops = np.flatnonzero(~inner[1:] & inner[:-1])  # last suffix of each run
    if not len(starts):
        return none, none, none, none
    lows = np.minimum.reduceat(shared, starts)
    # reduceat runs on to the next start; a run's own lengths end at its last pair, and 0s follow.
    lows = np.where(lows == 0, _run_least(shared, starts, stops), lows)
    highs = np.maximum.reduceat(shared, starts)
    intervals: list[np.ndarray] = []
    even = lows == highs
    intervals.append(np.stack([starts[even], stops[even], lows[even]], axis=1))
    for lo, hi in zip(starts[~even].tolist(), stops[~even].tolist()):
        intervals.append(np.array(_scan(shared[lo:hi].tolist(), lo), np.int64).reshape(-1, 3))
    found = np.concatenate(intervals)
    # Left diversity: an interval whose suffixes all have the same left neighbour is
    # part of a longer repeat.
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    found = found[changes[found[:, 1]] > changes[found[:, 0]]]
    counts = found[:, 1] - found[:, 0] + 1
    number = np.repeat(np.arange(len(found)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = array[np.repeat(found[:, 0], counts) + inside]
    return number, np.repeat(found[:, 2], counts), owner[at], at - first[owner[at]]


def _run_least(shared: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The least of shared[start:stop] for each run."""
    bounds = np.stack([starts, np.minimum(stops, len(shared) - 1)], axis=1).ravel()
    least = np.minimum.reduceat(shared, bounds)[::2]
    return np.where(stops == starts + 1, shared[starts], least)


def _scan(shared: list[int], offset: int) -> list[tuple[int, int, int]]:
    """The common-prefix intervals (first, last, length) of a run of suffixes, by a stack."""
    out, stack = [], [(0, 0)]
    for i, h in enumerate([*shared, 0]):
        begin = i
        while stack and stack[-1][1] > h:
            begin, top = stack.pop()
            out.append((offset + begin, offset + i, top))
        if h and (not stack or stack[-1][1] < h):
            stack.append((begin, h))
    return out


#: A gram with more surroundings than this is settled by its whole stretches.
MANY = 1000


def _contexts(open_: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """`key, doc_id, start, lead, text`: surroundings as text, with one byte more to the
    left (`lead`). For grams with very many: a row for each stretch, keyed by its
    hash, without text."""
    gram = length // 2
    reach = length - gram
    sizes = open_.groupBy("key").agg((F.count(F.lit(1)) > MANY).alias("many"))
    wanted = open_.join(sizes, "key").groupBy("doc_id").agg(F.collect_list(F.struct("key", "at", "many")).alias("places"))
    rows = docs.join(wanted, "doc_id").select("doc_id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc_id", "start", "lead", "text"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

        def put(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        out = []
        for batch in batches:
            for i in range(batch.num_rows):
                doc, data = batch.column(0)[i].as_py(), (batch.column(1)[i].as_py() or "").encode()
                ranges = None
                for place in batch.column(2)[i].as_py():
                    at = place["at"]
                    if place["many"]:
                        ranges = ranges or Ranges(np.frombuffer(data, np.uint8))
                        starts = np.arange(max(0, at - reach), min(at, len(data) - length) + 1)
                        keys = ranges.of(starts, starts + length).view(np.int64)
                        out.extend((k, doc, s, 0, None) for k, s in zip(keys.tolist(), starts.tolist()))
                    else:
                        start = max(0, at - reach - 1)
                        out.append((place["key"], doc, start, int(at - reach - 1 >= 0), data[start : at + length]))
                if len(out) >= 10_000:
                    yield put(out)
                    out = []
        if out:
            yield put(out)

    return rows.mapInArrow(run, "key long, doc_id long, start long, lead int, text binary")


def _trees(contexts: DataFrame, length: int) -> DataFrame:
    """Occurrences of the maximal repeats among the contexts of each gram."""
    fields = [f.split()[0] for f in OCCURRENCE.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def occurrences(rows: list[tuple[np.ndarray, np.ndarray, list[bytes]]]) -> pa.RecordBatch:
        doc, base = (np.concatenate([r[i] for r in rows]) for i in range(2))
        number, size, which, place = maximal_repeats([t for r in rows for t in r[2]], length)
        docs, starts = doc[which], base[which] + place
        # The first occurrence; one place may be there in several contexts.
        order = np.lexsort((starts, docs, number))
        number, size, docs, starts = (x[order] for x in (number, size, docs, starts))
        new = np.concatenate([[True], number[1:] != number[:-1]]) if len(number) else np.zeros(0, bool)
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        first = (docs == docs[head]) & (starts == starts[head])
        name = mix(mix(docs[head].view(np.uint64)) + starts[head].view(np.uint64) * np.uint64(512) + size.view(np.uint64)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((name, size, docs, starts, first), types)], names=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []
        held, last, head = 0, None, (0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, doc, start = (batch.column(i).to_numpy() for i in range(3))
            new = np.concatenate([[key[0] != last], key[1:] != key[:-1]])
            # The first row of each row's key, which may be in an earlier batch.
            lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            lead_doc, lead_start = np.where(lead < 0, head[0], doc[lead]), np.where(lead < 0, head[1], start[lead])
            last, head = key[-1], (lead_doc[-1], lead_start[-1])
            plain = batch.column(4).is_null().to_numpy(zero_copy_only=False)
            # Stretches of grams with very many surroundings: all but the first of equal
            # ones. Two such grams in one stretch put it out twice.
            copies = np.flatnonzero(plain & ((doc != lead_doc) | (start != lead_start)))
            if len(copies):
                columns = (key[copies], np.full(len(copies), length), doc[copies], start[copies], np.zeros(len(copies), bool))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=fields)
            cuts = [*np.flatnonzero(new).tolist(), len(key)]
            if cuts[0] != 0:
                cuts.insert(0, 0)
            for a, b in zip(cuts, cuts[1:]):
                if plain[a]:
                    continue
                if new[a] and held >= TOGETHER:
                    yield occurrences(waiting)
                    waiting, held = [], 0
                waiting.append((doc[a:b], start[a:b], batch.column(4).slice(a, b - a).to_pylist()))
                held += b - a
        if held:
            yield occurrences(waiting)

    dealt = contexts.repartition("key").sortWithinPartitions("key", "doc_id", "start")
    return dealt.mapInArrow(run, OCCURRENCE)


# --- operators -----------------------------------------------------------------------


def repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Occurrences of repeated byte strings: `repeat, length, doc_id, start, first`.

    Every string of `length` bytes (100 to 110) that occurs twice lies in one of the repeats at
    the same place, and is put out as its first or another occurrence. Texts are UTF-8 bytes;
    a null one is empty. Rows with a null id take no part; rows that repeat an id are
    taken for the same document. Documents come in order of their ids.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    settled = cut(_settle_copies(_anchor_rows(own, length), length), "anchors")
    trees = _trees(_contexts(settled.where("kind = 0").select("key", "doc_id", "at"), own, length), length)
    copies = settled.where("kind = 1").select(F.col("around").alias("repeat"), "length", "doc_id", "start", F.lit(False).alias("first"))
    return copies.unionByName(trees)


def removed_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, spans` of documents in which something is removed: start and end of each
    occurrence that is not the first, in bytes, as found; spans may overlap."""
    later = repeats(docs, length, id_col, text_col).where(~F.col("first"))
    span = F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))
    return later.groupBy("doc_id").agg(F.collect_set(span).alias("spans"))


def remove(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept` (binary) per row; see `repeats`.

    Rows with a null id keep all their bytes.
    """
    spans = removed_spans(docs, length, id_col, text_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = own.where("doc_id IS NOT NULL").join(spans, "doc_id", "left")
    rows = named.unionByName(own.where("doc_id IS NULL"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                out = []
                for i in range(part.num_rows):
                    data = (part.column(1)[i].as_py() or "").encode()
                    bounds = part.column(2)[i].values
                    out.append(_without(data, None if bounds is None else bounds.flatten()))
                columns = list(zip(*out))
                kinds = [pa.int64()] * 3 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
                )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _without(data: bytes, bounds) -> tuple[int, int, int, bytes]:
    """Length, bytes removed, runs removed, and the bytes left of one text."""
    if bounds is None:
        return len(data), 0, 0, data
    steps = np.zeros(len(data) + 1, np.int64)
    starts, ends = (np.minimum(b.to_numpy(), len(data)) for b in bounds)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    gone = np.cumsum(steps)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return len(data), int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()
