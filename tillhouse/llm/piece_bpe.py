"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as such models do (a blank becomes the piece sign, one is put in
front), cut where no piece can reach across, and each unit is merged by an agenda of its
adjacent symbol pairs: the pair whose merged piece scores best goes first, the leftmost of
equals, until no pair forms a piece. Characters without a piece fall back to bytes.

Units of usual length are merged many at a time: a row of a matrix is a unit, the
best entry of its row of pair ranks the top of its agenda. Long ones use a heap. Merged units
are kept in a bounded table per task. In every Arrow batch a share of the documents is
encoded by the sentencepiece library as well; a difference ends the job.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillhouse.llm.common import ship

SIGN = "▁"
NONE = np.int32(2**31 - 1)
#: Units of more characters are merged by a heap, one at a time.
LONG = 48
#: Units kept per task, and characters encoded at a time.
KEPT_UNITS, BATCH_CHARS = 500_000, 1_000_000


class PieceEncoder:
    """A merge-type model read through the sentencepiece library."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = lib.get_piece_size()
        fixed = {i for i in range(size) if lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i)}
        ids = {lib.id_to_piece(i): i for i in range(size) if i not in fixed}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.char_ids = {p: i for p, i in ids.items() if len(p) == 1}
        self.char_table = np.full(0x110000, -1, np.int32)
        self.char_table[[ord(c) for c in self.char_ids]] = list(self.char_ids.values())
        self._refuse_others(lib, size)
        scores = np.array([lib.get_score(i) for i in range(size)])
        ranks = np.unique(-scores, return_inverse=True)[1]
        keys, merged = [], []
        for piece, i in ids.items():
            for at in range(1, len(piece)):
                left, right = ids.get(piece[:at]), ids.get(piece[at:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.merged = np.array(merged, np.int32)[order]
        self.ranks = ranks[self.merged].astype(np.int32)
        self.pairs = dict(zip(keys, zip(ranks[merged].tolist(), merged)))
        # A character in no longer piece stands alone.
        joined = set("".join(p for p in ids if len(p) > 1))
        alone = "\n" if "\n" not in joined else ""
        self.unit = re.compile(f"{SIGN}*[^{SIGN}{alone}]+|{SIGN}+" + (f"|{alone}" if alone else ""))
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _refuse_others(lib, size: int) -> None:
        """Only models that keep text as it is, with a blank in front, byte fallback
        and no piece that reaches over the start of a word."""
        text = " a\t 　bﬁ "
        as_is = SIGN + text.replace(" ", SIGN)
        crossing = any(SIGN in p.lstrip(SIGN) for p in map(lib.id_to_piece, range(size)))
        kinds = any(lib.is_unused(i) for i in range(size)) or not any(lib.is_byte(i) for i in range(size))
        if lib.normalize(text) not in (as_is, as_is[1:]) or crossing or kinds or lib.encode(" ") == lib.encode(""):
            raise ValueError("this model normalises text or has pieces that are not merged")

    # --- merging ---------------------------------------------------------------

    def _to_bytes(self, unit: str, symbols: list[tuple[int, int]]) -> bytes:
        """Ids as int32 bytes; symbols are (id, start), id -1 is a character without a piece."""
        ids: list[int] = []
        for i, start in symbols:
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.byte_ids[b] for b in unit[start].encode("utf-8"))
        return np.array(ids, np.int32).tobytes()

    def merge_by_heap(self, unit: str) -> bytes:
        """One unit by an agenda in a heap."""
        sym = [self.char_ids.get(c, -1) for c in unit]
        n = len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and sym[i] >= 0 and sym[j] >= 0 and (found := self.pairs.get(sym[i] << 32 | sym[j])):
                heapq.heappush(agenda, (found[0], i, j, sym[i] << 32 | sym[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, pair, piece = heapq.heappop(agenda)
            # An entry is stale when one of its symbols has been merged since.
            if after[i] != j or sym[i] << 32 | sym[j] != pair:
                continue
            sym[i], sym[j] = piece, -2
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            after[j] = -1
            offer(before[i], i)
            offer(i, after[i])
        return self._to_bytes(unit, [(s, i) for i, s in enumerate(sym) if s != -2])

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; rank NONE where the pair is no piece."""
        key = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.merged[at]

    def merge_rows(self, units: list[str]) -> list[bytes]:
        """Units of up to LONG characters, all rows at once.

        Symbols keep their cells; each cell knows the next and the previous one in use.
        """
        rows, width = len(units), max(map(len, units)) + 1
        # -1: a character without a piece; -3: behind the end, or merged into another.
        sym = np.full(rows * width, -3, np.int32)
        lengths = np.array([len(u) for u in units])
        sym[(np.arange(width) < lengths[:, None]).ravel()] = self.char_table[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        rank, merged = np.full(rows * width, NONE, np.int32), np.zeros(rows * width, np.int32)
        rank[:-1], merged[:-1] = self._lookup(sym[:-1], sym[1:])
        cells = np.arange(rows * width, dtype=np.int32)
        after, before = cells + 1, cells - 1
        rank = rank.reshape(rows, width)
        flat = rank.ravel()
        live = np.arange(rows)
        while len(live):
            ranks = rank if len(live) == rows else rank[live]
            best = live * width + ranks.argmin(axis=1)
            more = flat[best] != NONE
            if not more.all():
                live, best = live[more], best[more]
            gone = after[best]
            sym[best], sym[gone] = merged[best], -3
            then = after[gone]
            after[best], before[np.minimum(then, rows * width - 1)] = then, best
            flat[gone] = NONE
            # Cells next to a row's ends are empty or of another row: no pair there.
            flat[best], merged[best] = self._lookup(sym[best], sym[np.minimum(then, rows * width - 1)])
            inner = best % width > 0
            left = before[best[inner]]
            flat[left], merged[left] = self._lookup(sym[left], sym[best[inner]])
        grid = sym.reshape(rows, width)
        counts = (grid != -3).sum(axis=1)
        ids = sym[sym != -3].tobytes()
        ends = np.cumsum(counts) * 4
        starts = ends - counts * 4
        out = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        for r in np.flatnonzero((grid == -1).any(axis=1)).tolist():
            out[r] = self.merge_by_heap(units[r])
        return out

    def learn(self, units: set[str]) -> None:
        """Merges the units that are not kept yet."""
        fresh = sorted(units.difference(self.known), key=len)
        if len(self.known) + len(fresh) > KEPT_UNITS:
            self.known = {}
            fresh = sorted(units, key=len)
        short = [u for u in fresh if len(u) <= LONG]
        for a in range(0, len(short), 4096):
            part = short[a : a + 4096]
            self.known.update(zip(part, self.merge_rows(part)))
        for u in fresh[len(short) :]:
            self.known[u] = self.merge_by_heap(u)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as int32 bytes; none for an empty text."""
        cut = [self.unit.findall(SIGN + t.replace(" ", SIGN)) if t else [] for t in texts]
        self.learn(set(itertools.chain.from_iterable(cut)))
        get = self.known.__getitem__
        return [b"".join(map(get, units)) for units in cut]

    def check(self, texts: list[str], found: list[bytes]) -> None:
        for text, expected, own in zip(texts, self.library.encode(texts), found):
            if np.array(expected, np.int32).tobytes() != own:
                raise ValueError(f"differs from the sentencepiece library: {text[:200]!r}")


#: What this worker process has loaded, by model.
_ENCODERS: dict[int, PieceEncoder] = {}
_LIBRARIES: dict[int, object] = {}
#: Rows taken out of an Arrow batch at a time.
ROWS = 128


def encoder_of(model: bytes) -> PieceEncoder:
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(model)
    return _ENCODERS[key]


def library_of(model: bytes):
    """The library's processor in this worker process."""
    import sentencepiece

    key = hash(model)
    if key not in _LIBRARIES:
        _LIBRARIES.clear()
        _LIBRARIES[key] = sentencepiece.SentencePieceProcessor(model_proto=model)
    return _LIBRARIES[key]


def _pieces(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of about so many characters; a longer text is a range of its own."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def _parts(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of a batch with their texts, few enough to hold as Python strings."""
    for first in range(0, batch.num_rows, ROWS):
        texts = [t or "" for t in batch.column(at).slice(first, ROWS).to_pylist()]
        for a, b in _pieces(texts, BATCH_CHARS):
            yield first + a, first + b, texts[a:b]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", check_every: int = 16) -> DataFrame:
    """The rows with `ids_col`, the ids of each whole text, without begin or end ids.

    A null text has no ids, like an empty one. Rows, repeated or not, stay as they
    are; a column named `ids_col` is replaced. One text in `check_every` of each
    batch, the first included, is compared with the library.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(_read(model_path))
    rows = docs.drop(ids_col)
    at = rows.columns.index(text_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        for batch in batches:
            for a, b, part in _parts(batch, at):
                found = encoder.encode(part)
                encoder.check(part[::check_every], found[::check_every])
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(f) // 4 for f in found], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                item = pa.field("element", pa.int32(), False)
                ids = pa.ListArray.from_arrays(pa.array(offsets), values, type=pa.list_(item))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, ids], names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with `text_col`, what the library decodes from the ids; null ids give
    an empty text. A column named `text_col` is replaced."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(_read(model_path))
    rows = docs.drop(text_col)
    at = rows.columns.index(ids_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = library_of(model.value)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                texts = [library.decode(ids) if ids else "" for ids in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
