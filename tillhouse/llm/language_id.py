"""Language identification by cross-parsing entropy.

For each labelled language a suffix automaton of some of its text is built. A new text is
parsed against it: the longest match from the current place is a phrase, the next phrase
begins behind it. Text of the same language has longer matches, so fewer phrases; with
n phrases against N characters of a language, n * log2(N) estimates the bits it takes.
The language that needs the fewest wins.

Only letters count: a run of anything else is one mark between words. Letters that the samples
have most are one symbol each, every other letter is its code point in DIGITS symbols, so
that all letters are told apart by tables of bounded width. Automata become tables, and many segments of text walk
through them side by side.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import ship

#: Labelled documents per language that are learned from, and characters of each: the
#: bound of the sample, and so of the automata.
DOCS, CHARS = 120, 300
#: Letters with a symbol of their own, the most frequent of the samples; the others are
#: written with DIGITS symbols of base BASE.
ALPHABET = 96
BASE, DIGITS = 32, 4
#: A text is parsed in segments of so many characters, so many segments at a time.
SEGMENT, LANES = 256, 4096
LETTER = regex.compile(r"\p{L}")


def learn(labelled: DataFrame, docs: int = DOCS, chars: int = CHARS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """(language, sample) of each language: `chars` characters each, from a hashed place of the
    whole text, of `docs` documents chosen by a hash of their id. Rows with a null id,
    language or text are not learned."""
    usable = labelled.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).withColumn("n", F.row_number().over(order))
    chosen = [r.id for r in ids.where(F.col("n") <= docs).collect()]
    places = F.greatest(F.length(text_col) - chars, F.lit(0)) + 1
    window = F.substring(F.col(text_col), (F.pmod(F.xxhash64(F.col(id_col), F.lit("place")), places) + 1).cast("int"), F.lit(chars))
    rows = usable.where(F.col(id_col).isin(chosen)).select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), window.alias("text"))
    parts: dict[str, list] = {}
    for r in rows.collect():
        parts.setdefault(r.lang, []).append((str(r.id), r.text))
    return [(lang, " ".join(t for _, t in sorted(parts[lang])[:docs])) for lang in sorted(parts)]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state; state 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        current = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = current
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[current] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    return nexts


class Parser:
    """The automata of all languages as tables."""

    def __init__(self, samples: list[tuple[str, str]]):
        self.langs = [lang for lang, _ in samples]
        counts = Counter(c for _, text in samples for c in text.lower() if c.isalpha())
        known = sorted(c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET])
        # Classes: 0 what is no letter, 1 other letters, then the known, digits; the last pads.
        self.classes = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)
        for i, c in enumerate(known, 2):
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1:
                    self.classes[ord(form)] = i
        self.digits = len(known) + 2
        self.width = self.digits + BASE + 1
        self.tables, self.bits = [], []
        for _, text in samples:
            symbols = self.symbols(text)
            self.tables.append(self._table(suffix_automaton(symbols.tolist())))
            self.bits.append(np.log2(max(2, len(symbols))))

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text's characters, a run without letters as one."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        own = self.classes[points]
        keep = own > 0
        keep[1:] |= own[:-1] > 0
        own, points = own[keep], points[keep]
        other = own == 1
        if not other.any():
            return own
        sizes = np.where(other, DIGITS, 1)
        out = np.repeat(own, sizes)
        starts = (np.cumsum(sizes) - sizes)[other]
        for i in range(DIGITS):
            out[starts + i] = self.digits + points[other] // BASE ** (DIGITS - 1 - i) % BASE
        return out

    def _table(self, nexts: list[dict[int, int]]) -> np.ndarray:
        """Next state by state and class, times the width; where a phrase ends, the
        complement of the state after starting again with that class."""
        start = np.zeros(self.width, np.int32)
        for c, target in nexts[0].items():
            start[c] = target * self.width
        table = np.tile(~start, (len(nexts), 1))
        for state, own in enumerate(nexts):
            for c, target in own.items():
                table[state, c] = target * self.width
        table[:, -1] = np.arange(len(nexts), dtype=np.int32) * self.width
        return table.ravel()

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases per text (rows) and language (columns).

        A phrase is the longest match, with the next character if the language has none
        such; segments are parsed on their own.
        """
        cells = [(len(t) + SEGMENT - 1) // SEGMENT for t in texts]
        owner = np.repeat(np.arange(len(texts)), cells)
        grid = np.full((len(owner), SEGMENT), self.width - 1, np.uint8)
        row = 0
        for text, n in zip(texts, cells):
            if n:
                grid[row : row + n].reshape(-1)[: len(text)] = text
            row += n
        found = np.zeros((len(texts), len(self.langs)), np.int64)
        for a in range(0, len(owner), LANES):
            steps = np.ascontiguousarray(grid[a : a + LANES].T).astype(np.int32)
            for k, table in enumerate(self.tables):
                state = np.zeros(steps.shape[1], np.int32)
                ended = np.zeros(steps.shape[1], np.int32)
                for symbols in steps:
                    state = table[state + symbols]
                    sign = state >> 31
                    ended -= sign
                    state ^= sign
                np.add.at(found[:, k], owner[a : a + LANES], ended + (state != 0))
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lettered = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not lettered or not self.langs:
            return langs, scores
        bits = self.phrases([self.symbols(texts[i]) for i in lettered]) * np.array(self.bits)
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        second = ordered[:, 1] if len(self.langs) > 1 else np.full(len(lettered), np.inf)
        for i, b, low, high in zip(lettered, best.tolist(), ordered[:, 0].tolist(), second.tolist()):
            langs[i], scores[i] = self.langs[b], 1 - low / high
        return langs, scores


#: The parser of this worker process.
_PARSERS: dict[int, Parser] = {}


def parser_of(samples: list[tuple[str, str]]) -> Parser:
    key = hash(tuple(samples))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(samples)
    return _PARSERS[key]


def identify(docs: DataFrame, samples: list[tuple[str, str]], text_col: str = "text") -> DataFrame:
    """The rows with `lang_pred` and `score`, from whole texts.

    `und` with score 0 where the text is null or has no letter, or nothing was learned.
    The score is the share of bits saved against the second language, from 0 to 1; of
    equals the first by name wins. Columns of these names are replaced.
    """
    ship(docs.sparkSession)
    rows = docs.drop("lang_pred", "score")
    at = rows.columns.index(text_col)
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_of(sent.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                langs, scores = parser.predict(part.column(at).to_pylist())
                columns = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
