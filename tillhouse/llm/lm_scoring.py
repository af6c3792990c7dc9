"""Cross-entropy difference between matched target and background n-gram models.

Both models read the same symbols: all 256 bytes of UTF-8, none taken for another, and one that
stands before a text. They have the same order and the same smoothing, so what they differ by is
the text they counted: the target's documents, and all documents. A symbol's loss is -log2 of its
probability after the three before it; a document's score is its mean background loss minus its
mean target loss, higher for text like the target.

Counts cover every document. They grow with the corpus, so they are a table that no process holds
as a whole: documents are put into blocks, a block counts its own n-grams, and only a block's own
n-grams come back to it with their losses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import cut, ship

SYMBOLS, ORDER = 257, 4
START = SYMBOLS - 1
DISCOUNT = 0.75
#: A symbol for each byte; START stands for what is before a text.
CLASSES = np.arange(256)
MODELS = ("target", "background")

# Documents of a block, which a task holds at once, are two to this power.
BLOCK_BITS = 10
# Texts whose codes are made at once.
AT_ONCE = 256


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram codes of all bytes, text after text, and the length of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    pad = b"\0" * (ORDER - 1)
    joined = CLASSES[np.frombuffer(pad + b"".join(t + pad for t in texts), np.uint8)]
    # Texts and padding in turn; a code is placed by its last symbol.
    runs = np.full(2 * len(texts) + 1, ORDER - 1)
    runs[1::2] = lengths
    real = np.repeat(np.arange(len(runs)) % 2 == 1, runs)
    joined[~real] = START
    last = len(joined) - ORDER + 1
    codes = np.zeros(last, np.int64)
    for i in range(ORDER):
        codes = codes * SYMBOLS + joined[i : last + i]
    return codes[real[ORDER - 1 :]], lengths


def _bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def in_blocks(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, text, is_target, block` of all rows, written, so that blocks stay as they are.

    Blocks are dealt by place, so that no key fills one.
    """
    ids = target.select(F.col(id_col).alias("t_id")).where(F.col("t_id").isNotNull()).distinct()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # The target grows with the corpus, so it is never broadcast: one plan for every size.
    marked = rows.join(ids.hint("merge"), F.col("doc_id") == F.col("t_id"), "left")
    place = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    return cut(marked.select("doc_id", "text", F.col("t_id").isNotNull().alias("is_target"), place.alias("block")), "lm_blocks", "zstd")


def count(blocks: DataFrame) -> DataFrame:
    """`block, code, target, background` from rows of `text, is_target, block`.

    A block that is read in parts gives a row of a code for each of them.
    """

    def of_block(block: int, texts: list[bytes], inside: list[bool]) -> Iterator[pa.RecordBatch]:
        parts = []
        for a in range(0, len(texts), AT_ONCE):
            codes, lengths = codes_of(texts[a : a + AT_ONCE])
            # The last bit tells the target's.
            parts.append(np.unique(2 * codes + np.repeat(inside[a : a + AT_ONCE], lengths), return_counts=True))
        marked = np.concatenate([p[0] for p in parts])
        codes, place = np.unique(marked >> 1, return_inverse=True)
        n = np.concatenate([p[1] for p in parts])
        sums = [np.bincount(place, np.where(marked & 1, n, 0), len(codes)), np.bincount(place, n, len(codes))]
        columns = [pa.array(np.full(len(codes), block)), pa.array(codes), *[pa.array(s.astype(np.int64)) for s in sums]]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "code", *MODELS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, texts, inside = None, [], []
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if texts and numbers[a] != current:
                    yield from of_block(current, texts, inside)
                    texts, inside = [], []
                part = batch.slice(a, b - a)
                current = numbers[a]
                texts += _bytes(part.column(1))
                inside += part.column(2).to_pylist()
        if texts:
            yield from of_block(current, texts, inside)

    return blocks.select("block", "text", "is_target").mapInArrow(run, "block long, code long, target long, background long")


def fit(counted: DataFrame) -> DataFrame:
    """`code, target, background`: the counts of both models, a row for each code that occurs."""
    return cut(counted.groupBy("code").agg(*[F.sum(m).alias(m) for m in MODELS]), "lm_counts")


def probabilities(asked: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """`code, target, background`: what each model gives the last symbol of a code after those before it.

    `asked` are distinct codes of some order, whether they occur or not; `counts` those of `fit`, by codes of that order.
    Absolute discounting: what is taken from the symbols seen after a history is shared out as
    the next shorter history does; at the end stands one more of each symbol.
    """
    seen = lambda m: F.coalesce(F.col(f"n_{m}"), F.lit(0))
    own = counts.select("code", *[F.col(m).alias(f"n_{m}") for m in MODELS])
    found = asked.join(own, "code", "left")
    if order == 1:
        whole = counts.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(f"all_{m}") for m in MODELS])
        return found.crossJoin(F.broadcast(whole)).select("code", *[((seen(m) + 1) / (F.col(f"all_{m}") + SYMBOLS)).alias(m) for m in MODELS])
    history, shorter = F.expr(f"code div {SYMBOLS}"), F.col("code") % F.lit(SYMBOLS ** (order - 1))
    after = counts.groupBy(history.alias("history")).agg(
        *[F.sum(m).alias(f"all_{m}") for m in MODELS], *[F.count_if(F.col(m) > 0).alias(f"kinds_{m}") for m in MODELS]
    )
    lower = counts.groupBy(shorter.alias("code")).agg(*[F.sum(m).alias(m) for m in MODELS])
    found = found.withColumns({"history": history, "shorter": shorter})
    below = probabilities(found.select(F.col("shorter").alias("code")).distinct(), lower, order - 1)
    below = below.select(F.col("code").alias("shorter"), *[F.col(m).alias(f"less_{m}") for m in MODELS])
    found = found.join(after, "history", "left").join(below, "shorter")

    def interpolated(m: str) -> Column:
        total, less = F.col(f"all_{m}"), F.col(f"less_{m}")
        known = (F.greatest(seen(m) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"kinds_{m}") * less) / total
        return F.when(total > 0, known).otherwise(less)

    return found.select("code", *[interpolated(m).alias(m) for m in MODELS])


def losses(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """`code, target, background`: -log2 of the probabilities of distinct codes."""
    return probabilities(asked, counts).select("code", *[(-F.log2(m)).alias(m) for m in MODELS])


def score(blocks: DataFrame, priced: DataFrame) -> DataFrame:
    """`doc_id, n_tokens, target_loss, background_loss, score` per row of `doc_id, text, block`.

    `priced` has the losses of all codes of each block, as `block, code, target, background`. Losses are means in
    bits per symbol, over the whole text. A null or empty text has no symbols and null losses and score. Rows, repeated
    or with a null id, stay.
    """
    kind = blocks.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        known = table.column("code").to_numpy()
        order = np.argsort(known)
        known = known[order]
        loss = [table.column(m).to_numpy()[order] for m in MODELS]
        n_tokens, means = [], ([], [])
        texts = _bytes(docs.column("text"))
        for a in range(0, len(texts), AT_ONCE):
            codes, lengths = codes_of(texts[a : a + AT_ONCE])
            place, ends = np.searchsorted(known, codes), np.cumsum(lengths)
            if not (known[place] == codes).all():
                raise ValueError("a block has n-grams without a loss")
            for mean, of_code in zip(means, loss):
                sums = np.concatenate([[0.0], np.cumsum(of_code[place])])
                mean.append((sums[ends] - sums[ends - lengths]) / np.maximum(lengths, 1))
            n_tokens.append(lengths)
        n, (t, b) = np.concatenate(n_tokens), [np.concatenate(m) for m in means]
        arrays = [pa.array(m, mask=n == 0) for m in (t, b, b - t)]
        return pa.Table.from_arrays([docs.column("doc_id"), pa.array(n), *arrays], names=names)

    fields = f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, score double"
    texts = blocks.select("block", "doc_id", "text").groupBy("block")
    return texts.cogroup(priced.select("block", "code", *MODELS).groupBy("block")).applyInArrow(run, fields)


def cross_entropy_difference(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents; `target` has the ids of the target's documents.

    See `score`. Without target documents the target model knows nothing but the symbols.
    """
    ship(docs.sparkSession)
    blocks = in_blocks(docs, target, id_col, text_col)
    counted = cut(count(blocks), "lm_block_counts")
    counts = fit(counted)
    priced = counted.select("block", "code").distinct().join(losses(counts.select("code"), counts), "code")
    return score(blocks, priced)
