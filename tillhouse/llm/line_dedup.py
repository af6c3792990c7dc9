"""Lines that stand in several documents, kept in one of them only.

Texts are exploded to lines. A line's key is the line without the blanks at its ends, in lower
case (A-Z); two hashes of 64 bits stand for it. Documents are counted per key, and the
keys in enough of them lose their lines in all documents but the first (smallest id).
What stays is put together again by position, from the text itself: of a dropped line
only its document and its position travel.

A key that a large share of all lines has would meet in one task of the join. Counting
spreads it over (key, document) first; for dropping it is broadcast, since fewer than
`SHARE` keys can have more than one in SHARE of all lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import BLANKS, cut, to_lower_ascii

# A key is frequent with more than one in SHARE of all lines.
SHARE = 1024


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row(text: Column) -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """`id, row, pos, a, b` of every line whose key has at least `min_chars` code points."""
    text = F.col(text_col)
    # The row's hash is taken below the generator, once for all lines of a text.
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), _row(text).alias("row"), text.alias("text"))
    lines = rows.select("id", "row", F.posexplode(lines_of(to_lower_ascii(F.col("text")))).alias("pos", "line"))
    key = F.btrim(F.col("line"), F.lit(BLANKS))
    kept = lines.where(F.char_length(key) >= min_chars)
    return kept.select("id", "row", "pos", F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def shared_keys(lines: DataFrame, min_docs: int = 2) -> DataFrame:
    """`a, b, n_lines, first` of the keys that at least `min_docs` documents hold."""
    # Counted per document before the shuffle, then per key: a frequent key is spread
    # over its documents and combined before it meets.
    per_doc = lines.groupBy("a", "b", "id").agg(F.count(F.lit(1)).alias("n"))
    keys = per_doc.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_lines"), F.min("id").alias("first")
    )
    return keys.where(F.col("n_docs") >= min_docs).select("a", "b", "n_lines", "first")


def dropped_lines(lines: DataFrame, shared: DataFrame, n_lines: int) -> DataFrame:
    """`id, row, pos` of the lines that another document keeps. Both inputs are written tables."""
    frequent = F.col("n_lines") * SHARE > F.lit(n_lines)
    hot = F.broadcast(shared.where(frequent).select("a", "b", "first"))
    cold = shared.where(~frequent).select("a", "b", "first")
    of_hot = lines.join(hot, ["a", "b"])
    of_cold = lines.join(hot.select("a", "b"), ["a", "b"], "left_anti").join(cold, ["a", "b"])
    return of_hot.unionByName(of_cold).where(F.col("id") > F.col("first")).select("id", "row", "pos")


def marks(gone: Column) -> Column:
    """True at each of the sorted positions `gone` and false between them, up to the last."""

    def up_to(at: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(gone, i - 1))
        return F.concat(F.array_repeat(F.lit(False), at - before - 1), F.array(F.lit(True)))

    return F.flatten(F.transform(gone, up_to))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The rows with `n_lines` (before dropping), `n_dropped` and `kept`, the text that is left.

    A null text is one empty line. Rows that repeat an id are one document: they are counted once and
    lose the same lines if their texts are equal. A row with a null id stays whole and counts for no key.
    Within the first document all lines of a key stay. Columns named like the three results are replaced.
    """
    names = ["n_lines", "n_dropped", "kept"]
    rows = docs.drop(*names)
    lines = cut(line_keys(docs, id_col, text_col, min_chars), "line_keys")
    shared = cut(shared_keys(lines, min_docs), "shared_lines")
    dropped = dropped_lines(lines, shared, lines.count())
    gone = dropped.groupBy("id", "row").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    gone = gone.select(*[F.col(c).alias(f"_line_{c}") for c in gone.columns])
    same = (F.col(id_col) == F.col("_line_id")) & (_row(F.col(text_col)) == F.col("_line_row"))
    # Nothing outside of its elements is named in a lambda: it would be worked out for each of them.
    pairs = F.arrays_zip(lines_of(F.col(text_col)).alias("line"), marks(F.col("_line_gone")).alias("gone"))
    found = rows.join(gone, same, "left").withColumn("_line_pairs", pairs)
    stays = F.filter("_line_pairs", lambda p: ~F.coalesce(p["gone"], F.lit(False)))
    left = F.array_join(F.transform(stays, lambda p: p["line"]), "\n")
    return found.select(
        *rows.columns,
        F.size(lines_of(F.col(text_col))).cast("long").alias("n_lines"),
        F.coalesce(F.size("_line_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_line_gone").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(left).alias("kept"),
    )
