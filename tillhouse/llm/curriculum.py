"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a target number of words: its weight's part of the mix, at most
`max_repeats` times its own words; what that cuts off is shared out by weight again.
A source's documents stand in a fixed pseudo-random order; whole passes over all of them
and then a part of one more fill its target, so only the last document is cut.

A weight may change while training runs. Over training time t in [0, 1] a source's
share of each batch is `target * (1 + slope * (2 * t - 1))`: it integrates to the target,
and rises or falls by `slope`. The demand met by time t is the integral; a document's
place in its source's word stream is turned into a time by the inverse of that
integral, and sorting by time gives the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import cut, n_words

#: Hash prefixes that cut a source into parts, so that no window holds a whole source.
PART_DIGITS = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...], mix: float, max_repeats: int) -> DataFrame:
    """`source, source_size, weight, rank, target` from rows of `source, source_size`.

    Sources by code point, null last, take `weights` in turn. Water filling in closed
    form: ordered by the level at which they are full, sources are full up to the
    first level that the rest can share. One row per source, whatever the rows behind.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_repeats)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (total * mix - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = capped.withColumn("level", level)
    # The first source that is not full at its level sets the level of all behind it.
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "rank", "level")))
    shared = levels.withColumn("shared", open_level.over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("shared") * F.col("weight"), F.col("cap").cast("double")))
    return shared.select("source", "source_size", "weight", "rank", target.alias("target"))


def schedule_time(share: Column, slope: Column) -> Column:
    """The time by which a source has met `share` of its demand: the inverse of
    t + slope * (t * t - t), for slopes within [-1, 1]."""
    rest = 1 - slope
    root = F.sqrt(F.greatest(rest * rest + 4 * slope * share, F.lit(0.0)))
    return F.when(share <= 0, F.lit(0.0)).otherwise(2 * share / (rest + root))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    mix: float = 1.5,
    max_repeats: int = 2,
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """`doc_id, size, source, source_size, target, taken, position, positions` per document.

    `taken` is the words the mix takes from it, repeats counted; `positions` the training
    times of its copies and `position` the first of them, null where nothing is taken. A null or blank
    text has size 0 and takes nothing; null sources are one source, ranked last;
    a null or repeated id is a row like any other; other columns are not read. An empty
    table gives no rows. `slopes` turn like `weights`. Rows come sorted by position.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")
    ).withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # The text is read once: what follows works on these narrow rows.
    rows = cut(rows.withColumn("part", F.substring("key", 1, PART_DIGITS)), "mix_sizes")
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    along = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("source").alias("p_source"), F.col("part").alias("p_part"), F.coalesce(F.sum("part_size").over(along), F.lit(0)).alias("start")
    )
    sizes = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    slope = F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), (F.col("rank") % len(slopes) + 1).cast("int"))
    targets = source_targets(sizes, weights, mix, max_repeats).select(
        F.col("source").alias("t_source"), "source_size", "target", slope.alias("slope")
    )
    plan = starts.join(targets, F.col("p_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    same = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part"))
    inside = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(plan, same)
    before, wanted = F.col("start") + F.col("inner"), F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0).cast("long")
    rest = wanted - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before)).cast("long")
    # The words of each pass as one stream: the middle of each copy's words, as a share.
    copies = (passes + (part > 0).cast("long")).cast("int")
    length = lambda k: F.when(k < passes, F.col("size")).otherwise(part)
    share = lambda k: (2 * (k * F.col("source_size") + before) + length(k)) / (2 * wanted)
    times = F.transform(F.sequence(F.lit(0), copies - 1), lambda k: schedule_time(share(k), F.col("slope")))
    used = (copies > 0) & (F.col("size") > 0)
    chosen = placed.withColumn("positions", F.when(used, times).otherwise(F.array().cast("array<double>")))
    return chosen.select(
        "doc_id", "size", "source", "source_size", "target", (passes * F.col("size") + part).alias("taken"),
        F.get("positions", F.lit(0)).alias("position"), "positions",
    ).orderBy("position", "doc_id")


def in_order(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents the mix takes, one row per copy, range-sorted by training position.

    Documents stay whole: the copy that the mix would cut is put out in full. Rows with
    a null id are looked up like others; of rows that repeat an id each is put out.
    """
    plan = mixed.where(F.size("positions") > 0).select(F.col("doc_id").alias("_id"), F.col("positions").alias("_positions")).dropDuplicates(["_id"])
    taken = docs.join(plan, docs[id_col].eqNullSafe(F.col("_id")))
    placed = taken.select(*[docs[c] for c in docs.columns], F.explode("_positions").alias("_position"))
    return placed.repartitionByRange("_position").sortWithinPartitions("_position", id_col).drop("_position")
