"""Inserting rows whose key is not in the target yet.

The target wins, and a key that is new may come more than once in a batch.

A key that makes up a large share of a batch would send all its rows to one task
of the join. Such keys are found first; there can be at most `SHARE` of them, so
they are safe to broadcast, and their rows are decided without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot with more than one in SHARE of a batch's rows.
SHARE = 1024


def hot_keys(staged: DataFrame, keys: list[str], hot_rows: int = 0) -> DataFrame:
    """Keys with more than `hot_rows` and 1/SHARE of the rows: fewer than SHARE."""
    total = staged.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        staged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > hot_rows) & (F.col("n") * SHARE > total))
        .select(*keys)
    )


def not_in_target(
    staged: DataFrame, target: DataFrame, keys: list[str], hot_rows: int | None = 0
) -> DataFrame:
    """Staged rows without a match in the target on all keys.

    Pass staged rows that are cheap to read again, such as a staged table: they
    are counted by key first. `hot_rows=None` says that no key repeats in them.
    """
    # Of the target only keys of the batch matter: the batch's distinct keys go to it,
    # broadcast where they turn out small, before any key of the target is moved.
    # Counted as `hot_keys` counts them, so that one shuffle serves both; the test keeps the count in the plan.
    batch = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(*keys)
    known = target.select(*keys).join(batch, keys, "left_semi")
    if hot_rows is None:
        return staged.join(known.distinct(), keys, "left_anti").select(*staged.columns)
    hot = hot_keys(staged, keys, hot_rows)
    # At most SHARE keys on either side of these joins.
    known_hot = known.join(F.broadcast(hot), keys, "left_semi").distinct()
    hot_rows_new = staged.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(known_hot), keys, "left_anti")
    # `distinct` combines before the shuffle, so a key repeated in the target is
    # one row by then; the join reuses its partitioning.
    cold = staged.join(F.broadcast(hot), keys, "left_anti")
    cold_new = cold.join(known.distinct(), keys, "left_anti")
    return cold_new.select(*staged.columns).unionByName(hot_rows_new.select(*staged.columns))


def one_per_key(staged: DataFrame, keys: list[str]) -> DataFrame:
    """Optional: one row per key of a batch, the smallest by all other columns.

    `min` combines before the shuffle, unlike ranking within a key.
    """
    values = [c for c in staged.columns if c not in keys]
    return staged.groupBy(*keys).agg(F.min(F.struct(*values)).alias("first")).select(
        *[F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in staged.columns]
    )


def load_metrics(staged: DataFrame, inserted: DataFrame) -> DataFrame:
    """`rows_staged, rows_inserted, duplicates_skipped` of one load."""
    marks = staged.select(F.lit(1).alias("s"), F.lit(0).alias("i")).unionAll(
        inserted.select(F.lit(0).alias("s"), F.lit(1).alias("i"))
    )
    return marks.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("rows_staged"),
        F.coalesce(F.sum("i"), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum("s") - F.sum("i"), F.lit(0)).alias("duplicates_skipped"),
    )
