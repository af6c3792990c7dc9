"""Versions of dimension rows over time (type 2 history)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VALID = ["valid_from", "valid_to", "is_current"]


def _row_hash(columns: list[str]):
    # Marks nulls, so that a null and an empty text differ.
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def one_per_snapshot(snapshots: DataFrame, keys: list[str], day: str) -> DataFrame:
    """One row per key and snapshot, combined before the shuffle.

    What is left of a key is at most one row per snapshot, however often it was
    repeated, so the ranking below works on groups bounded by the calendar.
    """
    values = [c for c in snapshots.columns if c not in (*keys, day)]
    return snapshots.groupBy(*keys, day).agg(F.min(F.struct(*values)).alias("row")).select(*keys, day, "row.*")


def history_of(snapshots: DataFrame, keys: list[str], tracked: list[str], day: str = "snapshot_date") -> DataFrame:
    """Version rows from a table of snapshots.

    A version ends where the tracked columns change, or at the first snapshot that
    no longer has the key; the key opens a new version when it comes back.
    """
    # One row per snapshot day: bounded by the calendar, hence one task and a broadcast.
    days = snapshots.select(day).distinct()
    following = days.select(F.col(day), F.lead(day).over(Window.orderBy(day)).alias("next_day"))
    rows = one_per_snapshot(snapshots.select(*keys, day, *tracked), keys, day).join(F.broadcast(following), day)
    by_key = Window.partitionBy(*keys).orderBy(day)
    marked = rows.withColumn("_hash", _row_hash(tracked)).withColumns(
        {
            "_same": F.lag("_hash").over(by_key) == F.col("_hash"),
            "_unbroken": F.lag("next_day").over(by_key) == F.col(day),
        }
    )
    starts = ~(F.coalesce(F.col("_same"), F.lit(False)) & F.coalesce(F.col("_unbroken"), F.lit(False)))
    numbered = marked.withColumn("_version", F.sum(starts.cast("int")).over(by_key))
    versions = numbered.groupBy(*keys, "_version").agg(
        *[F.min_by(c, day).alias(c) for c in tracked],
        F.min(day).alias("valid_from"),
        F.max_by("next_day", day).alias("valid_to"),
    )
    return versions.select(*keys, *tracked, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def next_versions(opened: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str], day) -> DataFrame:
    """What the open versions become with a snapshot taken on `day`.

    Changed and vanished keys are closed, changed and new ones opened; each side is
    one row per key. Closed versions of before are not needed.
    """
    now = F.lit(day).cast("date")
    fresh = snapshot.groupBy(*keys).agg(F.min(F.struct(*tracked)).alias("new"))
    met = opened.select(*keys, F.struct(*tracked).alias("old"), "valid_from").join(fresh, keys, "full_outer")
    same = F.col("old").eqNullSafe(F.col("new"))
    old_version = F.struct(
        F.col("old").alias("row"),
        F.col("valid_from"),
        F.when(~same, now).alias("valid_to"),
        same.alias("is_current"),
    )
    new_version = F.struct(
        F.col("new").alias("row"),
        now.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    versions = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), old_version),
            F.when(F.col("new").isNotNull() & ~same, new_version),
        )
    )
    return met.select(*keys, F.explode(versions).alias("v")).select(
        *keys, "v.row.*", "v.valid_from", "v.valid_to", "v.is_current"
    )


def apply_snapshot(history: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str], day) -> DataFrame:
    """History after one more snapshot taken on `day`. Closed versions pass through."""
    closed = history.where(~F.col("is_current")).select(*keys, *tracked, *VALID)
    return closed.unionByName(next_versions(history.where("is_current"), snapshot, keys, tracked, day))


def valid_on(days: DataFrame, versions: DataFrame, keys: list[str], carried: list[str], day: str = "business_date") -> DataFrame:
    """`keys, day` with the `carried` columns of the version valid then, one row for each pair in `days`.

    A day before the first version, or on or after the end of a key's last one, gets nulls. Both
    sides meet by key and are sorted by day; the last version is carried forward, so neither days nor versions
    are multiplied. Of `days` only distinct pairs are used: a key has at most one row
    per day, however many facts it has.
    """
    nothing = F.lit(None).cast(f"struct<{','.join(f'`{c}`:{versions.schema[c].dataType.simpleString()}' for c in carried)},valid_to:date>")
    asked = days.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).select(*keys, day).distinct()
    version = F.struct(*carried, "valid_to")
    both = versions.select(*keys, F.col("valid_from").alias(day), F.lit(0).alias("_kind"), version.alias("_version")).unionByName(
        asked.select(*keys, day, F.lit(1).alias("_kind"), nothing.alias("_version"))
    )
    so_far = Window.partitionBy(*keys).orderBy(day, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = both.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).where("_kind = 1")
    holds = F.col("_version.valid_to").isNull() | (F.col(day) < F.col("_version.valid_to"))
    return told.select(*keys, day, *[F.when(holds, F.col("_version")[c]).alias(c) for c in carried])
