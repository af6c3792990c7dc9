"""Casting to a target table, and setting aside what does not fit.

Nothing is dropped silently: a row that misses a required value, or has a value
that does not fit its column, keeps its place with a `reject_reason`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.values import filled, to_day, to_instant
from tillhouse.schemas import Table

REASON = "reject_reason"

_CASTS = {
    "string": lambda raw: raw,
    "double": lambda raw: raw.try_cast("double"),
    "boolean": lambda raw: raw.try_cast("boolean"),
    "date": to_day,
    "timestamp": to_instant,
}


def enforce(rows: DataFrame, table: Table, extra: list[str] = (), defects: list[Column] = ()) -> DataFrame:
    """Casts the table's columns and adds `reject_reason`.

    Columns that already have their target type are taken as they are. `extra`
    columns are carried along; `defects` are further reasons, null when fine.
    """
    given = {field.name: field.dataType for field in rows.schema}
    values, reasons = [], list(defects)
    for name, kind in table.types.items():
        raw = F.col(name)
        value = raw if given[name] == kind else _CASTS[kind.simpleString()](raw)
        values.append(value.alias(name))
        if given[name] != kind:
            reasons.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"bad {name}")))
        if name in table.required:
            # A value that did not fit before is null by now, and named in `defects`.
            reasons.append(F.when(raw.isNull(), F.lit(f"missing {name}")))
    reason = F.nullif(F.concat_ws(", ", *reasons), F.lit("")) if reasons else F.lit(None).cast("string")
    return rows.select(*values, reason.alias(REASON), *extra)


def accepted(enforced: DataFrame, table: Table) -> DataFrame:
    return enforced.where(F.col(REASON).isNull()).select(*table.columns)


def rejected(enforced: DataFrame) -> DataFrame:
    return enforced.where(F.col(REASON).isNotNull())


def strict(enforced: DataFrame) -> DataFrame:
    """Rejects every row of a restaurant that has a rejected row."""
    failed = rejected(enforced).select("restaurant_guid").distinct().withColumn("_failed", F.lit(True))
    reason = F.when(F.col("_failed"), F.coalesce(F.col(REASON), F.lit("restaurant batch failed")))
    return enforced.join(failed, "restaurant_guid", "left").withColumn(REASON, reason).select(*enforced.columns)


def require_all(enforced: DataFrame, table: Table) -> DataFrame:
    """Stops the job at the first row that does not fit."""
    stop = F.raise_error(F.concat(F.lit(f"{table.name}: "), F.col(REASON)))
    checked = enforced.withColumn(REASON, F.when(F.col(REASON).isNotNull(), stop))
    # The test keeps the check in the plan although its column is dropped.
    return checked.where(F.col(REASON).isNull()).select(*table.columns)


def keyed(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are neither null nor empty."""
    for key in keys:
        rows = rows.where(filled(F.col(key)))
    return rows
