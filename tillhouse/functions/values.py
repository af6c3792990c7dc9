"""Column functions for single values of a document.

A value "counts" when it is neither absent nor empty, zero or false; many fields
take the first of several values that counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(raw: Column) -> Column:
    """Neither null nor an empty string."""
    return F.coalesce(raw, F.lit("")) != ""


def first_text(raw: Column, *others: Column) -> Column:
    """First non-empty text; when none counts, the last one as it is."""
    chain = [raw, *others]
    return reduce(lambda rest, head: F.when(filled(head), head).otherwise(rest), reversed(chain))


def first_struct(fields: list[str], first: Column, second: Column) -> Column:
    """The first object unless it is empty; an empty object parses to all nulls."""
    used = reduce(lambda a, b: a | b, [first[name].isNotNull() for name in fields])
    return F.when(used, first).otherwise(second)


def flag(value: Column) -> Column:
    """False when absent or null."""
    return F.coalesce(value, F.lit(False))


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def first_number(*values: Column) -> Column:
    """The first number that is not zero; zero when none counts."""
    return F.coalesce(*[F.nullif(value, F.lit(0.0)) for value in values], F.lit(0.0))


def iso_day(raw: Column) -> Column:
    """`20260208` becomes `2026-02-08`; anything else stays as it is."""
    dashed = F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2), F.substring(raw, 7, 2))
    return F.when(raw.rlike("^[0-9]{8}$"), dashed).otherwise(raw)


def to_day(raw: Column) -> Column:
    """A date from `yyyy-mm-dd` only; shorter forms would be read as January 1st."""
    return F.when(raw.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), raw.try_cast("date"))


def utc_suffix(raw: Column) -> Column:
    """`+0000`, or else `-0000`, becomes `Z`; other offsets stay."""
    return (
        F.when(raw.contains("+0000"), F.replace(raw, F.lit("+0000"), F.lit("Z")))
        .when(raw.contains("-0000"), F.replace(raw, F.lit("-0000"), F.lit("Z")))
        .otherwise(raw)
    )


def to_instant(raw: Column) -> Column:
    """A timestamp from text that starts with a full date; any offset is honoured."""
    dated = (F.substring(raw, 5, 1) == "-") & (F.substring(raw, 8, 1) == "-")
    return F.when(dated, raw.try_cast("timestamp"))
