"""Reductions over the payments of one check; the arrays never leave their row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tip_total(payments: Column) -> Column:
    """Sum of the tips in payment order; zero without payments."""
    total = F.aggregate(payments, F.lit(0.0), lambda tips, p: tips + F.coalesce(p["tipAmount"], F.lit(0.0)))
    return F.coalesce(total, F.lit(0.0))


def first_payment_type(payments: Column) -> Column:
    """First type that is not null; an empty type is a value."""
    return F.get(F.filter(payments, lambda p: p["type"].isNotNull()), F.lit(0))["type"]
