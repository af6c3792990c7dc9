"""Which restaurants and days a run covers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.values import to_instant
from tillhouse.sources.tenants import dataset_of

ALL = "ALL"


def restaurants_of(tenants: DataFrame, tenant: str, restaurant_guid: str | None = None) -> DataFrame:
    """The `restaurant_guid`s of a run.

    No guid, or "ALL", means every restaurant of the tenant; any other guid is
    taken as it is. An unknown tenant raises `KeyError`. Tenant rows are passed on
    as they are: a semi-join needs no distinct list, and without an aggregate in
    between adaptive execution can split a restaurant that has most of the rows.
    """
    dataset_of(tenants, tenant)
    if restaurant_guid and restaurant_guid != ALL:
        return tenants.sparkSession.createDataFrame([(restaurant_guid,)], "restaurant_guid string")
    return tenants.where(F.col("tenant") == tenant).select("restaurant_guid")


def in_restaurants(rows: DataFrame, restaurants: DataFrame, restaurant_guid: str | None = None) -> DataFrame:
    """Rows of the given restaurants.

    One restaurant is a plain filter, which prunes folders and moves nothing. For several, a
    semi-join on the partition column lets Spark prune folders at run time. It
    is left to Spark whether the restaurant list is small enough to broadcast.
    """
    if restaurant_guid and restaurant_guid != ALL:
        return rows.where(F.col("restaurant_guid") == restaurant_guid)
    return rows.join(restaurants, "restaurant_guid", "left_semi")


def date_range(start: str | None = None, end: str | None = None, today: dt.date | None = None) -> tuple[str, str]:
    """`start` defaults to yesterday (UTC), `end` to `start`."""
    if not start:
        today = today or dt.datetime.now(dt.timezone.utc).date()
        start = (today - dt.timedelta(days=1)).isoformat()
    return start, end or start


def _day(text: str) -> Column:
    return F.lit(dt.date.fromisoformat(text))


def in_query_days(pages: DataFrame, start: str, end: str) -> DataFrame:
    """Pages asked for on the days of the range; prunes partition folders."""
    return pages.where(F.col("query_date").between(_day(start), _day(end)))


def in_instants(rows: DataFrame, raw: Column, start: str, end: str) -> DataFrame:
    """Rows whose timestamp text lies from the start of `start` to the end of `end`, UTC."""
    instant = to_instant(raw)
    first = _day(start).cast("timestamp")
    after = F.date_add(_day(end), 1).cast("timestamp")
    return rows.where((instant >= first) & (instant < after))
