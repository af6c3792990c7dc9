"""The registered queries: every operator over the driver's tables.

Each query runs over whole tables. Timestamps leave as zone-less UTC values and the
load stamp is left out, so that results can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.arrays import first_payment_type, tip_total
from tillhouse.functions.values import iso_day, to_day, to_instant, utc_suffix
from tillhouse.functions.windows import each_day, week_windows
from tillhouse.operators import flatten
from tillhouse.operators.enforce import REASON, accepted, enforce, rejected
from tillhouse.operators.history import history_of
from tillhouse.operators.insert import load_metrics, not_in_target, one_per_key
from tillhouse.operators.menus import menu_items
from tillhouse.operators.orders import with_lineage
from tillhouse.operators.scope import in_instants, in_restaurants, restaurants_of
from tillhouse.operators.summaries import reject_summary, rejected_row, tally
from tillhouse.operators.windows import backfill_plan, with_window
from tillhouse.plans import jobs, marts, testdata
from tillhouse.schemas import (
    DIM_EMPLOYEES,
    DIM_JOBS,
    DIM_MENU_ITEMS,
    DIM_RESTAURANTS,
    EMPLOYEE_DOC,
    FACT_ORDER_ITEMS,
    JOB_DOC,
    ORDER_TIMESTAMPS,
    RESTAURANT_DOC,
    Table,
)
from tillhouse.session import shared_folder, use_utc
from tillhouse.sinks.warehouse import Warehouse
from tillhouse.sources.envelope import documents, first_documents, menu_pages, parse_pages
from tillhouse.streaming.ingest import insert_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The loaded part of a table and the batch overlap by one period.
ORDERS_LOADED_BEFORE, ORDERS_BATCH_FROM = "1999-01-01", "1998-01-01"
EVENTS_LOADED_BEFORE, EVENTS_BATCH_FROM = "2024-01-20", "2024-01-10"


def query(name: str) -> Callable[[Query], Query]:
    """Registers a query under a name; it runs with UTC as the session's zone."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(use_utc(spark), sf_dir)
        return build

    return register


def _plain(rows: DataFrame) -> DataFrame:
    """Without the load stamp; instants as zone-less timestamps."""
    return rows.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name)
            for f in rows.schema
            if f.name != "_loaded_at"
        ]
    )


def _between(rows: DataFrame, column: str, first: str | None = None, before: str | None = None) -> DataFrame:
    if first:
        rows = rows.where(F.col(column) >= F.lit(first).cast("timestamp_ntz"))
    if before:
        rows = rows.where(F.col(column) < F.lit(before).cast("timestamp_ntz"))
    return rows


def _line_pages(spark, sf_dir, first=None, before=None) -> DataFrame:
    return testdata.line_orders(_between(testdata.table(spark, sf_dir, "lineitem"), "l_shipdate", first, before))


def _parsed_lines(spark, sf_dir, first=None, before=None, used=None) -> jobs.Parsed:
    return jobs.parse(jobs.ORDERS, _line_pages(spark, sf_dir, first, before), used)


def _parsed_headers(spark, sf_dir) -> DataFrame:
    return jobs.parse_headers(jobs.ORDERS, testdata.header_orders(testdata.table(spark, sf_dir, "orders")))


def _valid_headers(spark, sf_dir) -> DataFrame:
    return _parsed_headers(spark, sf_dir).where(F.col(REASON).isNull())


def _order_items(spark, sf_dir, first=None, before=None) -> DataFrame:
    enforced = flatten.order_items(_parsed_lines(spark, sf_dir, first, before).valid)
    return accepted(enforced, FACT_ORDER_ITEMS)


def _event_rows(spark, sf_dir, fact: jobs.Fact, pages, first=None, before=None) -> DataFrame:
    """Enforced rows of a fact that is made from events."""
    events = _between(testdata.table(spark, sf_dir, "events"), "ts", first, before)
    return fact.flatten(jobs.parse(fact, pages(events)).valid)


def _event_fact(spark, sf_dir, fact: jobs.Fact, pages, first=None, before=None) -> DataFrame:
    return accepted(_event_rows(spark, sf_dir, fact, pages, first, before), fact.table)


# --- documents ----------------------------------------------------------------


@query("orders_scan")
def orders_scan(spark, sf_dir):
    """Orders with normalised dates and lineage tags."""
    orders = with_lineage(_valid_headers(spark, sf_dir))
    return orders.select(
        "guid", "restaurantGuid", "businessDate", "voidBusinessDate", *ORDER_TIMESTAMPS, "_restaurant_guid", "_data_source"
    )


@query("timestamp_normalize")
def timestamp_normalize(spark, sf_dir):
    """Offset text and the instant it stands for."""
    offset = F.element_at(
        F.array(*[F.lit(o) for o in ("+0000", "-0000", "Z", "+0530")]), (F.col("event_id") % 4 + 1).cast("int")
    )
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset)
    return testdata.table(spark, sf_dir, "events").select(
        "event_id", utc_suffix(raw).alias("normalized"), to_instant(raw).cast("timestamp_ntz").alias("instant")
    )


@query("business_date_normalize")
def business_date_normalize(spark, sf_dir):
    """Compact and dashed days, and days that do not exist."""
    key = F.col("o_orderkey")
    raw = (
        F.when(key % 5 == 0, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("1399")))
        .when(key % 5 == 1, F.date_format("o_orderdate", "yyyy"))
        .when(key % 5 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return testdata.table(spark, sf_dir, "orders").select(
        "o_orderkey", iso_day(raw).alias("normalized"), to_day(iso_day(raw)).alias("business_date")
    )


@query("envelope_unwrap")
def envelope_unwrap(spark, sf_dir):
    """Documents per list page and object page, back as one flat set."""
    pages = testdata.header_orders(testdata.table(spark, sf_dir, "orders"))
    docs = documents(parse_pages(pages, "guid string, businessDate string"))
    return docs.select("restaurant_guid", "query_date", "doc.guid", "doc.businessDate")


@query("order_validation")
def order_validation(spark, sf_dir):
    """Every order with what it misses, if anything."""
    return _parsed_headers(spark, sf_dir).select("restaurant_guid", "query_date", "guid", "restaurantGuid", REASON)


# --- order items --------------------------------------------------------------


@query("order_items_flatten")
def order_items_flatten(spark, sf_dir):
    return _plain(_order_items(spark, sf_dir))


def _checks(spark, sf_dir, *used: str) -> DataFrame:
    """Checks of the valid orders, with the values that are used; selections and other values are not built."""
    orders = _parsed_lines(spark, sf_dir, used=["guid", "restaurantGuid", "businessDate", "checks.guid", *used]).valid
    return orders.select("guid", F.explode("checks").alias("check"))


@query("check_tip_sum")
def check_tip_sum(spark, sf_dir):
    return _checks(spark, sf_dir, "checks.payments.tipAmount").select(
        F.col("guid").alias("order_guid"),
        F.col("check.guid").alias("check_guid"),
        tip_total(F.col("check.payments")).alias("check_tip"),
    )


@query("check_first_payment_type")
def check_first_payment_type(spark, sf_dir):
    return _checks(spark, sf_dir, "checks.payments.type").select(
        F.col("guid").alias("order_guid"),
        F.col("check.guid").alias("check_guid"),
        first_payment_type(F.col("check.payments")).alias("payment_type"),
    )


@query("schema_enforce")
def schema_enforce(spark, sf_dir):
    """Raw text cast to the order item table, with reasons where it does not fit."""
    c = F.col
    part = c("l_partkey")
    raw = {name: F.lit(None).cast("string") for name in FACT_ORDER_ITEMS.columns} | {
        "selection_guid": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "order_guid": c("l_orderkey").cast("string"),
        "check_guid": F.when(part % 7 != 0, c("l_linestatus")),
        "restaurant_guid": F.concat(F.lit("R"), c("l_suppkey").cast("string")),
        "business_date": F.when(part % 11 == 0, "2025-13-99").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
        "item_quantity": F.when(part % 13 == 0, "many").otherwise(c("l_quantity").cast("string")),
        "is_voided": F.when(part % 17 == 0, "perhaps").otherwise(F.lit("false")),
        "_loaded_at": F.lit("2026-01-01T00:00:00Z"),
    }
    rows = testdata.table(spark, sf_dir, "lineitem").select(*[value.alias(name) for name, value in raw.items()])
    return enforce(rows, FACT_ORDER_ITEMS).select(
        "selection_guid", "check_guid", "restaurant_guid", "business_date", "item_quantity", "is_voided", REASON
    )


@query("reject_summary")
def rejects_by_reason(spark, sf_dir):
    """Rejected documents and rows by reason."""
    return reject_summary(rejected(jobs.outcomes(jobs.ORDERS, _line_pages(spark, sf_dir))))


@query("run_summary")
def run_summary(spark, sf_dir):
    """Documents and rows per restaurant."""
    is_row = F.col("stage") == "row"
    counted = {
        "orders_fetched": F.col("n_documents") == 1,
        "items_flattened": is_row,
        "items_rejected": is_row & rejected_row(),
    }
    return tally(["restaurant_guid"], (jobs.outcomes(jobs.ORDERS, _line_pages(spark, sf_dir)), counted))


# --- cash, labor, dimensions ----------------------------------------------------


@query("cash_entries_flatten")
def cash_entries_flatten(spark, sf_dir):
    return _plain(_event_fact(spark, sf_dir, jobs.CASH_ENTRIES, testdata.cash_entry_pages))


@query("cash_deposits_flatten")
def cash_deposits_flatten(spark, sf_dir):
    return _plain(_event_fact(spark, sf_dir, jobs.CASH_DEPOSITS, testdata.cash_deposit_pages))


@query("labor_flatten")
def labor_flatten(spark, sf_dir):
    return _plain(_event_fact(spark, sf_dir, jobs.TIME_ENTRIES, testdata.time_entry_pages))


def _restaurants(spark, sf_dir) -> DataFrame:
    info = first_documents(testdata.restaurant_pages(testdata.table(spark, sf_dir, "supplier")), RESTAURANT_DOC)
    return accepted(flatten.restaurants(documents(info)), DIM_RESTAURANTS)


@query("dim_restaurants")
def dim_restaurants(spark, sf_dir):
    return _plain(_restaurants(spark, sf_dir))


@query("dim_employees")
def dim_employees(spark, sf_dir):
    pages = testdata.employee_pages(testdata.table(spark, sf_dir, "customer"))
    return _plain(accepted(flatten.employees(documents(parse_pages(pages, EMPLOYEE_DOC))), DIM_EMPLOYEES))


@query("dim_jobs")
def dim_jobs(spark, sf_dir):
    pages = testdata.job_pages(testdata.table(spark, sf_dir, "customer"))
    return _plain(accepted(flatten.jobs(documents(parse_pages(pages, JOB_DOC))), DIM_JOBS))


@query("menu_flatten")
def menu_flatten(spark, sf_dir):
    pages = testdata.menu_trees(testdata.table(spark, sf_dir, "part"))
    return _plain(accepted(menu_items(menu_pages(pages)), DIM_MENU_ITEMS))


# --- keyed inserts --------------------------------------------------------------


def _stage(spark, table: Table, rows: DataFrame) -> DataFrame:
    """A staged table in the shared folder, as a load has one."""
    return Warehouse(spark, shared_folder(spark), "staged_queries").stage(table.name, rows)


def _batch_and_target(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    batch = _order_items(spark, sf_dir, first=ORDERS_BATCH_FROM)
    return _stage(spark, FACT_ORDER_ITEMS, batch), _order_items(spark, sf_dir, before=ORDERS_LOADED_BEFORE)


def _batch_and_target_keys(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The target's keys are staged too: a plan that reads them several times parses no page again."""
    batch, target = _batch_and_target(spark, sf_dir)
    return batch, _stage(spark, FACT_ORDER_ITEMS, target.select(*FACT_ORDER_ITEMS.key))


def _insert_events(spark, sf_dir, fact: jobs.Fact, pages) -> DataFrame:
    batch = _stage(spark, fact.table, _event_fact(spark, sf_dir, fact, pages, first=EVENTS_BATCH_FROM))
    target = _event_fact(spark, sf_dir, fact, pages, before=EVENTS_LOADED_BEFORE)
    return _plain(not_in_target(batch, target, list(fact.table.key)))


@query("insert_new_order_items")
def insert_new_order_items(spark, sf_dir):
    batch, target = _batch_and_target_keys(spark, sf_dir)
    return _plain(not_in_target(batch, target, list(FACT_ORDER_ITEMS.key)))


@query("insert_one_per_key")
def insert_one_per_key(spark, sf_dir):
    """The optional form that also drops duplicates inside the batch."""
    batch, target = _batch_and_target_keys(spark, sf_dir)
    keys = list(FACT_ORDER_ITEMS.key)
    return not_in_target(one_per_key(batch, keys), target, keys, hot_rows=None).select(*keys)


@query("insert_new_cash_entries")
def insert_new_cash_entries(spark, sf_dir):
    return _insert_events(spark, sf_dir, jobs.CASH_ENTRIES, testdata.cash_entry_pages)


@query("insert_new_cash_deposits")
def insert_new_cash_deposits(spark, sf_dir):
    return _insert_events(spark, sf_dir, jobs.CASH_DEPOSITS, testdata.cash_deposit_pages)


@query("insert_new_shifts")
def insert_new_shifts(spark, sf_dir):
    return _insert_events(spark, sf_dir, jobs.TIME_ENTRIES, testdata.time_entry_pages)


@query("load_metrics")
def load_counts(spark, sf_dir):
    batch, target = _batch_and_target_keys(spark, sf_dir)
    return load_metrics(batch, not_in_target(batch, target, list(FACT_ORDER_ITEMS.key)))


@query("stream_cash_entries")
def stream_cash_entries(spark, sf_dir):
    """Cash entries streamed into the fact table, and once more from the start."""
    folder = f"{shared_folder(spark)}/stream_{uuid.uuid4().hex}"
    pages = testdata.cash_entry_pages(testdata.table(spark, sf_dir, "events"))
    pages.write.parquet(f"{folder}/pages")
    store = Warehouse(spark, folder, "streamed")
    for attempt in ("first", "replay"):
        landed = spark.readStream.schema(pages.schema).parquet(f"{folder}/pages")
        insert_stream(store, jobs.CASH_ENTRIES, landed, f"{folder}/{attempt}").awaitTermination()
    return _plain(store.read(jobs.CASH_ENTRIES.table))


# --- scope and windows ------------------------------------------------------------


@query("tenant_scope")
def tenant_scope(spark, sf_dir):
    """Sales lines per restaurant of one tenant."""
    lines = testdata.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string")).alias("restaurant_guid"), "l_quantity"
    )
    restaurants = restaurants_of(testdata.tenants(spark, sf_dir), "ASIA")
    return (
        in_restaurants(lines, restaurants)
        .groupBy("restaurant_guid")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    )


@query("date_range_scope")
def date_range_scope(spark, sf_dir):
    """Orders opened in a range of days, both included, in UTC."""
    orders = _valid_headers(spark, sf_dir)
    return in_instants(orders, F.col("openedDate"), "1996-03-01", "1998-02-28").select("guid", "openedDate")


def _order_range(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """First and last order day, each a one-row frame for use as a scalar."""
    orders = testdata.table(spark, sf_dir, "orders")
    return (
        orders.agg(F.min("o_orderdate").cast("date").alias("first")),
        orders.agg(F.max("o_orderdate").cast("date").alias("last")),
    )


@query("week_windows")
def week_windows_of_orders(spark, sf_dir):
    first, last = _order_range(spark, sf_dir)
    span = first.select("first", last.scalar().alias("last"))
    return span.select(F.explode(week_windows(F.col("first"), F.col("last"))).alias("w")).select("w.*")


@query("day_expansion")
def days_of_orders(spark, sf_dir):
    first, last = _order_range(spark, sf_dir)
    span = first.select("first", last.scalar().alias("last"))
    return span.select(F.explode(each_day(F.col("first"), F.col("last"))).alias("business_date"))


@query("backfill_plan")
def backfill_units(spark, sf_dir):
    first, last = _order_range(spark, sf_dir)
    restaurants = testdata.tenants(spark, sf_dir).select("restaurant_guid")
    return backfill_plan(restaurants, first.scalar(), last.scalar())


@query("rows_per_backfill_window")
def rows_per_backfill_window(spark, sf_dir):
    """Orders and their worth per week window."""
    first, last = _order_range(spark, sf_dir)
    orders = testdata.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("business_date"), "o_totalprice"
    )
    return (
        with_window(orders, first.scalar(), last.scalar())
        .groupBy("window_no")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


# --- reports and history ------------------------------------------------------------


@query("daily_sales_by_restaurant")
def daily_sales_by_restaurant(spark, sf_dir):
    sales = marts.daily_sales(_order_items(spark, sf_dir), _restaurants(spark, sf_dir))
    return sales.withColumns({c: F.round(c, 2) for c in ("quantity", "revenue", "discounts")})


@query("daily_tips_by_restaurant")
def daily_tips_by_restaurant(spark, sf_dir):
    return marts.daily_tips(_order_items(spark, sf_dir)).withColumn("tips", F.round("tips", 2))


@query("daily_labor_by_restaurant")
def daily_labor_by_restaurant(spark, sf_dir):
    labor = marts.daily_labor(_event_fact(spark, sf_dir, jobs.TIME_ENTRIES, testdata.time_entry_pages))
    return labor.withColumns({c: F.round(c, 2) for c in ("hours", "pay")})


@query("scd2_history")
def scd2_history(spark, sf_dir):
    snapshots = testdata.employee_snapshots(testdata.table(spark, sf_dir, "customer"))
    return history_of(snapshots, ["employee_guid"], ["job_title"])
