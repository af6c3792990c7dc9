"""Registered queries that go the whole way: landed files, jobs, warehouse tables."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators import flatten
from tillhouse.operators.enforce import accepted
from tillhouse.operators.history import history_of
from tillhouse.operators.menus import menu_items
from tillhouse.operators.scope import date_range, in_query_days, in_restaurants
from tillhouse.plans import jobs, marts, testdata
from tillhouse.plans.catalogue import _batch_and_target, _event_fact, _order_items, _plain, query
from tillhouse.schemas import (
    DIM_EMPLOYEES,
    DIM_JOBS,
    DIM_MENU_ITEMS,
    DIM_RESTAURANTS,
    EMPLOYEE_DOC,
    FACT_CASH_DEPOSITS,
    FACT_CASH_ENTRIES,
    FACT_LABOR_SHIFTS,
    FACT_ORDER_ITEMS,
    REJECTS,
)
from tillhouse.session import shared_folder
from tillhouse.sinks.history import HistoryTable
from tillhouse.sinks.warehouse import Warehouse, write_ndjson
from tillhouse.sources.envelope import documents, menu_pages, parse_pages
from tillhouse.sources.landing import read_pages
from tillhouse.sources.tenants import dataset_of
from tillhouse.streaming.ingest import insert_stream

TENANT = "all"
DOCS_PER_PAGE = 100


def _name(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _context(spark: SparkSession, sf_dir: str, gathered: bool) -> jobs.Context:
    """A landing and a warehouse of its own for every restaurant there is."""
    folder = f"{shared_folder(spark)}/landed_{uuid.uuid4().hex}"
    everyone = testdata.tenants(spark, sf_dir).select("restaurant_guid")
    nations = testdata.table(spark, sf_dir, "nation").select(_name("R", "n_nationkey").alias("restaurant_guid"))
    tenants = everyone.unionByName(nations).distinct().withColumns({"tenant": F.lit(TENANT), "dataset": F.lit(TENANT)})
    return jobs.Context(spark, f"{folder}/landing", f"{folder}/warehouse", tenants, TENANT, gathered=gathered)


def _land(context: jobs.Context, endpoint: str, pages: DataFrame, day: str) -> None:
    """Pages gathered in a folder per day or snapshot, however many restaurants there are; nothing is shuffled."""
    laid_out = pages.select("restaurant_guid", "value", day)
    laid_out.write.mode("append").partitionBy(day).option("compression", "zstd").parquet(f"{context.landing}/{endpoint}")


class Dying(Warehouse):
    """Writes all files of a load and dies before its manifest."""

    def publish(self, *added, **more):
        raise ConnectionError("the driver is gone")


class DyingContext(jobs.Context):
    @property
    def store(self) -> Warehouse:
        alive = super().store
        return Dying(self.spark, self.warehouse, TENANT, alive.run)


def _until_it_dies(run, context: jobs.Context, *given, **options) -> None:
    dying = DyingContext(*[getattr(context, f.name) for f in fields(context)])
    try:
        run(dying, *given, **options)
    except ConnectionError:
        return
    raise AssertionError("this load should not have got through")


def _land_employees(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Employee pages of many lines each, one per file, in two weekly snapshots.

    Pages differ in what stands before them: nothing, a new line and a tab, or a byte order
    mark; one in each restaurant is empty. The second snapshot leaves out some restaurants and some employees.
    """
    customers = testdata.table(spark, sf_dir, "customer")
    pages = testdata.employee_pages(customers)
    document = F.regexp_extract("value", r'(?s)^(?:\{"data":)?\[(.*)\](?:,"pagination":.*)?$', 1)
    key = F.regexp_extract("value", r'"guid":"U(\d+)"', 1).try_cast("bigint")
    rows = pages.select("restaurant_guid", document.alias("document"), key.alias("key"))
    nation = F.substring("restaurant_guid", 2, 10).cast("int")
    second = rows.where((nation % 5 != 0) & F.coalesce(F.col("key") % 7 != 0, F.lit(True)))
    snapshots = rows.withColumn("snapshot_date", F.lit("2024-01-07")).unionByName(second.withColumn("snapshot_date", F.lit("2024-01-14")))
    # Pages by a restaurant's own number of documents, so that all but the smallest are full.
    sizes = rows.groupBy("restaurant_guid").agg(F.ceil(F.count(F.lit(1)) / DOCS_PER_PAGE).alias("n_pages"))
    snapshots = snapshots.join(sizes, "restaurant_guid")
    part = F.pmod(F.xxhash64("document"), F.col("n_pages")) + F.pmod(F.xxhash64("restaurant_guid"), F.lit(6))
    lines = snapshots.groupBy("restaurant_guid", "snapshot_date", part.alias("part")).agg(F.array_join(F.collect_list("document"), ",\n").alias("documents"))
    head = F.element_at(F.array(F.lit(""), F.lit("\n\t"), F.lit("﻿")), (F.col("part") % 3 + 1).cast("int"))
    listed = F.when(F.col("part") % 2 == 0, F.concat(head, F.lit("[\n"), "documents", F.lit("\n]\n"))).otherwise(
        F.concat(head, F.lit('{\n"data": [\n'), "documents", F.lit("\n]}\n"))
    )
    # One page per file: each row is a task's only row of its folder.
    files = lines.select("restaurant_guid", "snapshot_date", listed.alias("value"))
    files.write.partitionBy("restaurant_guid", "snapshot_date").option("maxRecordsPerFile", 1).text(f"{root}/employees")


@query("dimension_refresh")
def dimension_refresh(spark, sf_dir):
    """The employee dimension from landed files, after two refreshes of one context."""
    context = _context(spark, sf_dir, gathered=False)
    _land_employees(spark, sf_dir, context.landing)
    jobs.run_dimensions(context, "R7", mode="restaurant")
    jobs.run_dimensions(context)
    return _plain(context.store.read_dimension(DIM_EMPLOYEES))


@query("one_restaurant_scope")
def one_restaurant_scope(spark, sf_dir):
    """Employees of one restaurant: a filter that prunes folders."""
    context = _context(spark, sf_dir, gathered=False)
    _land_employees(spark, sf_dir, context.landing)
    pages = in_restaurants(read_pages(spark, context.landing, "employees"), context.tenants, "R7")
    return _plain(accepted(flatten.employees(documents(parse_pages(pages, EMPLOYEE_DOC))), DIM_EMPLOYEES))


@query("dimension_refresh_all")
def dimension_refresh_all(spark, sf_dir):
    """The four dimensions after a refresh that died, and after one that came through with an unreadable page."""
    context = _context(spark, sf_dir, gathered=True)
    customers, parts = testdata.table(spark, sf_dir, "customer"), testdata.table(spark, sf_dir, "part")
    first, second = {"snapshot_date": F.lit("2024-01-07")}, {"snapshot_date": F.lit("2024-01-14")}
    _land(context, "restaurants", testdata.restaurant_pages(testdata.table(spark, sf_dir, "supplier")).withColumns(first), "snapshot_date")
    _land(context, "jobs", testdata.job_pages(customers).withColumns(first), "snapshot_date")
    _land(context, "employees", testdata.employee_pages(customers).withColumns(first), "snapshot_date")
    _land(context, "menus", testdata.menu_trees(parts).withColumns(first), "snapshot_date")
    jobs.run_dimensions(context)
    # Some restaurants are landed again, with fewer employees and menus and a page that is cut off.
    fewer = testdata.employee_pages(customers.where("c_nationkey % 5 <> 0 AND c_custkey % 7 <> 0"))
    cut_off = testdata.table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.lit("[{").alias("value"), _name("R", "n_nationkey").alias("restaurant_guid"))
    _land(context, "employees", fewer.unionByName(cut_off).withColumns(second), "snapshot_date")
    _land(context, "menus", testdata.menu_trees(parts.where("p_partkey % 5 <> 0 AND p_partkey % 3 <> 0")).withColumns(second), "snapshot_date")

    def all_four(outcome: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            context.store.read_dimension(t).select(
                F.lit(outcome).alias("outcome"), F.lit(t.name).alias("table_name"), F.col(key).alias("guid"), "restaurant_guid"
            )
            for t, key in (
                (DIM_RESTAURANTS, "restaurant_guid"), (DIM_EMPLOYEES, "employee_guid"), (DIM_JOBS, "job_guid"), (DIM_MENU_ITEMS, "menu_item_guid"),
            )
        ])

    _until_it_dies(jobs.run_dimensions, context)
    # Its folders are named now, so the next refresh does not change what they show.
    died = all_four("died")
    jobs.run_dimensions(context)
    return died.unionByName(all_four("partial"))


# --- orders -----------------------------------------------------------------------------


def _years(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """The first day, the end of the third year, and the last day of the lines' years."""
    year = F.year("l_shipdate")
    first, last = testdata.table(spark, sf_dir, "lineitem").agg(F.min(year), F.max(year)).first()
    return f"{first}-01-01", f"{first + 2}-12-31", f"{last}-12-31"


def _landed_orders(spark: SparkSession, sf_dir: str) -> jobs.Context:
    """Order pages in a folder per year of shipping; lines without a day have one of their own."""
    context = _context(spark, sf_dir, gathered=True)
    # In the order of their folders, so that the write has no page texts to sort and spill.
    year = F.trunc(F.col("l_shipdate").cast("date"), "year")
    _land(context, "orders", testdata.line_orders(testdata.table(spark, sf_dir, "lineitem"), year), "query_date")
    return context


@query("order_load")
def order_load(spark, sf_dir):
    """The order fact after half a load and a load of everything."""
    context, (first, half, last) = _landed_orders(spark, sf_dir), _years(spark, sf_dir)
    for end in (half, last):
        jobs.run_orders(context, start=first, end=end).close()
    return _plain(context.store.read(FACT_ORDER_ITEMS))


@query("backfill_by_window")
def backfill_by_window(spark, sf_dir):
    """What a backfill read and loaded per restaurant and week, half of it loaded before."""
    context, (first, half, last) = _landed_orders(spark, sf_dir), _years(spark, sf_dir)
    jobs.run_orders(context, start=first, end=half).close()
    return jobs.run_backfill(context, "orders", first, last).by_window


@query("load_by_restaurant")
def load_by_restaurant(spark, sf_dir):
    """The counters of a second load with the same context."""
    context, (first, half, last) = _landed_orders(spark, sf_dir), _years(spark, sf_dir)
    jobs.run_orders(context, start=first, end=half).close()
    return jobs.run_orders(context, start=first, end=last).by_restaurant


@query("insert_by_index")
def insert_by_index(spark, sf_dir):
    """New order items of a batch; keys of the fact are read from the index, where it may have them."""
    batch, loaded = _batch_and_target(spark, sf_dir)
    store = Warehouse(spark, shared_folder(spark), f"indexed_{uuid.uuid4().hex}")
    store.append(FACT_ORDER_ITEMS, store.stage("loaded", loaded))
    return _plain(store.insert_new(FACT_ORDER_ITEMS, batch).inserted)


# --- cash and labor -----------------------------------------------------------------------


def _landed_events(spark: SparkSession, sf_dir: str) -> jobs.Context:
    """Cash entries, deposits and time entries, in a folder per week asked for.

    Restaurants with an even number are one tenant, the others another.
    """
    context, events = _context(spark, sf_dir, gathered=True), testdata.table(spark, sf_dir, "events")
    side = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    tenants = events.select(_name("R", "user_id").alias("restaurant_guid"), side.alias("tenant")).distinct()
    both = tenants.withColumn("dataset", F.concat(F.lit("cash_"), "tenant")).unionByName(tenants.withColumns({"tenant": F.lit(TENANT), "dataset": F.lit(TENANT)}))
    for endpoint, pages in (
        ("cash_entries", testdata.cash_entry_pages(events)),
        ("cash_deposits", testdata.cash_deposit_pages(events)),
        ("time_entries", testdata.time_entry_pages(events)),
    ):
        _land(context, endpoint, pages.withColumn("query_date", F.trunc("query_date", "week")), "query_date")
    return replace(context, tenants=both)


def _weeks(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """The first Monday, the end of the second week, and the last day of the events' weeks."""
    first, last = testdata.table(spark, sf_dir, "events").agg(F.trunc(F.min("ts"), "week"), F.trunc(F.max("ts"), "week")).first()
    return first.isoformat(), (first + dt.timedelta(days=13)).isoformat(), (last + dt.timedelta(days=6)).isoformat()


def _cash_rows(store: Warehouse) -> DataFrame:
    """Both cash facts in one shape."""
    shape = lambda table, key, amount: store.read(table).select(
        F.lit(table.name).alias("table_name"), F.col(key).alias("guid"), "restaurant_guid", "business_date", F.col(amount).alias("amount")
    )
    return shape(FACT_CASH_ENTRIES, "cash_entry_guid", "amount").unionByName(shape(FACT_CASH_DEPOSITS, "deposit_guid", "deposit_amount"))


@query("cash_load")
def cash_load(spark, sf_dir):
    """Both cash facts after a load of two weeks and one of all of them."""
    context, (first, second, last) = _landed_events(spark, sf_dir), _weeks(spark, sf_dir)
    jobs.run_cash(context, start=first, end=second)
    jobs.run_cash(context, start=first, end=last)
    return _cash_rows(context.store)


@query("labor_load")
def labor_load(spark, sf_dir):
    """The shifts after the same load twice."""
    context, (first, _, last) = _landed_events(spark, sf_dir), _weeks(spark, sf_dir)
    jobs.run_labor(context, start=first, end=last)
    jobs.run_labor(context, start=first, end=last)
    return _plain(context.store.read(FACT_LABOR_SHIFTS))


@query("load_after_failure")
def load_after_failure(spark, sf_dir):
    """Both cash facts after a load of two weeks and one that died with all its files written."""
    context, (first, second, last) = _landed_events(spark, sf_dir), _weeks(spark, sf_dir)
    jobs.run_cash(context, start=first, end=second)
    _until_it_dies(jobs.run_cash, context, start=first, end=last)
    return _cash_rows(context.store)


@query("two_tenants_load")
def two_tenants_load(spark, sf_dir):
    """Two tenants' cash, loaded from one landing to a dataset each."""
    context, (first, _, last) = _landed_events(spark, sf_dir), _weeks(spark, sf_dir)
    parts = []
    for tenant in ("even", "odd"):
        own = replace(context, tenant=tenant)
        jobs.run_cash(own, start=first, end=last)
        parts.append(_cash_rows(own.store).withColumn("dataset", F.lit(dataset_of(own.tenants, tenant))))
    return parts[0].unionByName(parts[1])


@query("backfill_resume")
def backfill_resume(spark, sf_dir):
    """What a resumed backfill of cash did per unit, after one that had finished the first two weeks."""
    context, (first, second, last) = _landed_events(spark, sf_dir), _weeks(spark, sf_dir)
    jobs.run_backfill(context, "cash", first, second)
    return jobs.run_backfill(context, "cash", first, last, resume=True).by_unit


@query("empty_load")
def empty_load(spark, sf_dir):
    """A load without pages after one with some: the counters of both, and versions of the dataset."""
    context, (first, second, _) = _landed_events(spark, sf_dir), _weeks(spark, sf_dir)
    rows = []
    for start, end in ((first, second), ("1900-01-01", "1900-01-07")):
        counted = jobs.run_labor(context, start=start, end=end).summary["tables"][FACT_LABOR_SHIFTS.name]
        rows.append((start == first, counted["staged"], counted["loaded"], context.store.manifest().number))
    return spark.createDataFrame(rows, "with_pages boolean, staged bigint, loaded bigint, version int")


@query("load_stamp")
def load_stamp(spark, sf_dir):
    """Shifts of two loads with the stamps that their runs were given; a row keeps the stamp of the run that brought it."""
    context, (first, second, last) = _landed_events(spark, sf_dir), _weeks(spark, sf_dir)
    for day, end in ((1, second), (2, last)):
        jobs.run_labor(replace(context, loaded_at=dt.datetime(2026, 1, day, tzinfo=dt.timezone.utc)), start=first, end=end)
    shifts = context.store.read(FACT_LABOR_SHIFTS)
    return shifts.select("time_entry_guid", F.col("_loaded_at").cast("timestamp_ntz").alias("loaded_at"))


@query("default_date_scope")
def default_date_scope(spark, sf_dir):
    """Order pages of a run without dates, on the day after the last order: those of yesterday."""
    orders = testdata.table(spark, sf_dir, "orders")
    today = orders.agg(F.date_add(F.max("o_orderdate").cast("date"), 1)).first()[0]
    start, end = date_range(today=today)
    pages = in_query_days(testdata.header_orders(orders), start, end)
    return documents(parse_pages(pages, "guid string")).select("restaurant_guid", "query_date", "doc.guid")


@query("stream_rejects")
def stream_rejects(spark, sf_dir):
    """What a stream set aside, after a replay from a fresh checkpoint."""
    folder = f"{shared_folder(spark)}/stream_{uuid.uuid4().hex}"
    pages = testdata.cash_entry_pages(testdata.table(spark, sf_dir, "events"))
    pages.write.parquet(f"{folder}/pages")
    store = Warehouse(spark, folder, "streamed")
    for attempt in ("first", "replay"):
        landed = spark.readStream.schema(pages.schema).parquet(f"{folder}/pages")
        insert_stream(store, jobs.CASH_ENTRIES, landed, f"{folder}/{attempt}").awaitTermination()
    guid = F.get_json_object("record", "$.cash_entry_guid").alias("guid")
    return store.read(REJECTS).select("table_name", "stage", "restaurant_guid", "reject_reason", guid)


@query("ndjson_export")
def ndjson_export(spark, sf_dir):
    """Cash entries written as a JSON object per line and read again."""
    folder = f"{shared_folder(spark)}/export_{uuid.uuid4().hex}"
    write_ndjson(_event_fact(spark, sf_dir, jobs.CASH_ENTRIES, testdata.cash_entry_pages), folder)
    return _plain(spark.read.schema(FACT_CASH_ENTRIES.schema).json(folder))


# --- history -----------------------------------------------------------------------------


@query("scd2_apply")
def scd2_apply(spark, sf_dir):
    """The history of employees, taken in snapshot by snapshot into a published table."""
    store = Warehouse(spark, shared_folder(spark), f"history_{uuid.uuid4().hex}")
    history = HistoryTable(store, "employee_history", ("employee_guid",), ("job_title",))
    snapshots = testdata.employee_snapshots(testdata.table(spark, sf_dir, "customer"))
    for row in snapshots.select("snapshot_date").distinct().sort("snapshot_date").collect():
        history.apply(snapshots.where(F.col("snapshot_date") == F.lit(row.snapshot_date)), row.snapshot_date)
    return history.read()


@query("sales_by_job_title_then")
def sales_by_job_title_then(spark, sf_dir):
    """Sales by the title a server had on the day; every server has a large share, one leaves."""
    history = history_of(testdata.server_snapshots(testdata.table(spark, sf_dir, "customer")), ["employee_guid"], ["job_title"])
    sales = marts.sales_by_title_then(_order_items(spark, sf_dir), history)
    return sales.withColumn("revenue", F.round("revenue", 2))


@query("sales_by_menu_group")
def sales_by_menu_group(spark, sf_dir):
    """Quantity and revenue per menu group; an item's first placement has the number that sales have."""
    pages = testdata.menu_trees(testdata.table(spark, sf_dir, "part"))
    menu = accepted(menu_items(menu_pages(pages)), DIM_MENU_ITEMS)
    sold_as = F.regexp_replace("menu_item_guid", "^M([0-9]+)-1$", "P$1")
    sales = marts.sales_by_menu_group(_order_items(spark, sf_dir), menu.withColumn("menu_item_guid", sold_as))
    return sales.withColumns({c: F.round(c, 2) for c in ("quantity", "revenue")})
