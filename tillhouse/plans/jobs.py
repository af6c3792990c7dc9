"""The loads: orders, cash, labor, dimensions, and a backfill of the first three.

A fact load is one plan over all restaurants and days of its scope. Documents are
parsed once, on the way to a staged table; counting, checking and inserting read
that table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators import flatten
from tillhouse.operators.enforce import REASON, accepted, strict
from tillhouse.operators.menus import menu_outcomes
from tillhouse.operators.orders import normalise_orders, order_defect
from tillhouse.operators.outcomes import counts, rows_of, set_aside, tag
from tillhouse.operators.scope import date_range, in_query_days, in_restaurants, restaurants_of
from tillhouse.operators.summaries import every_row, rejected_row, tally
from tillhouse.operators.windows import backfill_plan, with_window
from tillhouse.schemas import (
    CASH_DEPOSIT_DOC,
    CASH_ENTRY_DOC,
    DIM_EMPLOYEES,
    DIM_JOBS,
    DIM_MENU_ITEMS,
    DIM_RESTAURANTS,
    EMPLOYEE_DOC,
    FACT_CASH_DEPOSITS,
    FACT_CASH_ENTRIES,
    FACT_LABOR_SHIFTS,
    FACT_ORDER_ITEMS,
    JOB_DOC,
    LOAD_UNITS,
    ORDER_DOC,
    ORDER_HEADER_DOC,
    RESTAURANT_DOC,
    TIME_ENTRY_DOC,
    Table,
)
from tillhouse.session import use_utc
from tillhouse.sinks.warehouse import LoadResult, Warehouse, Written
from tillhouse.sources.envelope import documents, documents_and_pages, first_documents, first_per_restaurant, menu_pages, narrowed, parse_pages
from tillhouse.sources.landing import read_pages
from tillhouse.sources.tenants import dataset_of


TASKS_PER_CORE = 3
# So many restaurants take some tens of megabytes in memory.
FEW_RESTAURANTS = 500_000


@dataclass(frozen=True)
class Fact:
    """How one endpoint becomes one fact table."""

    endpoint: str
    document: str
    table: Table
    flatten: Callable[..., DataFrame]
    # What is needed of a document to count and validate it; the rest is skipped.
    header: str = "guid string"
    prepare: Callable[[DataFrame], DataFrame] = lambda docs: docs
    defect: Callable[[], Column] = lambda: F.lit(None).cast("string")


ORDERS = Fact(
    "orders", ORDER_DOC, FACT_ORDER_ITEMS, flatten.order_items, ORDER_HEADER_DOC, normalise_orders, order_defect
)
CASH_ENTRIES = Fact("cash_entries", CASH_ENTRY_DOC, FACT_CASH_ENTRIES, flatten.cash_entries)
CASH_DEPOSITS = Fact("cash_deposits", CASH_DEPOSIT_DOC, FACT_CASH_DEPOSITS, flatten.cash_deposits)
TIME_ENTRIES = Fact("time_entries", TIME_ENTRY_DOC, FACT_LABOR_SHIFTS, flatten.labor_shifts)


@dataclass
class Parsed:
    """Documents of a fact on their way to rows."""

    pages: DataFrame
    docs: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.docs.where(F.col(REASON).isNull())

    @property
    def invalid(self) -> DataFrame:
        return self.docs.where(F.col(REASON).isNotNull())


def parse(fact: Fact, pages: DataFrame, used: list[str] | None = None) -> Parsed:
    """Pages to documents, with a reason on those that miss a required field.

    With `used`, only these of a document's values are read; its required ones are to be among them.
    """
    parsed = parse_pages(pages, fact.document if used is None else narrowed(fact.document, used))
    return Parsed(parsed, fact.prepare(documents(parsed)).withColumn(REASON, fact.defect()))


def outcomes(fact: Fact, pages: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Rows, documents and pages of a fact with what became of them, from one parse."""
    listed = documents_and_pages(parse_pages(pages, fact.document))
    docs = fact.prepare(listed).withColumn(REASON, fact.defect())
    return fact.flatten(tag(docs, T.StructType.fromDDL(fact.header).names), loaded_at)


def parse_headers(fact: Fact, pages: DataFrame) -> DataFrame:
    """Documents with their reason, parsed only as far as that takes."""
    return fact.prepare(documents(parse_pages(pages, fact.header))).withColumn(REASON, fact.defect())


@dataclass
class RunResult:
    """What a run did. `summary` is plain values; the frames are made on request."""

    status: str
    summary: dict
    find_rejects: Callable[[], DataFrame] = field(repr=False)
    count_restaurants: Callable[[], DataFrame] = field(repr=False)
    staged: DataFrame | None = field(default=None, repr=False)
    inserted: DataFrame | None = field(default=None, repr=False)
    drop: Callable[[], bool] = field(default=lambda: False, repr=False)

    def close(self) -> None:
        """Deletes the run's staged tables; its frames end with them."""
        self.drop()

    @property
    def rejects(self) -> DataFrame:
        """What was set aside: `table_name, stage, restaurant_guid, reject_reason, record`."""
        return self.find_rejects()

    @property
    def by_restaurant(self) -> DataFrame:
        """The counters of each table and restaurant."""
        return self.count_restaurants()


def _together(frames: list[Callable[[], DataFrame]]) -> Callable[[], DataFrame]:
    return lambda: reduce(DataFrame.unionByName, [frame() for frame in frames])


@dataclass
class Context:
    """Where a run reads and writes, and for whom."""

    spark: SparkSession
    landing: str
    warehouse: str
    tenants: DataFrame
    tenant: str
    one_per_line: bool = False
    loaded_at: dt.datetime | None = None
    run_id: str | None = None
    gathered: bool = False
    # Looked up once per run; of a context outside of a run, whenever it is asked for.
    dataset: str | None = None

    def __post_init__(self) -> None:
        use_utc(self.spark)

    def at(self) -> Context:
        """The same with one load stamp, one staging folder and one dataset for a run."""
        return replace(
            self, loaded_at=self.loaded_at or dt.datetime.now(dt.timezone.utc), run_id=self.run_id or uuid.uuid4().hex,
            dataset=dataset_of(self.tenants, self.tenant),
        )

    @property
    def stamp(self) -> Column:
        return F.lit(self.loaded_at)

    @property
    def store(self) -> Warehouse:
        return Warehouse(self.spark, self.warehouse, self.dataset or dataset_of(self.tenants, self.tenant), self.run_id)

    def pages(self, endpoint: str, restaurants: DataFrame, restaurant_guid: str | None = None) -> DataFrame:
        pages = read_pages(self.spark, self.landing, endpoint, self.one_per_line, self.gathered)
        return in_restaurants(pages, restaurants, restaurant_guid)


@dataclass
class _Loaded:
    """One fact of a run, written but not visible yet."""

    fact: Fact
    counts: dict[str, int]
    outcomes: DataFrame
    # Accepted and rejected rows.
    rows: DataFrame
    load: LoadResult
    written: Written | None

    def rejects(self) -> DataFrame:
        rows = self.rows.select(*self.outcomes.columns)
        others = self.outcomes.where(F.col("stage") != "row")
        return set_aside(rows.unionByName(others), self.fact.table)

    def by_restaurant(self) -> DataFrame:
        documents = {"fetched": F.col("n_documents") == 1, "documents_rejected": (F.col("stage") == "document") & rejected_row()}
        return tally(
            ["restaurant_guid"],
            (self.outcomes.where(F.col("stage") != "page"), documents),
            (self.rows, {"flattened": every_row(), "rejected": rejected_row()}),
            (self.load.inserted, {"loaded": every_row()}),
        ).select(F.lit(self.fact.table.name).alias("table_name"), "*")

    def days(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(F.lit(self.fact.table.name).alias("table_name"), "restaurant_guid", "business_date", "query_date", *more)


def _load_fact(ctx: Context, fact: Fact, pages: DataFrame, fail_batch: bool, dedup_batch: bool) -> _Loaded:
    store, table = ctx.store, fact.table
    found, seen = store.stage_counted(table.name, outcomes(fact, pages, ctx.stamp), **counts())
    rows, n_rejected = rows_of(found), seen["rejected"]
    if fail_batch:
        rows, strictly = store.stage_counted(f"{table.name}_strict", strict(rows), rejected=counts()["rejected"])
        n_rejected = strictly["rejected"]
    good = rows.where(F.col(REASON).isNull()).select(*table.columns, "query_date")
    written, load = store.prepare(table, good, dedup_batch, n_staged=seen["flattened"] - n_rejected)
    summed = {
        "fetched": seen["fetched"],
        "flattened": seen["flattened"],
        "staged": load.rows_staged,
        "loaded": load.rows_inserted,
        "duplicates_skipped": load.duplicates_skipped,
        "rejected": seen["broken"] + seen["invalid"] + n_rejected,
    }
    return _Loaded(fact, summed, found, rows, load, written)


def listed_restaurants(ctx: Context, restaurant_guid: str | None) -> DataFrame:
    """The restaurants of a run, staged and counted: unless they are very many, pages are not moved to meet them."""
    staged, seen = ctx.store.stage_counted("restaurants", restaurants_of(ctx.tenants, ctx.tenant, restaurant_guid), n=F.count(F.lit(1)))
    return F.broadcast(staged) if seen["n"] <= FEW_RESTAURANTS else staged


def _run_facts(
    ctx: Context, facts: list[Fact], restaurant_guid, start, end, fail_batch, dedup_batch,
    pages_of: Callable[[DataFrame], DataFrame] = lambda pages: pages,
    also: Callable[[RunResult], list[Written]] = lambda run: [],
) -> RunResult:
    """Writes all facts of a run, then publishes them as one version.

    `pages_of` narrows the pages down; `also` may write more for the same version.
    """
    ctx = ctx.at()
    start, end = date_range(start, end)
    restaurants = listed_restaurants(ctx, restaurant_guid)
    summary = {"start_date": start, "end_date": end, "restaurants_processed": restaurants.distinct().count(), "tables": {}}
    loaded = []
    for fact in facts:
        pages = in_query_days(ctx.pages(fact.endpoint, restaurants, restaurant_guid), start, end)
        loaded.append(_load_fact(ctx, fact, pages_of(pages), fail_batch, dedup_batch))
        summary["tables"][fact.table.name] = loaded[-1].counts
    n_rejected = sum(part.counts["rejected"] for part in loaded)
    run = RunResult(
        "partial" if n_rejected else "success",
        summary,
        _together([part.rejects for part in loaded]),
        _together([part.by_restaurant for part in loaded]),
        reduce(DataFrame.unionByName, [part.days(part.rows, REASON) for part in loaded]),
        reduce(DataFrame.unionByName, [part.days(part.load.inserted) for part in loaded]),
        lambda: ctx.store.drop_staging(ctx.run_id),
    )
    ctx.store.publish(*[part.written for part in loaded if part.written], *also(run))
    return run


def run_orders(ctx: Context, restaurant_guid=None, start=None, end=None, fail_batch=False, dedup_batch=False) -> RunResult:
    """Loads `fact_order_items`.

    `fail_batch` loads nothing of a restaurant with a rejected row; `dedup_batch`
    keeps one row per key of the batch.
    """
    return _run_facts(ctx, [ORDERS], restaurant_guid, start, end, fail_batch, dedup_batch)


def run_cash(ctx: Context, restaurant_guid=None, start=None, end=None, fail_batch=False, dedup_batch=False) -> RunResult:
    """Loads `fact_cash_entries` and `fact_cash_deposits`."""
    return _run_facts(ctx, [CASH_ENTRIES, CASH_DEPOSITS], restaurant_guid, start, end, fail_batch, dedup_batch)


def run_labor(ctx: Context, restaurant_guid=None, start=None, end=None, fail_batch=False, dedup_batch=False) -> RunResult:
    """Loads `fact_labor_shifts`."""
    return _run_facts(ctx, [TIME_ENTRIES], restaurant_guid, start, end, fail_batch, dedup_batch)


def dealt(pages: DataFrame) -> DataFrame:
    """Pages over all cores, some tasks to each, however few restaurants and files they came in.

    Parsing a menu takes far longer than moving its text. Page texts compress so well that a file of very many
    is read, and a shuffle of them coalesced, as one task; a number of partitions is not coalesced.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages.repartition(TASKS_PER_CORE * cores, "restaurant_guid", "value")


def dimension_outcomes(ctx: Context, restaurants: DataFrame, restaurant_guid: str | None = None) -> dict[Table, DataFrame]:
    """Rows and unreadable pages of the four dimensions, each from one parse."""

    def pages(endpoint: str) -> DataFrame:
        return ctx.pages(endpoint, restaurants, restaurant_guid)

    def listed(parsed: DataFrame) -> DataFrame:
        return documents_and_pages(parsed).withColumn(REASON, F.lit(None).cast("string"))

    info = first_per_restaurant(listed(first_documents(pages("restaurants"), RESTAURANT_DOC)))
    staff = listed(parse_pages(pages("employees"), EMPLOYEE_DOC))
    roles = listed(parse_pages(pages("jobs"), JOB_DOC))
    return {
        DIM_RESTAURANTS: flatten.restaurants(tag(info, []), ctx.stamp),
        DIM_EMPLOYEES: flatten.employees(tag(staff, []), ctx.stamp),
        DIM_JOBS: flatten.jobs(tag(roles, []), ctx.stamp),
        DIM_MENU_ITEMS: menu_outcomes(menu_pages(dealt(pages("menus"))), ctx.stamp, ctx.store.stage),
    }


def run_dimensions(ctx: Context, restaurant_guid=None, mode: str = "full") -> RunResult:
    """Refreshes the four dimensions, each in full or only for the restaurants read.

    All four change in one version, or none does.
    """
    ctx = ctx.at()
    # Staged, so that its size is known to the joins and it is not worked out again for each of them.
    restaurants = ctx.store.stage("restaurants", restaurants_of(ctx.tenants, ctx.tenant, restaurant_guid))
    found, seen = {}, {}
    for table, frame in dimension_outcomes(ctx, restaurants, restaurant_guid).items():
        found[table], seen[table] = ctx.store.stage_counted(table.name, frame, **counts())
    loaded = ctx.store.refresh_all({table: accepted(rows_of(frame), table) for table, frame in found.items()}, mode)
    n_bad = {table: seen[table]["broken"] + seen[table]["rejected"] for table in found}

    def by_restaurant(table: Table) -> DataFrame:
        rows = tally(["restaurant_guid"], (rows_of(found[table]), {"flattened": every_row(), "rejected": rejected_row()}))
        return rows.select(F.lit(table.name).alias("table_name"), "*")

    return RunResult(
        "partial" if sum(n_bad.values()) else "success",
        {
            "restaurants_processed": restaurants.distinct().count(),
            "tables": {t.name: {"loaded": loaded[t.name], "rejected": n_bad[t]} for t in found},
        },
        lambda: reduce(DataFrame.unionByName, [set_aside(frame, table) for table, frame in found.items()]),
        lambda: reduce(DataFrame.unionByName, [by_restaurant(table) for table in found]),
        drop=lambda: ctx.store.drop_staging(ctx.run_id),
    )


RUN_FACTS = {"orders": [ORDERS], "cash": [CASH_ENTRIES, CASH_DEPOSITS], "labor": [TIME_ENTRIES]}
UNIT = ["restaurant_guid", "week_start", "week_end"]


@dataclass
class Backfill:
    """`plan` are the units of work, `finished` those that were left out as done before."""

    plan: DataFrame
    run: RunResult | None = None
    by_window: DataFrame | None = None
    # What each unit gave: its pages are those asked for in its days.
    by_unit: DataFrame | None = None
    finished: DataFrame | None = None


def finished_units(ctx: Context, kind: str) -> DataFrame:
    """Units that earlier backfills of a kind have loaded, whatever they gave."""
    return ctx.store.read(LOAD_UNITS).where(F.col("kind") == kind).select(*UNIT).distinct()


def run_backfill(
    ctx: Context, kind: str, start: str, end: str | None = None, restaurant_guid=None, dry_run: bool = False, resume: bool = False,
    fail_batch: bool = False, dedup_batch: bool = False,
) -> Backfill:
    """One load over the whole range, reported by restaurant and week window.

    `end` defaults to yesterday. A dry run only gives the plan. Rows whose business
    day is outside the range are reported with a null window.

    Units are noted as finished in the version that makes their rows visible. With `resume`, units of
    the plan that were finished before are left out: their pages are not read again.
    """
    if kind not in RUN_FACTS:
        raise ValueError(f"unknown load {kind!r}")
    ctx = ctx.at()
    end = end or date_range()[0]
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    plan = backfill_plan(restaurants_of(ctx.tenants, ctx.tenant, restaurant_guid).distinct(), first, last)
    finished = finished_units(ctx, kind) if resume else None
    if resume:
        plan = plan.join(finished, UNIT, "left_anti")
    if dry_run:
        return Backfill(plan, finished=finished)
    plan = ctx.store.stage("backfill_plan", plan)
    unit = ["restaurant_guid", "window_no"]

    def in_plan(pages: DataFrame) -> DataFrame:
        return with_window(pages, first, last, "query_date").join(plan, unit, "left_semi").drop("window_no") if resume else pages

    def per(day: str, run: RunResult) -> DataFrame:
        return tally(
            unit,
            (plan, {"planned": every_row()}),
            (with_window(run.staged, first, last, day), {"flattened": every_row()}),
            (with_window(run.inserted, first, last, day), {"loaded": every_row()}),
        ).drop("planned")

    units: list[DataFrame] = []

    def note(run: RunResult) -> list[Written]:
        counted = per("query_date", run).join(plan, unit)
        units.append(ctx.store.stage("backfill_units", counted.select(*unit, "week_start", "week_end", "flattened", "loaded")))
        return [ctx.store.write_plain(LOAD_UNITS, units[0].select(F.lit(kind).alias("kind"), *UNIT, "flattened", "loaded", ctx.stamp.alias("_loaded_at")))]

    run = _run_facts(ctx, RUN_FACTS[kind], restaurant_guid, start, end, fail_batch, dedup_batch, in_plan, note)
    return Backfill(plan, run, per("business_date", run), units[0], finished)
