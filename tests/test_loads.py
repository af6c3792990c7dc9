"""Loads from a landing folder: scope, keyed insert, refresh, backfill, stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import scope
from tillhouse.plans import jobs
from tillhouse.schemas import DIM_EMPLOYEES, DIM_MENU_ITEMS, FACT_CASH_DEPOSITS, FACT_ORDER_ITEMS
from tillhouse.sinks.warehouse import Warehouse, write_ndjson
from tillhouse.streaming.ingest import start_ingest

DAYS = ["2025-01-01", "2025-01-05", "2025-01-09"]


def order(key, day, lines=2, **changes):
    selections = [{"guid": f"{key}-{n}", "quantity": 1, "price": n} for n in range(lines)]
    check = {"guid": f"{key}-c", "totalAmount": 3, "selections": selections}
    return {"guid": key, "businessDate": int(day.replace("-", "")), "checks": [check]} | changes


def land(root, endpoint, restaurant, day, page):
    folder = root / endpoint / f"restaurant_guid={restaurant}"
    if day:
        folder /= f"query_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    name = f"page{len(list(folder.iterdir()))}.json"
    (folder / name).write_text(page if isinstance(page, str) else json.dumps(page))


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    for restaurant in ("A", "B", "Z"):
        for day in DAYS:
            land(root, "orders", restaurant, day, [order(f"{restaurant}{day}", day)])
            land(root, "cash_entries", restaurant, day, {"data": [{"guid": f"e{restaurant}{day}", "amount": 1}]})
            land(root, "cash_deposits", restaurant, day, [{"guid": f"d{restaurant}{day}", "amount": 2}])
            land(root, "time_entries", restaurant, day, [{"guid": f"t{restaurant}{day}", "inDate": f"{day}T10:00:00.000+0000"}])
        land(root, "restaurants", restaurant, None, {"general": {"name": f"Inn {restaurant}"}})
        land(root, "employees", restaurant, None, [{"guid": f"u{restaurant}"}])
        land(root, "jobs", restaurant, None, [{"guid": f"j{restaurant}", "title": "Cook"}])
        land(root, "menus", restaurant, None, {"menus": [{"name": "M", "groups": [{"name": "g", "items": [{"guid": f"m{restaurant}"}]}]}]})
    return root


@pytest.fixture
def tenants(spark, tmp_path):
    path = tmp_path / "tenants"
    rows = [("one", "ds_one", "A"), ("one", "ds_one", "B"), ("two", "ds_two", "Z")]
    write_ndjson(spark.createDataFrame(rows, "tenant string, dataset string, restaurant_guid string"), str(path))
    from tillhouse.sources.tenants import read_tenants

    return read_tenants(spark, str(path))


@pytest.fixture
def context(spark, landing, tenants, tmp_path):
    def build(tenant="one", **more):
        return jobs.Context(spark, str(landing), str(tmp_path / "warehouse"), tenants, tenant, **more)

    return build


def test_scope(spark, tenants):
    def guids(tenant, guid=None):
        return sorted(r[0] for r in scope.restaurants_of(tenants, tenant, guid).collect())

    assert guids("one") == guids("one", "ALL") == guids("one", "") == ["A", "B"]
    assert guids("one", "Z") == ["Z"]
    with pytest.raises(KeyError):
        guids("nobody")
    assert scope.date_range(today=dt.date(2026, 3, 1)) == ("2026-02-28", "2026-02-28")
    assert scope.date_range("2026-01-01") == ("2026-01-01", "2026-01-01")


def test_orders_load_is_idempotent(spark, context, landing):
    first = jobs.run_orders(context(), start=DAYS[0], end=DAYS[1])
    assert first.status == "success" and first.summary["restaurants_processed"] == 2
    assert first.summary["tables"]["fact_order_items"] == {
        "fetched": 4, "flattened": 8, "staged": 8, "loaded": 8, "duplicates_skipped": 0, "rejected": 0,
    }
    # Changed values of a loaded key are ignored; a new key of an old day goes in.
    changed = order(f"A{DAYS[0]}", DAYS[0], lines=3)
    changed["checks"][0]["selections"][0]["price"] = 99
    land(landing, "orders", "A", DAYS[0], [changed])
    second = jobs.run_orders(context(), start=DAYS[0], end=DAYS[2])
    table = second.summary["tables"]["fact_order_items"]
    assert (table["fetched"], table["flattened"], table["loaded"], table["duplicates_skipped"]) == (7, 15, 5, 10)
    rows = context().store.read(FACT_ORDER_ITEMS)
    assert rows.count() == 13 and rows.where("item_price = 99").isEmpty()
    assert jobs.run_orders(context(), start=DAYS[0], end=DAYS[2]).summary["tables"]["fact_order_items"]["loaded"] == 0
    counts = {r.restaurant_guid: r for r in second.by_restaurant.collect()}
    assert (counts["A"].fetched, counts["A"].flattened, counts["A"].loaded) == (4, 9, 3)
    assert (counts["B"].fetched, counts["B"].flattened, counts["B"].loaded) == (3, 6, 2)


def test_new_duplicates_in_one_batch(spark, context, landing):
    land(landing, "orders", "A", DAYS[0], [order(f"A{DAYS[0]}", DAYS[0])])
    assert jobs.run_orders(context(), "A", DAYS[0]).summary["tables"]["fact_order_items"]["loaded"] == 4
    other = jobs.run_orders(context("two"), "A", DAYS[0], dedup_batch=True)
    assert other.summary["tables"]["fact_order_items"]["loaded"] == 2


def test_rejects(spark, context, landing):
    bad_line = order("A9", DAYS[0])
    bad_line["checks"][0]["selections"][0]["price"] = "n/a"
    land(landing, "orders", "A", DAYS[0], [bad_line, order("A8", DAYS[0], guid=None)])
    land(landing, "orders", "B", DAYS[0], "[{")
    run = jobs.run_orders(context(), start=DAYS[0])
    assert run.status == "partial"
    assert run.summary["tables"]["fact_order_items"]["rejected"] == 3
    assert sorted((r.stage, r.restaurant_guid, r.reject_reason) for r in run.rejects.collect()) == [
        ("document", "A", "missing guid"), ("page", "B", "unreadable page"), ("row", "A", "bad price"),
    ]
    assert run.summary["tables"]["fact_order_items"]["loaded"] == 5
    whole = jobs.run_orders(context("two"), "A", DAYS[0], fail_batch=True)
    assert whole.summary["tables"]["fact_order_items"]["loaded"] == 0


def test_an_empty_batch_changes_nothing(spark, context):
    run = jobs.run_orders(context(), start="2030-01-01")
    assert run.status == "success" and run.summary["tables"]["fact_order_items"]["loaded"] == 0
    assert context().store.read(FACT_ORDER_ITEMS).count() == 0


def test_cash_and_labor(spark, context):
    cash = jobs.run_cash(context(), start=DAYS[0], end=DAYS[2]).summary["tables"]
    assert (cash["fact_cash_entries"]["loaded"], cash["fact_cash_deposits"]["loaded"]) == (6, 6)
    days = context().store.read(FACT_CASH_DEPOSITS).select("business_date").distinct()
    assert sorted(r[0].isoformat() for r in days.collect()) == DAYS
    assert jobs.run_labor(context(), start=DAYS[0], end=DAYS[2]).summary["tables"]["fact_labor_shifts"]["loaded"] == 6


def test_dimensions(spark, context):
    run = jobs.run_dimensions(context())
    assert run.status == "success"
    assert {t: v["loaded"] for t, v in run.summary["tables"].items()} == {
        "dim_restaurants": 2, "dim_employees": 2, "dim_jobs": 2, "dim_menu_items": 2,
    }
    store = context().store
    guids = lambda table: sorted(r[0] for r in store.read_dimension(table).select("restaurant_guid").collect())
    jobs.run_dimensions(context(), "Z", mode="restaurant")
    assert guids(DIM_EMPLOYEES) == ["A", "B", "Z"]
    # Nothing was landed for this restaurant, so the old version stays.
    jobs.run_dimensions(context(), "nobody")
    assert guids(DIM_MENU_ITEMS) == ["A", "B", "Z"]
    jobs.run_dimensions(context(), "A")
    assert guids(DIM_EMPLOYEES) == ["A"]


def test_backfill(spark, context):
    dry = jobs.run_backfill(context(), "orders", "2025-01-01", "2025-01-10", dry_run=True)
    assert dry.run is None and dry.plan.count() == 4
    assert sorted(tuple(map(str, r)) for r in dry.plan.where("restaurant_guid = 'A'").collect()) == [
        ("A", "0", "2025-01-01", "2025-01-07"), ("A", "1", "2025-01-08", "2025-01-10"),
    ]
    done = jobs.run_backfill(context(), "orders", "2025-01-01", "2025-01-10")
    units = {(r.restaurant_guid, r.window_no): (r.flattened, r.loaded) for r in done.by_window.collect()}
    assert units == {("A", 0): (4, 4), ("A", 1): (2, 2), ("B", 0): (4, 4), ("B", 1): (2, 2)}


def test_stream(spark, context, landing, tmp_path):
    def ingest(checkpoint):
        start_ingest(context(), jobs.ORDERS, str(tmp_path / checkpoint), maxFilesPerTrigger=4).awaitTermination()
        return context().store.read(FACT_ORDER_ITEMS).count()

    assert ingest("a") == 12
    land(landing, "orders", "A", "2025-01-12", [order("A12", "2025-01-12")])
    assert ingest("a") == 14
    # A fresh checkpoint replays every file; nothing goes in twice.
    assert ingest("b") == 14


def test_lines_as_pages(spark, context, landing):
    folder = landing / "orders" / "restaurant_guid=A" / "query_date=2025-02-01"
    folder.mkdir(parents=True)
    (folder / "pages.json").write_text("\n".join(json.dumps([order(f"L{n}", "2025-02-01")]) for n in range(3)))
    run = jobs.run_orders(context(one_per_line=True), start="2025-02-01")
    assert run.summary["tables"]["fact_order_items"]["loaded"] == 6


def test_facts_are_laid_out_by_day(spark, context):
    store: Warehouse = context().store
    jobs.run_orders(context(), start=DAYS[0], end=DAYS[2])
    plan = store.read(FACT_ORDER_ITEMS).where(F.col("business_date") == F.lit(dt.date(2025, 1, 5)))
    text = plan._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(business_date" in text
    assert plan.count() == 4
    assert store.drop_staging() and plan.count() == 4
