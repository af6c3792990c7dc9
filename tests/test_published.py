"""Published versions, the key index, resumed and repeated loads, one parse, histories."""

import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from test_loads import DAYS, context, land, landing, order, tenants  # noqa: F401  fixtures
from tillhouse.operators import menus as menu_operators
from tillhouse.operators.history import history_of, valid_on
from tillhouse.operators.insert import not_in_target
from tillhouse.operators.scope import in_restaurants
from tillhouse.plans import jobs, marts
from tillhouse.plans.landed import Dying
from tillhouse.schemas import DIM_EMPLOYEES, DIM_MENU_ITEMS, FACT_CASH_ENTRIES, FACT_ORDER_ITEMS, LOAD_UNITS, REJECTS
from tillhouse.sinks import key_index
from tillhouse.sinks.history import HistoryTable
from tillhouse.sinks.key_index import may_hold, with_hashes
from tillhouse.sinks.manifest import Manifest, ManifestLog
from tillhouse.sinks.warehouse import Warehouse
from tillhouse.sources.envelope import menu_pages
from tillhouse.sources.landing import read_pages
from tillhouse.streaming.ingest import insert_batch


def facts(spark, keys, day="2025-01-01"):
    """Cash entries with the given numbers as keys."""
    given = spark.createDataFrame([(k,) for k in keys], "k long") if isinstance(keys, list) else keys
    values = {c: F.lit(None) for c in FACT_CASH_ENTRIES.columns} | {
        "cash_entry_guid": F.concat(F.lit("E"), F.col("k").cast("string")),
        "restaurant_guid": F.lit("R"),
        "business_date": F.lit(day).cast("date"),
        "amount": F.col("k").cast("double"),
        "_loaded_at": F.lit("2025-01-01 00:00:00").cast("timestamp"),
    }
    return given.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in FACT_CASH_ENTRIES.schema])


def keys_of(frame):
    return sorted(int(r[0][1:]) for r in frame.select("cash_entry_guid").collect())


# --- manifests ----------------------------------------------------------------------------


def test_versions_are_numbered_and_taken_once(spark, tmp_path):
    log = ManifestLog(spark, str(tmp_path / "data"))
    assert log.read() == Manifest() and log.numbers() == []
    first = log.write(Manifest().after({"a": ["x"]}, {}, {}))
    second = log.write(first.after({"a": ["y"]}, {"b": ["z"]}, {"s": 4}))
    assert log.numbers() == [1, 2] and log.read() == second and log.read(1) == first
    assert second.tables == {"a": ["x", "y"], "b": ["z"]} and second.batches == {"s": 4}
    with pytest.raises(FileExistsError):
        log.write(first.after({"a": ["other"]}, {}, {}))
    assert log.read() == second
    assert not [n for n in log.files.names(log.folder) if n.endswith(".part")]


def test_a_load_that_dies_leaves_nothing(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), "d")
    store.append(FACT_CASH_ENTRIES, facts(spark, [1, 2]))
    with pytest.raises(ConnectionError):
        Dying(spark, str(tmp_path), "d").append(FACT_CASH_ENTRIES, facts(spark, [3]))
    assert keys_of(store.read(FACT_CASH_ENTRIES)) == [1, 2]
    # Its keys are not known either, so the next try inserts them.
    assert store.insert_new(FACT_CASH_ENTRIES, store.stage("batch", facts(spark, [2, 3]))).rows_inserted == 1
    assert keys_of(store.read(FACT_CASH_ENTRIES)) == [1, 2, 3] and keys_of(store.read(FACT_CASH_ENTRIES, 1)) == [1, 2]
    (orphan,) = store.unpublished(FACT_CASH_ENTRIES)
    assert store.drop_unpublished(FACT_CASH_ENTRIES) == 1 and store.unpublished(FACT_CASH_ENTRIES) == []
    assert not store.files.exists(f"{store.path(FACT_CASH_ENTRIES)}/{orphan}") and keys_of(store.read(FACT_CASH_ENTRIES)) == [1, 2, 3]


def test_nothing_to_add_is_no_version(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), "d")
    assert store.append(FACT_CASH_ENTRIES, facts(spark, [])) == 0 and store.manifest().number == 0
    assert store.insert_new(FACT_CASH_ENTRIES, store.stage("batch", facts(spark, []))).rows_inserted == 0
    assert store.read(FACT_CASH_ENTRIES).count() == 0 and store.manifest().number == 0


def test_dimensions_change_together(spark, context, landing):  # noqa: F811
    jobs.run_dimensions(context())
    before = context().store.manifest()
    land(landing, "employees", "A", None, [{"guid": "new"}])
    land(landing, "jobs", "A", None, "[{")
    dying = context()
    dying.__class__ = type("D", (jobs.Context,), {"store": property(lambda self: Dying(self.spark, self.warehouse, "ds_one", self.run_id))})
    with pytest.raises(ConnectionError):
        jobs.run_dimensions(dying)
    assert context().store.manifest() == before
    run = jobs.run_dimensions(context())
    after = context().store.manifest()
    assert after.number == before.number + 1 and len(after.tables) == 4
    assert all(after.tables[t] != before.tables[t] for t in after.tables)
    assert run.status == "partial" and [(r.table_name, r.stage, r.reject_reason) for r in run.rejects.collect()] == [("dim_jobs", "page", "unreadable page")]
    assert context().store.read_dimension(DIM_EMPLOYEES, before.number).count() == 2
    assert context().store.read_dimension(DIM_EMPLOYEES).count() == 3


# --- the key index ------------------------------------------------------------------------


def test_insert_by_index_is_the_plain_insert(spark, tmp_path):
    rng = random.Random(1)
    store = Warehouse(spark, str(tmp_path), "d", buckets=4)
    for part in range(3):
        store.append(FACT_CASH_ENTRIES, facts(spark, [rng.randrange(3000) for _ in range(400)], DAYS[part]))
    batch = store.stage("batch", facts(spark, [rng.randrange(3000) for _ in range(500)] + [7] * 900))
    plain = not_in_target(batch, store.read(FACT_CASH_ENTRIES), ["cash_entry_guid"])
    by_index = not_in_target(batch, store.known_keys(FACT_CASH_ENTRIES, batch), ["cash_entry_guid"])
    assert keys_of(plain) == keys_of(by_index) and 0 < by_index.count() < batch.count()


def test_only_files_that_may_hold_a_key_are_read(spark, tmp_path):
    """Twenty loads; a batch of keys from one of them, now of another day, and of new keys."""
    store = Warehouse(spark, str(tmp_path), "d", buckets=2)
    for part in range(20):
        store.append(FACT_CASH_ENTRIES, facts(spark, [part * 100 + i for i in range(100)], "2025-01-01"))
    index = store.index(FACT_CASH_ENTRIES)
    every = store.manifest().tables[FACT_CASH_ENTRIES.name]
    # All files of one load hold its keys; a file of another load is read by mistake for one key in 10^5.
    moved = store.known_keys(FACT_CASH_ENTRIES, facts(spark, [700 + i for i in range(40)] + [90_000 + i for i in range(40)], "2025-06-30"))
    assert len(every) == 20 and len(index._open([f"{index.keys_root}/{f}" for f in every], moved).inputFiles()) == 40
    assert len(moved.inputFiles()) == 2
    assert set(range(700, 740)) <= set(keys_of(moved)) and moved.count() == 100
    assert store.known_keys(FACT_CASH_ENTRIES, facts(spark, [50_000 + i for i in range(50)])) is None
    result = store.insert_new(FACT_CASH_ENTRIES, store.stage("b", facts(spark, [701, 90_001], "2025-06-30")))
    assert result.rows_inserted == 1 and keys_of(result.inserted) == [90_001]


def test_compaction(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), "d", buckets=2)
    assert store.compact(FACT_CASH_ENTRIES) == 0
    for part in range(3):
        store.append(FACT_CASH_ENTRIES, facts(spark, [part * 10 + i for i in range(10)], DAYS[part]))
    files = len(store.read(FACT_CASH_ENTRIES).inputFiles())
    assert store.compact(FACT_CASH_ENTRIES) == 30 and len(store.manifest().tables[FACT_CASH_ENTRIES.name]) == 1
    assert keys_of(store.read(FACT_CASH_ENTRIES)) == list(range(30)) == keys_of(store.read(FACT_CASH_ENTRIES, 3))
    assert len(store.read(FACT_CASH_ENTRIES).inputFiles()) <= files
    batch = store.stage("b", facts(spark, [5, 25, 31]))
    assert keys_of(store.insert_new(FACT_CASH_ENTRIES, batch).inserted) == [31]


def test_filter_holds_every_key_and_few_others(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), "d", buckets=3)
    store.append(FACT_CASH_ENTRIES, facts(spark, spark.range(20_000).withColumnRenamed("id", "k")))
    index = store.index(FACT_CASH_ENTRIES)
    units = index.units(store.manifest().tables[FACT_CASH_ENTRIES.name])
    assert sorted(r.bucket for r in units.collect()) == [0, 1, 2] and units.agg(F.sum("n_keys")).first()[0] == 20_000

    def held(first, last):
        rows = facts(spark, spark.range(first, last).withColumnRenamed("id", "k"))
        return with_hashes(rows, ["cash_entry_guid"], 3).join(units, "bucket").where(may_hold()).count()

    assert held(0, 20_000) == 20_000
    assert held(20_000, 120_000) < 30


def test_two_column_keys(spark, context, landing):  # noqa: F811
    """A selection number may come again in another order."""
    jobs.run_orders(context(), start=DAYS[0])
    other = order("other", DAYS[0])
    other["checks"][0]["selections"][0]["guid"] = f"A{DAYS[0]}-0"
    land(landing, "orders", "A", DAYS[0], [other])
    assert jobs.run_orders(context(), start=DAYS[0]).summary["tables"]["fact_order_items"]["loaded"] == 2


# --- backfill and streams -------------------------------------------------------------------


def test_backfill_goes_on_where_it_stopped(spark, context, landing):  # noqa: F811
    whole = ("orders", "2025-01-01", "2025-01-14")
    jobs.run_backfill(context(), "orders", "2025-01-01", "2025-01-07", "A")
    assert jobs.run_backfill(context(), *whole, resume=True, dry_run=True).plan.count() == 3
    # What has been landed since for a finished unit stays out; a full backfill takes it.
    land(landing, "orders", "A", DAYS[0], [order("late", DAYS[0])])
    second = jobs.run_backfill(context(), *whole, resume=True)
    units = {(r.restaurant_guid, r.window_no): (r.flattened, r.loaded) for r in second.by_unit.collect()}
    assert units == {("A", 1): (2, 2), ("B", 0): (4, 4), ("B", 1): (2, 2)} and second.finished.count() == 1
    table = second.run.summary["tables"]["fact_order_items"]
    assert (sum(u[0] for u in units.values()), sum(u[1] for u in units.values())) == (table["flattened"], table["loaded"])
    again = jobs.run_backfill(context(), *whole, resume=True)
    assert again.by_unit.count() == 0 and again.run.summary["tables"]["fact_order_items"]["fetched"] == 0
    full = jobs.run_backfill(context(), *whole)
    assert full.run.summary["tables"]["fact_order_items"]["loaded"] == 2 and full.by_unit.count() == 4
    assert context().store.read(LOAD_UNITS).count() == 1 + 3 + 4


def test_a_backfill_that_dies_has_finished_nothing(spark, context):  # noqa: F811
    dying = context()
    dying.__class__ = type("D", (jobs.Context,), {"store": property(lambda self: Dying(self.spark, self.warehouse, "ds_one", self.run_id))})
    with pytest.raises(ConnectionError):
        jobs.run_backfill(dying, "orders", DAYS[0], DAYS[2])
    assert context().store.read(FACT_ORDER_ITEMS).count() == 0
    assert jobs.run_backfill(context(), "orders", DAYS[0], DAYS[2], resume=True).by_unit.count() == 4


def test_a_batch_that_comes_again_changes_nothing(spark, context, landing):  # noqa: F811
    bad = order("bad", DAYS[0])
    bad["checks"][0]["selections"][0]["price"] = "n/a"
    land(landing, "orders", "A", DAYS[0], [bad, order("x", DAYS[0], guid=None)])
    land(landing, "orders", "A", DAYS[0], "[{")
    store = context().store
    pages = read_pages(spark, str(landing), "orders").where("restaurant_guid = 'A'")

    def state():
        return store.read(FACT_ORDER_ITEMS).count(), sorted((r.stage, r.reject_reason) for r in store.read(REJECTS).collect())

    assert insert_batch(store, jobs.ORDERS, pages, "s", 0)
    first = state()
    assert first == (7, [("document", "missing guid"), ("page", "unreadable page"), ("row", "bad price")])
    assert not insert_batch(store, jobs.ORDERS, pages, "s", 0) and state() == first
    # From a fresh checkpoint it is another stream: known by its keys and by its rejects' content.
    assert insert_batch(store, jobs.ORDERS, pages, "t", 0) and state() == first
    assert store.manifest().batches == {"s": 0, "t": 0}
    assert store.files.names(f"{store.root}/_staging") == []


def test_runs_drop_their_own_staging(spark, context):  # noqa: F811
    first, second = jobs.run_labor(context(), start=DAYS[0]), jobs.run_labor(context(), start=DAYS[1])
    folders = context().store.files.names(f"{context().store.root}/_staging")
    assert len(folders) == 2
    first.close()
    assert len(context().store.files.names(f"{context().store.root}/_staging")) == 1
    assert second.by_restaurant.count() == 2


# --- one parse ------------------------------------------------------------------------------


def test_one_parse_tells_everything(spark, context, landing):  # noqa: F811
    """Rows, rejects of all stages and counters come from one chain of parsing."""
    voided = order("v", DAYS[0])
    for line in voided["checks"][0]["selections"]:
        line["voided"] = True
    empty = order("e", DAYS[0], checks=[])
    land(landing, "orders", "A", DAYS[0], [voided, empty, order("n", DAYS[0], guid=None), None])
    land(landing, "orders", "B", DAYS[0], [])
    land(landing, "orders", "B", DAYS[0], "[{")
    found = jobs.outcomes(jobs.ORDERS, read_pages(spark, str(landing), "orders"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The typed read, and the one as text for pages that do not fit; none of them twice.
    assert plan.count("from_json(") == 2
    counted = found.where("query_date = DATE'2025-01-01'").groupBy("restaurant_guid", "stage", "reject_reason").agg(F.count(F.lit(1)).alias("n"), F.sum("n_documents").alias("d"))
    got = {(r[0], r[1], r[2]): (r.n, r.d) for r in counted.collect()}
    assert got == {
        ("A", "row", None): (2, 1), ("A", "document", None): (2, 2), ("A", "document", "missing guid"): (2, 2),
        ("B", "row", None): (2, 1), ("B", "page", "unreadable page"): (1, 0), ("Z", "row", None): (2, 1),
    }
    record = json.loads(found.where("reject_reason = 'unreadable page'").first().record)
    assert record["value"] == "[{" and record["restaurant_guid"] == "B"


def test_menu_levels_stage_no_subtrees(spark, tmp_path):
    """A tree seven levels deep: what is staged is about what came in, not seven times that."""
    def tree(level):
        items = [{"guid": f"g{level}-{i}", "name": f"a rather long name of item {i} on level {level}" * 3} for i in range(300)]
        return {"name": f"level {level}", "items": items, "subgroups": [tree(level + 1)] if level < 7 else []}

    pages = spark.createDataFrame([("R", json.dumps([{"name": "M", "groups": [tree(1)]}]))], "restaurant_guid string, value string")
    size, staged = len(pages.first().value), []

    def stage(name, frame):
        frame.write.option("compression", "uncompressed").option("parquet.enable.dictionary", False).parquet(f"{tmp_path}/{name}")
        staged.append(f"{tmp_path}/{name}")
        return spark.read.schema(frame.schema).parquet(staged[-1])

    found = menu_operators.menu_items(menu_pages(pages), stage=stage)
    assert found.count() == 2100 and len(staged) == 1
    assert Warehouse(spark, str(tmp_path), "d").files.size(staged[0]) < 1.3 * size


def test_menu_pages_and_rows_from_one_pass(spark):
    deep = {"name": "g20", "items": [{"guid": "deep", "price": "dear"}]}
    for level in range(19, 0, -1):
        deep = {"name": f"g{level}", "subgroups": [deep], "items": [{"guid": f"i{level}"}, {"guid": ""}]}
    values = [json.dumps([{"name": "M", "groups": [deep]}]), "[{", json.dumps([])]
    pages = spark.createDataFrame([("R", v) for v in values], "restaurant_guid string, value string")
    rows = menu_operators.menu_outcomes(menu_pages(pages)).collect()
    assert sorted((r.stage, r.reject_reason) for r in rows if r.reject_reason) == [("page", "unreadable page"), ("row", "bad price")]
    assert sorted(r.menu_item_guid for r in rows if r.stage == "row") == sorted(["deep", *[f"i{n}" for n in range(1, 20)]])
    assert json.loads(next(r.record for r in rows if r.stage == "page"))["value"] == "[{"


def test_old_snapshots_are_not_opened(spark, tmp_path):
    root = tmp_path / "landing"
    for restaurant, days in (("A", ["2024-01-07", "2024-01-14"]), ("B b", ["2024-01-07"]), ("7", ["2023-12-31", "2024-01-07"])):
        for day in days:
            folder = root / "employees" / f"restaurant_guid={restaurant}" / f"snapshot_date={day}"
            folder.mkdir(parents=True)
            (folder / "page.json").write_text(json.dumps([{"guid": f"{restaurant} {day}"}]))
    pages = read_pages(spark, str(root), "employees")
    assert len(pages.inputFiles()) == 3 and not [f for f in pages.inputFiles() if "2023" in f]
    assert sorted(json.loads(r.value)[0]["guid"] for r in pages.collect()) == ["7 2024-01-07", "A 2024-01-14", "B b 2024-01-07"]
    assert sorted(r.restaurant_guid for r in pages.collect()) == ["7", "A", "B b"] and pages.columns == ["value", "restaurant_guid", "source_file"]


# --- histories ------------------------------------------------------------------------------

SNAPSHOTS = [
    ("2024-01-07", {"a": "cook", "b": "host", "c": None}),
    ("2024-01-14", {"a": "chef", "b": "host", "d": "cook"}),
    ("2024-01-21", {"a": "chef", "c": "host", "d": None}),
    ("2024-01-28", {"a": "cook", "b": "host", "c": "host", "d": None}),
]


def test_history_table(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), "d")
    history = HistoryTable(store, "staff", ("guid",), ("title",))
    rows = [(guid, title, dt.date.fromisoformat(day)) for day, staff in SNAPSHOTS for guid, title in staff.items()]
    everything = spark.createDataFrame(rows, "guid string, title string, snapshot_date date")
    closed_before = []
    for day, _ in SNAPSHOTS:
        taken = everything.where(F.col("snapshot_date") == F.lit(day).cast("date"))
        assert history.apply(taken, dt.date.fromisoformat(day)) and not history.apply(taken, dt.date.fromisoformat(day))
        closed = store.manifest().tables.get("staff_closed", [])
        # Closed versions are added to, never written again.
        assert closed[: len(closed_before)] == closed_before
        closed_before = closed
    expected = history_of(everything, ["guid"], ["title"])
    assert sorted(map(repr, history.read().collect())) == sorted(map(repr, expected.collect()))
    assert history.read(2).where("is_current").count() == 3
    assert not history.apply(everything, dt.date(2024, 1, 1))


def test_valid_on_against_brute_force(spark):
    rng = random.Random(3)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    versions, facts_ = [], []
    for key in "abcde":
        at = rng.randrange(10)
        for n in range(rng.randrange(4)):
            end = at + rng.randrange(1, 9)
            versions.append((key, f"{key}{n}", day(at), None if n == 2 else day(end)))
            at = end + rng.choice([0, 0, 3])
    facts_ = [(rng.choice("abcdef"), day(rng.randrange(-3, 60))) for _ in range(300)] + [("a", day(5))] * 500 + [(None, day(5)), ("b", None)]
    history = spark.createDataFrame(versions, "k string, title string, valid_from date, valid_to date")
    asked = spark.createDataFrame(facts_, "k string, business_date date")
    got = {(r.k, r.business_date): r.title for r in valid_on(asked, history, ["k"], ["title"]).collect()}
    expected = {
        (k, d): next((t for v, t, a, b in versions if v == k and d is not None and a <= d and (b is None or d < b)), None)
        for k, d in set(facts_) if k is not None
    }
    assert got == expected
    plan = valid_on(asked, history, ["k"], ["title"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sales_by_title(spark):
    history = spark.createDataFrame([("s", "cook", dt.date(2024, 1, 1), dt.date(2024, 2, 1)), ("s", "chef", dt.date(2024, 2, 1), None)], "employee_guid string, job_title string, valid_from date, valid_to date")
    rows = [("s", dt.date(2024, 1, 31), 1.0, False), ("s", dt.date(2024, 2, 1), 2.0, False), ("s", dt.date(2023, 12, 31), 4.0, False), (None, dt.date(2024, 1, 5), 8.0, False), ("s", dt.date(2024, 1, 5), 16.0, True)]
    items = spark.createDataFrame(rows, "server_guid string, business_date date, item_price double, is_voided boolean").withColumn("is_deleted", F.lit(False))
    got = {r.job_title: (r.items_sold, r.revenue) for r in marts.sales_by_title_then(items, history).collect()}
    assert got == {"cook": (1, 1.0), "chef": (1, 2.0), None: (2, 12.0)}


def test_dimension_tables_have_menu_rows(spark, context):  # noqa: F811
    jobs.run_dimensions(context())
    assert [r.menu_item_guid for r in context().store.read_dimension(DIM_MENU_ITEMS).sort("menu_item_guid").collect()] == ["mA", "mB"]


# --- large loads -----------------------------------------------------------------------------


def test_large_batches_are_inserted_in_parts(spark, tmp_path, monkeypatch):
    """A batch of more rows than are taken at once gives the same rows, counts and versions; part of its keys are known."""
    rng = random.Random(4)
    loaded, given = [rng.randrange(3000) for _ in range(700)], [rng.randrange(3000) for _ in range(900)] + [7] * 300
    found = []
    for at_once in (1 << 26, 150):
        monkeypatch.setattr(key_index, "ROWS_AT_ONCE", at_once)
        monkeypatch.setattr(key_index, "MANY", at_once)
        monkeypatch.setattr(key_index, "SHOWN", 8)
        for dedup in (False, True):
            store = Warehouse(spark, str(tmp_path), f"d{at_once}{dedup}", buckets=8)
            store.append(FACT_CASH_ENTRIES, facts(spark, loaded))
            staged = store.stage("batch", facts(spark, given).withColumn("query_date", F.lit("2025-01-05").cast("date")))
            result = store.insert_new(FACT_CASH_ENTRIES, staged, dedup_batch=dedup)
            folders = store.manifest().tables[FACT_CASH_ENTRIES.name]
            assert len(folders) == (2 if at_once > 1200 else 9) and store.manifest().number == 2
            assert result.inserted.schema == staged.schema and {str(r.query_date) for r in result.inserted.collect()} == {"2025-01-05"}
            found.append((result.rows_staged, result.rows_inserted, keys_of(result.inserted), keys_of(store.read(FACT_CASH_ENTRIES))))
            again = store.insert_new(FACT_CASH_ENTRIES, staged, dedup_batch=dedup)
            assert again.rows_inserted == 0 and again.inserted.count() == 0
    new = [k for k in given if k not in set(loaded)]
    assert found[0] == found[2] == (1200, len(new), sorted(new), sorted(loaded + new))
    assert found[1] == found[3] == (1200, len(set(new)), sorted(set(new)), sorted(loaded + sorted(set(new))))


def test_no_shuffle_is_left_behind(spark, tmp_path):
    """What a write has shuffled is gone when it ends, and the setting is as before."""
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    store = Warehouse(spark, str(tmp_path), "d", buckets=2)
    store.append(FACT_CASH_ENTRIES, facts(spark, [*range(50)]))
    batch = store.stage("batch", facts(spark, [*range(30, 90)]).distinct())
    before = set(re.findall(r"\d+", str(shuffles.keySet().toString())))
    assert store.stage("counted", batch.groupBy("business_date").count()).count() == 1
    store.append(FACT_CASH_ENTRIES, batch)
    assert set(re.findall(r"\d+", str(shuffles.keySet().toString()))) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_key_files_hold_keys_only(spark, tmp_path):
    """Hashes are random bytes, which took more space than the keys."""
    store = Warehouse(spark, str(tmp_path), "d", buckets=2)
    store.append(FACT_CASH_ENTRIES, facts(spark, [*range(50)]))
    assert spark.read.parquet(store.index(FACT_CASH_ENTRIES).keys_root).columns == ["cash_entry_guid", "load", "bucket"]


def test_pages_are_not_moved_to_meet_restaurants(spark, context, monkeypatch):  # noqa: F811
    """The restaurants of a run are staged and counted: few are broadcast, very many are left to Spark."""
    def joins():
        ctx = context().at()
        pages = in_restaurants(ctx.pages("orders", ctx.tenants), jobs.listed_restaurants(ctx, None))
        return pages._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in joins()
    monkeypatch.setattr(jobs, "FEW_RESTAURANTS", 0)
    assert "strategy=broadcast" not in joins()
