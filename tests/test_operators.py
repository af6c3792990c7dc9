"""Keyed insert under skew, history, tallies and reports against brute force."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillhouse.operators.history import apply_snapshot, history_of
from tillhouse.operators.insert import hot_keys, load_metrics, not_in_target, one_per_key
from tillhouse.operators.summaries import every_row, tally
from tillhouse.plans import marts
from tillhouse.session import settings as session_settings

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("hot_rows", [10, None])
@pytest.mark.parametrize("known_hot", [True, False])
def test_insert_with_a_hot_key(spark, hot_rows, known_hot):
    # One key holds a third of the batch, and one a third of the target.
    batch = [("hot", "o", n) for n in range(300)] + [(f"k{n % 400}", "o", n) for n in range(600)]
    target = [(f"k{n}", "o") for n in range(0, 400, 2)] + [("k1", "o")] * 100 + [("k3", "other")] * 50
    target += [("hot", "o")] * 100 if known_hot else []
    staged = frame(spark, batch, "a string, b string, n int")
    known = frame(spark, target, "a string, b string")
    expected = Counter(row for row in batch if row[:2] not in set(target))
    new = not_in_target(staged, known, ["a", "b"], hot_rows)
    assert Counter(map(tuple, new.collect())) == expected
    metrics = load_metrics(staged, new).first()
    assert metrics == (900, sum(expected.values()), 900 - sum(expected.values()))
    if hot_rows:
        assert [tuple(r) for r in hot_keys(staged, ["a", "b"], hot_rows).collect()] == [("hot", "o")]


def test_insert_is_an_anti_join(spark):
    staged = frame(spark, [("a", 1)], "k string, n int")
    plan = not_in_target(staged, staged, ["k"])._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "BatchEvalPython" not in plan and "CartesianProduct" not in plan


@FEW
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 3))), st.lists(st.sampled_from("abcd")))
def test_loading_twice_adds_nothing(spark, batch, loaded):
    staged = frame(spark, batch, "k string, n int")
    target = frame(spark, [(k,) for k in loaded], "k string")
    new = not_in_target(staged, target, ["k"])
    assert Counter(map(tuple, new.collect())) == Counter(r for r in batch if r[0] not in loaded)
    after = target.unionByName(new.select("k"))
    assert not_in_target(staged, after, ["k"]).isEmpty()


def test_keys_of_a_batch_are_shuffled_once(spark, tmp_path):
    """Finding hot keys and reducing the target's keys share one shuffle of the batch's keys."""
    spark.range(10).selectExpr("id AS k", "id AS n").write.parquet(f"{tmp_path}/a")
    staged = spark.read.parquet(f"{tmp_path}/a")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with session_settings(spark, off):
        plan = not_in_target(staged, staged.select("k"), ["k"])._jdf.queryExecution().executedPlan().toString()
    counted = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Of the batch's keys, of the target's keys, of the batch's rows.
    assert len([line for line in counted if "Reused" not in line]) == 3


def test_one_per_key(spark):
    staged = frame(spark, [("a", 2, None), ("a", 1, "x"), ("b", 3, None), ("b", 3, None)], "k string, n int, s string")
    assert sorted(one_per_key(staged, ["k"]).collect()) == [("a", 1, "x"), ("b", 3, None)]


def test_tally(spark):
    left = frame(spark, [("a", True), ("a", False), ("b", True)], "k string, f boolean")
    right = frame(spark, [("c",)], "k string")
    counts = tally(["k"], (left, {"rows": every_row(), "flagged": F.col("f")}), (right, {"others": every_row()}))
    assert sorted(map(tuple, counts.collect())) == [("a", 2, 1, 0), ("b", 1, 1, 0), ("c", 0, 0, 1)]


D = [dt.date(2024, 1, d) for d in (7, 14, 21)]
SNAPSHOTS = [
    ("same", "x", D[0]), ("same", "x", D[1]), ("same", "x", D[2]),
    ("changed", "x", D[0]), ("changed", "y", D[1]), ("changed", "y", D[2]),
    ("gone", "x", D[0]), ("gone", "x", D[1]),
    ("back", "x", D[0]), ("back", "x", D[2]),
    ("new", None, D[2]), ("new", None, D[2]),
    ("emptied", "x", D[0]), ("emptied", None, D[1]), ("emptied", "", D[2]),
]
HISTORY = [
    ("back", "x", D[0], D[1], False), ("back", "x", D[2], None, True),
    ("changed", "x", D[0], D[1], False), ("changed", "y", D[1], None, True),
    ("emptied", "", D[2], None, True), ("emptied", "x", D[0], D[1], False), ("emptied", None, D[1], D[2], False),
    ("gone", "x", D[0], D[2], False),
    ("new", None, D[2], None, True),
    ("same", "x", D[0], None, True),
]


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def test_history_of_snapshots(spark):
    snapshots = frame(spark, SNAPSHOTS, "k string, v string, snapshot_date date")
    assert by_text(history_of(snapshots, ["k"], ["v"]).collect()) == by_text(HISTORY)


def test_history_snapshot_by_snapshot(spark):
    history = frame(spark, [], "k string, v string, valid_from date, valid_to date, is_current boolean")
    for day in D:
        taken = frame(spark, [r[:2] for r in SNAPSHOTS if r[2] == day], "k string, v string")
        history = apply_snapshot(history, taken, ["k"], ["v"], day)
    assert by_text(history.collect()) == by_text(HISTORY)


def test_reports(spark):
    day = dt.date(2024, 1, 1)
    rows = [
        ("R", day, "o1", "c1", "m1", 1.0, 5.0, 0.0, 2.0, False, False),
        ("R", day, "o1", "c1", "m2", 2.0, 7.0, 1.0, 2.0, False, False),
        ("R", day, "o2", "c2", "m1", 1.0, 5.0, 0.0, 1.0, True, False),
    ]
    items = frame(
        spark, rows,
        "restaurant_guid string, business_date date, order_guid string, check_guid string, menu_item_guid string, "
        "item_quantity double, item_price double, discount_amount double, check_tip double, is_voided boolean, is_deleted boolean",
    )
    places = frame(spark, [("R", "Inn")], "restaurant_guid string, restaurant_name string")
    assert [tuple(r) for r in marts.daily_sales(items, places).collect()] == [("R", day, "Inn", 2, 3.0, 12.0, 1.0)]
    # The tip of a check counts once, though it stands on every line.
    assert [tuple(r) for r in marts.daily_tips(items).collect()] == [("R", day, 2, 3.0)]
    menu = frame(spark, [("m1", "M", "a"), ("m1", "M", "b"), ("m2", "M", "a")], "menu_item_guid string, menu_name string, menu_group_name string")
    assert [tuple(r) for r in marts.sales_by_menu_group(items, menu).collect()] == [("M", "a", 3.0, 12.0)]
