"""Order pages made from lines: their text, and that making and wrapping them is compiled."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import testdata
from tillhouse.schemas import ORDER_DOC
from tillhouse.sources.envelope import parse_pages

SHAPE = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
DAY = dt.datetime(1996, 2, 3)


def _pages(spark, **changed):
    row = {
        "l_orderkey": 5, "l_partkey": 10, "l_suppkey": 7, "l_linenumber": 1, "l_quantity": 8.0, "l_extendedprice": 100.5,
        "l_discount": 0.1, "l_tax": 0.02, "l_returnflag": "N", "l_linestatus": "O", "l_shipdate": DAY,
    } | changed
    return testdata.line_orders(spark.createDataFrame([tuple(row.values())], SHAPE))


def _document(spark, **changed):
    page = json.loads(_pages(spark, **changed).first().value)
    return page[0] if isinstance(page, list) else page["data"][0]


def test_a_page_of_one_line(spark):
    selection = {
        "guid": "5-1-1", "itemGuid": "10", "item": {"guid": "P10"}, "displayName": "item 10", "salesCategory": {"name": "category 2"},
        "quantity": 8.0, "price": 100.5, "preDiscountPrice": 101.5, "appliedDiscountAmount": 0.1, "tax": 0.02,
    }
    first = {"guid": "5-1-A", "totalAmount": 100.5, "taxAmount": 0.02, "payments": [], "selections": [selection]}
    assert _document(spark) == {
        "guid": "5", "restaurantGuid": "R7", "businessDate": 19960203, "openedDate": "1996-02-03T00:00:00.000+0000",
        "server": {"guid": "S3"}, "checks": [first],
    }


def test_null_values_leave_their_fields_out(spark):
    got = _document(spark, l_orderkey=None, l_partkey=None, l_extendedprice=None, l_tax=None, l_shipdate=None, l_returnflag=None)
    assert "guid" not in got and "businessDate" not in got and "openedDate" not in got
    (check,) = got["checks"]
    assert "guid" not in check and "totalAmount" not in check and "taxAmount" not in check
    assert check["selections"] == [
        {"itemGuid": "", "item": {}, "salesCategory": {"name": "category 2"}, "quantity": 8.0, "appliedDiscountAmount": 0.1}
    ]


@pytest.mark.parametrize("line", [None, -3, 1, 2, 7, 9, 40])
def test_lists_are_as_long_as_the_line_says(spark, line):
    check = _document(spark, l_linenumber=line, l_linestatus="F")["checks"][0]
    assert len(check["payments"]) == max((line or 1) - 1, 0)
    assert len(check["selections"]) == (max(line, 0) % 4 if line else 0)
    assert [p.get("tipAmount") for p in check["payments"]] == [k * 2.0 if (7 + k) % 4 else None for k in range(1, line or 1)]


def test_numbers_that_json_does_not_have_are_quoted(spark):
    check = _document(spark, l_extendedprice=float("nan"), l_tax=float("-inf"))["checks"][0]
    assert (check["totalAmount"], check["taxAmount"]) == ("NaN", "-Infinity")


def test_pages_are_made_and_wrapped_outside_of_interpreted_expressions(spark):
    pages = _pages(spark)
    made = pages._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in made and "structstojson" not in made.lower()
    # What is parsed is a plain column: an argument of `from_json` is evaluated node by node.
    parsed = parse_pages(pages, ORDER_DOC).select(F.size("data"))._jdf.queryExecution().optimizedPlan().toString()
    assert "concat({\"data\":" not in parsed.split("AS _typed", 1)[0].rsplit("from_json(", 1)[1]


def test_pages_of_a_landing_come_in_the_order_of_their_folders(spark):
    """The write asks for that order; without it the texts of all pages of a task are sorted."""
    days = [DAY + dt.timedelta(days=200 * n) for n in (3, 0, 2, 1)] + [None]
    row = (5, 10, 7, 1, 8.0, 100.5, 0.1, 0.02, "N", "O")
    lines = spark.createDataFrame([(*row, day) for day in days], SHAPE).coalesce(1)
    year = F.trunc(F.col("l_shipdate").cast("date"), "year")
    ordered, plain = testdata.line_orders(lines, year), testdata.line_orders(lines)
    assert "query_date" in ordered._jdf.queryExecution().optimizedPlan().outputOrdering().toString()
    folders = ordered.withColumn("task", F.spark_partition_id()).collect()
    for task in {r.task for r in folders}:
        of_task = [r.query_date or dt.date.min for r in folders if r.task == task]
        assert of_task == sorted(of_task)
    in_year = plain.withColumn("query_date", F.trunc("query_date", "year"))
    assert sorted(map(str, ordered.collect())) == sorted(map(str, in_year.collect()))
