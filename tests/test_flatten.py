"""Documents to rows: the edge cases of each endpoint."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import flatten
from tillhouse.operators.enforce import REASON, accepted, rejected, require_all, strict
from tillhouse.operators.menus import menu_items, one_row_per_item
from tillhouse.plans import jobs
from tillhouse.schemas import (
    DIM_MENU_ITEMS,
    EMPLOYEE_DOC,
    FACT_CASH_ENTRIES,
    FACT_LABOR_SHIFTS,
    FACT_ORDER_ITEMS,
    JOB_DOC,
    ORDER_DOC,
    RESTAURANT_DOC,
)
from tillhouse.sources.envelope import broken_pages, documents, first_documents, menu_pages, parse_pages

ASKED = dt.date(2026, 2, 9)


def pages(spark, *values):
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t, "R1", ASKED) for t in texts], "value string, restaurant_guid string, query_date date")


def order(**changes):
    line = {"guid": "s1", "itemGuid": "m1", "displayName": "Soup", "quantity": 1, "price": 4.5}
    check = {"guid": "c1", "totalAmount": 9, "taxAmount": 1, "payments": [], "selections": [line]}
    return {"guid": "o1", "businessDate": 20260208, "checks": [check]} | changes


def with_line(**changes):
    document = order()
    document["checks"][0]["selections"][0] |= changes
    return document


def with_check(**changes):
    document = order()
    document["checks"][0] |= changes
    return document


def order_rows(spark, *docs):
    return flatten.order_items(jobs.parse(jobs.ORDERS, pages(spark, list(docs))).valid).collect()


def test_order_row(spark):
    (row,) = order_rows(spark, order(server={"guid": "w1"}))
    assert (row.selection_guid, row.order_guid, row.check_guid, row.restaurant_guid) == ("s1", "o1", "c1", "R1")
    assert row.business_date == dt.date(2026, 2, 8)
    assert (row.item_quantity, row.item_price, row.pre_discount_price, row.tax_amount) == (1.0, 4.5, 0.0, 0.0)
    assert (row.check_total, row.check_tax, row.check_tip, row.payment_type) == (9.0, 1.0, 0.0, None)
    assert (row.server_guid, row.is_voided, row.is_deleted, row.reject_reason) == ("w1", False, False, None)


@pytest.mark.parametrize(
    "document",
    [
        order(checks=[]),
        order(checks=None),
        {"guid": "o1", "businessDate": 20260208},
        with_check(selections=[]),
        with_check(selections=None),
        with_line(voided=True),
        with_line(guid=None),
        with_line(guid=""),
        order(guid=""),
    ],
)
def test_orders_without_rows(spark, document):
    assert order_rows(spark, document) == []


@pytest.mark.parametrize("document", [with_line(voided=None), with_line(voided=False), with_line(), with_check(payments=None)])
def test_kept_lines(spark, document):
    assert len(order_rows(spark, document)) == 1


def test_a_voided_order_is_flagged_not_dropped(spark):
    (row,) = order_rows(spark, order(voided=True, deleted=None))
    assert (row.is_voided, row.is_deleted) == (True, False)


def test_item_reference_falls_back(spark):
    (row,) = order_rows(spark, with_line(itemGuid="", item={"guid": "x"}))
    assert row.menu_item_guid == "x"


def test_payments_of_a_check(spark):
    payments = [{"tipAmount": 1.5}, {"tipAmount": None, "type": "CASH"}, {"tipAmount": 2, "type": "CARD"}]
    (row,) = order_rows(spark, with_check(payments=payments))
    assert (row.check_tip, row.payment_type) == (3.5, "CASH")


@pytest.mark.parametrize("day", [20260208, "20260208", "2026-02-08"])
def test_business_date_forms(spark, day):
    (row,) = order_rows(spark, order(businessDate=day))
    assert row.business_date == dt.date(2026, 2, 8)


@pytest.mark.parametrize(
    "document, reason",
    [
        (order(businessDate=20251399), "bad businessDate, missing business_date"),
        (with_check(guid=None), "missing check_guid"),
        (with_line(price="n/a"), "bad price"),
        (with_check(totalAmount="much"), "bad totalAmount"),
        (with_check(payments=[{"tipAmount": "some"}]), "bad tipAmount"),
        (order(deleted="perhaps"), "bad deleted"),
    ],
)
def test_row_rejects(spark, document, reason):
    (row,) = order_rows(spark, document)
    assert row.reject_reason == reason


def test_a_bad_value_spoils_neither_its_page_nor_its_order(spark):
    document = with_line(price="n/a")
    document["checks"][0]["selections"].append({"guid": "s2", "price": "2.50", "quantity": 3})
    rows = {r.selection_guid: r for r in order_rows(spark, document, order(guid="o2"))}
    assert len(rows) == 2 and rows["s2"].reject_reason is None
    assert (rows["s2"].item_price, rows["s2"].item_quantity) == (2.5, 3.0)


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"guid": None}, "missing guid"),
        ({"restaurantGuid": None}, "missing restaurantGuid"),
        ({"businessDate": None}, "missing businessDate"),
        ({"restaurantGuid": "other"}, None),
        ({}, None),
    ],
)
def test_required_fields(spark, changes, reason):
    page = pages(spark, [order(**changes)])
    assert [r[REASON] for r in jobs.parse(jobs.ORDERS, page).docs.collect()] == [reason]
    assert [r[REASON] for r in jobs.parse_headers(jobs.ORDERS, page).collect()] == [reason]


def test_envelopes(spark):
    found = documents(
        parse_pages(
            pages(spark, [order()], {"data": [order(guid="o2")], "pagination": {}}, {"other": 1}, [], {"data": None}),
            ORDER_DOC,
        )
    )
    assert sorted(r.doc.guid for r in found.collect()) == ["o1", "o2"]


@pytest.mark.parametrize("value", ["[{", "nothing", '{"data":{"guid":"x"}}', '[{"guid":"x","checks":"none"}]'])
def test_unreadable_pages_are_set_aside_whole(spark, value):
    parsed = parse_pages(pages(spark, value, [order()]), ORDER_DOC)
    assert [r.value for r in broken_pages(parsed).collect()] == [value]
    assert [r.doc.guid for r in documents(parsed).collect()] == ["o1"]


def fact_rows(spark, fact, *docs):
    return fact.flatten(jobs.parse(fact, pages(spark, list(docs))).valid).collect()


def test_cash_entries(spark):
    stamp = "2026-02-08T04:26:03.864"
    rows = fact_rows(
        spark,
        jobs.CASH_ENTRIES,
        {"guid": "a", "entryDate": stamp + "+0000", "amount": None, "cashDrawer": {"guid": "d"}},
        {"guid": "b", "businessDate": 20260207, "date": stamp + "-0000", "employee": {}, "amount": 3},
        {"guid": "c", "businessDate": 0, "date": "", "entryDate": stamp + "+0530"},
        {"guid": ""},
        {"guid": "e", "date": "junk"},
    )
    by_key = {r.cash_entry_guid: r for r in rows}
    assert sorted(by_key) == ["a", "b", "c", "e"]
    assert by_key["a"].business_date == ASKED and by_key["a"].amount == 0.0 and by_key["a"].cash_drawer_guid == "d"
    assert by_key["b"].business_date == dt.date(2026, 2, 7) and by_key["b"].employee_guid is None
    assert by_key["a"].entry_date == by_key["b"].entry_date != by_key["c"].entry_date
    assert by_key["e"].reject_reason == "bad entry_date"


def test_cash_deposits(spark):
    (row,) = fact_rows(spark, jobs.CASH_DEPOSITS, {"guid": "a", "amount": 5, "cashAmount": None}, {"amount": 1})
    assert (row.deposit_guid, row.business_date, row.deposit_amount, row.cash_amount, row.check_amount) == (
        "a", ASKED, 5.0, 0.0, 0.0,
    )
    assert row.deposit_date is None


def test_labor(spark):
    rows = fact_rows(
        spark,
        jobs.TIME_ENTRIES,
        {
            "guid": "a", "inDate": "2026-02-08T23:00:00.000-0500", "jobReference": {}, "job": {"guid": "j", "name": "Cook"},
            "employeeReference": {"guid": "e"}, "employee": {"guid": "f"}, "regularPay": 0, "nonOvertimeHourlyWages": 7,
            "wage": None, "hourlyWage": 12.5,
        },
        {"guid": "b", "businessDate": "2026-02-01", "jobReference": {"title": "", "name": "Bar"}, "job": {"guid": "j"}},
        {"guid": "c"},
        {"guid": None, "inDate": "2026-02-08T23:00:00.000Z"},
    )
    by_key = {r.time_entry_guid: r for r in rows}
    assert sorted(by_key) == ["a", "b", "c"]
    a, b, c = by_key["a"], by_key["b"], by_key["c"]
    # The fallback is the calendar day as written.
    assert a.business_date == dt.date(2026, 2, 8)
    assert (a.job_guid, a.job_title, a.employee_guid) == ("j", "Cook", "e")
    assert (a.regular_pay, a.hourly_wage, a.total_pay, a.is_deleted) == (7.0, 12.5, 0.0, False)
    assert (b.job_guid, b.job_title, b.employee_guid) == (None, "Bar", None)
    assert c.reject_reason == "missing business_date"


def test_restaurants(spark):
    info = {
        "general": {"name": "Inn", "locationName": "Hall", "timeZone": ""},
        "location": {"address": {"stateCode": "", "state": "TN", "zip": "1"}},
        "locationName": "", "timeZone": "UTC",
    }
    parsed = first_documents(pages(spark, info, [info | {"locationName": "East"}, info], {}, [], [{}], " { } "), RESTAURANT_DOC)
    rows = flatten.restaurants(documents(parsed)).collect()
    assert sorted(r.location_name for r in rows) == ["East", "Hall"]
    assert {(r.restaurant_name, r.state, r.zip_code, r.timezone, r.city) for r in rows} == {("Inn", "TN", "1", "UTC", None)}
    assert broken_pages(first_documents(pages(spark, "[{", "{"), RESTAURANT_DOC)).count() == 2


def test_employees_and_jobs(spark):
    staff = documents(parse_pages(pages(spark, [{"guid": "a", "externalId": "", "externalEmployeeId": "x"}, {"guid": ""}]), EMPLOYEE_DOC))
    assert [(r.employee_guid, r.external_id, r.is_deleted) for r in flatten.employees(staff).collect()] == [("a", "x", False)]
    roles = documents(parse_pages(pages(spark, {"data": [{"guid": "j", "title": "", "name": "Cook", "tipped": True}]}), JOB_DOC))
    assert [(r.job_title, r.default_wage, r.tipped, r.is_deleted) for r in flatten.jobs(roles).collect()] == [("Cook", 0.0, True, False)]


def item(guid, **more):
    return {"guid": guid, "name": f"item {guid}"} | more


def test_menus(spark):
    tree = {
        "name": "Lunch",
        "menuGroups": [
            {
                "name": "top",
                "menuItems": [],
                "items": [item("a", visibility=["POS", "KIOSK"], price=None), item("", price=1)],
                "subgroups": [
                    {"name": "mid", "menuItems": [item("a", visibility="ALL", salesCategory={"name": "Food"})],
                     "subgroups": [], "menuGroups": [{"name": "low", "items": [item("b", visibility=[], price="dear")]}]}
                ],
            }
        ],
    }
    other = {"name": "Dinner", "menuGroups": [], "groups": [{"name": "g", "menuItems": [item("c", price=2.5, deleted=True)]}]}
    found = menu_items(menu_pages(pages(spark, [tree], {"menus": [other], "data": [tree]}, {"menus": None, "data": [tree]}, "[{")))
    rows = {(r.menu_name, r.menu_group_name, r.menu_item_guid): r for r in found.collect()}
    assert sorted(rows) == [("Dinner", "g", "c"), ("Lunch", "low", "b"), ("Lunch", "mid", "a"), ("Lunch", "top", "a")]
    assert found.count() == 4
    assert rows["Lunch", "top", "a"].visibility == "POS,KIOSK" and rows["Lunch", "top", "a"].price == 0.0
    assert rows["Lunch", "mid", "a"].visibility == "ALL" and rows["Lunch", "mid", "a"].sales_category_name == "Food"
    assert rows["Lunch", "low", "b"].visibility is None and rows["Lunch", "low", "b"].reject_reason == "bad price"
    assert rows["Dinner", "g", "c"].price == 2.5 and rows["Dinner", "g", "c"].is_deleted
    assert one_row_per_item(accepted(found, DIM_MENU_ITEMS)).count() == 2


def test_a_single_menu_page_and_a_deep_tree(spark):
    node = {"name": "g120", "items": [item("deep")]}
    for level in range(119, 0, -1):
        node = {"name": f"g{level}", "subgroups": [node]}
    (row,) = menu_items(menu_pages(pages(spark, {"name": "Deep", "groups": [node]}))).collect()
    assert (row.menu_name, row.menu_group_name, row.menu_item_guid) == ("Deep", "g120", "deep")


def test_rejecting_whole_restaurants(spark):
    rows = spark.createDataFrame([("R1", None), ("R1", "bad"), ("R2", None)], f"restaurant_guid string, {REASON} string")
    assert sorted((r.restaurant_guid, r[REASON]) for r in rejected(strict(rows)).collect()) == [
        ("R1", "bad"), ("R1", "restaurant batch failed"),
    ]


def test_stopping_at_the_first_bad_row(spark):
    good = flatten.order_items(jobs.parse(jobs.ORDERS, pages(spark, [order()])).valid)
    assert require_all(good, FACT_ORDER_ITEMS).count() == 1
    bad = flatten.order_items(jobs.parse(jobs.ORDERS, pages(spark, [with_line(price="n/a")])).valid)
    with pytest.raises(Exception, match="bad price"):
        require_all(bad, FACT_ORDER_ITEMS).collect()
