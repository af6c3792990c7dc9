"""Flattening documents to fact and dimension rows.

Every function is a chain of narrow steps over `doc` rows (or normalised orders),
with the page's `restaurant_guid`; it returns the target columns and a
`reject_reason`. Rows without a key are left out, as are voided selections.

Documents that `outcomes.tag` has marked keep what became of each: their rows come with
`outcomes.COLUMNS`, and so do the documents and pages that gave none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.arrays import first_payment_type, tip_total
from tillhouse.functions.values import (
    filled,
    first_number,
    first_struct,
    first_text,
    flag,
    iso_day,
    number_or_zero,
    to_day,
)
from tillhouse.operators.enforce import enforce, keyed
from tillhouse.operators.outcomes import is_tagged, passing, settle, sound
from tillhouse.schemas import (
    DIM_EMPLOYEES,
    DIM_JOBS,
    DIM_RESTAURANTS,
    FACT_CASH_DEPOSITS,
    FACT_CASH_ENTRIES,
    FACT_LABOR_SHIFTS,
    FACT_ORDER_ITEMS,
    Table,
)
from tillhouse.sources.envelope import UNFIT


def load_stamp(loaded_at: Column | None) -> Column:
    return F.current_timestamp() if loaded_at is None else loaded_at


def _rows(docs: DataFrame, table: Table, loaded_at: Column | None, **columns: Column) -> DataFrame:
    """Target columns of one-row-per-document tables, keyed and enforced."""
    columns = {"restaurant_guid": F.col("restaurant_guid"), "_loaded_at": load_stamp(loaded_at), **columns}
    unfit = F.col("doc")[UNFIT] if UNFIT in docs.schema["doc"].dataType.names else F.lit(None).cast("string")
    values = [columns[name].alias(name) for name in table.columns]
    if is_tagged(docs):
        return settle(docs.select(*values, unfit.alias(UNFIT), *passing(docs)), table, [F.col(UNFIT)])
    flat = docs.select(*values, unfit.alias(UNFIT))
    return enforce(keyed(flat, *table.key), table, defects=[F.col(UNFIT)])


def order_checks(orders: DataFrame) -> DataFrame:
    """One row per check, with the order's and the check's own attributes.

    What holds for all lines of a check is worked out here, once per check. The
    business day is checked here too; `defects` says what does not fit.
    """
    check = F.col("check")
    bad_tips = F.array_join(F.transform(check["payments"], lambda p: p[UNFIT]), ", ")
    day = to_day(F.col("businessDate"))
    bad_day = F.when(F.col("businessDate").isNotNull() & day.isNull(), F.lit("bad businessDate"))
    defects = F.concat_ws(", ", bad_day, F.col(UNFIT), check[UNFIT], F.nullif(bad_tips, F.lit("")))
    if is_tagged(orders):
        exploded = orders.select("*", F.posexplode_outer(F.when(sound(), F.col("checks"))).alias("check_no", "check"))
        place = [*passing(orders), "check_no"]
    else:
        exploded, place = orders.select("*", F.explode("checks").alias("check")), []
    return exploded.select(
        *place,
        "restaurant_guid",
        F.col("guid").alias("order_guid"),
        day.alias("business_date"),
        F.col("server.guid").alias("server_guid"),
        flag(F.col("voided")).alias("is_voided"),
        flag(F.col("deleted")).alias("is_deleted"),
        check["guid"].alias("check_guid"),
        number_or_zero(check["totalAmount"]).alias("check_total"),
        number_or_zero(check["taxAmount"]).alias("check_tax"),
        tip_total(check["payments"]).alias("check_tip"),
        first_payment_type(check["payments"]).alias("payment_type"),
        F.nullif(defects, F.lit("")).alias("defects"),
        check["selections"].alias("selections"),
    )


def order_items(orders: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One row per sold selection. An order or check without children gives none."""
    checks = order_checks(orders)
    parents = [c for c in checks.columns if c != "selections"]
    line = F.col("line")
    tagged = is_tagged(orders)
    if tagged:
        kept = checks.select(*parents, F.posexplode_outer("selections").alias("line_no", "line"))
        parents.append("line_no")
    else:
        kept = checks.select(*parents, F.explode("selections").alias("line")).where(~flag(line["voided"]))
    flat = kept.select(
        *([flag(line["voided"]).alias("line_voided")] if tagged else []),
        *parents,
        line["guid"].alias("selection_guid"),
        first_text(line["itemGuid"], line["item"]["guid"]).alias("menu_item_guid"),
        line["displayName"].alias("menu_item_name"),
        line["salesCategory"]["name"].alias("sales_category_name"),
        number_or_zero(line["quantity"]).alias("item_quantity"),
        number_or_zero(line["price"]).alias("item_price"),
        number_or_zero(line["preDiscountPrice"]).alias("pre_discount_price"),
        number_or_zero(line["appliedDiscountAmount"]).alias("discount_amount"),
        number_or_zero(line["tax"]).alias("tax_amount"),
        line[UNFIT].alias(UNFIT),
        load_stamp(loaded_at).alias("_loaded_at"),
    )
    defects = [F.col("defects"), F.col(UNFIT)]
    if tagged:
        first = (F.coalesce("check_no", F.lit(0)) == 0) & (F.coalesce("line_no", F.lit(0)) == 0)
        return settle(flat, FACT_ORDER_ITEMS, defects, first, F.col("line_no").isNotNull() & ~F.col("line_voided"))
    return enforce(keyed(flat, *FACT_ORDER_ITEMS.key), FACT_ORDER_ITEMS, defects=defects)


def _asked_day(doc: Column) -> Column:
    """The business day, or the day that was asked for."""
    return F.when(filled(doc["businessDate"]) & (doc["businessDate"] != "0"), doc["businessDate"]).otherwise(
        F.date_format("query_date", "yyyyMMdd")
    )


def cash_entries(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    doc = F.col("doc")
    return _rows(
        docs,
        FACT_CASH_ENTRIES,
        loaded_at,
        cash_entry_guid=doc["guid"],
        business_date=iso_day(_asked_day(doc)),
        employee_guid=doc["employee"]["guid"],
        entry_type=doc["type"],
        amount=number_or_zero(doc["amount"]),
        reason=doc["reason"],
        notes=doc["notes"],
        cash_drawer_guid=doc["cashDrawer"]["guid"],
        entry_date=first_text(doc["date"], doc["entryDate"]),
    )


def cash_deposits(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    doc = F.col("doc")
    return _rows(
        docs,
        FACT_CASH_DEPOSITS,
        loaded_at,
        deposit_guid=doc["guid"],
        business_date=iso_day(_asked_day(doc)),
        deposit_date=doc["date"],
        deposit_amount=number_or_zero(doc["amount"]),
        cash_amount=number_or_zero(doc["cashAmount"]),
        check_amount=number_or_zero(doc["checkAmount"]),
    )


def labor_shifts(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    doc = F.col("doc")
    employee = first_struct(["guid"], doc["employeeReference"], doc["employee"])
    job = first_struct(["guid", "title", "name"], doc["jobReference"], doc["job"])
    # Without a business day the calendar day of the clock-in (UTC) stands in.
    clock_in_day = F.substring(doc["inDate"], 1, 10)
    has_day = filled(doc["businessDate"]) & (doc["businessDate"] != "0")
    day = F.when(has_day, iso_day(doc["businessDate"])).when(filled(doc["inDate"]), clock_in_day)
    return _rows(
        docs,
        FACT_LABOR_SHIFTS,
        loaded_at,
        time_entry_guid=doc["guid"],
        business_date=day,
        employee_guid=employee["guid"],
        job_guid=job["guid"],
        job_title=first_text(job["title"], job["name"]),
        in_date=doc["inDate"],
        out_date=doc["outDate"],
        regular_hours=number_or_zero(doc["regularHours"]),
        overtime_hours=number_or_zero(doc["overtimeHours"]),
        hourly_wage=first_number(doc["wage"], doc["hourlyWage"]),
        regular_pay=first_number(doc["regularPay"], doc["nonOvertimeHourlyWages"]),
        overtime_pay=first_number(doc["overtimePay"], doc["overtimeHourlyWages"]),
        total_pay=first_number(doc["totalPay"], doc["totalWages"]),
        declared_tips=first_number(doc["declaredTips"], doc["cashTips"]),
        is_deleted=flag(doc["deleted"]),
    )


def restaurants(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    doc = F.col("doc")
    general, address = doc["general"], doc["location"]["address"]
    return _rows(
        docs,
        DIM_RESTAURANTS,
        loaded_at,
        restaurant_name=general["name"],
        location_name=first_text(doc["locationName"], general["locationName"]),
        address_line1=address["addressLine1"],
        address_line2=address["addressLine2"],
        city=address["city"],
        state=first_text(address["stateCode"], address["state"]),
        zip_code=first_text(address["zipCode"], address["zip"]),
        timezone=first_text(general["timeZone"], doc["timeZone"]),
    )


def employees(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    doc = F.col("doc")
    return _rows(
        docs,
        DIM_EMPLOYEES,
        loaded_at,
        employee_guid=doc["guid"],
        first_name=doc["firstName"],
        last_name=doc["lastName"],
        email=doc["email"],
        external_id=first_text(doc["externalId"], doc["externalEmployeeId"]),
        is_deleted=flag(doc["deleted"]),
    )


def jobs(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    doc = F.col("doc")
    return _rows(
        docs,
        DIM_JOBS,
        loaded_at,
        job_guid=doc["guid"],
        job_title=first_text(doc["title"], doc["name"]),
        default_wage=number_or_zero(doc["defaultWage"]),
        tipped=flag(doc["tipped"]),
        is_deleted=flag(doc["deleted"]),
    )
