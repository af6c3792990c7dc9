"""Daily reports on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.history import valid_on
from tillhouse.operators.menus import one_row_per_item

_DAY = ["restaurant_guid", "business_date"]


def daily_sales(items: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Items sold and revenue per restaurant and day, with the restaurant's name.

    Sales are reduced to days before they meet the dimension.
    """
    days = items.where(~F.col("is_voided") & ~F.col("is_deleted")).groupBy(*_DAY).agg(
        F.count(F.lit(1)).alias("items_sold"),
        F.sum("item_quantity").alias("quantity"),
        F.sum("item_price").alias("revenue"),
        F.sum("discount_amount").alias("discounts"),
    )
    return days.join(restaurants.select("restaurant_guid", "restaurant_name"), "restaurant_guid", "left").select(
        *_DAY, "restaurant_name", "items_sold", "quantity", "revenue", "discounts"
    )


def daily_tips(items: DataFrame) -> DataFrame:
    """Tips per restaurant and day.

    A check's tip stands on each of its rows, so it is taken once per check. Tips count
    also where lines are voided or deleted: the payment stands until the check itself
    goes, and the loaded rows do not tell that.
    """
    checks = items.groupBy(*_DAY, "order_guid", "check_guid").agg(F.max("check_tip").alias("tip"))
    return checks.groupBy(*_DAY).agg(F.count(F.lit(1)).alias("checks"), F.sum("tip").alias("tips"))


def daily_labor(shifts: DataFrame) -> DataFrame:
    """Hours and pay per restaurant and day, without deleted shifts."""
    return (
        shifts.where(~F.col("is_deleted"))
        .groupBy(*_DAY)
        .agg(
            F.count(F.lit(1)).alias("shifts"),
            F.sum(F.col("regular_hours") + F.col("overtime_hours")).alias("hours"),
            F.sum("total_pay").alias("pay"),
        )
    )


def sales_by_menu_group(items: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Quantity and revenue per menu group.

    Sales are reduced to menu items first, and items to one row each, so the join
    neither fans out nor moves single sales.
    """
    sold = items.where(~F.col("is_voided") & ~F.col("is_deleted")).groupBy("menu_item_guid").agg(
        F.sum("item_quantity").alias("quantity"), F.sum("item_price").alias("revenue")
    )
    groups = one_row_per_item(menu_items.select("menu_item_guid", "menu_name", "menu_group_name"))
    return (
        sold.join(groups, "menu_item_guid", "left")
        .groupBy("menu_name", "menu_group_name")
        .agg(F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"))
    )


def sales_by_title_then(items: DataFrame, history: DataFrame) -> DataFrame:
    """Items sold and revenue by the job title that a server had on the day of the sale.

    `history` has versions of `employee_guid, job_title`. Sales are reduced to servers and days first,
    so a server with a large share of all sales is as many rows as there are days. Sales of an
    unknown server, or of a day that no version covers, have a null title.
    """
    sold = items.where(~F.col("is_voided") & ~F.col("is_deleted")).groupBy(F.col("server_guid").alias("employee_guid"), "business_date").agg(
        F.count(F.lit(1)).alias("items_sold"), F.sum("item_price").alias("revenue")
    )
    titles = valid_on(sold, history, ["employee_guid"], ["job_title"])
    return (
        sold.join(titles, ["employee_guid", "business_date"], "left")
        .groupBy("job_title")
        .agg(F.sum("items_sold").alias("items_sold"), F.sum("revenue").alias("revenue"))
    )
