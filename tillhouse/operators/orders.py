"""Document-level work on orders: defaults, normalised dates, required fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.values import iso_day, utc_suffix
from tillhouse.schemas import ORDER_DATES, ORDER_TIMESTAMPS

# --- Fixed value: fields an order cannot do without --------------------------
REQUIRED = ["guid", "restaurantGuid", "businessDate"]


def normalise_orders(docs: DataFrame) -> DataFrame:
    """Orders as columns, with the restaurant default and normalised dates.

    The page's restaurant stands in when `restaurantGuid` is absent; an explicit
    null stays null.
    """
    doc = F.col("doc")
    named = F.try_variant_get(doc["restaurantGuid"], "$", "string")
    restaurant = F.when(doc["restaurantGuid"].isNull(), F.col("restaurant_guid")).otherwise(named)
    replaced: dict[str, Column] = {"restaurantGuid": restaurant}
    # A narrowed document has some of the dates only.
    given = docs.schema["doc"].dataType.names
    for names, normal in ((ORDER_TIMESTAMPS, utc_suffix), (ORDER_DATES, iso_day)):
        replaced |= {name: normal(doc[name]) for name in names if name in given}
    others = [name for name in given if name not in replaced]
    carried = [c for c in docs.columns if c != "doc"]
    return docs.select(
        *carried,
        *[doc[name].alias(name) for name in others],
        *[value.alias(name) for name, value in replaced.items()],
    )


def order_defect(orders_columns: list[str] = REQUIRED) -> Column:
    """Text naming the first required field that is missing, else null."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in orders_columns])


def with_lineage(orders: DataFrame, data_source: str = "pos_api", loaded_at: Column | None = None) -> DataFrame:
    """Tags each order with its load time, restaurant and source."""
    return orders.withColumns(
        {
            "_loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
            "_restaurant_guid": F.col("restaurant_guid"),
            "_data_source": F.lit(data_source),
        }
    )
