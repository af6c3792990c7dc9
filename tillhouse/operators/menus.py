"""Menu trees of any depth, flattened several levels at a time.

A pass goes `DEPTH` levels down within a row: each level's groups give their items with the
group's name, and their subgroups are the next level. Items leave at once as table rows; only
groups below the last level of a pass are carried on, as text with their place. A pass
writes both in one staged table, so a tree of up to `DEPTH` levels is read and parsed once and no
subtree is ever staged. Deeper ones take a pass more for each `DEPTH` levels. There is no limit on
depth or rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.menus import children, list_or_text, member
from tillhouse.functions.values import filled, flag, number_or_zero
from tillhouse.operators.enforce import REASON, enforce
from tillhouse.operators.flatten import load_stamp
from tillhouse.schemas import DIM_MENU_ITEMS
from tillhouse.session import shared_folder

DEPTH = 8
_PLACE = ["restaurant_guid", "menu_name"]
Stage = Callable[[str, DataFrame], DataFrame]


def unfit(node: Column, **kinds: str) -> Column:
    """Which members have a value that does not fit their kind, null when all do."""
    bad = [
        F.when(filled(member(node, name)) & member(node, name, kind).isNull(), F.lit(f"bad {name}"))
        for name, kind in kinds.items()
    ]
    return F.nullif(F.concat_ws(", ", *bad), F.lit(""))


def _listed(node: Column, *names: str) -> Column:
    """The first of the named lists that has elements, else an empty one."""
    return F.coalesce(children(node, *names), F.array().cast("array<variant>"))


def top_groups(menus: DataFrame) -> DataFrame:
    """The outermost groups of every menu, `restaurant_guid, menu_name, groups, page_error, record`.

    A page that cannot be read is a row without groups. `menus` comes from `menu_pages`.
    """
    broken = F.col("page_error").isNotNull()
    place = [c for c in ("restaurant_guid", "source_file", "value") if c in menus.columns]
    pages = menus.select(
        "restaurant_guid",
        "page_error",
        F.when(broken, F.to_json(F.struct(*place))).alias("record"),
        F.explode_outer(F.when(~broken, F.col("menus"))).alias("menu"),
    ).where(F.col("menu").isNotNull() | F.col("page_error").isNotNull())
    menu = F.col("menu")
    return pages.select(
        "restaurant_guid",
        member(menu, "name").alias("menu_name"),
        _listed(menu, "menuGroups", "groups").alias("groups"),
        "page_error",
        "record",
    )


def descend(groups: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """`DEPTH` levels of groups: items as enforced rows, pages in error, and what is left below.

    Adds `stage` (row, page, or group for what is left), `record` and, for groups, `node`.
    """
    level = groups.withColumn("_groups0", F.col("groups"))
    for n in range(DEPTH):
        below = F.flatten(F.transform(f"_groups{n}", lambda node: _listed(node, "subgroups", "menuGroups")))
        level = level.withColumn(f"_groups{n + 1}", below)

    def placed(node: Column) -> Column:
        name = member(node, "name").alias("menu_group_name")
        return F.transform(
            _listed(node, "menuItems", "items"),
            lambda item: F.struct(name, item.alias("item"), F.lit(None).cast("string").alias("node")),
        )

    items = [F.flatten(F.transform(f"_groups{n}", placed)) for n in range(DEPTH)]
    left = F.transform(
        f"_groups{DEPTH}",
        lambda node: F.struct(F.lit(None).cast("string").alias("menu_group_name"), F.lit(None).cast("variant").alias("item"), F.to_json(node).alias("node")),
    )
    found = level.select(*_PLACE, "page_error", "record", F.explode_outer(F.concat(*items, left)).alias("one"))
    item, node = F.col("one.item"), F.col("one.node")
    key = member(item, "guid")
    flat = found.select(
        key.alias("menu_item_guid"),
        *_PLACE,
        F.col("one.menu_group_name").alias("menu_group_name"),
        member(item, "name").alias("item_name"),
        number_or_zero(member(item, "price", "double")).alias("price"),
        member(item, "salesCategory.name").alias("sales_category_name"),
        list_or_text(item, "visibility").alias("visibility"),
        flag(member(item, "deleted", "boolean")).alias("is_deleted"),
        unfit(item, price="double", deleted="boolean").alias("defects"),
        load_stamp(loaded_at).alias("_loaded_at"),
        F.when(F.col("page_error").isNotNull(), "page").when(node.isNotNull(), "group").when(filled(key), "row").alias("stage"),
        "page_error",
        "record",
        node.alias("node"),
    )
    enforced = enforce(flat, DIM_MENU_ITEMS, ["stage", "page_error", "record", "node"], [F.col("defects")])
    reason = F.when(F.col("stage") == "row", F.col(REASON)).otherwise(F.col("page_error"))
    return enforced.where(F.col("stage").isNotNull()).withColumn(REASON, reason).drop("page_error")


def _in_shared_folder(rows: DataFrame) -> Stage:
    spark = rows.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/menus_{uuid.uuid4().hex}"

    def stage(name: str, frame: DataFrame) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    return stage


def menu_outcomes(menus: DataFrame, loaded_at: Column | None = None, stage: Stage | None = None) -> DataFrame:
    """Item rows and unreadable pages, `dim_menu_items` with `reject_reason, stage, n_documents, record`.

    `stage` writes a frame under a name and reads it back; staged tables stay as long as
    the result is in use.
    """
    stage = stage or _in_shared_folder(menus)
    groups, done = top_groups(menus), []
    while True:
        level = stage(f"menu_level{len(done)}", descend(groups, loaded_at))
        done.append(level.where(F.col("stage") != "group").drop("node"))
        left = level.where(F.col("stage") == "group")
        if left.isEmpty():
            break
        groups = left.select(
            *_PLACE, F.array(F.parse_json("node")).alias("groups"),
            F.lit(None).cast("string").alias("page_error"), F.lit(None).cast("string").alias("record"),
        )
    return reduce(DataFrame.unionByName, done).withColumn("n_documents", F.lit(0))


def menu_items(menus: DataFrame, loaded_at: Column | None = None, stage: Stage | None = None) -> DataFrame:
    """One row per placement of an item, in the shape of `dim_menu_items`."""
    found = menu_outcomes(menus, loaded_at, stage)
    return found.where(F.col("stage") == "row").select(*DIM_MENU_ITEMS.columns, REASON)


def one_row_per_item(items: DataFrame) -> DataFrame:
    """One row per item for joins: placements of an item would fan out a fact.

    The smallest row of an item is kept. `min` combines before the shuffle, so an
    item placed very often does not gather in one task.
    """
    values = [c for c in items.columns if c != "menu_item_guid"]
    return (
        items.groupBy("menu_item_guid")
        .agg(F.min(F.struct(*values)).alias("first"))
        .select("menu_item_guid", "first.*")
    )
