"""Landings of many restaurants: gathered files, as many as there are days."""

from pathlib import Path

from pyspark.sql import functions as F

from tillhouse.plans import landed
from tillhouse.sources import envelope
from tillhouse.sources.landing import read_pages


def _events(spark, n):
    users = spark.range(n).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"))
    return users.select(
        "*",
        F.element_at(F.array(F.lit("purchase"), F.lit("click"), F.lit("signup")), (F.col("event_id") % 3 + 1).cast("int")).alias("event_type"),
        (F.lit("2024-01-01 12:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("event_id") % 14).cast("int"))).alias("ts"),
        F.lit(2.5).alias("value"),
        F.lit('{"k": "a"}').alias("props"),
    )


def _tables(spark, folder, n):
    _events(spark, n).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    spark.createDataFrame([(0, 0)], "s_suppkey long, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")


def test_folders_do_not_grow_with_restaurants(spark, tmp_path):
    """A folder per restaurant and week made 600 restaurants 600 files, each with a line."""
    _tables(spark, tmp_path, 600)
    context = landed._landed_events(spark, str(tmp_path))
    files = [f for f in Path(context.landing).rglob("*") if f.is_file() and f.name.startswith("part-")]
    tasks = spark.sparkContext.defaultParallelism
    assert 0 < len(files) <= 3 * 2 * tasks
    pages = landed.read_pages(spark, context.landing, "cash_entries", gathered=True)
    assert pages.count() == pages.select("restaurant_guid").distinct().count() == 200


def test_gathered_pages(spark, tmp_path):
    rows = [("A", '[{"guid":"1"}]', "2024-01-07"), ("A", " ", "2024-01-07"), ("B", '[{"guid":"2"}]', "2024-01-07"), (None, "[]", "2024-01-07"),
            ("B", '{"data":\n[]}', "2024-01-14"), ("B", None, "2024-01-14")]
    landed_rows = spark.createDataFrame(rows, "restaurant_guid string, value string, day string")
    landed_rows.withColumnRenamed("day", "snapshot_date").write.partitionBy("snapshot_date").parquet(f"{tmp_path}/employees")
    landed_rows.withColumnRenamed("day", "query_date").write.partitionBy("query_date").parquet(f"{tmp_path}/orders")
    newest = read_pages(spark, str(tmp_path), "employees", gathered=True)
    assert newest.columns == ["value", "restaurant_guid", "source_file"]
    assert {(r.restaurant_guid, r.value) for r in newest.collect()} == {("A", '[{"guid":"1"}]'), ("B", '{"data":\n[]}'), (None, "[]")}
    dated = read_pages(spark, str(tmp_path), "orders", gathered=True)
    assert dict(dated.dtypes)["query_date"] == "date" and dated.count() == 4
    assert read_pages(spark, str(tmp_path), "menus", gathered=True).count() == 0


def test_pages_are_full(spark, tmp_path):
    """Documents with far apart numbers, and those without one, are still a hundred to a page."""
    keys = spark.range(3000).select((F.col("id") * 101).alias("c_custkey"))
    keys.select("c_custkey", F.lit(0).alias("c_nationkey"), F.lit("n").alias("c_name"), F.lit("s").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    landed._land_employees(spark, str(tmp_path), f"{tmp_path}/landing")
    files = list(Path(f"{tmp_path}/landing/employees").rglob("part-*"))
    assert 30 <= len(files) <= 60
    docs = [f.read_text().count('"email":') for f in files]
    assert max(docs) < 2 * landed.DOCS_PER_PAGE and sum(docs) == 3000


def test_trimmed_pages(spark):
    """What stands around a page goes, whether or not brackets end it."""
    texts = ["[1]", "{}", "[1", " [1]", "[1]\n", "﻿\n{} ", "", "  ", "1]", "[\n]\t", None]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", envelope._clean(F.col("t")).alias("c"))
    assert {r.i: r.c for r in found.collect()} == {i: None if t is None else t.strip(" \t\r\n﻿") for i, t in enumerate(texts)}
