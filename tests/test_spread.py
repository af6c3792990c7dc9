"""Work per row that is dear is dealt to all cores, and done once per row."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.menus import children
from tillhouse.operators.orders import normalise_orders
from tillhouse.plans import jobs, testdata
from tillhouse.schemas import ORDER_DOC
from tillhouse.sources.envelope import documents, narrowed, parse_pages


def _used(frame):
    return frame.select(F.spark_partition_id().alias("task")).distinct().count()


def test_menus_of_one_file_are_made_and_parsed_on_all_cores(spark, tmp_path):
    """All menu pages of one restaurant in one file were one task of the landing and one of the parse."""
    rows = [(key, f"part {key}", "brand", "type", key % 50, 1.5) for key in range(0, 25 * 200, 25)]
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    pages = testdata.menu_trees(testdata.table(spark, str(tmp_path), "part"))
    cores = spark.sparkContext.defaultParallelism
    assert cores == 1 or _used(pages) > 1
    dealt = jobs.dealt(pages.coalesce(1))
    assert dealt.rdd.getNumPartitions() == jobs.TASKS_PER_CORE * cores and _used(dealt) > 1
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, pages.collect()))


def test_a_list_of_a_menu_is_taken_out_once(spark):
    nodes = ['{"a":[],"b":[1]}', '{"a":[2],"b":[1]}', '{"a":"x"}', '{"a":null,"b":[3,null]}', "{}"]
    rows = spark.createDataFrame([(n,) for n in nodes], "node string").select(F.parse_json("node").alias("node"))
    found = rows.select(F.to_json(F.struct(children(F.col("node"), "a", "b").alias("c"))).alias("c"))
    assert [r.c for r in found.collect()] == ['{"c":[1]}', '{"c":[2]}', "{}", '{"c":[3,null]}', "{}"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") == 2


def test_a_run_looks_its_dataset_up_once(spark):
    tenants = spark.createDataFrame([("t", "d", "R1")], "tenant string, dataset string, restaurant_guid string")
    run = jobs.Context(spark, "/nowhere", "/nowhere", tenants, "t").at()
    assert run.dataset == "d" and run.store.root == "/nowhere/d"


def test_narrowed_documents(spark):
    """Values that are not used are not read; the same pages are unreadable."""
    used = ["guid", "businessDate", "checks.guid", "checks.payments.tipAmount"]
    kind = narrowed(ORDER_DOC, used)
    check = kind["checks"].dataType.elementType
    assert check["selections"].dataType.elementType == T.StructType(
        [T.StructField("item", T.StructType([])), T.StructField("salesCategory", T.StructType([]))]
    )
    order = '{"guid":"1","businessDate":20260102,"restaurantGuid":"R","checks":[%s]}'
    pages = [
        order % '{"guid":"c","payments":[{"tipAmount":1.5,"type":"X"}],"selections":[{"price":"n/a","item":{"guid":"i"}}]}',
        order % '{"guid":"d","payments":[{"tipAmount":"much"}],"totalAmount":"n/a"}',
        order % '{"guid":"e","selections":{}}',
        order % '{"guid":"f","selections":[{"item":"i"}]}',
        order % '{"guid":"g","selections":[]',
        order % '{"guid":{"odd":1},"payments":null}',
    ]
    rows = spark.createDataFrame([("R", f"[{page}]") for page in pages], "restaurant_guid string, value string")

    def read(document):
        parsed = parse_pages(rows, document)
        errors = [r.page_error for r in parsed.select("page_error").collect()]
        orders = normalise_orders(documents(parsed)).select("guid", "restaurantGuid", "businessDate", F.explode("checks").alias("c"))
        tips = F.transform("c.payments", lambda p: p["tipAmount"])
        return errors, [tuple(r) for r in orders.select("guid", "restaurantGuid", "businessDate", "c.guid", tips).collect()]

    errors, checks = read(kind)
    assert (errors, checks) == read(ORDER_DOC)
    assert errors.count("unreadable page") == 3 and checks[0] == ("1", "R", "2026-01-02", "c", [1.5])


def test_lines_are_dealt_to_several_tasks_per_core(spark):
    line = (1, 1, 1, 1, 5.0, 1.0, 0.0, 0.0, "N", "O", dt.datetime(1998, 1, 2))
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    lines = spark.createDataFrame([line], schema)
    cores = spark.sparkContext.defaultParallelism
    assert testdata.line_orders(lines).rdd.getNumPartitions() == 3 * cores
