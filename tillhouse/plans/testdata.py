"""Landed pages made from the driver's tables.

The tables hold no point-of-sale documents, so each table row becomes one response
page with one document, in place: nothing is grouped, so no group can grow with the
data. Nested lists get their length from the row. From the page text on, a query runs
the same code as a load from a landing folder.

Odd cases are put in by key: absent and empty keys, alternate fields, both date forms,
several offsets, and values that do not fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.schemas import ORDER_TIMESTAMPS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, tasks_per_core: int = 1) -> DataFrame:
    """Rows over all cores where a small file would feed only a few of them.

    A table with at least as many splits as tasks are asked for is left as it is: nothing is shuffled.
    """
    tasks = tasks_per_core * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks, *rows.columns) if rows.rdd.getNumPartitions() < tasks else rows


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _when(condition: Column, value) -> Column:
    """The value or null; null fields are left out of the document."""
    return F.when(condition, value)


def _up_to(n: Column) -> Column:
    """The numbers 1 to n, none for zero."""
    return F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))


def _stamp(ts: Column, offset: str, fraction: str = "SSS") -> Column:
    return F.concat(F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss.{fraction}"), F.lit(offset))


def _compact(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def _page(document: Column, listed: Column) -> Column:
    """A list page or an object page around one document."""
    return F.when(listed, _text("[", document, "]")).otherwise(
        _text('{"data":[', document, '],"pagination":{"hasNextPage":false}}')
    )


def _rename(document: Column, field: str, to: str) -> Column:
    return F.replace(document, F.lit(f'"{field}":'), F.lit(to))


def _pages(rows: DataFrame, document: Column, listed: Column, *edits, **partition: Column) -> DataFrame:
    """Pages of documents; an edit is (condition, change of the document text)."""
    return _in_place(spread(rows), document, listed, *edits, **partition)


def _in_place(rows: DataFrame, document: Column, listed: Column, *edits, **partition: Column) -> DataFrame:
    """`_pages` of rows where they are. Each step is a column of its own, so that the document is built once."""
    rows = rows.withColumn("_document", document)
    for condition, change in edits:
        edited = F.when(condition, change(F.col("_document"))).otherwise(F.col("_document"))
        rows = rows.withColumn("_document", edited)
    return rows.select(
        *[value.alias(name) for name, value in partition.items()], _page(F.col("_document"), listed).alias("value")
    )


def _null_restaurant(document: Column) -> Column:
    return F.replace(document, F.lit('"restaurantGuid":"'), F.lit('"restaurantGuid":null,"was":"'))


def _iso_date(document: Column) -> Column:
    return _rename(document, "isoDate", '"businessDate":')


def _number(value: Column) -> Column:
    """A number as JSON has it; what is no finite number is quoted."""
    text, double = value.cast("string"), value.cast("double")
    odd = F.isnan(double) | (F.abs(double) == float("inf"))
    return F.when(odd, _text('"', text, '"')).otherwise(text)


def _quoted(text: Column) -> Column:
    return _text('"', text, '"')


def _object(*fields: Column) -> Column:
    return _text("{", F.concat_ws(",", *fields), "}")


def _list(*elements: Column) -> Column:
    """A list of those that are not null."""
    return _text("[", F.concat_ws(",", *elements), "]")


def line_orders(lines: DataFrame, day: Column | None = None) -> DataFrame:
    """Order pages, one per line item: up to two checks with up to three selections.

    With `day`, that is the day asked for, and each task has its pages in the order of it. The lines are
    sorted, which are a tenth of their pages' text.

    The text is put together from pieces, field by field; a null piece leaves its field out.
    Lists are spelled out, since lambdas and `to_json` are not compiled with the rest of the row.
    """
    c = F.col
    order, part, line, supplier = c("l_orderkey"), c("l_partkey"), c("l_linenumber"), c("l_suppkey")
    is_n_a = F.coalesce(part % 73 == 0, F.lit(False))
    price_field = F.when(is_n_a, '"price":"n/a","listPrice":').otherwise('"price":')
    was_null = F.coalesce(part % 59 == 0, F.lit(False))
    restaurant_field = F.when(was_null, '"restaurantGuid":null,"was":').otherwise('"restaurantGuid":')

    # Making and parsing a page takes some twenty times as long as moving its line. Splits hold unequal numbers of row
    # groups, so pages that are parsed at once are dealt to several tasks per core.
    lines = spread(lines, 3 if day is None else 1).withColumn("_day", c("l_shipdate").cast("date") if day is None else day)
    if day is not None:
        lines = lines.sortWithinPartitions("_day")
    # What all selections of a line share is a column of its own, so that it is built once.
    item = F.concat_ws(
        ",",
        _text('"itemGuid":', _quoted(F.when(part % 2 == 0, part.cast("string")).otherwise(""))),
        _text('"item":', _object(_text('"guid":"P', part, '"'))),
        _text('"displayName":"item ', part, '"'),
        _when(supplier % 5 != 0, _text('"salesCategory":{"name":"category ', supplier % 5, '"}')),
        _when(c("l_quantity") >= 5, _text('"quantity":', _number(c("l_quantity")))),
        _text(price_field, c("_price")),
    )
    lines = lines.withColumns(
        {"_check": _text(order, "-", line), "_price": _number(c("l_extendedprice")), "_tax": _number(c("l_tax"))}
    ).withColumns({"_item": item, "_discount": _text('"appliedDiscountAmount":', _number(c("l_discount")))})
    check_key, tax = c("_check"), _text('"tax":', c("_tax"))

    def payment(k: Column) -> Column:
        kind = F.when((part + k) % 3 == 1, "CREDIT").when((part + k) % 3 == 2, F.when(k % 2 == 0, "").otherwise("CASH"))
        tip = _when((supplier + k) % 4 != 0, k * c("l_quantity") * 0.25)
        return _object(_text('"tipAmount":', _number(tip)), _text('"type":', _quoted(kind)))

    def selection(k: int) -> Column:
        guid = _text(check_key, f"-{k}")
        voided = F.when(c("l_returnflag") == "A", "false")
        return _object(
            _text('"guid":', _quoted(F.when(part % 7 == 0, "").otherwise(guid) if k == 3 else guid)),
            _text('"voided":', F.when(c("l_returnflag") == "R", "true").otherwise(voided) if k == 1 else voided),
            c("_item"),
            _text('"preDiscountPrice":', _number(c("l_extendedprice") + k)),
            c("_discount"),
            F.lit(None) if k == 2 else tax,
        )

    n_payments, n_selections, spelled_out = line - 1, line % 4, 6
    payments = F.when(
        n_payments > spelled_out, F.array_join(F.transform(_up_to(n_payments), payment), ",")
    ).otherwise(F.concat_ws(",", *[_when(n_payments >= k, payment(F.lit(k))) for k in range(1, spelled_out + 1)]))
    first = _object(
        _when(part % 71 != 0, _text('"guid":"', check_key, '-A"')),
        _text('"totalAmount":', c("_price")),
        _when(c("l_tax") != 0, _text('"taxAmount":', c("_tax"))),
        _text('"payments":[', payments, "]"),
        _text('"selections":', _list(*[_when(n_selections >= k, selection(k)) for k in (1, 2, 3)])),
    )
    second = _object(
        _text('"guid":"', check_key, '-B"'), F.lit('"payments":[]'), _text('"selections":', _list(selection(9)))
    )
    document = _object(
        _when(part % 53 != 0, _text('"guid":"', order, '"')),
        _when(supplier % 3 != 0, _text(restaurant_field, '"R', supplier, '"')),
        F.when(part % 61 == 0, F.lit(None))
        .when(part % 67 == 0, '"businessDate":20251399')
        .when(line % 2 == 1, _text('"businessDate":', _compact(c("l_shipdate")))),
        _when(
            (part % 61 != 0) & (part % 67 != 0) & (line % 2 == 0),
            _text('"businessDate":"', F.date_format("l_shipdate", "yyyy-MM-dd"), '"'),
        ),
        _text('"openedDate":"', _stamp(c("l_shipdate"), "+0000"), '"'),
        F.when((c("l_linestatus") == "O") & (c("l_returnflag") == "R"), '"voided":true').when(
            c("l_linestatus") == "F", '"voided":false'
        ),
        _when(c("l_tax") == 0.08, F.lit('"deleted":true')),
        _when(supplier % 4 != 0, _text('"server":{"guid":"S', supplier % 4, '"}')),
        F.when((line == 7) & (c("l_linestatus") == "O"), F.lit(None))
        .when(c("l_linestatus") == "F", _text('"checks":', _list(first, second)))
        .otherwise(_text('"checks":', _list(first))),
    )
    return _in_place(lines, document, line % 2 == 1, restaurant_guid=_text("R", supplier), query_date=c("_day"))


def header_orders(orders: DataFrame) -> DataFrame:
    """Order pages, one per order, with every date field and no checks."""
    c = F.col
    key, day = c("o_orderkey"), c("o_orderdate")
    offsets = ["+0000", "-0000", "Z", "+0530", "+0000", "-0000", "Z", "+0530", "-0000"]
    stamps = [
        _when(key % (at + 2) != 0, _stamp(F.expr(f"o_orderdate + interval {at} hour"), offset)).alias(name)
        for at, (name, offset) in enumerate(zip(ORDER_TIMESTAMPS, offsets))
    ]
    document = F.to_json(
        F.struct(
            _when(key % 41 != 0, key.cast("string")).alias("guid"),
            _when(key % 3 != 0, _text("R", c("o_custkey"))).alias("restaurantGuid"),
            _when((key % 43 != 0) & (key % 2 == 1), _compact(day)).alias("businessDate"),
            _when((key % 43 != 0) & (key % 2 == 0), F.date_format(day, "yyyy-MM-dd")).alias("isoDate"),
            _when(c("o_orderstatus") == "P", _compact(day)).alias("voidBusinessDate"),
            *stamps,
        )
    )
    return _pages(
        orders,
        document,
        key % 2 == 1,
        (key % 2 == 0, _iso_date),
        (key % 47 == 0, _null_restaurant),
        restaurant_guid=_text("R", c("o_custkey")),
        query_date=day.cast("date"),
    )


def _event_pages(events: DataFrame, kind: str, document: Column) -> DataFrame:
    return _pages(
        events.where(F.col("event_type") == kind),
        document,
        F.col("event_id") % 2 == 1,
        restaurant_guid=_text("R", F.col("user_id")),
        query_date=F.col("ts").cast("date"),
    )


def cash_entry_pages(events: DataFrame) -> DataFrame:
    """Cash entries from purchases."""
    c = F.col
    key = c("event_id")
    document = F.to_json(
        F.struct(
            F.when(key % 11 == 0, "").otherwise(_text("E", key)).alias("guid"),
            _when(key % 3 != 0, F.when(key % 31 == 0, 20251399).otherwise(_compact(c("ts")))).alias("businessDate"),
            F.when(key % 4 == 0, "").when(key % 4 == 1, _stamp(c("ts"), "-0000", "SSSSSS")).alias("date"),
            _stamp(c("ts"), "+0000", "SSSSSS").alias("entryDate"),
            _when(key % 5 != 0, F.struct(_text("U", c("user_id")).alias("guid"))).alias("employee"),
            F.lit("PAY_OUT").alias("type"),
            _when(key % 7 != 0, c("value")).alias("amount"),
            _when(key % 2 == 0, "till count").alias("reason"),
            F.struct(F.get_json_object("props", "$.k").alias("guid")).alias("cashDrawer"),
        )
    )
    return _event_pages(events, "purchase", document)


def cash_deposit_pages(events: DataFrame) -> DataFrame:
    """Cash deposits from clicks."""
    c = F.col
    key = c("event_id")
    document = F.to_json(
        F.struct(
            _when(key % 11 != 0, _text("D", key)).alias("guid"),
            F.when(key % 3 == 0, 0).when(key % 3 == 1, _compact(c("ts"))).alias("businessDate"),
            _when(key % 4 != 0, _stamp(c("ts"), "+0000")).alias("date"),
            c("value").alias("amount"),
            _when(key % 2 == 0, c("value") / 2).alias("cashAmount"),
            _when(key % 2 == 1, c("value") / 4).alias("checkAmount"),
        )
    )
    return _event_pages(events, "click", document)


def time_entry_pages(events: DataFrame) -> DataFrame:
    """Time entries from sign-ups."""
    c = F.col
    key, value = c("event_id"), c("value")
    employee = F.struct(_text("U", c("user_id")).alias("guid"))
    job = F.struct(
        _text("J", key % 6).alias("guid"),
        F.when(key % 5 == 0, "").otherwise(_text("title ", key % 6)).alias("title"),
        _text("name ", key % 6).alias("name"),
    )
    nobody = F.struct(F.lit(None).cast("string").alias("guid"))
    document = F.to_json(
        F.struct(
            F.when(key % 13 == 0, "").otherwise(_text("T", key)).alias("guid"),
            _when(key % 3 == 1, _compact(c("ts"))).alias("businessDate"),
            _when(key % 3 == 2, F.date_format("ts", "yyyy-MM-dd")).alias("isoDate"),
            _when(key % 17 != 0, _stamp(c("ts"), "+0000")).alias("inDate"),
            _when(key % 19 != 0, _stamp(F.expr("ts + interval 8 hour"), "-0000")).alias("outDate"),
            F.when(key % 2 == 0, employee).when(key % 4 == 1, nobody).alias("employeeReference"),
            F.struct(_text("V", c("user_id")).alias("guid")).alias("employee"),
            _when(key % 4 < 2, job).alias("jobReference"),
            _when(key % 4 == 2, job).alias("job"),
            F.when(key % 4 == 0, 0.0).otherwise(value).alias("wage"),
            F.lit(15.5).alias("hourlyWage"),
            F.lit(8).alias("regularHours"),
            _when(key % 2 == 0, 1.5).alias("overtimeHours"),
            F.when(key % 2 == 0, 0.0).otherwise(value * 8).alias("regularPay"),
            (value * 7).alias("nonOvertimeHourlyWages"),
            _when(key % 3 == 0, value).alias("overtimePay"),
            _when(key % 3 == 1, value * 2).alias("overtimeHourlyWages"),
            F.lit(0).alias("totalPay"),
            (value * 10).alias("totalWages"),
            _when(key % 6 == 0, value).alias("cashTips"),
            _when(key % 23 == 0, True).alias("deleted"),
        )
    )
    return _event_pages(events, "signup", _iso_date(document))


def restaurant_pages(suppliers: DataFrame) -> DataFrame:
    """Restaurant info from suppliers: as an object, a list, or an empty document."""
    c = F.col
    key = c("s_suppkey")
    address = F.struct(
        _text("street ", key).alias("addressLine1"),
        _when(key % 2 == 0, "floor 2").alias("addressLine2"),
        _text("city ", c("s_nationkey")).alias("city"),
        F.when(key % 3 == 0, "").otherwise(_text("S", c("s_nationkey"))).alias("stateCode"),
        _text("state ", c("s_nationkey")).alias("state"),
        _when(key % 4 == 0, _text("Z", key)).alias("zipCode"),
        _text("zip ", key).alias("zip"),
    )
    general = F.struct(
        c("s_name").alias("name"),
        _text("site ", key).alias("locationName"),
        _when(key % 5 != 0, "UTC").alias("timeZone"),
    )
    document = F.to_json(
        F.struct(
            _when(key % 13 != 0, general).alias("general"),
            F.struct(address.alias("address")).alias("location"),
            _when(key % 2 == 0, _text("branch ", key)).alias("locationName"),
            F.lit("US/Central").alias("timeZone"),
        )
    )
    page = (
        F.when(key % 29 == 0, F.lit("{}"))
        .when(key % 3 == 0, _text("[", document, ',{"locationName":"not used"}]'))
        .otherwise(document)
    )
    return suppliers.select(_text("R", key).alias("restaurant_guid"), page.alias("value"))


def employee_pages(customers: DataFrame) -> DataFrame:
    """Employees from customers."""
    c = F.col
    key = c("c_custkey")
    document = F.to_json(
        F.struct(
            F.when(key % 11 == 0, "").otherwise(_text("U", key)).alias("guid"),
            c("c_name").alias("firstName"),
            _when(key % 2 == 0, c("c_mktsegment")).alias("lastName"),
            _text("u", key, "@example.org").alias("email"),
            F.when(key % 3 == 0, "").otherwise(_text("X", key)).alias("externalId"),
            _when(key % 2 == 1, _text("Y", key)).alias("externalEmployeeId"),
            _when(key % 7 == 0, True).alias("deleted"),
        )
    )
    return _pages(customers, document, key % 2 == 1, restaurant_guid=_text("R", c("c_nationkey")))


def job_pages(customers: DataFrame) -> DataFrame:
    """Jobs from the market segments of each nation's customers."""
    c = F.col
    kinds = customers.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_acctbal").alias("wage"))
    key = c("c_nationkey")
    document = F.to_json(
        F.struct(
            _text("J", key, "-", c("c_mktsegment")).alias("guid"),
            F.when(key % 2 == 0, "").otherwise(c("c_mktsegment")).alias("title"),
            F.lower("c_mktsegment").alias("name"),
            _when(key % 3 != 0, c("wage")).alias("defaultWage"),
            _when(key % 4 == 0, True).alias("tipped"),
            _when(key % 5 == 0, False).alias("deleted"),
        )
    )
    return _pages(kinds, document, key % 2 == 1, restaurant_guid=_text("R", key))


def menu_trees(parts: DataFrame) -> DataFrame:
    """Menu pages from parts: one item, nested up to seven groups deep.

    Every group on the way down holds the item too, under its own key.
    """
    c = F.col
    key = c("p_partkey")
    visibility = F.when(key % 4 == 0, '["POS","KIOSK"]').when(key % 4 == 1, '"ALL"').when(key % 4 == 2, "[]")
    tail = _text(
        ',"name":"', c("p_name"), '","price":', c("p_retailprice"),
        F.when(key % 3 == 0, ',"salesCategory":null').otherwise(_text(',"salesCategory":{"name":"', c("p_type"), '"}')),
        F.coalesce(_text(',"visibility":', visibility), F.lit("")),
        F.when(key % 5 == 0, ',"deleted":true').otherwise(""),
        "}",
    )

    def items(level):
        guid = F.when((key % 6 == 0) & (level == 2), "").otherwise(_text("M", key, "-", level))
        return _text('[{"guid":"', guid, '"', tail, "]")

    def group(level, below):
        # The first list that is not empty counts, whichever of its two names it has.
        named_items = F.when(level % 2 == 0, _text('"menuItems":[],"items":', items(level))).otherwise(
            _text('"menuItems":', items(level), ',"items":[{"guid":"not used"}]')
        )
        named_groups = F.when(level % 2 == 0, _text('"subgroups":[],"menuGroups":', below)).otherwise(
            _text('"subgroups":', below)
        )
        return _text('[{"name":"', c("p_type"), " ", level, '",', named_items, ",", named_groups, "}]")

    depth = (c("p_size") % 7).cast("int") + 1
    # Built from the innermost group outwards.
    tree = F.aggregate(F.reverse(_up_to(depth)), F.lit("[]"), lambda below, level: group(level, below))
    menu = _text('{"name":"', c("p_brand"), '","', F.when(key % 2 == 0, "menuGroups").otherwise("groups"), '":', tree, "}")
    page = (
        F.when(key % 4 == 0, _text("[", menu, "]"))
        .when(key % 4 == 1, _text('{"menus":[', menu, "]}"))
        .when(key % 4 == 2, _text('{"data":[', menu, "]}"))
        .otherwise(menu)
    )
    return spread(parts).select(_text("R", key % 25).alias("restaurant_guid"), page.alias("value"))


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as tenants, suppliers as their restaurants."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("tenant"),
            F.lower("r_name").alias("dataset"),
            _text("R", F.col("s_suppkey")).alias("restaurant_guid"),
        )
    )


def employee_snapshots(customers: DataFrame) -> DataFrame:
    """Three snapshots of the employees: some change, some vanish, some come back."""
    key = F.col("c_custkey")
    return (
        customers.select(
            _text("U", key).alias("employee_guid"),
            "c_custkey",
            "c_mktsegment",
            F.explode(F.array(*[F.lit(f"2024-01-{d:02d}").cast("date") for d in (7, 14, 21)])).alias("snapshot_date"),
        )
        .where(~((key % 5 == 0) & (F.dayofmonth("snapshot_date") == 14)))
        .where(~((key % 7 == 0) & (F.dayofmonth("snapshot_date") == 21)))
        .select(
            "employee_guid",
            F.when((key % 3 == 0) & (F.dayofmonth("snapshot_date") > 7), "MOVED")
            .when((key % 4 == 0) & (F.dayofmonth("snapshot_date") > 14), F.lit(None))
            .otherwise(F.col("c_mktsegment"))
            .alias("job_title"),
            "snapshot_date",
        )
    )


def server_snapshots(customers: DataFrame) -> DataFrame:
    """Three snapshots of the servers S1 to S3: S1 is promoted, S2 leaves, S3 comes with the second."""
    server = F.col("c_custkey") % 4
    days = F.array(*[F.lit(day).cast("date") for day in ("1996-01-01", "1998-04-01", "2000-01-01")])
    seen = customers.where(server > 0).select(server.alias("server"), "c_mktsegment", "c_custkey", F.explode(days).alias("snapshot_date"))
    return (
        seen.where(~((F.col("server") == 2) & (F.year("snapshot_date") == 2000)) & ~((F.col("server") == 3) & (F.year("snapshot_date") == 1996)))
        .groupBy(_text("S", F.col("server")).alias("employee_guid"), "snapshot_date", "server")
        .agg(
            F.when((F.col("server") == 1) & (F.year("snapshot_date") >= 1998), F.max("c_mktsegment"))
            .otherwise(F.min("c_mktsegment"))
            .alias("job_title")
        )
        .select("employee_guid", "job_title", "snapshot_date")
    )
