"""The registered queries as plain SQL over the flat tables.

Written from what the documents mean, not from how they are parsed.
"""

# Line orders: one document per line item. `l` holds all, `good` the valid ones.
_LINES = """
l AS MATERIALIZED (
  SELECT *, row_number() OVER () AS rid, l_orderkey || '-' || l_linenumber AS ck, 'R' || l_suppkey AS rest,
    CASE WHEN l_partkey % 53 = 0 THEN 'missing guid'
         WHEN l_partkey % 59 = 0 AND l_suppkey % 3 <> 0 THEN 'missing restaurantGuid'
         WHEN l_partkey % 61 = 0 THEN 'missing businessDate' END AS doc_reason
  FROM lineitem),
good AS MATERIALIZED (SELECT * FROM l WHERE doc_reason IS NULL),
pay AS MATERIALIZED (
  SELECT rid, sum(coalesce(tip, 0)) AS tip, arg_min(kind, k) FILTER (WHERE kind IS NOT NULL) AS kind
  FROM (SELECT rid, k, CASE WHEN (l_suppkey + k) % 4 <> 0 THEN k * l_quantity * 0.25::DOUBLE END AS tip,
          CASE (l_partkey + k) % 3 WHEN 1 THEN 'CREDIT' WHEN 2 THEN CASE WHEN k % 2 = 0 THEN '' ELSE 'CASH' END END AS kind
        FROM good, unnest(range(1, l_linenumber)) AS t(k)) p
  GROUP BY rid),
checks AS MATERIALIZED (
  SELECT rid, 'A' AS side, CASE WHEN l_partkey % 71 <> 0 THEN ck || '-A' END AS check_guid,
    l_extendedprice AS check_total, l_tax AS check_tax, coalesce(tip, 0)::DOUBLE AS check_tip, kind AS payment_type
  FROM good LEFT JOIN pay USING (rid) WHERE NOT (l_linenumber = 7 AND l_linestatus = 'O')
  UNION ALL
  SELECT rid, 'B', ck || '-B', 0, 0, 0, NULL FROM good WHERE l_linestatus = 'F'),
sel AS (
  SELECT rid, 'A' AS side, k FROM good, unnest(range(1, l_linenumber % 4 + 1)) AS t(k)
  WHERE NOT (l_returnflag = 'R' AND k = 1) AND NOT (k = 3 AND l_partkey % 7 = 0)
  UNION ALL
  SELECT rid, 'B', 9 FROM good),
rows AS MATERIALIZED (
  SELECT good.*, k, check_guid, check_total, check_tax, check_tip, payment_type,
    nullif(concat_ws(', ', CASE WHEN l_partkey % 67 = 0 THEN 'bad businessDate' END,
                           CASE WHEN l_partkey % 73 = 0 THEN 'bad price' END,
                           CASE WHEN check_guid IS NULL THEN 'missing check_guid' END,
                           CASE WHEN l_partkey % 67 = 0 THEN 'missing business_date' END), '') AS row_reason
  FROM sel JOIN checks USING (rid, side) JOIN good USING (rid)),
items AS (
  SELECT ck || '-' || k AS selection_guid, l_orderkey::VARCHAR AS order_guid, check_guid, rest AS restaurant_guid,
    l_shipdate::DATE AS business_date,
    CASE WHEN l_partkey % 2 = 0 THEN l_partkey::VARCHAR ELSE 'P' || l_partkey END AS menu_item_guid,
    CASE WHEN l_suppkey % 4 <> 0 THEN 'S' || (l_suppkey % 4) END AS server_guid,
    'item ' || l_partkey AS menu_item_name,
    CASE WHEN l_suppkey % 5 <> 0 THEN 'category ' || (l_suppkey % 5) END AS sales_category_name,
    CASE WHEN l_quantity >= 5 THEN l_quantity ELSE 0 END AS item_quantity,
    l_extendedprice AS item_price, l_extendedprice + k AS pre_discount_price, l_discount AS discount_amount,
    CASE WHEN k <> 2 THEN l_tax ELSE 0 END AS tax_amount,
    check_total, check_tax, check_tip, payment_type,
    (l_linestatus = 'O' AND l_returnflag = 'R') AS is_voided, (l_tax = 0.08) AS is_deleted
  FROM rows WHERE row_reason IS NULL)
"""

_BATCH = (
    "WITH "
    + _LINES
    + """,
batch AS MATERIALIZED (SELECT * FROM items WHERE business_date >= DATE '1998-01-01'),
loaded AS MATERIALIZED (SELECT * FROM items WHERE business_date < DATE '1999-01-01'),
fresh AS MATERIALIZED (
  SELECT * FROM batch b WHERE NOT EXISTS (
    SELECT 1 FROM loaded t WHERE t.selection_guid = b.selection_guid AND t.order_guid = b.order_guid))
"""
)

# Header orders: one document per row of `orders`.
_HEADERS = """
h AS (
  SELECT *, 'R' || o_custkey AS rest,
    CASE WHEN o_orderkey % 41 = 0 THEN 'missing guid'
         WHEN o_orderkey % 47 = 0 AND o_orderkey % 3 <> 0 THEN 'missing restaurantGuid'
         WHEN o_orderkey % 43 = 0 THEN 'missing businessDate' END AS reason,
    CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey::VARCHAR END AS guid,
    CASE WHEN o_orderkey % 47 = 0 AND o_orderkey % 3 <> 0 THEN NULL ELSE 'R' || o_custkey END AS named
  FROM orders)
"""


def _stamp(hours: int, suffix: str) -> str:
    return (
        f"CASE WHEN o_orderkey % {hours + 2} <> 0 THEN "
        f"strftime(o_orderdate + INTERVAL {hours} HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '{suffix}' END"
    )


_CASH = """
  SELECT 'E' || event_id AS cash_entry_guid, 'R' || user_id AS restaurant_guid, ts::DATE AS business_date,
    CASE WHEN event_id % 5 <> 0 THEN 'U' || user_id END AS employee_guid, 'PAY_OUT' AS entry_type,
    CASE WHEN event_id % 7 <> 0 THEN value ELSE 0 END AS amount,
    CASE WHEN event_id % 2 = 0 THEN 'till count' END AS reason, NULL::VARCHAR AS notes,
    json_extract_string(props, '$.k') AS cash_drawer_guid, ts::TIMESTAMP AS entry_date, ts
  FROM events WHERE event_type = 'purchase' AND event_id % 11 <> 0 AND NOT (event_id % 3 <> 0 AND event_id % 31 = 0)
"""

_DEPOSITS = """
  SELECT 'D' || event_id AS deposit_guid, 'R' || user_id AS restaurant_guid, ts::DATE AS business_date,
    CASE WHEN event_id % 4 <> 0 THEN date_trunc('milliseconds', ts) END AS deposit_date, value AS deposit_amount,
    CASE WHEN event_id % 2 = 0 THEN value / 2 ELSE 0 END AS cash_amount,
    CASE WHEN event_id % 2 = 1 THEN value / 4 ELSE 0 END AS check_amount, ts
  FROM events WHERE event_type = 'click' AND event_id % 11 <> 0
"""

_SHIFTS = """
  SELECT 'T' || event_id AS time_entry_guid, 'R' || user_id AS restaurant_guid, ts::DATE AS business_date,
    CASE WHEN event_id % 2 = 0 THEN 'U' ELSE 'V' END || user_id AS employee_guid,
    CASE WHEN event_id % 4 <> 3 THEN 'J' || (event_id % 6) END AS job_guid,
    CASE WHEN event_id % 4 <> 3 THEN CASE WHEN event_id % 5 = 0 THEN 'name ' ELSE 'title ' END || (event_id % 6) END AS job_title,
    CASE WHEN event_id % 17 <> 0 THEN date_trunc('milliseconds', ts) END AS in_date,
    CASE WHEN event_id % 19 <> 0 THEN date_trunc('milliseconds', ts) + INTERVAL 8 HOUR END AS out_date,
    8::DOUBLE AS regular_hours, CASE WHEN event_id % 2 = 0 THEN 1.5 ELSE 0 END::DOUBLE AS overtime_hours,
    CASE WHEN event_id % 4 = 0 OR value = 0 THEN 15.5 ELSE value END AS hourly_wage,
    CASE WHEN event_id % 2 = 0 THEN value * 7 ELSE value * 8 END AS regular_pay,
    CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN value * 2 ELSE 0 END AS overtime_pay,
    value * 10 AS total_pay, CASE WHEN event_id % 6 = 0 THEN value ELSE 0 END AS declared_tips,
    event_id % 23 = 0 AS is_deleted, ts
  FROM events WHERE event_type = 'signup' AND event_id % 13 <> 0 AND NOT (event_id % 3 = 0 AND event_id % 17 = 0)
"""

_RESTAURANTS = """
  SELECT 'R' || s_suppkey AS restaurant_guid,
    CASE WHEN s_suppkey % 13 <> 0 THEN s_name END AS restaurant_name,
    CASE WHEN s_suppkey % 2 = 0 THEN 'branch ' || s_suppkey WHEN s_suppkey % 13 <> 0 THEN 'site ' || s_suppkey END AS location_name,
    'street ' || s_suppkey AS address_line1, CASE WHEN s_suppkey % 2 = 0 THEN 'floor 2' END AS address_line2,
    'city ' || s_nationkey AS city,
    CASE WHEN s_suppkey % 3 = 0 THEN 'state ' ELSE 'S' END || s_nationkey AS state,
    CASE WHEN s_suppkey % 4 = 0 THEN 'Z' ELSE 'zip ' END || s_suppkey AS zip_code,
    CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 13 <> 0 THEN 'UTC' ELSE 'US/Central' END AS timezone
  FROM supplier WHERE s_suppkey % 29 <> 0
"""


def _insert(rows: str, *keys: str) -> str:
    match = " AND ".join(f"t.{key} = b.{key}" for key in keys)
    return (
        f"WITH f AS ({rows}) SELECT * EXCLUDE (ts) FROM f b WHERE ts >= TIMESTAMP '2024-01-10' AND NOT EXISTS "
        f"(SELECT 1 FROM f t WHERE t.ts < TIMESTAMP '2024-01-20' AND {match})"
    )


_SPAN = "SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders"

ORACLE: dict[str, str] = {
    "orders_scan": "WITH "
    + _HEADERS
    + f"""
SELECT guid, named AS "restaurantGuid", strftime(o_orderdate, '%Y-%m-%d') AS "businessDate",
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS "voidBusinessDate",
  {_stamp(0, 'Z')} AS "openedDate", {_stamp(1, 'Z')} AS "closedDate", {_stamp(2, 'Z')} AS "modifiedDate",
  {_stamp(3, '+0530')} AS "paidDate", {_stamp(4, 'Z')} AS "voidDate", {_stamp(5, 'Z')} AS "deletedDate",
  {_stamp(6, 'Z')} AS "createdDate", {_stamp(7, '+0530')} AS "promisedDate",
  {_stamp(8, 'Z')} AS "estimatedFulfillmentDate", rest AS _restaurant_guid, 'pos_api' AS _data_source
FROM h WHERE reason IS NULL""",
    "timestamp_normalize": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || CASE WHEN event_id % 4 = 3 THEN '+0530' ELSE 'Z' END AS normalized,
  ts - CASE WHEN event_id % 4 = 3 THEN INTERVAL 330 MINUTE ELSE INTERVAL 0 MINUTE END AS instant
FROM events""",
    "business_date_normalize": """
SELECT o_orderkey,
  CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y') || '-13-99' WHEN 1 THEN strftime(o_orderdate, '%Y')
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS normalized,
  CASE WHEN o_orderkey % 5 > 1 THEN o_orderdate::DATE END AS business_date
FROM orders""",
    "envelope_unwrap": """
SELECT 'R' || o_custkey AS restaurant_guid, o_orderdate::DATE AS query_date,
  CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey::VARCHAR END AS guid,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime(o_orderdate, '%Y%m%d') END AS "businessDate"
FROM orders""",
    "order_validation": "WITH "
    + _HEADERS
    + """SELECT rest AS restaurant_guid, o_orderdate::DATE AS query_date, guid, named AS "restaurantGuid",
  reason AS reject_reason FROM h""",
    "order_items_flatten": "WITH " + _LINES + "SELECT * FROM items",
    "check_tip_sum": "WITH "
    + _LINES
    + "SELECT l_orderkey::VARCHAR AS order_guid, check_guid, check_tip FROM checks JOIN good USING (rid)",
    "check_first_payment_type": "WITH "
    + _LINES
    + "SELECT l_orderkey::VARCHAR AS order_guid, check_guid, payment_type FROM checks JOIN good USING (rid)",
    "schema_enforce": """
SELECT l_orderkey || '-' || l_linenumber AS selection_guid, CASE WHEN l_partkey % 7 <> 0 THEN l_linestatus END AS check_guid,
  'R' || l_suppkey AS restaurant_guid, CASE WHEN l_partkey % 11 <> 0 THEN l_shipdate::DATE END AS business_date,
  CASE WHEN l_partkey % 13 <> 0 THEN l_quantity END AS item_quantity, CASE WHEN l_partkey % 17 <> 0 THEN false END AS is_voided,
  nullif(concat_ws(', ', CASE WHEN l_partkey % 7 = 0 THEN 'missing check_guid' END,
    CASE WHEN l_partkey % 11 = 0 THEN 'bad business_date' END, CASE WHEN l_partkey % 13 = 0 THEN 'bad item_quantity' END,
    CASE WHEN l_partkey % 17 = 0 THEN 'bad is_voided' END), '') AS reject_reason
FROM lineitem""",
    "reject_summary": "WITH "
    + _LINES
    + """SELECT reject_reason, count(*)::BIGINT AS n_rejected FROM (
  SELECT doc_reason AS reject_reason FROM l UNION ALL SELECT row_reason FROM rows) r
WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "run_summary": "WITH "
    + _LINES
    + """SELECT rest AS restaurant_guid, sum(o)::BIGINT AS orders_fetched, sum(f)::BIGINT AS items_flattened,
  sum(r)::BIGINT AS items_rejected
FROM (SELECT rest, 1 AS o, 0 AS f, 0 AS r FROM l UNION ALL
      SELECT rest, 0, 1, CASE WHEN row_reason IS NOT NULL THEN 1 ELSE 0 END FROM rows) c GROUP BY rest""",
    "cash_entries_flatten": f"SELECT * EXCLUDE (ts) FROM ({_CASH}) f",
    "cash_deposits_flatten": f"SELECT * EXCLUDE (ts) FROM ({_DEPOSITS}) f",
    "labor_flatten": f"SELECT * EXCLUDE (ts) FROM ({_SHIFTS}) f",
    "dim_restaurants": _RESTAURANTS,
    "dim_employees": """
SELECT 'U' || c_custkey AS employee_guid, 'R' || c_nationkey AS restaurant_guid, c_name AS first_name,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS last_name, 'u' || c_custkey || '@example.org' AS email,
  CASE WHEN c_custkey % 3 <> 0 THEN 'X' || c_custkey WHEN c_custkey % 2 = 1 THEN 'Y' || c_custkey END AS external_id,
  c_custkey % 7 = 0 AS is_deleted
FROM customer WHERE c_custkey % 11 <> 0""",
    "dim_jobs": """
SELECT 'J' || c_nationkey || '-' || c_mktsegment AS job_guid, 'R' || c_nationkey AS restaurant_guid,
  CASE WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS job_title,
  CASE WHEN c_nationkey % 3 <> 0 THEN min(c_acctbal) ELSE 0 END AS default_wage,
  c_nationkey % 4 = 0 AS tipped, false AS is_deleted
FROM customer GROUP BY c_nationkey, c_mktsegment""",
    "menu_flatten": """
SELECT 'M' || p_partkey || '-' || k AS menu_item_guid, 'R' || (p_partkey % 25) AS restaurant_guid, p_brand AS menu_name,
  p_type || ' ' || k AS menu_group_name, p_name AS item_name, p_retailprice AS price,
  CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS sales_category_name,
  CASE p_partkey % 4 WHEN 0 THEN 'POS,KIOSK' WHEN 1 THEN 'ALL' END AS visibility, p_partkey % 5 = 0 AS is_deleted
FROM part, unnest(range(1, p_size % 7 + 2)) AS t(k) WHERE NOT (p_partkey % 6 = 0 AND k = 2)""",
    "insert_new_order_items": _BATCH + "SELECT * FROM fresh",
    "insert_one_per_key": _BATCH + "SELECT DISTINCT selection_guid, order_guid FROM fresh",
    "insert_new_cash_entries": _insert(_CASH, "cash_entry_guid"),
    "stream_cash_entries": f"SELECT * EXCLUDE (ts) FROM ({_CASH}) f",
    "insert_new_cash_deposits": _insert(_DEPOSITS, "deposit_guid"),
    "insert_new_shifts": _insert(_SHIFTS, "time_entry_guid"),
    "load_metrics": _BATCH
    + """SELECT s AS rows_staged, i AS rows_inserted, s - i AS duplicates_skipped
FROM (SELECT (SELECT count(*) FROM batch)::BIGINT AS s, (SELECT count(*) FROM fresh)::BIGINT AS i) n""",
    "tenant_scope": """
SELECT 'R' || l_suppkey AS restaurant_guid, count(*)::BIGINT AS n_lines, sum(l_quantity) AS quantity
FROM lineitem WHERE l_suppkey IN (
  SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'ASIA')
GROUP BY l_suppkey""",
    "date_range_scope": "WITH "
    + _HEADERS
    + f"""SELECT guid, {_stamp(0, 'Z')} AS "openedDate" FROM h
WHERE reason IS NULL AND o_orderkey % 2 <> 0 AND o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1998-03-01'""",
    "week_windows": f"""
SELECT w::DATE AS week_start, least(w::DATE + 6, b) AS week_end
FROM ({_SPAN}) s, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 7 DAY)) AS t(w)""",
    "day_expansion": f"""
SELECT d::DATE AS business_date
FROM ({_SPAN}) s, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS t(d)""",
    "backfill_plan": f"""
SELECT 'R' || s_suppkey AS restaurant_guid, (date_diff('day', a, w::DATE) / 7)::INTEGER AS window_no,
  w::DATE AS week_start, least(w::DATE + 6, b) AS week_end
FROM supplier, ({_SPAN}) s, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 7 DAY)) AS t(w)""",
    "rows_per_backfill_window": f"""
SELECT floor(date_diff('day', a, o_orderdate::DATE) / 7)::INTEGER AS window_no, count(*)::BIGINT AS n_orders,
  round(sum(o_totalprice), 2) AS total
FROM orders, ({_SPAN}) s GROUP BY 1""",
    "daily_sales_by_restaurant": "WITH "
    + _LINES
    + f"""SELECT i.restaurant_guid, business_date, restaurant_name, count(*)::BIGINT AS items_sold,
  round(sum(item_quantity), 2) AS quantity, round(sum(item_price), 2) AS revenue, round(sum(discount_amount), 2) AS discounts
FROM items i LEFT JOIN ({_RESTAURANTS}) r ON r.restaurant_guid = i.restaurant_guid
WHERE NOT is_voided AND NOT is_deleted GROUP BY 1, 2, 3""",
    "daily_tips_by_restaurant": "WITH "
    + _LINES
    + """SELECT restaurant_guid, business_date, count(*)::BIGINT AS checks, round(sum(tip), 2) AS tips
FROM (SELECT restaurant_guid, business_date, order_guid, check_guid, max(check_tip) AS tip FROM items GROUP BY ALL) c
GROUP BY ALL""",
    "daily_labor_by_restaurant": f"""
SELECT restaurant_guid, business_date, count(*)::BIGINT AS shifts, round(sum(regular_hours + overtime_hours), 2) AS hours,
  round(sum(total_pay), 2) AS pay
FROM ({_SHIFTS}) f WHERE NOT is_deleted GROUP BY ALL""",
    "scd2_history": """
WITH snap AS (
  SELECT 'U' || c_custkey AS employee_guid, d,
    CASE WHEN c_custkey % 3 = 0 AND d > DATE '2024-01-07' THEN 'MOVED'
         WHEN c_custkey % 4 = 0 AND d > DATE '2024-01-14' THEN NULL ELSE c_mktsegment END AS job_title
  FROM customer, (VALUES (DATE '2024-01-07'), (DATE '2024-01-14'), (DATE '2024-01-21')) AS v(d)
  WHERE NOT (c_custkey % 5 = 0 AND d = DATE '2024-01-14') AND NOT (c_custkey % 7 = 0 AND d = DATE '2024-01-21')),
marked AS (
  SELECT *, CASE WHEN lag(d) OVER k = d - 7 AND lag(job_title) OVER k IS NOT DISTINCT FROM job_title THEN 0 ELSE 1 END AS opens
  FROM snap WINDOW k AS (PARTITION BY employee_guid ORDER BY d)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY employee_guid ORDER BY d) AS version FROM marked)
SELECT employee_guid, job_title, min(d) AS valid_from,
  CASE WHEN max(d) < DATE '2024-01-21' THEN max(d) + 7 END AS valid_to, max(d) = DATE '2024-01-21' AS is_current
FROM numbered GROUP BY employee_guid, job_title, version""",
}

_EMPLOYEES = ORACLE["dim_employees"]
# The years of the lines: the first day, the third year, the last day.
_START = "(SELECT make_date(min(year(l_shipdate)), 1, 1) FROM lineitem)"
_THIRD = "(SELECT min(year(l_shipdate)) + 2 FROM lineitem)"
_END = "(SELECT make_date(max(year(l_shipdate)), 12, 31) FROM lineitem)"
# Keys of what a load of the years up to the third has put into the fact.
_HALVES = (
    "WITH "
    + _LINES
    + f""",
early AS MATERIALIZED (
  SELECT DISTINCT l_orderkey, l_linenumber, k FROM rows WHERE row_reason IS NULL AND year(l_shipdate) <= {_THIRD}),
seen AS MATERIALIZED (
  SELECT *, (row_reason IS NULL AND year(l_shipdate) > {_THIRD} AND NOT EXISTS (
    SELECT 1 FROM early e WHERE e.l_orderkey = rows.l_orderkey AND e.l_linenumber = rows.l_linenumber AND e.k = rows.k))::INTEGER AS n
  FROM rows)
"""
)
ORACLE |= {
    "dimension_refresh": f"""SELECT * FROM ({_EMPLOYEES}) e
WHERE substr(restaurant_guid, 2)::INTEGER % 5 = 0 OR substr(employee_guid, 2)::INTEGER % 7 <> 0""",
    "one_restaurant_scope": f"""SELECT * FROM ({_EMPLOYEES}) e
WHERE restaurant_guid = 'R7' AND substr(employee_guid, 2)::INTEGER % 7 <> 0""",
    "order_load": _HALVES
    + f"""SELECT i.* FROM items i WHERE year(business_date) <= {_THIRD} OR NOT EXISTS (
  SELECT 1 FROM early e WHERE i.selection_guid = e.l_orderkey || '-' || e.l_linenumber || '-' || e.k)""",
    "backfill_by_window": _HALVES
    + f""", plan AS (
  SELECT DISTINCT restaurant_guid, w::INTEGER AS window_no
  FROM (SELECT 'R' || s_suppkey AS restaurant_guid FROM supplier UNION SELECT 'R' || n_nationkey FROM nation) r,
    unnest(range(0, date_diff('day', {_START}, {_END}) // 7 + 1)) AS t(w)),
counted AS (
  SELECT rest AS restaurant_guid, 1 AS f,
    CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE date_diff('day', {_START}, l_shipdate::DATE) // 7 END AS window_no,
    n
  FROM seen)
SELECT restaurant_guid, window_no::INTEGER AS window_no, sum(f)::BIGINT AS flattened, sum(n)::BIGINT AS loaded
FROM (SELECT restaurant_guid, f, window_no, n FROM counted UNION ALL SELECT restaurant_guid, 0, window_no, 0 FROM plan) u GROUP BY 1, 2""",
    "load_by_restaurant": _HALVES
    + """SELECT 'fact_order_items' AS table_name, rest AS restaurant_guid, sum(o)::BIGINT AS fetched, sum(d)::BIGINT AS documents_rejected,
  sum(f)::BIGINT AS flattened, sum(r)::BIGINT AS rejected, sum(n)::BIGINT AS loaded
FROM (SELECT rest, 1 AS o, CASE WHEN doc_reason IS NOT NULL THEN 1 ELSE 0 END AS d, 0 AS f, 0 AS r, 0 AS n FROM l UNION ALL
      SELECT rest, 0, 0, 1, CASE WHEN row_reason IS NOT NULL THEN 1 ELSE 0 END, n FROM seen) c GROUP BY rest""",
}

# Cash and labor, landed by the week; restaurants are the events' users.
_WEEK = "date_trunc('week', {0})::DATE"
_MONDAY = "(SELECT date_trunc('week', min(ts))::DATE FROM events)"
# A document without a day of its own has the day its page was asked for.
_BOTH_CASH = f"""
SELECT 'fact_cash_entries' AS table_name, cash_entry_guid AS guid, restaurant_guid,
  CASE WHEN substr(cash_entry_guid, 2)::BIGINT % 3 <> 0 THEN business_date ELSE {_WEEK.format('ts')} END AS business_date, amount, ts
FROM ({_CASH}) c
UNION ALL SELECT 'fact_cash_deposits', deposit_guid, restaurant_guid,
  CASE WHEN substr(deposit_guid, 2)::BIGINT % 3 = 1 THEN business_date ELSE {_WEEK.format('ts')} END, deposit_amount, ts
FROM ({_DEPOSITS}) d"""
_MENU = ORACLE["menu_flatten"]


def _four_dimensions(outcome: str, employees: str, menus: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{outcome}' AS outcome, '{name}' AS table_name, {key} AS guid, restaurant_guid FROM ({rows}) x WHERE {condition}"
        for name, key, rows, condition in (
            ("dim_restaurants", "restaurant_guid", _RESTAURANTS, "true"),
            ("dim_employees", "employee_guid", _EMPLOYEES, employees),
            ("dim_jobs", "job_guid", ORACLE["dim_jobs"], "true"),
            ("dim_menu_items", "menu_item_guid", _MENU, menus),
        )
    )


ORACLE |= {
    "insert_by_index": ORACLE["insert_new_order_items"],
    "dimension_refresh_all": _four_dimensions("died", "true", "true")
    + " UNION ALL "
    + _four_dimensions(
        "partial",
        "substr(restaurant_guid, 2)::INTEGER % 5 = 0 OR substr(employee_guid, 2)::INTEGER % 7 <> 0",
        "substr(restaurant_guid, 2)::INTEGER % 5 = 0 OR split_part(substr(menu_item_guid, 2), '-', 1)::INTEGER % 3 <> 0",
    ),
    "cash_load": f"SELECT * EXCLUDE (ts) FROM ({_BOTH_CASH}) b",
    "load_after_failure": f"SELECT * EXCLUDE (ts) FROM ({_BOTH_CASH}) b WHERE ts < {_MONDAY} + 14",
    "two_tenants_load": f"""SELECT * EXCLUDE (ts),
  CASE WHEN substr(restaurant_guid, 2)::BIGINT % 2 = 0 THEN 'cash_even' ELSE 'cash_odd' END AS dataset FROM ({_BOTH_CASH}) b""",
    "labor_load": ORACLE["labor_flatten"],
    "empty_load": f"""
SELECT true AS with_pages, count(*)::BIGINT AS staged, count(*)::BIGINT AS loaded, 1 AS version FROM ({_SHIFTS}) f WHERE ts < {_MONDAY} + 14
UNION ALL SELECT false, 0, 0, 1""",
    "backfill_resume": f"""
WITH units AS (
  SELECT DISTINCT 'R' || user_id AS restaurant_guid, w::INTEGER AS window_no, {_MONDAY} + 7 * w::INTEGER AS week_start
  FROM events, unnest(range(2, date_diff('day', {_MONDAY}, (SELECT max(ts)::DATE FROM events)) // 7 + 1)) AS t(w)),
rows AS (
  SELECT 'R' || user_id AS restaurant_guid, {_WEEK.format('ts')} AS week_start,
    CASE WHEN event_type = 'purchase' AND event_id % 3 <> 0 AND event_id % 31 = 0 THEN 0 ELSE 1 END AS loaded
  FROM events WHERE event_type IN ('purchase', 'click') AND event_id % 11 <> 0)
SELECT u.restaurant_guid, window_no, u.week_start, u.week_start + 6 AS week_end, count(loaded)::BIGINT AS flattened,
  coalesce(sum(loaded), 0)::BIGINT AS loaded
FROM units u LEFT JOIN rows r ON r.restaurant_guid = u.restaurant_guid AND r.week_start = u.week_start GROUP BY ALL""",
    "load_stamp": f"""
SELECT time_entry_guid, CASE WHEN ts < {_MONDAY} + 14 THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2026-01-02' END AS loaded_at FROM ({_SHIFTS}) f""",
    "default_date_scope": """
SELECT 'R' || o_custkey AS restaurant_guid, o_orderdate::DATE AS query_date, CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey::VARCHAR END AS guid
FROM orders WHERE o_orderdate::DATE = (SELECT max(o_orderdate)::DATE FROM orders)""",
    "stream_rejects": """
SELECT 'fact_cash_entries' AS table_name, 'row' AS stage, 'R' || user_id AS restaurant_guid, 'bad business_date' AS reject_reason,
  'E' || event_id AS guid
FROM events WHERE event_type = 'purchase' AND event_id % 11 <> 0 AND event_id % 3 <> 0 AND event_id % 31 = 0""",
    "ndjson_export": ORACLE["cash_entries_flatten"],
    "scd2_apply": ORACLE["scd2_history"],
    "sales_by_job_title_then": "WITH "
    + _LINES
    + """, titles AS (
  SELECT 'S' || (c_custkey % 4) AS server, min(c_mktsegment) AS low, max(c_mktsegment) AS high FROM customer GROUP BY c_custkey % 4),
versions(server, title, valid_from, valid_to) AS (
  SELECT server, low, DATE '1996-01-01', CASE WHEN low <> high THEN DATE '1998-04-01' END FROM titles WHERE server = 'S1'
  UNION ALL SELECT server, high, DATE '1998-04-01', NULL FROM titles WHERE server = 'S1' AND low <> high
  UNION ALL SELECT server, low, DATE '1996-01-01', DATE '2000-01-01' FROM titles WHERE server = 'S2'
  UNION ALL SELECT server, low, DATE '1998-04-01', NULL FROM titles WHERE server = 'S3')
SELECT v.title AS job_title, count(*)::BIGINT AS items_sold, round(sum(item_price), 2) AS revenue
FROM items i LEFT JOIN versions v ON v.server = i.server_guid AND i.business_date >= v.valid_from
  AND (v.valid_to IS NULL OR i.business_date < v.valid_to)
WHERE NOT is_voided AND NOT is_deleted GROUP BY 1""",
    "sales_by_menu_group": "WITH "
    + _LINES
    + f""", menu AS (
  SELECT 'P' || split_part(substr(menu_item_guid, 2), '-', 1) AS item, menu_name, menu_group_name FROM ({_MENU}) m
  WHERE menu_item_guid LIKE '%-1')
SELECT menu_name, menu_group_name, round(sum(item_quantity), 2) AS quantity, round(sum(item_price), 2) AS revenue
FROM items i LEFT JOIN menu m ON m.item = i.menu_item_guid
WHERE NOT is_voided AND NOT is_deleted GROUP BY 1, 2""",
}
