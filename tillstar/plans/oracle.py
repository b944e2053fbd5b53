"""The same queries as SQL for DuckDB, over views of the same tables. Money is exact: it is summed in cents."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# -- shared pieces --------------------------------------------------------------------------------------------------------

LINES = """
lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id, o_custkey AS customer_id,
         c_nationkey AS store_id, n_name AS store_name, s_name AS supplier_name, p_name AS product_name,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(o_orderdate AS DATE) AS d,
         CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT) AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
)"""

MASTER = """
master AS (
  SELECT p_partkey AS product_id, p_name AS product_name, CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents,
         s_suppkey AS supplier_id, s_name AS supplier_name, n_nationkey AS store_id, n_name AS store_name,
         p_type, p_brand
  FROM part JOIN (SELECT l_partkey AS pk, min(l_suppkey) AS sk FROM lineitem GROUP BY l_partkey) ON p_partkey = pk
  JOIN supplier ON s_suppkey = sk JOIN nation ON s_nationkey = n_nationkey
)"""

# Percent change of cents, rounded half away from zero to two places, in whole numbers.
GROWTH = """CASE WHEN prev IS NOT NULL AND prev <> 0 THEN CAST(
    sign(cents - prev) * ((abs(cents - prev) * 20000 + prev) // (2 * prev)) AS DOUBLE) / 100 END"""


def money(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) / 100 AS {name}"


# -- reports ----------------------------------------------------------------------------------------------------------------

ORACLE["r1_top_products"] = f"""
WITH {LINES},
sums AS (
  SELECT month(d) AS month_t, CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS sale_type,
         product_id, product_name, sum(cents) AS cents
  FROM lines WHERE year(d) = 1997 GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY month_t, sale_type ORDER BY cents DESC, product_id) AS r FROM sums)
SELECT month_t, sale_type, product_id, product_name, {money('cents', 'total_revenue')}
FROM ranked WHERE r <= 5 ORDER BY month_t, sale_type, r"""

ORACLE["r2_store_growth"] = f"""
WITH {LINES},
sums AS (
  SELECT store_id, store_name, quarter(d) AS quarter_t, CAST(sum(cents) AS HUGEINT) AS cents
  FROM lines WHERE year(d) = 1997 GROUP BY ALL),
lagged AS (SELECT *, lag(cents) OVER (PARTITION BY store_id ORDER BY quarter_t) AS prev FROM sums)
SELECT store_id, store_name, quarter_t, {money('cents', 'total_revenue')},
       {money('prev', 'prev_quarter_revenue')}, {GROWTH} AS growth_rate
FROM lagged ORDER BY store_id, quarter_t"""

ORACLE["r3_supplier_contribution"] = f"""
WITH {LINES}
SELECT store_name, supplier_name, product_name, {money('sum(cents)', 'total_sales')}
FROM lines GROUP BY ALL ORDER BY ALL"""

ORACLE["r4_seasonal_sales"] = f"""
WITH {LINES}
SELECT product_name,
       CASE WHEN month(d) IN (3, 4, 5) THEN 'Spring' WHEN month(d) IN (6, 7, 8) THEN 'Summer'
            WHEN month(d) IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END AS season,
       {money('sum(cents)', 'total_sales')}
FROM lines GROUP BY ALL ORDER BY ALL"""

ORACLE["r4_seasonal_sales_any_case"] = f"""
WITH {LINES},
spelled AS (
  SELECT *, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS spelling FROM part),
one AS (SELECT lower(spelling) AS folded, min(spelling) AS spelling FROM spelled GROUP BY ALL)
SELECT spelling AS product_name,
       CASE WHEN month(d) IN (3, 4, 5) THEN 'Spring' WHEN month(d) IN (6, 7, 8) THEN 'Summer'
            WHEN month(d) IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END AS season,
       {money('sum(cents)', 'total_sales')}
FROM lines JOIN one ON lower(product_name) = folded GROUP BY ALL ORDER BY ALL"""

ORACLE["r5_monthly_volatility"] = f"""
WITH {LINES},
sums AS (
  SELECT store_name, supplier_name, year(d) AS year_t, month(d) AS month_t, CAST(sum(cents) AS HUGEINT) AS cents
  FROM lines GROUP BY ALL),
lagged AS (
  SELECT *, lag(cents) OVER (PARTITION BY store_name, supplier_name, year_t ORDER BY month_t) AS prev FROM sums)
SELECT store_name, supplier_name, year_t, month_t, {money('cents', 'total_revenue')},
       {money('prev', 'prev_month_revenue')}, {GROWTH} AS revenue_volatility
FROM lagged ORDER BY 1, 2, 3, 4"""

ORACLE["r6_product_affinity"] = """
WITH pairs AS (
  SELECT a.l_partkey AS p1, b.l_partkey AS p2, count(*) AS pair_count
  FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY ALL)
SELECT x.p_name AS product_name_1, y.p_name AS product_name_2, pair_count
FROM pairs JOIN part x ON p1 = x.p_partkey JOIN part y ON p2 = y.p_partkey
ORDER BY pair_count DESC, p1, p2 LIMIT 5"""

ORACLE["r7_yearly_rollup"] = f"""
WITH {LINES}
SELECT store_name, supplier_name, product_name, {money('sum(cents)', 'total_revenue')}, year_t
FROM (SELECT *, year(d) AS year_t FROM lines WHERE year(d) = 1997)
GROUP BY ROLLUP (store_name, supplier_name, product_name, year_t)"""


ORACLE["r7_yearly_rollup_levels"] = f"""
WITH {LINES}
SELECT store_name, supplier_name, product_name, {money('sum(cents)', 'total_revenue')}, year_t,
       GROUPING(store_name, supplier_name, product_name, year_t) AS level
FROM (SELECT *, year(d) AS year_t FROM lines WHERE year(d) = 1997)
GROUP BY ROLLUP (store_name, supplier_name, product_name, year_t)"""


def _halves(where: str) -> str:
    return f"""
WITH {LINES}
SELECT product_id, product_name,
       {money('sum(CASE WHEN month(d) <= 6 THEN cents ELSE 0 END)', '"H1_revenue"')},
       CAST(sum(CASE WHEN month(d) <= 6 THEN quantity ELSE 0 END) AS BIGINT) AS "H1_quantity",
       {money('sum(CASE WHEN month(d) > 6 THEN cents ELSE 0 END)', '"H2_revenue"')},
       CAST(sum(CASE WHEN month(d) > 6 THEN quantity ELSE 0 END) AS BIGINT) AS "H2_quantity",
       {money('sum(cents)', 'total_revenue')}, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM lines {where} GROUP BY product_id, product_name ORDER BY product_name, product_id"""


ORACLE["r8_half_year_split"] = _halves("")
ORACLE["r8_half_year_split_one_year"] = _halves("WHERE year(d) = 1997")

ORACLE["r9_sales_spikes"] = f"""
WITH {LINES},
daily AS (SELECT product_id, product_name, d, CAST(sum(cents) AS HUGEINT) AS cents FROM lines GROUP BY ALL),
averaged AS (
  SELECT product_id, (sum(cents) * 20000 + count(*)) // (2 * count(*)) AS avg_e6 FROM daily GROUP BY product_id)
SELECT product_id, product_name, CAST(d AS VARCHAR) AS date_t, {money('cents', 'daily_sales')},
       CAST(avg_e6 AS DOUBLE) / 1000000 AS avg_daily_sales, 'Outlier' AS sales_status
FROM daily JOIN averaged USING (product_id) WHERE cents * 10000 > 2 * avg_e6 ORDER BY product_id, d"""

ORACLE["r10_store_quarterly"] = f"""
WITH {LINES}
SELECT store_id, store_name, quarter(d) AS quarter, {money('sum(cents)', 'total_quarterly_sales')}
FROM lines GROUP BY ALL ORDER BY store_name, quarter"""

ORACLE["r10_store_quarterly_one_year"] = f"""
WITH {LINES}
SELECT store_id, store_name, quarter(d) AS quarter, {money('sum(cents)', 'total_quarterly_sales')}
FROM lines WHERE year(d) = 1997 GROUP BY ALL"""

# -- enrichment and dimensions ------------------------------------------------------------------------------------------------

_ENRICHED = f"""
WITH {MASTER}
SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id, supplier_id, store_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       {money('CAST(l_quantity AS BIGINT) * price_cents', 'sales_revenue')},
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_t
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN master ON l_partkey = product_id"""

ORACLE["j1_enrich"] = _ENRICHED
ORACLE["m1_stream_enrich"] = _ENRICHED
ORACLE["o6_incremental"] = ORACLE["o6_compacted"] = ORACLE["o6_replayed"] = _ENRICHED
ORACLE["o6_dimensions"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(DISTINCT {key}) AS n_rows, count(DISTINCT {key}) AS n_keys, "
    f"CAST(sum(DISTINCT {key}) AS BIGINT) AS sum_ids FROM ({_ENRICHED})"
    for name, key in (("product", "product_id"), ("customer", "customer_id"), ("store", "store_id"),
                      ("supplier", "supplier_id"), ("date", "order_id")))

_PARTIAL = """
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) p ON l_partkey = p.p_partkey
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c.c_custkey"""

ORACLE["j3_rejects"] = f"""
SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       CASE WHEN p_partkey IS NULL AND c_custkey IS NULL THEN 'unknown product and customer'
            WHEN p_partkey IS NULL THEN 'unknown product' ELSE 'unknown customer' END AS reject_reason
{_PARTIAL} WHERE p_partkey IS NULL OR c_custkey IS NULL"""

ORACLE["j3_matched"] = f"""
SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       {money('CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)', 'sales_revenue')}
{_PARTIAL} WHERE p_partkey IS NOT NULL AND c_custkey IS NOT NULL"""

ORACLE["g1_keep_last"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS r
      FROM lineitem) WHERE r = 1"""

ORACLE["g2_dimension"] = """
SELECT product_id, supplier_name, supplier_id
FROM (SELECT l_partkey AS product_id, s_name AS supplier_name, s_suppkey AS supplier_id,
             row_number() OVER (PARTITION BY l_partkey ORDER BY s_name, s_suppkey) AS r
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) WHERE r = 1"""


def _calendar(key: str, ts: str, table: str) -> str:
    return f"""
SELECT {key} AS time_id, CAST(CAST({ts} AS DATE) AS VARCHAR) AS date_t, strftime({ts}, '%H:%M:%S') AS time_t,
       isodow({ts}) >= 6 AS weekend, CASE WHEN month({ts}) <= 6 THEN 1 ELSE 2 END AS half_of_year,
       month({ts}) AS month_t, quarter({ts}) AS quarter_t, year({ts}) AS year_t FROM {table}"""


ORACLE["p5_date_dim"] = _calendar("o_orderkey", "o_orderdate", "orders")
ORACLE["p5_event_dates"] = _calendar("event_id", "ts", "events")

ORACLE["p12_normalise_product"] = f"""
WITH {MASTER} SELECT product_id, product_name, {money('price_cents', 'price')} FROM master"""
ORACLE["p12_normalise_supplier"] = f"WITH {MASTER} SELECT DISTINCT supplier_id, supplier_name FROM master"
ORACLE["p12_normalise_store"] = f"WITH {MASTER} SELECT DISTINCT store_id, store_name FROM master"

# -- cleaning -----------------------------------------------------------------------------------------------------------------

_SUPPLIER_TEXT = "CASE WHEN p_type = 'ECONOMY' THEN supplier_name || ', Inc.' ELSE supplier_name END"

ORACLE["s2_clean_products"] = f"""
WITH {MASTER}
SELECT CASE WHEN p_brand <> 'Brand#3' THEN product_id END AS product_id, product_name,
       CASE WHEN p_brand NOT IN ('Brand#7', 'Brand#9') THEN CAST(price_cents AS DOUBLE) / 100 END AS price,
       supplier_id, {_SUPPLIER_TEXT} AS supplier_name, store_id, store_name,
       CASE WHEN p_brand = 'Brand#3' THEN 'bad product_id'
            WHEN p_brand IN ('Brand#7', 'Brand#9') THEN 'bad price' END AS reject_reason
FROM master"""

ORACLE["s1_clean_customers"] = """
SELECT c_custkey AS customer_id, c_name AS customer_name, nullif(c_mktsegment, 'BUILDING') AS gender,
       CAST(NULL AS VARCHAR) AS reject_reason FROM customer"""

ORACLE["s3_clean_transactions"] = """
WITH t AS (
  SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL
                 WHEN o_orderstatus = 'F' AND month(o_orderdate) < 10 THEN NULL
                 ELSE CAST(o_orderdate AS TIMESTAMP) END AS ts,
            CASE WHEN l_quantity <> 7 THEN CAST(l_quantity AS INTEGER) END AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey AS order_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_ts, l_partkey AS product_id,
       q AS quantity, o_custkey AS customer_id,
       CASE WHEN ts IS NULL THEN 'bad order_date' WHEN q IS NULL THEN 'bad quantity' END AS reject_reason
FROM t"""

ORACLE["p3_field_repair"] = f"""
WITH {MASTER}, priced AS (
  SELECT *, (price_cents // 100)::VARCHAR || '.' || lpad((price_cents % 100)::VARCHAR, 2, '0') || '$' AS t FROM master)
SELECT CASE WHEN p_brand = 'Brand#3' THEN 'P' ELSE '' END || product_id::VARCHAR AS product_id, product_name,
       CASE WHEN p_brand = 'Brand#7' THEN '-' || t WHEN p_brand = 'Brand#9' THEN 'n/a' ELSE t END AS price,
       supplier_id::VARCHAR AS supplier_id, {_SUPPLIER_TEXT} AS supplier_name, store_id::VARCHAR AS store_id, store_name
FROM priced"""

_TEXT_LINES = """
t AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date,
             CAST(l_partkey AS VARCHAR) AS product_id, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
             CAST(o_custkey AS VARCHAR) AS customer_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ORACLE["s6_bulk_load"] = f"WITH {_TEXT_LINES} SELECT * FROM t WHERE quantity NOT IN ('7', '8')"
ORACLE["s6_bulk_load_rejects"] = f"""
WITH {_TEXT_LINES}
SELECT CASE quantity WHEN '7' THEN concat_ws(',', order_id, order_date, product_id, quantity, customer_id, order_id)
              || ',extra' ELSE order_id || ',' || order_date END AS line
FROM t WHERE quantity IN ('7', '8')"""
ORACLE["s7_malformed_rows"] = f"""
WITH {_TEXT_LINES}
SELECT CASE quantity WHEN '7' THEN concat_ws(',', order_id, order_date, product_id, quantity, customer_id, order_id)
              || ',extra' ELSE order_id || ',' || order_date END AS line, 'malformed row' AS reject_reason
FROM t WHERE quantity IN ('7', '8')"""
ORACLE["o1_staging"] = f"""
WITH {MASTER}
SELECT product_id, product_name, CAST(price_cents AS DOUBLE) / 100 AS price, supplier_id,
       {_SUPPLIER_TEXT} AS supplier_name, store_id, store_name
FROM master WHERE p_brand NOT IN ('Brand#3', 'Brand#7', 'Brand#9')"""

ORACLE["p14_zero_dates"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS as_null,
       CASE WHEN o_orderstatus = 'P' THEN '0001-01-01' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
         AS as_first_day
FROM orders"""

# -- constraints ----------------------------------------------------------------------------------------------------------------

ORACLE["k1_unique"] = """
SELECT 'unique(l_orderkey,l_linenumber)' AS rule, l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
ORACLE["k2_not_null"] = """
SELECT 'not_null(status)' AS rule, o_orderkey FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'not_null(priority)', o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'"""
ORACLE["k3_check"] = """
SELECT 'check(segment)' AS rule, c_custkey, c_mktsegment AS segment FROM customer
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"""
ORACLE["k4_foreign_key"] = """
SELECT 'foreign_key(l_partkey)' AS rule, l_partkey, count(*) AS n_rows
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY l_partkey"""
ORACLE["k5_bounds"] = """
SELECT 'length(o_orderpriority)' AS rule, o_orderkey FROM orders WHERE length(o_orderpriority) > 6
UNION ALL SELECT 'decimal(o_totalprice)', o_orderkey FROM orders WHERE TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL"""
ORACLE["k6_conflicts"] = """
SELECT 'conflict(l_partkey)' AS rule, l_partkey, count(DISTINCT l_suppkey) AS n_variants, count(*) AS n_rows
FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1"""

# -- loads ------------------------------------------------------------------------------------------------------------------------

_LAST = """
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY o_orderdate DESC, l_partkey DESC, l_quantity DESC) AS r
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) WHERE r = 1)"""

ORACLE["o2_loaded_top_products"] = f"""
WITH {_LAST},
sums AS (
  SELECT month(o_orderdate) AS month_t,
         CASE WHEN isodow(o_orderdate) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS sale_type,
         l_partkey AS product_id, p_name AS product_name,
         sum(CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)) AS cents
  FROM last WHERE year(o_orderdate) = 1997 GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY month_t, sale_type ORDER BY cents DESC, product_id) AS r FROM sums)
SELECT month_t, sale_type, product_id, product_name, {money('cents', 'total_revenue')} FROM ranked WHERE r <= 5"""

ORACLE["o2_load_rejects"] = """
SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       CASE WHEN l_partkey % 5 = 0 AND o_custkey % 7 = 0 THEN 'unknown product and customer'
            WHEN l_partkey % 5 = 0 THEN 'unknown product' WHEN o_custkey % 7 = 0 THEN 'unknown customer'
            ELSE 'sale' END AS outcome
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

ORACLE["m3_latest_orders"] = f"""
WITH {_LAST}
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
       {money('CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)', 'sales_revenue')} FROM last"""

ORACLE["m3_latest_orders_state"] = ORACLE["m3_latest_orders"]

ORACLE["o6_refused"] = f"""
WITH {_LAST}
SELECT l_orderkey % 3 AS third, count(*) AS n_sales,
       (SELECT count(*) FROM last WHERE l_orderkey % 3 = 2) AS n_repeated
FROM last WHERE l_orderkey % 3 <> 0 GROUP BY ALL"""

ORACLE["o3_insert_ignore"] = """
SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_name ELSE upper(p_name) END AS p_name, p_size FROM part"""

# -- table statements ---------------------------------------------------------------------------------------------------------------

ORACLE["c1_select"] = """
SELECT l_partkey, l_returnflag, count(*) AS n_lines, max(l_extendedprice) AS max_price FROM lineitem
WHERE l_quantity > 10 GROUP BY l_partkey, l_returnflag HAVING count(*) > 1
ORDER BY n_lines DESC, l_partkey, l_returnflag LIMIT 100 OFFSET 10"""
ORACLE["c2_insert"] = """
SELECT p_partkey, p_name, p_size, p_retailprice FROM part
UNION ALL SELECT -p_partkey - 1, upper(p_name), NULL, NULL FROM part WHERE p_size > 45
UNION ALL VALUES (-1000000001, NULL, 3, 9.5), (-1000000002, NULL, 42, 2.5)"""
ORACLE["c3_update"] = """
WITH top AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'P' ORDER BY o_totalprice DESC, k LIMIT 100)
SELECT o_orderkey, CASE WHEN k IS NOT NULL THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN k IS NOT NULL THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders LEFT JOIN top ON o_orderkey = k"""
ORACLE["c3_update_all"] = """
SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice > 100000 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_totalprice > 100000 THEN o_orderstatus || '/' || o_orderpriority ELSE o_orderpriority END
         AS o_orderpriority
FROM orders"""
ORACLE["c4_delete"] = """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT')"""
ORACLE["c4_delete_limit"] = """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice, o_orderkey LIMIT 250)"""
ORACLE["t4_deep_page"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 1500 OFFSET 2500"""
ORACLE["t4_offset"] = "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey OFFSET 300"
ORACLE["a6_row_count"] = "SELECT count(*) AS n_rows FROM lineitem"

# -- documents ------------------------------------------------------------------------------------------------------------------------

EVENTS = """
e AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS _id, event_type, value, user_id AS u,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         '[' || user_id || ',' || json_extract_string(props, '$.k') || ']' AS tags
  FROM events)"""
_CLICK = "event_type = 'click'"


def docs(event_type="event_type", value="value", k="k", tags="tags", extra="", tail="") -> str:
    extra = f", {extra}" if extra else ""
    return f"""
WITH {EVENTS}
SELECT _id, {event_type} AS event_type, {value} AS value, {k} AS k, {tags} AS tags{extra} FROM e {tail}"""


def click(then: str, other: str = "NULL") -> str:
    return f"CASE WHEN {_CLICK} THEN {then} ELSE {other} END"


ORACLE["x1_add"] = f"""
WITH {EVENTS}
SELECT _id, event_type, value, k, tags, CAST(NULL AS VARCHAR) AS user_id FROM e WHERE event_type <> 'error'
UNION ALL
SELECT substr(sha256(event_id || '|{{"event_type":"error","user_id":' || u || '}}'), 1, 28), event_type, NULL, NULL,
       NULL, CAST(u AS VARCHAR) FROM e WHERE event_type = 'error'"""
ORACLE["x1_duplicate_ids"] = f"""
WITH {EVENTS} SELECT 'unique(_id)' AS rule, _id, 2 AS n_rows FROM e WHERE event_type = 'view'"""
ORACLE["x2_upsert"] = f"""
WITH {EVENTS}
SELECT _id, event_type, value, k, tags FROM e WHERE event_type NOT IN ('view', 'signup')
UNION ALL SELECT _id, upper(event_type), value, NULL, NULL FROM e WHERE event_type IN ('view', 'signup')"""
ORACLE["x2_upsert_effect"] = f"""
WITH {EVENTS}
SELECT _id, CASE WHEN event_type = 'view' THEN 2 ELSE 1 END AS affected FROM e WHERE event_type IN ('view', 'signup')"""
ORACLE["x3_replace"] = f"""
WITH {EVENTS}
SELECT _id, event_type, value, k, tags FROM e WHERE event_type NOT IN ('view', 'signup')
UNION ALL SELECT _id, 'VIEW', value, NULL, NULL FROM e WHERE event_type = 'view'"""
ORACLE["x4_remove_one"] = docs(tail="WHERE _id <> '7'")
ORACLE["x4_get_one"] = docs(tail="WHERE _id = '7'")
ORACLE["x5_find"] = docs(tail="WHERE k >= 50 AND value > 100")
ORACLE["x6_fields"] = f"""
WITH {EVENTS} SELECT _id AS id, event_type AS kind, u AS first_tag, k * 2 AS doubled FROM e"""
ORACLE["x6_project"] = f"""
WITH {EVENTS} SELECT _id, '{{"q":2,"g2":' || (k * -20) || ',"gone":null}}' AS doc FROM e"""
ORACLE["x7_find_grouped"] = f"""
WITH {EVENTS}
SELECT event_type, k % 10 AS bucket, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k FROM e WHERE value > 5
GROUP BY ALL HAVING count(*) > 1 ORDER BY event_type, bucket LIMIT 40 OFFSET 2"""
ORACLE["x8_set"] = docs(
    k=click("-1", "k"),
    tags=click("'[5,' || k || ']'", "tags"),
    extra=f"{click(chr(39) + 'new' + chr(39))} AS extra, {click(chr(39) + 'true' + chr(39))} AS flag, "
    f"CAST(NULL AS VARCHAR) AS nowhere, {click(chr(39) + '[' + chr(34) + 'cell' + chr(34) + ',' + chr(34) + 'no cell' + chr(34) + ']' + chr(39))} AS whole",
)
ORACLE["x9_change"] = docs(event_type=click("'tap'", "event_type"), extra="CAST(NULL AS VARCHAR) AS absent")
ORACLE["x10_unset"] = docs(
    value=click("NULL", "value"), k=click("NULL", "k"), tags=click("'[' || k || ']'", "tags")
)
ORACLE["x11_array_append"] = docs(tags=click("'[' || u || ',' || k || ',\"64\"]'", "tags"))
ORACLE["x12_array_insert"] = docs(tags=click("'[' || u || ',43,' || k || ',44]'", "tags"))
ORACLE["x13_patch"] = docs(
    value=click("NULL", "value"), extra=f"{click(chr(39) + '7' + chr(39))} AS j, {click(chr(39) + '1' + chr(39))} AS x"
)
ORACLE["x14_modify_limit"] = f"""
WITH {EVENTS}, top AS (SELECT _id AS t FROM e WHERE {_CLICK} ORDER BY value DESC, _id LIMIT 50)
SELECT _id, CASE WHEN t IS NOT NULL THEN 'top' ELSE event_type END AS event_type, value, k, tags
FROM e LEFT JOIN top ON _id = t"""
ORACLE["x15_remove"] = docs(tail="WHERE k >= 30")
ORACLE["x15_remove_limit"] = f"""
WITH {EVENTS}
SELECT _id, event_type, value, k, tags FROM e
WHERE _id NOT IN (SELECT _id FROM e WHERE {_CLICK} ORDER BY value, _id LIMIT 75)"""
ORACLE["x16_as_table"] = """
SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey, c_name, c_nationkey, c_mktsegment FROM customer"""
ORACLE["x17_validate"] = f"""
WITH {EVENTS}
SELECT 'required(props)' AS rule, _id FROM e WHERE {_CLICK}
UNION ALL SELECT 'type(value:number)', _id FROM e WHERE {_CLICK}"""
_SCHEMA_RULES = {
    "$.flag: required": "event_type = 'signup'",
    "$.event_type: enum": "event_type = 'error'",
    "$.event_type: minLength": "length(event_type) < 5",
    "$.value: minimum": "value < 1",
    "$.value: exclusiveMaximum": "value >= 200.5",
    "$.props.k: maximum": "k > 80",
    "$.props.k: multipleOf": "k % 2 <> 0",
    "$.props: additionalProperties": _CLICK,
    "$.tags[*]: minimum": "least(u, k) < 4",
    "$.tags: uniqueItems": "u = k",
    "$: anyOf": "event_type <> 'view' AND value > 100",
}
ORACLE["x17_schema"] = f"WITH {EVENTS} " + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, _id FROM e WHERE {broken}" for rule, broken in _SCHEMA_RULES.items())
ORACLE["e6_contains"] = f"""
WITH {EVENTS} SELECT _id, u = 42 OR k = 42 AS tag_42, event_type = 'click' AND k = 7 AS click_7 FROM e"""
ORACLE["e7_overlaps"] = f"""
WITH {EVENTS} SELECT _id, u IN (1, 2, 3, 50) OR k IN (1, 2, 3, 50) AS shares_tag, k = 5 AS shares_member FROM e"""
ORACLE["e11_wildcards"] = f"""
WITH {EVENTS} SELECT _id, k AS second_tag, k AS first_member, k AS any_k, 4 AS n_members FROM e"""
ORACLE["e11_deep_wildcards"] = """
SELECT event_id, least(event_id, user_id)::VARCHAR || ',' || greatest(event_id, user_id)::VARCHAR AS found FROM events"""

# -- expressions ------------------------------------------------------------------------------------------------------------------------

ORACLE["e1_arithmetic"] = f"""
WITH {EVENTS}
SELECT event_id, CASE WHEN k <> 50 THEN CAST(u AS DOUBLE) / (k - 50) END AS ratio,
       CASE WHEN k <> 50 THEN u % (k - 50) END AS rest, CASE WHEN k <> 50 THEN u // (k - 50) END AS whole FROM e"""
ORACLE["e3_logic"] = """
SELECT o_orderkey, s = 'F' AND p > 100000 AS both, s = 'F' OR p > 400000 OR o_orderpriority = '1-URGENT' AS "any",
       NOT (s = 'O') AS not_open, s IS NULL AS unknown, s <> 'F' AS differs, p BETWEEN 1000 AND 200000 AS in_range
FROM (SELECT *, nullif(o_orderstatus, 'P') AS s, o_totalprice AS p FROM orders)"""
ORACLE["e4_bits"] = """
SELECT event_id, CAST(event_id & user_id AS VARCHAR) AS both, CAST(event_id | user_id AS VARCHAR) AS either,
       CAST(xor(event_id, user_id) AS VARCHAR) AS one,
       CAST(CAST(18446744073709551615 AS HUGEINT) - event_id AS VARCHAR) AS inverse,
       CAST(event_id << 3 AS VARCHAR) AS left3,
       CAST((CAST(18446744073709551615 AS HUGEINT) - event_id) // 4 AS VARCHAR) AS right2
FROM events"""
ORACLE["e5_matching"] = """
SELECT p_partkey, p_name ILIKE '%ring' AS is_ring, regexp_matches(p_name, '^red|bolt$', 'i') AS red_or_bolt,
       lower(p_type) = 'economy' AS is_economy, p_size BETWEEN 10 AND 20 AS mid_size,
       p_brand IN ('Brand#1', 'Brand#2') AS first_brands FROM part"""
ORACLE["e8_intervals"] = """
SELECT o_orderkey, CAST(d + INTERVAL 1 MONTH AS VARCHAR) AS next_month,
       CAST(d - INTERVAL 3 MONTH AS VARCHAR) AS last_quarter, CAST(d + INTERVAL 14 MONTH AS VARCHAR) AS year_month,
       CAST(d + INTERVAL 14 DAY AS VARCHAR) AS fortnight, CAST(d + INTERVAL 90 SECOND AS VARCHAR) AS soon,
       CAST(d - INTERVAL 1 DAY - INTERVAL 7384 SECOND AS VARCHAR) AS before,
       CAST(d + INTERVAL 1500000 MICROSECOND AS VARCHAR) AS micro
FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS d FROM orders)"""
ORACLE["e9_casts_other"] = """
SELECT event_id, hex(encode(event_type)) AS bytes,
       CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS as_date,
       CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS as_datetime,
       CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%H:%M:%S') END AS as_time,
       CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
FROM events"""
# A week from Sunday that began last year has last year's number; a week from Monday counts with four days in the year.
ORACLE["f_week_codes"] = """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
w AS (SELECT *, strftime(d, '%U') AS u, strftime(d, '%V') AS iso, strftime(d, '%G') AS iso_year, year(d) AS y, day(d) AS n FROM d)
SELECT CAST(d AS VARCHAR) AS day, u AS week_sunday,
       CASE WHEN CAST(iso_year AS INTEGER) < y THEN '00'
            WHEN CAST(iso_year AS INTEGER) > y THEN lpad(CAST(CAST(strftime(d - 7, '%V') AS INTEGER) + 1 AS VARCHAR), 2, '0')
            ELSE iso END AS week_monday,
       CASE WHEN u = '00' THEN strftime(make_date(y - 1, 12, 31), '%U') ELSE u END AS week_sunday_full,
       CAST(CASE WHEN u = '00' THEN y - 1 ELSE y END AS VARCHAR) AS year_sunday,
       iso AS week_iso, iso_year AS year_iso, strftime(d, '%w') AS weekday,
       n || CASE WHEN n IN (11, 12, 13) THEN 'th' WHEN n % 10 = 1 THEN 'st' WHEN n % 10 = 2 THEN 'nd'
                 WHEN n % 10 = 3 THEN 'rd' ELSE 'th' END AS day_suffix
FROM w"""
ORACLE["e9_casts"] = """
SELECT p_partkey, CAST(substr(p_brand, 7) AS BIGINT) AS brand_number, CAST(NULL AS BIGINT) AS not_a_number,
       CAST(CAST(18446744073709551616 AS HUGEINT) - p_size AS VARCHAR) AS wrapped,
       CAST((CAST(round(p_retailprice * 100) AS BIGINT) + 5) // 10 AS DOUBLE) / 10 AS price_1,
       substr(p_name, 1, 4) AS name_4
FROM part"""
ORACLE["e12_json_path"] = f"WITH {EVENTS} SELECT event_id, k, CAST(NULL AS VARCHAR) AS none FROM e"
ORACLE["e14_parameters"] = """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000"""
ORACLE["fn_numeric"] = """
WITH p AS (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS c, p_size - 10 AS s FROM part)
SELECT p_partkey, CAST(c // 10 AS DOUBLE) / 10 AS cut_1, CAST(-(c // 100) AS DOUBLE) AS cut_0,
       CASE WHEN s > 0 THEN round(ln(s), 6) END AS log_size, CASE WHEN s >= 0 THEN round(sqrt(s), 6) END AS root,
       CASE WHEN abs(s) <= 20 THEN round(acos(s / 20), 6) END AS arc, CAST(bit_count(p_partkey) AS INTEGER) AS ones,
       upper(to_hex(p_size)) AS hex_size
FROM p"""
ORACLE["fn_string"] = """
SELECT p_partkey, strlen(p_name) AS n_bytes, substr(p_name, 2, 3) AS middle,
       substr(p_name, 1, 2) || '##' || substr(p_name, 5) AS patched,
       CASE p_size WHEN 1 THEN 'one' WHEN 2 THEN 'two' WHEN 3 THEN 'three' END AS word,
       CASE p_type WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 ELSE 0 END AS spot,
       CASE WHEN p_size >= 8 THEN (p_size // 8)::VARCHAR ELSE '' END || (p_size % 8)::VARCHAR AS oct_size,
       CAST(ascii(p_name) AS BIGINT) AS code,
       CASE WHEN p_name < 'm' THEN -1 WHEN p_name > 'm' THEN 1 ELSE 0 END AS cmp,
       '''' || p_name || '\\''s''' AS quoted,
       concat_ws(',', CASE WHEN p_size % 2 = 1 THEN 'a' END, CASE WHEN p_size // 2 % 2 = 1 THEN 'b' END,
                 CASE WHEN p_size // 4 % 2 = 1 THEN 'c' END) AS flags,
       concat(CASE WHEN p_size % 2 = 1 THEN 'Y' ELSE 'N' END, CASE WHEN p_size // 2 % 2 = 1 THEN 'Y' ELSE 'N' END,
              CASE WHEN p_size // 4 % 2 = 1 THEN 'Y' ELSE 'N' END,
              CASE WHEN p_size // 8 % 2 = 1 THEN 'Y' ELSE 'N' END) AS low_bits,
       split_part(p_name, ' ', 1) AS first_word, lpad(p_name, 14, '*') AS padded
FROM part"""
ORACLE["fn_date"] = """
SELECT o_orderkey, dayname(d) AS day_name, monthname(d) AS month_name, CAST(strftime(d, '%U') AS INTEGER) AS week,
       CAST(strftime(d + INTERVAL 5 MONTH, '%Y%m') AS INTEGER) AS later_period,
       (year(d) - 1995) * 12 + month(d) - 1 AS periods,
       date_diff('day', DATE '0001-01-01', d) + 366 AS day_number,
       CAST(CAST(d + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS next_day,
       format('{:02d}:{:02d}:{:02d}', o_orderkey // 3600, o_orderkey % 3600 // 60, o_orderkey % 60) AS as_time,
       strftime(d, '%A %d.%m.%Y, day %j, %% %y') AS formatted
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""
ORACLE["fn_time"] = """
SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS seconds, strftime(ts, '%H:%M:%S') AS clock,
       hour(ts) AS hour, dayofyear(ts) AS day_of_year FROM events"""

_REAL = "acos asin atan cos cot degrees exp log10 radians sin sqrt tan".split()
ORACLE["fn_same_numeric"] = f"""
SELECT p_partkey, {", ".join(f"round({f}(x), 9) AS {f}_x" for f in _REAL)}, round(atan2(x, 2), 9) AS atan2_x,
       round(pow(x, 3), 9) AS pow_x, round(pow(x, 0.5), 9) AS power_x, round(x * pi(), 9) AS pi_x,
       abs(p_size - 25) AS abs_size, CAST(ceil(x * 10) AS BIGINT) AS ceiling_x,
       CAST(floor(x * 10) AS BIGINT) AS floor_x, p_size % 7 AS mod_size
FROM (SELECT *, p_size / CAST(51 AS DOUBLE) AS x FROM part)"""
ORACLE["fn_same_string"] = """
SELECT p_partkey, ascii(p_name) AS f_ascii, to_binary(p_size) AS f_bin, strlen(p_name) * 8 AS f_bit_length,
       chr(p_size + 64) AS f_char, length(p_name) AS f_char_length, length(p_type) AS f_character_length,
       p_name || '/' || p_type AS f_concat, concat_ws('-', p_name, nullif(p_type, 'PROMO'), p_brand) AS f_concat_ws,
       CASE p_type WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'STANDARD' THEN 3 ELSE 0 END AS f_find_in_set,
       upper(to_hex(p_size)) AS f_hex, instr(p_name, 'o') AS f_instr, lower(p_type) AS f_lcase,
       left(p_name, 3) AS f_left, instr(p_name, 'e') AS f_locate, lower(p_brand) AS f_lower, p_name AS f_ltrim,
       strlen(p_name) AS f_octet_length, instr(p_name, 'l') AS f_position, p_type || p_type AS f_repeat,
       replace(p_name, 'e', 'E') AS f_replace, reverse(p_name) AS f_reverse, right(p_name, 3) AS f_right,
       rpad(p_name, 14, '.') AS f_rpad, p_name AS f_rtrim, '[   ]' AS f_space, substr(p_name, 2, 4) AS f_substring,
       p_name AS f_trim, upper(p_name) AS f_ucase, upper(p_name) AS f_upper
FROM part"""
ORACLE["fn_same_date"] = """
SELECT event_id, day(ts) AS f_dayofmonth, dayofweek(ts) + 1 AS f_dayofweek, dayofyear(ts) AS f_dayofyear,
       hour(ts) AS f_hour, minute(ts) AS f_minute, month(ts) AS f_month, quarter(ts) AS f_quarter,
       second(ts) AS f_second, isodow(ts) - 1 AS f_weekday, year(ts) AS f_year, true AS f_now
FROM events"""
