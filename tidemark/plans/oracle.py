"""Shared pieces of the SQL that checks the queries: the derived tables as CTEs."""

from __future__ import annotations

HOLIDAYS = """
years AS (SELECT CAST(unnest(range(lo, hi)) AS INTEGER) AS yr
  FROM (SELECT year(MIN(l_shipdate)) AS lo, year(MAX(l_shipdate)) + 2 AS hi FROM lineitem)),
holidays AS (
  SELECT 'Superbowl' AS holiday, d AS ds FROM (
    SELECT yr, make_date(yr, 2, 1) + CAST((12 - isodow(make_date(yr, 2, 1))) % 7 + 7 AS INTEGER) AS d FROM years)
  UNION ALL SELECT 'Labor Day', d + 4 FROM (
    SELECT make_date(yr, 9, 1) + CAST((8 - isodow(make_date(yr, 9, 1))) % 7 AS INTEGER) AS d FROM years)
  UNION ALL SELECT 'Thanksgiving', d + 1 FROM (
    SELECT make_date(yr, 11, 1) + CAST((11 - isodow(make_date(yr, 11, 1))) % 7 + 21 AS INTEGER) AS d FROM years)
  UNION ALL SELECT 'Christmas', d FROM (
    SELECT make_date(yr, 12, 31) - CAST((isodow(make_date(yr, 12, 31)) + 2) % 7 AS INTEGER) AS d FROM years)
)"""

LINES = """
lines AS (
  SELECT l_suppkey, l_partkey, l_linenumber,
    CAST(date_trunc('week', l_shipdate + INTERVAL 2 DAY) AS DATE) + 4 AS "Date",
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CAST(l_discount AS DECIMAL(4,2)) AS discount,
    CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
    CAST(l_tax AS DECIMAL(4,2)) AS tax,
    CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(12,2))
      * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net
  FROM lineitem
),
sales AS (
  SELECT s_nationkey AS "Store", p_brand AS "Dept", lines."Date", SUM(net) AS "Weekly_Sales",
    lines."Date" IN (SELECT ds FROM holidays) AS "IsHoliday"
  FROM lines JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3
),
cells AS (SELECT * FROM sales WHERE "Weekly_Sales" > 0)"""

ATTRIBUTES = """
stores AS (
  SELECT "Store", "Size",
    CASE WHEN n * COUNT(*) OVER () * 4 >= SUM(n) OVER () * 5 THEN 'A'
         WHEN n * COUNT(*) OVER () * 4 >= SUM(n) OVER () * 3 THEN 'B' ELSE 'C' END AS "Type"
  FROM (SELECT s_nationkey AS "Store", COUNT(*) AS n,
          CAST(round(SUM(CAST(s_acctbal AS DECIMAL(12,2))), 0) AS BIGINT) AS "Size"
        FROM supplier GROUP BY 1)
),
feats AS (
  SELECT s_nationkey AS "Store", "Date",
    CAST(SUM(quantity) AS DOUBLE) / COUNT(*) AS "Temperature",
    CAST(SUM(tax) AS DOUBLE) / COUNT(*) AS "Fuel_Price",
    CAST(SUM(price) AS DOUBLE) / CAST(SUM(quantity) AS DOUBLE) AS "CPI",
    CAST(SUM(discount) AS DOUBLE) / COUNT(*) AS "Unemployment",
    CASE WHEN "Date" >= DATE '1998-01-02' THEN CAST(SUM(CASE WHEN l_linenumber % 5 = 0 THEN price * discount END) AS DOUBLE) END AS "MarkDown1",
    CASE WHEN "Date" >= DATE '1998-01-02' THEN CAST(SUM(CASE WHEN l_linenumber % 5 = 1 THEN price * discount END) AS DOUBLE) END AS "MarkDown2",
    CASE WHEN "Date" >= DATE '1998-01-02' THEN CAST(SUM(CASE WHEN l_linenumber % 5 = 2 THEN price * discount END) AS DOUBLE) END AS "MarkDown3",
    CASE WHEN "Date" >= DATE '1998-01-02' THEN CAST(SUM(CASE WHEN l_linenumber % 5 = 3 THEN price * discount END) AS DOUBLE) END AS "MarkDown4",
    CASE WHEN "Date" >= DATE '1998-01-02' THEN CAST(SUM(CASE WHEN l_linenumber % 5 = 4 THEN price * discount END) AS DOUBLE) END AS "MarkDown5"
  FROM lines JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
),
log AS (
  SELECT sales.*, "Type", "Size", "Temperature", "Fuel_Price", "CPI", "Unemployment",
    "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5"
  FROM sales LEFT JOIN stores USING ("Store") LEFT JOIN feats USING ("Store", "Date")
),
clean AS (SELECT * FROM log WHERE "Weekly_Sales" > 0),
chain_full AS (
  SELECT "Date", SUM("Weekly_Sales") AS "Weekly_Sales", bool_or("IsHoliday") AS "IsHoliday",
    AVG("Temperature") AS "Temperature", AVG("Fuel_Price") AS "Fuel_Price", AVG("CPI") AS "CPI",
    AVG("Unemployment") AS "Unemployment"
  FROM clean GROUP BY 1
),
panel_full AS (
  SELECT "Store", "Date", SUM("Weekly_Sales") AS "Weekly_Sales", bool_or("IsHoliday") AS "IsHoliday",
    MAX("Type") AS "Type", MAX("Size") AS "Size",
    AVG("Temperature") AS "Temperature", AVG("Fuel_Price") AS "Fuel_Price", AVG("CPI") AS "CPI",
    AVG("Unemployment") AS "Unemployment"
  FROM clean GROUP BY 1, 2
)"""

SERIES = """
store_series AS (
  SELECT "Store", "Date" AS ds, CAST(SUM("Weekly_Sales") AS DOUBLE) AS y FROM cells GROUP BY 1, 2),
dept_series AS (
  SELECT "Store", "Dept", "Date" AS ds, CAST("Weekly_Sales" AS DOUBLE) AS y FROM cells),
chain_series AS (
  SELECT "Date" AS ds, CAST(SUM("Weekly_Sales") AS DOUBLE) AS y FROM cells GROUP BY 1)"""

EASTER = """
computus AS (SELECT yr, yr % 19 AS a, yr // 100 AS b, yr % 100 AS c FROM years),
computus2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM computus),
computus3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM computus2),
computus4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS q FROM computus3),
easter AS (SELECT yr, make_date(yr, CAST(q // 31 AS INTEGER), CAST(q % 31 + 1 AS INTEGER)) AS easter FROM computus4),
easter_weeks AS (
  SELECT MAX(ds) AS ds FROM chain_series JOIN easter ON year(ds) = yr
  WHERE ds > easter - 9 AND ds <= easter - 2 GROUP BY yr),
events_by_week AS (
  SELECT c.ds, concat_ws(' + ', h.holiday, CASE WHEN e.ds IS NOT NULL THEN 'Easter' END) AS event
  FROM chain_series c LEFT JOIN holidays h ON c.ds = h.ds LEFT JOIN easter_weeks e ON c.ds = e.ds)"""

CUSTOMERS = """
cust_orders AS (
  SELECT o_custkey,
    MIN(d) FILTER (WHERE d < DATE '2000-08-01') AS first_day,
    MAX(d) FILTER (WHERE d < DATE '2000-08-01') AS last_day,
    COUNT(*) FILTER (WHERE d < DATE '2000-08-01') AS orders,
    COUNT(*) FILTER (WHERE d >= DATE '2000-08-01' AND d < DATE '2001-08-01') AS orders_after,
    SUM(p) FILTER (WHERE d < DATE '2000-08-01') AS spend,
    MAX(p) FILTER (WHERE d < DATE '2000-08-01') AS largest,
    COUNT(*) FILTER (WHERE d < DATE '2000-08-01' AND o_orderpriority = '1-URGENT') AS urgent,
    COUNT(*) FILTER (WHERE d < DATE '2000-08-01' AND o_orderstatus = 'P') AS pending
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(14,2)) AS p FROM orders)
  GROUP BY 1
),
customers AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS segment, CAST(c_nationkey AS INTEGER) AS nation,
    CAST(c_acctbal AS DOUBLE) AS balance, CAST(orders AS DOUBLE) AS orders, CAST(spend AS DOUBLE) AS spend,
    CAST(largest AS DOUBLE) AS largest, CAST(urgent AS DOUBLE) AS urgent, CAST(pending AS DOUBLE) AS pending,
    CAST(DATE '2000-08-01' - last_day AS DOUBLE) AS days_silent,
    CAST((year(last_day) - year(first_day)) * 12 + month(last_day) - month(first_day) AS DOUBLE) AS tenure,
    CASE WHEN orders_after = 0 THEN 1 ELSE 0 END AS churn
  FROM customer JOIN cust_orders ON c_custkey = o_custkey WHERE orders > 0
)"""


def with_tables(body: str, *parts: str) -> str:
    """``WITH`` clause over the named parts, followed by ``body``."""
    return "WITH RECURSIVE " + ",".join(parts) + "\n" + body


def on_cells(body: str, *more: str) -> str:
    return with_tables(body, HOLIDAYS, LINES, SERIES, *more)


def on_log(body: str, *more: str) -> str:
    return with_tables(body, HOLIDAYS, LINES, SERIES, ATTRIBUTES, *more)


def on_customers(body: str, *more: str) -> str:
    return with_tables(body, CUSTOMERS, *more)
