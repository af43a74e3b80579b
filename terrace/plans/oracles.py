"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs against views named after the benchmark tables. The adapter
expressions mirror ``terrace.sources.adapters`` term by term. Two oracle rules:
DuckDB's ``decimal / int`` returns DOUBLE, so ``/ 100`` is written
``* 0.01::DECIMAL(3,2)``; and results are cast to the decimal type Spark derives,
so both engines print the same scale.
"""

from __future__ import annotations

# -- adapter fragments ---------------------------------------------------------------

LINE_BASE = """
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

BRONZE_ORDER_LINES = f"""
bronze_lines AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS order_line_id,
         l.l_orderkey AS order_id,
         l.l_partkey AS stock_item_id,
         l.l_suppkey AS supplier_id,
         p.p_name AS description,
         CAST(l.l_quantity AS DECIMAL(10,0)) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(l.l_tax * 100 AS DECIMAL(5,2)) AS tax_rate,
         CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_quantity AS DECIMAL(10,0))
              ELSE CAST(0 AS DECIMAL(10,0)) END AS picked_quantity,
         l.l_shipdate AS last_edited_when
  {LINE_BASE}
)"""

BRONZE_INVOICE_LINES = f"""
bronze_invoice_lines AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS invoice_line_id,
         l.l_orderkey AS invoice_id,
         l.l_partkey AS stock_item_id,
         l.l_suppkey AS supplier_id,
         p.p_name AS description,
         CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS DECIMAL(10,0))
              ELSE CAST(l.l_quantity AS DECIMAL(10,0)) END AS quantity,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(l.l_tax * 100 AS DECIMAL(5,2)) AS tax_rate,
         CAST((CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS DECIMAL(10,0))
                    ELSE CAST(l.l_quantity AS DECIMAL(10,0)) END)
              * CAST(p.p_retailprice AS DECIMAL(12,2))
              * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(28,4)) AS line_profit,
         l.l_shipdate AS last_edited_when
  {LINE_BASE}
)"""

BRONZE_ORDERS = """
bronze_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         o_custkey % 20 AS salesperson_person_id,
         CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS order_status, o_orderpriority AS order_priority,
         o_orderdate AS last_edited_when
  FROM orders
)"""

BRONZE_INVOICES = """
bronze_invoices AS (
  SELECT o_orderkey AS invoice_id, o_custkey AS customer_id,
         o_custkey % 20 AS salesperson_person_id,
         CAST(o_orderdate AS DATE) AS invoice_date,
         o_orderpriority = '5-LOW' AS is_credit_note,
         o_orderdate AS last_edited_when
  FROM orders WHERE o_orderstatus IN ('F', 'P')
)"""

SILVER_LINES = """
silver_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_line_id
      ORDER BY last_edited_when DESC NULLS LAST, stock_item_id DESC NULLS LAST,
               supplier_id DESC NULLS LAST) AS rn
    FROM bronze_lines) WHERE rn = 1
)"""

SILVER_INVOICE_LINES = """
silver_invoice_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY invoice_line_id
      ORDER BY last_edited_when DESC NULLS LAST, stock_item_id DESC NULLS LAST,
               supplier_id DESC NULLS LAST) AS rn
    FROM bronze_invoice_lines) WHERE rn = 1
)"""

SILVER_ORDERS = """
silver_orders AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
                                 ORDER BY last_edited_when DESC NULLS LAST) AS rn
    FROM bronze_orders) WHERE rn = 1
)"""

SILVER_INVOICES = """
silver_invoices AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_id
                                 ORDER BY last_edited_when DESC NULLS LAST) AS rn
    FROM bronze_invoices) WHERE rn = 1
)"""


def fact_sales_sql(name: str = "fact_sales", lines: str = "silver_lines", orders: str = "silver_orders") -> str:
    """The fact_sales CTE over the given line and order CTEs."""
    return FACT_SALES_TEMPLATE.format(name=name, lines=lines, orders=orders)


FACT_SALES_TEMPLATE = """
{name} AS (
  SELECT l.order_id, l.order_line_id, l.stock_item_id, l.description, l.quantity,
         l.unit_price, l.tax_rate, l.picked_quantity, o.customer_id,
         o.salesperson_person_id, o.order_date,
         CAST(l.quantity * l.unit_price AS DECIMAL(23,2)) AS extended_price,
         CAST(l.quantity * l.unit_price * l.tax_rate * 0.01::DECIMAL(3,2) AS DECIMAL(33,8))
           AS tax_amount,
         CAST(l.quantity * l.unit_price
              + l.quantity * l.unit_price * l.tax_rate * 0.01::DECIMAL(3,2) AS DECIMAL(34,8))
           AS line_total,
         CAST(year(o.order_date) AS INTEGER) AS order_year,
         CAST(month(o.order_date) AS INTEGER) AS order_month
  FROM {lines} l JOIN {orders} o ON l.order_id = o.order_id
)"""

FACT_SALES = fact_sales_sql()

FACT_INVOICES = """
fact_invoices AS (
  SELECT l.invoice_id, l.invoice_line_id, l.stock_item_id, l.description, l.quantity,
         l.unit_price, l.tax_rate, l.line_profit, i.customer_id,
         i.salesperson_person_id, i.invoice_date, i.is_credit_note,
         CAST(l.quantity * l.unit_price AS DECIMAL(23,2)) AS extended_price,
         CAST(l.quantity * l.unit_price * l.tax_rate * 0.01::DECIMAL(3,2) AS DECIMAL(33,8))
           AS tax_amount,
         CAST(l.quantity * l.unit_price
              + l.quantity * l.unit_price * l.tax_rate * 0.01::DECIMAL(3,2) AS DECIMAL(34,8))
           AS line_total,
         CAST(year(i.invoice_date) AS INTEGER) AS invoice_year,
         CAST(month(i.invoice_date) AS INTEGER) AS invoice_month
  FROM silver_invoice_lines l JOIN silver_invoices i ON l.invoice_id = i.invoice_id
)"""

AGG_SALES_DAILY = """
agg_sales_daily AS (
  SELECT order_date,
         count(DISTINCT order_id) AS num_orders,
         count(*) AS num_lines,
         CAST(sum(quantity) AS DECIMAL(20,0)) AS total_quantity,
         round(sum(line_total), 2) AS total_revenue
  FROM fact_sales GROUP BY order_date
)"""

AGG_BILLED_DAILY = """
agg_billed_daily AS (
  SELECT invoice_date,
         count(DISTINCT invoice_id) AS num_invoices,
         count(*) AS num_lines,
         CAST(sum(quantity) AS DECIMAL(20,0)) AS total_quantity,
         round(sum(line_total), 2) AS total_revenue,
         round(sum(line_profit), 2) AS total_profit
  FROM fact_invoices GROUP BY invoice_date
)"""

CHANGE_FEED = """
change_feed AS (
  SELECT user_id, event_id, ts, event_type, value, props,
         lpad(hex(CAST(epoch(date_trunc('hour', ts)) AS BIGINT)), 20, '0') AS change_lsn,
         lpad(hex(event_id // 2), 20, '0') AS change_seqval,
         CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2
                              WHEN 'view' THEN 3 ELSE 4 END AS INTEGER) AS change_operation
  FROM events
)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


ORDERED = (BRONZE_ORDER_LINES, BRONZE_ORDERS, SILVER_LINES, SILVER_ORDERS, FACT_SALES)
BILLED = (
    BRONZE_INVOICE_LINES, BRONZE_INVOICES, SILVER_INVOICE_LINES, SILVER_INVOICES, FACT_INVOICES,
)
