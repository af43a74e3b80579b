"""Map the benchmark tables onto the sales-shaped inputs the pipeline expects.

The driver's star-schema tables stand in for the source system:

* ``lineitem`` joined to ``part`` is the append-only order-line landing (several
  versions per ``order_line_id``; the ship date is the edit cursor).
* ``orders`` is the order header; ``F``/``P`` orders double as invoices.
* ``events`` is a change feed keyed by ``user_id``.

Every adapter is a projection or a join, so Catalyst prunes the parquet scan to the
columns used and pushes filters into it. The same expressions are written in the
DuckDB oracles in ``terrace.plans.oracles``. The specs here are the registered ones with the
tie-breaking columns that only these stand-ins have.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.expressions import lsn_hex
from terrace.operators.cdc import CT_OPERATION, CT_SEQVAL, CT_START_LSN
from terrace.specs import CHANGE_LSN, CHANGE_OPERATION, CHANGE_SEQVAL, SALES_TABLES, TableSpec, spec_by_name

QTY = "decimal(10,0)"
PRICE = "decimal(12,2)"
RATE = "decimal(5,2)"
DISCOUNT = "decimal(4,2)"

# Lines of the stand-in source can share key, cursor and item; the supplier tells them apart.
SPECS: tuple[TableSpec, ...] = tuple(
    replace(s, tiebreakers=(*s.tiebreakers, "supplier_id")) if s.name.endswith("lines") else s for s in SALES_TABLES
)
# The change feed: one table of its own, keyed by user.
FEED_SPECS = (TableSpec("user_events", ("user_id",), cursor="ts", tiebreakers=("event_id",)),)


def spec(name: str) -> TableSpec:
    return spec_by_name(name, SPECS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey, "inner")


def _quantity() -> Column:
    return F.col("l_quantity").cast(QTY)


def bronze_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-line landing table: every version of every line, cursor = ship date."""
    q = _quantity()
    return _line_base(spark, sf_dir).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_line_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("stock_item_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("p_name").alias("description"),
        q.alias("quantity"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
        (F.col("l_tax") * 100).cast(RATE).alias("tax_rate"),
        F.when(F.col("l_linestatus") == "F", q).otherwise(F.lit(0).cast(QTY)).alias("picked_quantity"),
        F.col("l_shipdate").alias("last_edited_when"),
    )


def bronze_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice-line landing table: returned lines are credits (negative quantity)."""
    q = F.when(F.col("l_returnflag") == "R", -_quantity()).otherwise(_quantity())
    price = F.col("p_retailprice").cast(PRICE)
    return _line_base(spark, sf_dir).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_line_id"),
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_partkey").alias("stock_item_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("p_name").alias("description"),
        q.alias("quantity"),
        price.alias("unit_price"),
        (F.col("l_tax") * 100).cast(RATE).alias("tax_rate"),
        (q * price * F.col("l_discount").cast(DISCOUNT)).alias("line_profit"),
        F.col("l_shipdate").alias("last_edited_when"),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers with their edit cursor."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_custkey") % 20).alias("salesperson_person_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_orderdate").alias("last_edited_when"),
    )


def bronze_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices: finished or partly finished orders; low-priority ones are credit notes."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus").isin("F", "P"))
        .select(
            F.col("o_orderkey").alias("invoice_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_custkey") % 20).alias("salesperson_person_id"),
            F.col("o_orderdate").cast("date").alias("invoice_date"),
            (F.col("o_orderpriority") == "5-LOW").alias("is_credit_note"),
            F.col("o_orderdate").alias("last_edited_when"),
        )
    )


def _op_code() -> Column:
    # Event type -> change operation (1 delete, 2 insert, 3 before, 4 after).
    return (
        F.when(F.col("event_type") == "error", 1)
        .when(F.col("event_type") == "signup", 2)
        .when(F.col("event_type") == "view", 3)
        .otherwise(4)
    )


def _hour_epoch() -> Column:
    return F.unix_seconds(F.date_trunc("hour", F.col("ts")).cast("timestamp"))


def change_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change table: binary LSN/seqval, operation code, then business columns."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.unhex(lsn_hex(_hour_epoch())).alias(CT_START_LSN),
        F.unhex(lsn_hex(F.expr("event_id div 2"))).alias(CT_SEQVAL),
        _op_code().alias(CT_OPERATION),
        "user_id", "event_id", "ts", "event_type", "value", "props",
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze change feed derived from ``events`` (key ``user_id``)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "user_id", "event_id", "ts", "event_type", "value", "props",
        lsn_hex(_hour_epoch()).alias(CHANGE_LSN),
        lsn_hex(F.expr("event_id div 2")).alias(CHANGE_SEQVAL),
        _op_code().alias(CHANGE_OPERATION),
    )


def landing_sources(spark: SparkSession, sf_dir: str, before: str | None) -> dict[str, DataFrame]:
    """Source tables as the extract stage sees them (orders with source-system names).
    ``before`` restricts every source to rows edited before that time."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        (F.col("o_custkey") % 20).alias("SalespersonPersonID"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.col("o_orderdate").alias("LastEditedWhen"),
    )
    sources = {
        "sales_orders": orders,
        "sales_orderlines": bronze_order_lines(spark, sf_dir),
        "sales_invoices": bronze_invoices(spark, sf_dir),
        "sales_invoicelines": bronze_invoice_lines(spark, sf_dir),
    }
    if before is None:
        return sources
    cut = F.lit(before).cast("timestamp_ntz")
    return {
        name: df.filter(F.col("LastEditedWhen" if name == "sales_orders" else "last_edited_when") < cut)
        for name, df in sources.items()
    }
