"""Registered queries: one per operator group of the blueprint, each with its oracle.

Every query reads the benchmark tables in ``sf_dir`` through the adapters, runs the
library operators over the whole tables and returns a lazy DataFrame. ``ORACLES``
holds the DuckDB SQL producing the same rows and column names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from terrace.operators import block_index, cdc, contracts, drift, gold, history, history_store, ingest, merkle, quality, runlog, search, silver
from terrace.plans import gold_refresh, stages
from terrace.sources import lake
from terrace.plans import oracles as O
from terrace.session import materialize, work_dir
from terrace.sources import adapters as A
from terrace.specs import ROW_ID
from terrace.streaming import cdc_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


# -- Silver ---------------------------------------------------------------------------


def silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = A.spec("sales_orderlines")
    return silver.conform(
        A.bronze_order_lines(spark, sf_dir), spec.primary_key, spec.cursor, spec.tiebreakers
    )


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = A.spec("sales_orders")
    return silver.conform(A.bronze_orders(spark, sf_dir), spec.primary_key, spec.cursor)


def silver_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = A.spec("sales_invoicelines")
    return silver.conform(
        A.bronze_invoice_lines(spark, sf_dir), spec.primary_key, spec.cursor, spec.tiebreakers
    )


def silver_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = A.spec("sales_invoices")
    return silver.conform(A.bronze_invoices(spark, sf_dir), spec.primary_key, spec.cursor)


@register(
    "silver_conform_lines",
    O.with_(O.BRONZE_ORDER_LINES, O.SILVER_LINES, body="SELECT * FROM silver_lines"),
)
def q_silver_conform_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1, WIN2, PRJ1, FIL1: latest version of every order line."""
    return silver_lines(spark, sf_dir)


@register(
    "silver_cdc_collapse",
    O.with_(
        O.CHANGE_FEED,
        body="""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id
    ORDER BY change_lsn DESC NULLS LAST, change_seqval DESC NULLS LAST,
             change_operation DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM change_feed) WHERE rn = 1 AND change_operation <> 1""",
    ),
)
def q_silver_cdc_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN3, FIL2, PRJ2: current state per user from the change feed."""
    return cdc.collapse_changes(A.change_feed(spark, sf_dir), "user_id", tiebreakers=("event_id",))


# Parameter: the stored watermark is the LSN of hour 2024-01-15 00:00 UTC (epoch
# 1705276800), so the run reads the changes after that hour.
CDC_LAST_LSN = "00000000000065A47580"


@register(
    "cdc_feed_projection",
    O.with_(
        O.CHANGE_FEED,
        body=f"""
SELECT change_lsn, change_seqval, change_operation,
       user_id, event_id, ts, event_type, value, props
FROM change_feed WHERE change_lsn > '{CDC_LAST_LSN}'""",
    ),
)
def q_cdc_feed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2, SRC3, EXP6, ING5: change table -> feed, strictly after the last LSN."""
    return cdc.project_change_table(A.change_table(spark, sf_dir), CDC_LAST_LSN)


# -- Gold -----------------------------------------------------------------------------


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact(gold.ORDERED, silver_orders(spark, sf_dir), silver_lines(spark, sf_dir))


def fact_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact(gold.BILLED, silver_invoices(spark, sf_dir), silver_invoice_lines(spark, sf_dir))


@register("fact_sales", O.with_(*O.ORDERED, body="SELECT * FROM fact_sales"))
def q_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI1, PRJ3, EXP1-4: order-line fact with measures."""
    return fact_sales(spark, sf_dir)


@register(
    "agg_sales_daily",
    O.with_(*O.ORDERED, O.AGG_SALES_DAILY, body="SELECT * FROM agg_sales_daily"),
)
def q_agg_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1, AGG3, EXP5, SRT1: daily ordered roll-up."""
    return gold.daily(gold.ORDERED, fact_sales(spark, sf_dir))


@register("fact_invoices", O.with_(*O.BILLED, body="SELECT * FROM fact_invoices"))
def q_fact_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI2, PRJ3, EXP1-4: invoice-line fact with profit and credit notes."""
    return fact_invoices(spark, sf_dir)


@register(
    "agg_billed_daily",
    O.with_(*O.BILLED, O.AGG_BILLED_DAILY, body="SELECT * FROM agg_billed_daily"),
)
def q_agg_billed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2: daily billed roll-up with profit."""
    return gold.daily(gold.BILLED, fact_invoices(spark, sf_dir))


# -- Ingest ---------------------------------------------------------------------------------

# Parameter: the first load ran on 1998-01-01 and had seen that day's finished orders.
FIRST_LOAD_CUTOFF = "1998-01-01 00:00:00"
_CUTOFF_SQL = f"TIMESTAMP '{FIRST_LOAD_CUTOFF}'"


def first_order_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed by the first load (load id 1)."""
    src = A.bronze_orders(spark, sf_dir)
    cutoff = F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    cur = F.col("last_edited_when")
    first = src.filter((cur < cutoff) | ((cur == cutoff) & (F.col("order_status") == "F")))
    return ingest.with_load_metadata(first, A.spec("sales_orders"), 1)


def second_order_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the second load (load id 2) appends over the full source."""
    spec = A.spec("sales_orders")
    return ingest.incremental_batch(A.bronze_orders(spark, sf_dir), first_order_load(spark, sf_dir), spec, 2)


_FIRST_LOAD_SQL = f"""
first_load AS (
  SELECT * FROM bronze_orders
  WHERE last_edited_when < {_CUTOFF_SQL}
     OR (last_edited_when = {_CUTOFF_SQL} AND order_status = 'F')
),
wm AS (SELECT max(last_edited_when) AS m FROM first_load),
second_load AS (
  SELECT s.*, CAST(2 AS BIGINT) AS _load_id FROM bronze_orders s, wm
  WHERE s.last_edited_when >= wm.m
    AND NOT EXISTS (SELECT 1 FROM first_load f
                    WHERE f.last_edited_when = wm.m AND f.order_id = s.order_id
                      AND f.last_edited_when = s.last_edited_when)
)"""


@register(
    "incremental_delta",
    O.with_(O.BRONZE_ORDERS, _FIRST_LOAD_SQL, body="SELECT * FROM second_load"),
)
def q_incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING1, ING2, ING4, JOI3: second incremental load after a partial boundary."""
    return second_order_load(spark, sf_dir).drop(ROW_ID)


@register(
    "normalized_names",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
              o_custkey % 20 AS salesperson_person_id,
              CAST(o_orderdate AS DATE) AS order_date, o_orderdate AS last_edited_when
       FROM orders""",
)
def q_normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING3: source-system column names normalised to snake_case."""
    raw = A.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        (F.col("o_custkey") % 20).alias("SalespersonPersonID"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.col("o_orderdate").alias("LastEditedWhen"),
    )
    return ingest.normalize_names(raw)


# -- Quality ------------------------------------------------------------------------------


def _first_invoice_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    return A.bronze_invoices(spark, sf_dir).filter(F.col("last_edited_when") < cutoff)


@register(
    "reconcile_counts",
    O.with_(
        O.BRONZE_ORDERS, _FIRST_LOAD_SQL, O.BRONZE_ORDER_LINES, O.SILVER_LINES,
        O.BRONZE_INVOICES, O.BRONZE_INVOICE_LINES, O.SILVER_INVOICE_LINES,
        body=f"""
, src AS (
  SELECT 'sales_orders' AS "table", count(*) AS n FROM orders
  UNION ALL SELECT 'sales_orderlines', count(*) FROM silver_lines
  UNION ALL SELECT 'sales_invoices', count(*) FROM bronze_invoices
  UNION ALL SELECT 'sales_invoicelines', count(*) FROM silver_invoice_lines),
brz AS (
  SELECT 'sales_orders' AS "table",
         (SELECT count(*) FROM first_load) + (SELECT count(*) FROM second_load) AS n
  UNION ALL SELECT 'sales_orderlines', count(*) FROM bronze_lines
  UNION ALL SELECT 'sales_invoices', count(*) FROM bronze_invoices
            WHERE last_edited_when < {_CUTOFF_SQL}
  UNION ALL SELECT 'sales_invoicelines', count(*) FROM bronze_invoice_lines)
SELECT coalesce(s."table", b."table") AS "table",
       CAST(coalesce(s.n, 0) AS BIGINT) AS source, CAST(coalesce(b.n, 0) AS BIGINT) AS bronze,
       CASE WHEN coalesce(s.n, 0) = coalesce(b.n, 0) THEN 'OK'
            WHEN coalesce(b.n, 0) > coalesce(s.n, 0) THEN 'APPEND' ELSE 'DIFF' END AS status
FROM src s FULL OUTER JOIN brz b ON s."table" = b."table"
""",
    ),
)
def q_reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT1, AGG4, JOI4, EXP8: source vs landed row counts with OK/APPEND/DIFF."""
    bronze = quality.table_counts(
        {
            "sales_orders": first_order_load(spark, sf_dir).unionByName(second_order_load(spark, sf_dir)),
            "sales_orderlines": A.bronze_order_lines(spark, sf_dir),
            "sales_invoices": _first_invoice_load(spark, sf_dir),
            "sales_invoicelines": A.bronze_invoice_lines(spark, sf_dir),
        }
    )
    source = quality.table_counts(
        {
            "sales_orders": A.table(spark, sf_dir, "orders"),
            "sales_orderlines": silver_lines(spark, sf_dir),
            "sales_invoices": A.bronze_invoices(spark, sf_dir),
            "sales_invoicelines": silver_invoice_lines(spark, sf_dir),
        }
    )
    return quality.reconcile(bronze, source)


def _silver_profile_tables(spark: SparkSession, sf_dir: str) -> dict[str, quality.ProfiledTable]:
    return {
        "sales_orders": quality.ProfiledTable(silver_orders(spark, sf_dir), ("order_id",)),
        "sales_orderlines": quality.ProfiledTable(silver_lines(spark, sf_dir), ("order_line_id",)),
        "sales_invoices": quality.ProfiledTable(silver_invoices(spark, sf_dir), ("invoice_id",)),
        "sales_invoicelines": quality.ProfiledTable(
            silver_invoice_lines(spark, sf_dir), ("invoice_line_id",)
        ),
    }


@register(
    "layer_profile",
    O.with_(
        *O.ORDERED[:4], *O.BILLED[:4],
        body="""
SELECT 'sales_orders' AS "table", count(*) AS rows, 7 AS cols, '' AS partition_columns,
       CAST(NULL AS BIGINT) AS version FROM silver_orders
UNION ALL SELECT 'sales_orderlines', count(*), 10, '', NULL FROM silver_lines
UNION ALL SELECT 'sales_invoices', count(*), 6, '', NULL FROM silver_invoices
UNION ALL SELECT 'sales_invoicelines', count(*), 10, '', NULL FROM silver_invoice_lines""",
    ),
)
def q_layer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT2: per-table rows and columns of the Silver layer."""
    return quality.profile(_silver_profile_tables(spark, sf_dir))


def _samples_sql() -> str:
    ts = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%g')"
    parts = [
        ("sales_orders", "silver_orders", "order_id",
         "'order_id': order_id, 'customer_id': customer_id, 'salesperson_person_id': salesperson_person_id, "
         "'order_date': order_date, 'order_status': order_status, 'order_priority': order_priority"),
        ("sales_orderlines", "silver_lines", "order_line_id",
         "'order_line_id': order_line_id, 'order_id': order_id, 'stock_item_id': stock_item_id, "
         "'supplier_id': supplier_id, 'description': description, 'quantity': CAST(quantity AS BIGINT)"),
        ("sales_invoices", "silver_invoices", "invoice_id",
         "'invoice_id': invoice_id, 'customer_id': customer_id, 'salesperson_person_id': salesperson_person_id, "
         "'invoice_date': invoice_date, 'is_credit_note': is_credit_note, "
         f"'last_edited_when': {ts.format(c='last_edited_when')}"),
        ("sales_invoicelines", "silver_invoice_lines", "invoice_line_id",
         "'invoice_line_id': invoice_line_id, 'invoice_id': invoice_id, 'stock_item_id': stock_item_id, "
         "'supplier_id': supplier_id, 'description': description, 'quantity': CAST(quantity AS BIGINT)"),
    ]
    body = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"table\", CAST(to_json({{{fields}}}) AS VARCHAR) AS sample "
        f"FROM (SELECT * FROM {cte} ORDER BY {key} LIMIT 3)"
        for name, cte, key, fields in parts
    )
    return O.with_(*O.ORDERED[:4], *O.BILLED[:4], body=body)


@register("layer_samples", _samples_sql())
def q_layer_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT2, TOP1: first 3 rows (by key) x first 6 columns per Silver table, as JSON.

    The three smallest keys are found first, so only their versions are conformed."""
    landed = {
        "sales_orders": A.bronze_orders, "sales_orderlines": A.bronze_order_lines,
        "sales_invoices": A.bronze_invoices, "sales_invoicelines": A.bronze_invoice_lines,
    }
    tables = {}
    for name, read in landed.items():
        raw, spec = read(spark, sf_dir), A.spec(name)
        keys = raw.select(*spec.primary_key).distinct().orderBy(*spec.primary_key).limit(3)
        few = raw.join(keys, list(spec.primary_key), "left_semi")
        rows = silver.conform(few, spec.primary_key, spec.cursor, spec.tiebreakers)
        tables[name] = quality.ProfiledTable(rows, spec.primary_key)
    return quality.samples(tables)


def _portable_hash_sql(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in cols)
    return f"CAST(('0x' || substr(md5(concat_ws(chr(1), {parts})), 1, 15))::UBIGINT AS DECIMAL(38,0))"


_LINE_COLS = [
    "order_line_id", "order_id", "stock_item_id", "supplier_id", "description", "quantity",
    "unit_price", "tax_rate", "picked_quantity", "last_edited_when",
]


@register(
    "table_fingerprint",
    O.with_(
        O.BRONZE_ORDER_LINES, O.SILVER_LINES,
        body=f"""
SELECT count(*) AS rows, coalesce(sum({_portable_hash_sql(_LINE_COLS)}), 0) AS hash_sum
FROM silver_lines""",
    ),
)
def q_table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT3: order-insensitive fingerprint of the conformed order lines."""
    return quality.fingerprint(silver_lines(spark, sf_dir), _LINE_COLS, portable=True)


_DIFF_SQL = """
, before_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_line_id
      ORDER BY last_edited_when DESC NULLS LAST, stock_item_id DESC NULLS LAST,
               supplier_id DESC NULLS LAST) AS rn
    FROM bronze_lines WHERE last_edited_when < {cutoff}) WHERE rn = 1)
SELECT coalesce(a.order_line_id, b.order_line_id) AS order_line_id,
       CASE WHEN b.order_line_id IS NULL THEN 'added'
            WHEN a.order_line_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM before_lines b FULL OUTER JOIN silver_lines a ON a.order_line_id = b.order_line_id
WHERE a.order_line_id IS NULL OR b.order_line_id IS NULL
   OR {distinct}
"""


@register(
    "snapshot_diff",
    O.with_(
        O.BRONZE_ORDER_LINES, O.SILVER_LINES,
        body=_DIFF_SQL.format(
            cutoff=_CUTOFF_SQL,
            distinct=" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _LINE_COLS[1:]),
        ),
    ),
)
def q_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT3: keyed diff of the conformed lines before and after the second load."""
    spec = A.spec("sales_orderlines")
    cutoff = F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    before = silver.conform(
        A.bronze_order_lines(spark, sf_dir).filter(F.col("last_edited_when") < cutoff),
        spec.primary_key, spec.cursor, spec.tiebreakers,
    )
    return quality.snapshot_diff(before, silver_lines(spark, sf_dir), spec.primary_key)


# -- Contracts and documents --------------------------------------------------------------


def _unconformed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as it would be without Silver: every landed version of every line."""
    return gold.fact(gold.ORDERED, A.bronze_orders(spark, sf_dir), A.bronze_order_lines(spark, sf_dir))


def _contract_sql() -> str:
    rules = []
    for f, kind in contracts.FACT_SALES_DOC.fields:
        bad = f"{f} IS NULL"
        if f in ("quantity", "picked_quantity"):
            bad += f" OR CAST(TRY_CAST({f} AS BIGINT) AS DECIMAL(10,0)) <> {f}"
        rules.append(f"SELECT 'invalid:{f}' AS rule, count_if({bad}) AS violations FROM f")
    rules.append(
        "SELECT 'duplicate_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM "
        "(SELECT order_line_id, count(*) AS n FROM f GROUP BY 1 HAVING count(*) > 1)"
    )
    return "\n UNION ALL ".join(rules)


_UNCONFORMED_FACT_SQL = O.fact_sales_sql("f", "bronze_lines", "bronze_orders")


@register(
    "contract_violations",
    O.with_(O.BRONZE_ORDER_LINES, O.BRONZE_ORDERS, _UNCONFORMED_FACT_SQL, body=_contract_sql()),
)
def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CON1-CON4: per-rule violations of the document contract, checked on the fact
    built straight from Bronze (so duplicate keys show up)."""
    return contracts.violation_summary(_unconformed_fact(spark, sf_dir), contracts.FACT_SALES_DOC)


@register(
    "duplicate_keys",
    O.with_(
        O.BRONZE_ORDER_LINES,
        body="SELECT order_line_id, count(*) AS copies FROM bronze_lines GROUP BY 1 HAVING count(*) > 1",
    ),
)
def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CON4: landed order-line keys held by more than one row."""
    return contracts.duplicate_keys(A.bronze_order_lines(spark, sf_dir), ("order_line_id",))


def _doc_json_sql() -> str:
    casts = {"int": "BIGINT", "float": "DOUBLE", "str": "VARCHAR", "date": "DATE"}
    fields = ", ".join(
        f"'{f}': CAST({f} AS {casts[k]})" for f, k in contracts.FACT_SALES_DOC.fields
    )
    return f"SELECT order_line_id AS doc_id, CAST(to_json({{{fields}}}) AS VARCHAR) AS doc FROM fact_sales"


@register("documents_json", O.with_(*O.ORDERED, body=_doc_json_sql()))
def q_documents_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6, EXP7, CON3: contract-typed JSON documents keyed by order line id."""
    return published(spark, fact_sales(spark, sf_dir), contracts.FACT_SALES_DOC)


def published(spark: SparkSession, fact: DataFrame, contract: contracts.Contract) -> DataFrame:
    """The fact published to a work folder (checked in the pass that writes it) and read back."""
    path = work_dir(spark, "documents")
    contracts.publish(fact, contract, path)
    return lake.read_table(spark, path)


# -- Search -------------------------------------------------------------------------------

_TOKENS_SQL = r"regexp_extract_all(lower({col}), '[\p{{L}}\p{{N}}]+')"


def _bm25_sql(docs_sql: str, queries_sql: str, k: int, ctes: tuple[str, ...] = ()) -> str:
    """BM25 top-k per query in SQL; ``docs_sql`` yields (doc_id, text), ``queries_sql``
    (query_id, q); ``ctes`` are defined first (inputs of ``docs_sql``)."""
    toks = _TOKENS_SQL.format(col="text")
    qtoks = _TOKENS_SQL.format(col="q")
    prefix = "".join(c.strip() + ",\n" for c in ctes)
    return f"""
WITH {prefix}d AS (SELECT doc_id, {toks} AS toks FROM ({docs_sql})),
stats AS (SELECT count(*) AS n, CAST(sum(len(toks)) AS DOUBLE) / count(*) AS avgdl FROM d),
post AS (SELECT term, doc_id, dl, count(*) AS tf FROM
          (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM d) GROUP BY ALL),
qt AS (SELECT query_id, term, count(*) AS qtf FROM
        (SELECT query_id, unnest({qtoks}) AS term FROM ({queries_sql})) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM post WHERE term IN (SELECT term FROM qt) GROUP BY term),
scored AS (
  SELECT qt.query_id, p.doc_id,
         round(sum(qt.qtf * (ln(1.0::DOUBLE + (s.n - dfs.df + 0.5::DOUBLE) / (dfs.df + 0.5::DOUBLE))
                   * (p.tf * 2.2::DOUBLE)
                   / (p.tf + 1.2::DOUBLE * (1.0::DOUBLE - 0.75::DOUBLE + 0.75::DOUBLE * p.dl / s.avgdl)))), 6)
           AS score
  FROM qt JOIN dfs USING (term) JOIN post p USING (term) CROSS JOIN stats s
  GROUP BY qt.query_id, p.doc_id),
ranked AS (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank,
         count(*) OVER (PARTITION BY query_id) AS total
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score, total FROM ranked WHERE rank <= {k}"""


SEARCH_K = 10


@register(
    "search_ranked",
    _bm25_sql(
        "SELECT doc_id, text FROM documents",
        "SELECT item_id AS query_id, text AS q FROM benchmark",
        SEARCH_K,
    ),
)
def q_search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA2, SEA3, TOP2: BM25 top-10 documents for every benchmark passage."""
    queries = A.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("q")
    )
    return search.search_text(A.table(spark, sf_dir, "documents"), queries, k=SEARCH_K)


# The language whose documents the third publish takes out again.
REMOVED_LANG = "fr"


@register(
    "search_block_max",
    _bm25_sql(
        f"SELECT doc_id, text FROM documents WHERE lang IS DISTINCT FROM '{REMOVED_LANG}'",
        "SELECT item_id AS query_id, text AS q FROM benchmark",
        SEARCH_K,
    ),
)
def q_search_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA2, SEA3, TOP2, SNK6: top-10 documents from the block index after three publishes: all
    documents, some of them cut short, then their whole texts, then a language removed."""
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    short = F.length("text") > 2000
    root = work_dir(spark, "search_block_max")
    block_index.publish(docs.withColumn("text", F.when(short, F.substring("text", 1, 500)).otherwise(F.col("text"))), root)
    block_index.publish(docs.filter(short), root)
    gone = docs.filter(F.col("lang") == REMOVED_LANG).withColumn("deleted", F.lit(True))
    block_index.publish(gone, root, deleted_col="deleted")
    queries = A.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("q"))
    return block_index.search(spark, root, queries, k=SEARCH_K)[0]


SALES_K = 5


@register(
    "search_sales",
    _bm25_sql(
        "SELECT order_line_id AS doc_id, description AS text FROM fact_sales",
        "SELECT DISTINCT p_name AS query_id, p_name AS q FROM part",
        SALES_K,
        ctes=O.ORDERED,
    ),
)
def q_search_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA1, SEA3, FIL4: full-text search of order-line descriptions, one query per
    distinct part name, top 5 with the total number of matches."""
    queries = A.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("query_id"), F.col("p_name").alias("q")
    ).distinct()
    return search.search_texts(fact_sales(spark, sf_dir), queries, "order_line_id", "description", k=SALES_K)


# Parameters: one request per combination of the three optional arguments, 0 counting as given.
REQUESTS = tuple(
    (n, q, customer, least)
    for n, (q, customer, least) in enumerate(
        [(q, customer, least) for q in (None, "plate red") for customer in (None, 7) for least in (None, 25000.0)]
        + [("", None, 0.0), ("plate red", 7, 0.0)]
    )
)


def _combined_sql() -> str:
    lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)
    values = ", ".join(f"({n}, {lit(q)}, {lit(c)}, {lit(m)})" for n, q, c, m in REQUESTS)
    text = _bm25_sql(
        "SELECT order_line_id AS doc_id, description AS text FROM fact_sales",
        "SELECT query_id, q FROM requests WHERE q <> ''", 10**12,
        ctes=(*O.ORDERED, f"requests AS (SELECT * FROM (VALUES {values}) AS t(query_id, q, customer_id, min_total))"),
    )
    return f"""
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score, total FROM (
  SELECT h.query_id, h.doc_id, h.score,
         row_number() OVER (PARTITION BY h.query_id ORDER BY h.score DESC, h.doc_id) AS rank,
         count(*) OVER (PARTITION BY h.query_id) AS total
  FROM (SELECT query_id, doc_id, score FROM ({text.strip()})
        UNION ALL SELECT r.query_id, f.order_line_id, 1.0::DOUBLE
        FROM (SELECT * FROM (VALUES {values}) AS t(query_id, q, customer_id, min_total)) r, ({_FACT_SUBQUERY}) f
        WHERE coalesce(r.q, '') = '') h
  JOIN (SELECT * FROM (VALUES {values}) AS t(query_id, q, customer_id, min_total)) r ON r.query_id = h.query_id
  JOIN ({_FACT_SUBQUERY}) f ON f.order_line_id = h.doc_id
  WHERE (r.customer_id IS NULL OR f.customer_id = r.customer_id)
    AND (r.min_total IS NULL OR f.line_total >= r.min_total))
WHERE rank <= {SEARCH_K}"""


_FACT_SUBQUERY = O.with_(*O.ORDERED, body="SELECT order_line_id, customer_id, line_total FROM fact_sales")


@register("search_combined", _combined_sql())
def q_search_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA1, SEA3, FIL3, FIL4, CON5: every combination of text, customer and minimum total,
    each served from the published postings, filters and documents."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "search_combined")))
    lake.write_table(fact_sales(spark, sf_dir), ctx.layout.path("gold", "fact_sales"), name="fact_sales")
    stages.publish_documents(ctx)
    found = None
    for n, q, customer, least in REQUESTS:
        total, rows = stages.serve_search(ctx, q, customer, least, SEARCH_K)
        order = Window.orderBy(F.col("score").desc(), F.col("doc_id"))  # at most SEARCH_K rows
        one = rows.select(
            F.lit(n).alias("query_id"), F.row_number().over(order).alias("rank"), "doc_id", "score",
            F.lit(total).cast("long").alias("total"),
        )
        found = one if found is None else found.union(one)
    return found


# Parameter: the filtered search asks for lines of at least this total.
MIN_TOTAL = 25000.0


@register(
    "search_filtered",
    O.with_(
        *O.ORDERED,
        body=f"""
, m AS (SELECT c.c_custkey AS query_id, f.order_line_id AS doc_id
        FROM customer c JOIN fact_sales f ON f.customer_id = c.c_custkey
        WHERE f.line_total >= {MIN_TOTAL}),
r AS (SELECT query_id, doc_id,
             row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rank,
             count(*) OVER (PARTITION BY query_id) AS total FROM m)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, 1.0::DOUBLE AS score, total
FROM r WHERE rank <= {SEARCH_K}""",
    ),
)
def q_search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA1, FIL3, FIL4, CON5: match-all search per customer with a minimum line
    total; top 10 by id plus the total number of matches."""
    queries = A.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("query_id"),
        F.col("c_custkey").alias("customer_id"),
        F.lit(MIN_TOTAL).alias("min_total"),
    )
    docs = fact_sales(spark, sf_dir).select(
        "order_line_id", F.col("customer_id").alias("doc_customer_id"), "line_total"
    )
    return search.search_filtered(
        docs, queries, "order_line_id", ("customer_id", "doc_customer_id"),
        filters=[("min_total", "gte", "line_total")], k=SEARCH_K,
    )


@register(
    "lookup_by_id",
    O.with_(
        *O.ORDERED,
        body="""
, ids AS (SELECT DISTINCT o_orderkey * 10 + 1 AS order_line_id FROM orders)
SELECT ids.order_line_id, f.description, f.customer_id, f.line_total,
       f.order_line_id IS NOT NULL AS found
FROM ids LEFT JOIN fact_sales f ON f.order_line_id = ids.order_line_id""",
    ),
)
def q_lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA5: get line 1 of every order by id; ``found`` is false where there is none."""
    ids = A.table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 10 + 1).alias("order_line_id"))
    docs = fact_sales(spark, sf_dir).select("order_line_id", "description", "customer_id", "line_total")
    return search.get_by_ids(ids, docs, "order_line_id")


@register(
    "description_facets",
    O.with_(*O.ORDERED, body="SELECT description, count(*) AS docs FROM fact_sales GROUP BY 1"),
)
def q_description_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA4: exact-value buckets of the description keyword."""
    return search.facets(fact_sales(spark, sf_dir), "description")


# -- Run log ---------------------------------------------------------------------------------


@register(
    "run_metrics",
    """SELECT CAST(user_id AS VARCHAR) AS correlation_id, event_type AS "table",
              count(*) AS events,
              sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS rows,
              min(ts) AS first_ts, max(ts) AS last_ts
       FROM events GROUP BY 1, 2""",
)
def q_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS1, EXP9: events per (run, table) with the rows each reported."""
    ev = A.table(spark, sf_dir, "events").select(
        F.col("ts"),
        F.col("user_id").cast("string").alias("correlation_id"),
        F.col("event_type").alias("table"),
        runlog.json_metric(F.col("props"), "k").alias("rows"),
    )
    return runlog.run_metrics(ev)


# -- Streaming --------------------------------------------------------------------------------

_CDC_COLLAPSE_SQL = ORACLES["silver_cdc_collapse"]


LANDINGS = 3


@register("stream_collapse", _CDC_COLLAPSE_SQL)
def q_stream_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1-STR3: the change feed lands in several steps, out of order and once repeated; each
    step is a run of the stateful stream, whose state crosses runs and a compaction. The
    current state equals the batch collapse."""
    root = work_dir(spark, "stream_collapse")
    # Landings are cut by a hash of the row, so each one holds changes out of LSN order.
    feed = A.change_feed(spark, sf_dir)
    part = F.pmod(F.xxhash64("event_id"), F.lit(LANDINGS))
    for n in range(LANDINGS):
        feed.filter(part == n).repartition(F.xxhash64("event_id")).write.mode("append").parquet(f"{root}/feed")
        if n == 1:  # a replay: rows of the landing before once more
            feed.filter(part == 0).write.mode("append").parquet(f"{root}/feed")
        cdc_stream.run_stream(
            spark, f"{root}/feed", feed.schema, ["user_id"], f"{root}/sink", f"{root}/checkpoint", tiebreakers=("event_id",)
        )
        if n == 1:
            cdc_stream.compact(spark, f"{root}/sink", ["user_id"])
    cdc_stream.compact(spark, f"{root}/sink", ["user_id"])
    return cdc_stream.current_state(spark, f"{root}/sink", ["user_id"])


# -- Extensions -------------------------------------------------------------------------------


_HISTORY_SQL = O.with_(
    O.BRONZE_ORDER_LINES,
    body="""
SELECT *, last_edited_when AS valid_from,
       lead(last_edited_when) OVER w AS valid_to,
       lead(order_line_id) OVER w IS NULL AS is_current
FROM bronze_lines
WINDOW w AS (PARTITION BY order_line_id
             ORDER BY last_edited_when, stock_item_id, supplier_id)""",
)


@register("scd2_history", _HISTORY_SQL)
def q_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT3: validity range of every landed version of every order line."""
    spec = A.spec("sales_orderlines")
    return history.scd2_history(
        A.bronze_order_lines(spark, sf_dir), spec.primary_key, spec.cursor, spec.tiebreakers
    )


@register("history_batches", _HISTORY_SQL)
def q_history_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT3: the same history kept by three loads whose versions come in any order of time, one
    load sent twice, and a compaction between them."""
    spec = A.spec("sales_orderlines")
    lines = A.bronze_order_lines(spark, sf_dir)
    root = work_dir(spark, "history_batches")
    # The landing is computed once, a folder for each load.
    landed = work_dir(spark, "history_landing")
    part = F.pmod(F.xxhash64(*lines.columns), F.lit(3))
    lines.withColumn("_load", part.cast("int")).write.partitionBy("_load").parquet(landed)
    loads = spark.read.schema(StructType([*lines.schema, StructField("_load", IntegerType())])).parquet(landed)
    for load_id in (2, 0, 0, 1):
        batch = loads.filter(F.col("_load") == load_id).drop("_load")
        history_store.merge(batch, root, load_id, spec.primary_key, spec.cursor, spec.tiebreakers, written=True)
        if load_id == 0:
            history_store.compact(spark, root)
    return history_store.current(spark, root)


# Parameter: a line is looked up this many days after its order.
ASOF_DAYS = 60


@register(
    "history_asof",
    O.with_(
        O.BRONZE_ORDER_LINES,
        body=f"""
, f AS (SELECT DISTINCT b.order_line_id, o.o_orderdate + INTERVAL {ASOF_DAYS} DAY AS seen_at
        FROM bronze_lines b JOIN orders o ON o.o_orderkey = b.order_id),
r AS (SELECT f.order_line_id, f.seen_at, b.last_edited_when, b.stock_item_id, b.supplier_id,
             row_number() OVER (PARTITION BY f.order_line_id, f.seen_at ORDER BY b.last_edited_when DESC,
                                b.stock_item_id DESC, b.supplier_id DESC) AS n
      FROM f LEFT JOIN bronze_lines b
        ON b.order_line_id = f.order_line_id AND b.last_edited_when <= f.seen_at)
SELECT order_line_id, seen_at, last_edited_when, stock_item_id, supplier_id FROM r WHERE n = 1""",
    ),
)
def q_history_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT3: the version every order line had two months after its order, if there was one."""
    spec = A.spec("sales_orderlines")
    lines = A.bronze_order_lines(spark, sf_dir).select("order_line_id", "order_id", "last_edited_when", "stock_item_id", "supplier_id")
    orders = A.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate") + F.expr(f"INTERVAL '{ASOF_DAYS}' DAY")
    ).toDF("order_id", "seen_at")
    facts = lines.select("order_line_id", "order_id").join(orders, "order_id").select("order_line_id", "seen_at").distinct()
    found = history_store.as_of(facts, lines, spec.primary_key, "seen_at", spec.cursor, spec.tiebreakers)
    return found.select("fact.*", "version.last_edited_when", "version.stock_item_id", "version.supplier_id")


_DQ_RULES = (
    quality.Rule("order_line_id_not_null", "not_null", "order_line_id"),
    quality.Rule("description_not_null", "not_null", "description"),
    quality.Rule("quantity_in_range", "range", "quantity", low=1, high=50),
    quality.Rule("tax_rate_in_range", "range", "tax_rate", low=0, high=8),
    quality.Rule("order_line_id_unique", "unique", "order_line_id"),
    quality.Rule("volume", "min_rows", threshold=1000),
    quality.Rule("fresh", "freshness", "last_edited_when", threshold="2001-01-01 00:00:00"),
    quality.Rule("columns", "schema", threshold=",".join(_LINE_COLS)),
)


@register(
    "dq_gate",
    O.with_(
        O.BRONZE_ORDER_LINES, O.SILVER_LINES,
        body="""
, r AS (
  SELECT 'order_line_id_not_null' AS rule, 'not_null' AS kind, count_if(order_line_id IS NULL) AS failures FROM silver_lines
  UNION ALL SELECT 'description_not_null', 'not_null', count_if(description IS NULL) FROM silver_lines
  UNION ALL SELECT 'quantity_in_range', 'range', count_if(quantity < 1 OR quantity > 50) FROM silver_lines
  UNION ALL SELECT 'tax_rate_in_range', 'range', count_if(tax_rate < 0 OR tax_rate > 8) FROM silver_lines
  UNION ALL SELECT 'order_line_id_unique', 'unique', count(*) FROM
    (SELECT order_line_id FROM silver_lines GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'volume', 'min_rows', CASE WHEN count(*) >= 1000 THEN 0 ELSE 1 END FROM silver_lines
  UNION ALL SELECT 'fresh', 'freshness',
    CASE WHEN max(last_edited_when) >= TIMESTAMP '2001-01-01 00:00:00' THEN 0 ELSE 1 END FROM silver_lines
  UNION ALL SELECT 'columns', 'schema', 0)
SELECT rule, kind, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM r""",
    ),
)
def q_dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT2: quality gate between Bronze and Silver (nulls, ranges, keys, volume,
    freshness, schema) as one report row per rule."""
    return quality.quality_report(silver_lines(spark, sf_dir), _DQ_RULES)


# Parameter: the month re-computed by the backfill.
_DRIFT_COLUMNS = ("quantity", "unit_price", "tax_rate", "picked_quantity")


def _drift_sql() -> str:
    """Exact Kolmogorov-Smirnov statistics, against the limit and the sketches' error."""
    each = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", late, CAST({c} AS DOUBLE) AS x FROM (SELECT *, last_edited_when >= {_CUTOFF_SQL} AS late FROM bronze_lines)"""
        for c in _DRIFT_COLUMNS
    )
    limit = drift.Limits().ks + 2 * drift.RANK_ERROR
    return O.with_(
        O.BRONZE_ORDER_LINES,
        body=f"""
, v AS ({each}),
g AS (SELECT "column", x, count(*) FILTER (WHERE late) AS a, count(*) FILTER (WHERE NOT late) AS e FROM v WHERE x IS NOT NULL GROUP BY ALL),
c AS (SELECT "column", abs(sum(a) OVER up / sum(a) OVER (PARTITION BY "column") - sum(e) OVER up / sum(e) OVER (PARTITION BY "column")) AS d
      FROM g WINDOW up AS (PARTITION BY "column" ORDER BY x)),
n AS (SELECT "column", count(*) FILTER (WHERE late) AS rows FROM v GROUP BY "column")
SELECT "column", n.rows, max(d) <= {limit} AS passed FROM c JOIN n USING ("column") GROUP BY "column", n.rows""",
    )


@register("dq_drift", _drift_sql())
def q_dq_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT2: the later load of order lines against the distributions of the first one."""
    lines = A.bronze_order_lines(spark, sf_dir)
    late = F.col("last_edited_when") >= F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    accepted, load = drift.profile(lines.filter(~late), _DRIFT_COLUMNS), drift.profile(lines.filter(late), _DRIFT_COLUMNS)
    return drift.report(accepted, load).select("column", "rows", "passed")


BACKFILL_START = dt.date(1997, 12, 5)
BACKFILL_END = dt.date(1997, 12, 20)


def _before_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = A.spec("sales_orderlines")
    cutoff = F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    return silver.conform(
        A.bronze_order_lines(spark, sf_dir).filter(F.col("last_edited_when") < cutoff),
        spec.primary_key, spec.cursor, spec.tiebreakers,
    )


_BEFORE_LINES_SQL = f"""
before_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_line_id
      ORDER BY last_edited_when DESC NULLS LAST, stock_item_id DESC NULLS LAST,
               supplier_id DESC NULLS LAST) AS rn
    FROM bronze_lines WHERE last_edited_when < {_CUTOFF_SQL}) WHERE rn = 1)"""

_OLD_FACT_SQL = O.fact_sales_sql("old_fact", "before_lines")


@register(
    "backfill_month",
    O.with_(
        *O.ORDERED, _BEFORE_LINES_SQL, _OLD_FACT_SQL,
        body="""
SELECT * FROM old_fact WHERE NOT (order_year = 1997 AND order_month = 12)
UNION ALL
SELECT * FROM fact_sales WHERE order_year = 1997 AND order_month = 12""",
    ),
)
def q_backfill_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT1: the fact written from an early Silver, then one month re-computed from
    the current Silver with dynamic partition overwrite; other months unchanged."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "backfill_month")))
    path = ctx.layout.path("gold", "fact_sales")
    old = gold.fact(gold.ORDERED, silver_orders(spark, sf_dir), _before_lines(spark, sf_dir))
    lake.write_table(old, path, partition_by=gold.ORDERED.months, name="fact_sales")
    stages.replace_months(ctx, gold.ORDERED, fact_sales(spark, sf_dir), BACKFILL_START, BACKFILL_END)
    return spark.read.parquet(path)


# Orders of the first two months of 1997: one is thinned out by a later correction, one emptied.
_THINNED, _EMPTIED = "1997-01", "1997-02"


def _corrected_sql(day: str, key: str) -> str:
    month = f"strftime({day}, '%Y-%m')"
    return f"NOT ({month} = '{_EMPTIED}' OR ({month} = '{_THINNED}' AND {key} % 2 = 0))"


@register(
    "stage_backfill",
    O.with_(
        *O.ORDERED, *O.BILLED,
        body=f"""
, kept AS (SELECT 'ordered' AS mart, order_date AS day, count(DISTINCT order_id) AS documents,
                  count(*) AS lines, round(sum(line_total), 2) AS revenue
           FROM fact_sales WHERE {_corrected_sql("order_date", "order_id")} GROUP BY 2
           UNION ALL
           SELECT 'billed', invoice_date, count(DISTINCT invoice_id), count(*), round(sum(line_total), 2)
           FROM fact_invoices WHERE {_corrected_sql("invoice_date", "invoice_id")} GROUP BY 2)
SELECT mart, day, documents, lines, revenue, lines AS fact_lines FROM kept""",
    ),
)
def q_stage_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT1: both marts are built, then Silver headers of two months are corrected (one month
    thinned out, one emptied) and the months backfilled: facts and roll-ups follow."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "stage_backfill")), specs=A.SPECS)
    silver_tables = {
        "sales_orders": silver_orders, "sales_orderlines": silver_lines,
        "sales_invoices": silver_invoices, "sales_invoicelines": silver_invoice_lines,
    }
    for name, build in silver_tables.items():
        lake.write_table(build(spark, sf_dir), ctx.layout.path("silver", name), name=name)
    stages.build_gold(ctx)
    for mart in gold.MARTS:
        month = F.date_format(mart.day, "yyyy-MM")
        gone = (month == _EMPTIED) | ((month == _THINNED) & (F.col(mart.key) % 2 == 0))
        headers = silver_tables[mart.headers](spark, sf_dir).filter(~gone)
        lake.write_table(headers, ctx.layout.path("silver", mart.headers), name=mart.headers)
    stages.backfill_gold(ctx, dt.date(1997, 1, 10), dt.date(1997, 2, 3))
    return _mart_days(ctx)


def _before_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = A.spec("sales_invoicelines")
    cutoff = F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    return silver.conform(
        A.bronze_invoice_lines(spark, sf_dir).filter(F.col("last_edited_when") < cutoff), spec.primary_key, spec.cursor, spec.tiebreakers
    )


def _mart_days(ctx: stages.RunContext) -> DataFrame:
    """Roll-ups of both marts with the number of lines that their facts hold."""
    out = None
    for name, mart in (("ordered", gold.ORDERED), ("billed", gold.BILLED)):
        lines = ctx.read("gold", mart.fact).groupBy(F.col(mart.day).alias("day")).agg(F.count(F.lit(1)).alias("fact_lines"))
        days = ctx.read("gold", mart.daily).select(
            F.lit(name).alias("mart"), F.col(mart.day).alias("day"), F.col(mart.documents).alias("documents"),
            F.col("num_lines").alias("lines"), F.col("total_revenue").alias("revenue"),
        ).join(lines, "day", "full_outer").select("mart", "day", "documents", "lines", "revenue", "fact_lines")
        out = days if out is None else out.unionByName(days)
    return out


def _conformed(mart: gold.Mart, lines: DataFrame) -> DataFrame:
    spec = A.spec(mart.lines)
    return silver.conform(lines, spec.primary_key, spec.cursor, spec.tiebreakers)


@register("gold_refresh", ORACLES["stage_backfill"])
def q_gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1, AGG2, EXT1: both marts are built from an early Silver; the later versions of lines
    and then corrected headers (a month thinned out, one emptied) arrive as signed changes."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "gold_refresh_query")), specs=A.SPECS)
    tables = {
        gold.ORDERED: (silver_orders, A.bronze_order_lines),
        gold.BILLED: (silver_invoices, A.bronze_invoice_lines),
    }
    early = F.col("last_edited_when") < F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    landed = {}  # computed once, for the lines before and after
    for mart, (headers, lines) in tables.items():
        landed[mart] = gold_refresh.kept(lines(spark, sf_dir), (mart.line_key,))
        by = (mart.key,)
        lake.write_table(headers(spark, sf_dir), ctx.layout.path("silver", mart.headers), name=mart.headers, bucket_by=by)
        lake.write_table(_conformed(mart, landed[mart].filter(early)), ctx.layout.path("silver", mart.lines), name=mart.lines, bucket_by=by)
    stages.build_gold(ctx)

    def kept(mart: gold.Mart) -> None:
        gold_refresh.start(ctx, mart)
        heads, old = ctx.read_bucketed("silver", mart.headers), ctx.read_bucketed("silver", mart.lines)
        new = gold_refresh.kept(_conformed(mart, landed[mart]), (mart.key,))
        d_lines = gold_refresh.signed(old, new, [mart.line_key])
        gold_refresh.refresh(ctx, mart, heads, gold_refresh.signed(heads, heads, [mart.key]), new, d_lines)
        month = F.date_format(mart.day, "yyyy-MM")
        gone = (month == _EMPTIED) | ((month == _THINNED) & (F.col(mart.key) % 2 == 0))
        d_heads = gold_refresh.signed(heads, heads.filter(~gone), [mart.key])
        gold_refresh.refresh(ctx, mart, heads, d_heads, new, gold_refresh.signed(new, new, [mart.line_key]))

    stages.concurrently(kept, list(tables))  # the marts share no table
    return _mart_days(ctx)


@register(
    "ordered_vs_billed",
    O.with_(
        *O.ORDERED, O.AGG_SALES_DAILY, *O.BILLED, O.AGG_BILLED_DAILY,
        body="""
SELECT coalesce(d.order_date, b.invoice_date) AS sales_date, d.num_orders,
       d.total_revenue AS ordered_revenue, b.num_invoices,
       b.total_revenue AS billed_revenue, b.total_profit AS billed_profit,
       coalesce(d.total_revenue, 0) - coalesce(b.total_revenue, 0) AS revenue_gap
FROM agg_sales_daily d FULL OUTER JOIN agg_billed_daily b ON d.order_date = b.invoice_date""",
    ),
)
def q_ordered_vs_billed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT6: ordered demand against billed actuals per day."""
    daily = gold.daily(gold.ORDERED, fact_sales(spark, sf_dir))
    billed = gold.daily(gold.BILLED, fact_invoices(spark, sf_dir))
    return gold.ordered_vs_billed(daily, billed)


def _invoice_doc_sql() -> str:
    casts = {"int": "BIGINT", "float": "DOUBLE", "str": "VARCHAR", "date": "DATE", "bool": "BOOLEAN"}
    fields = ", ".join(
        f"'{f}': CAST({f} AS {casts[k]})" for f, k in contracts.FACT_INVOICES_DOC.fields
    )
    return (
        f"SELECT invoice_line_id AS doc_id, CAST(to_json({{{fields}}}) AS VARCHAR) AS doc "
        "FROM fact_invoices"
    )


@register("invoice_documents_json", O.with_(*O.BILLED, body=_invoice_doc_sql()))
def q_invoice_documents_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT4: the billed fact published as contract-checked documents."""
    return published(spark, fact_invoices(spark, sf_dir), contracts.FACT_INVOICES_DOC)


# -- Staged run ------------------------------------------------------------------------------


@register("staged_run_daily", ORACLES["agg_sales_daily"])
def q_staged_run_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages on files: two incremental loads into Bronze, Silver, Gold; the written
    daily roll-up equals the one computed in a single plan."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "staged_run")), specs=A.SPECS)
    stages.run(ctx, "extract", sources=A.landing_sources(spark, sf_dir, FIRST_LOAD_CUTOFF), load_id=1)
    stages.run(ctx, "extract", sources=A.landing_sources(spark, sf_dir, None), load_id=2)
    stages.run(ctx, "all")
    return lake.read_table(spark, ctx.layout.path("gold", "agg_sales_daily"))


@register("staged_cdc_current", _CDC_COLLAPSE_SQL)
def q_staged_cdc_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2, SNK2, WIN3: the change table landed by two loads (the second takes what came after
    the first one's last LSN) and collapsed; equals the collapse of the whole feed."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "staged_cdc")), feed_specs=A.FEED_SPECS)
    changes, name = A.change_table(spark, sf_dir), A.FEED_SPECS[0].name
    early = changes.filter(F.col(cdc.CT_START_LSN) <= F.unhex(F.lit(CDC_LAST_LSN)))
    stages.run(ctx, "extract-cdc", change_tables={name: early}, load_id=1)
    stages.run(ctx, "extract-cdc", change_tables={name: changes}, load_id=2)
    stages.run(ctx, "silver-cdc")
    return ctx.read("silver", name, ctx.layout.cdc)


# Orders that arrive without a key or without a cursor.
_NO_KEY, _NO_CURSOR = "o_orderkey % 101 = 3", "o_orderkey % 97 = 5"


@register(
    "stage_rejects",
    f"""
WITH o AS (SELECT ({_NO_KEY}) AS no_key, ({_NO_CURSOR}) AS no_cursor, o_orderdate FROM orders),
l AS (SELECT *, (o_orderdate < {_CUTOFF_SQL} OR no_cursor) AS first FROM o)
SELECT 'sales_orders' AS "table", count(*) AS landed, count_if(no_cursor) AS without_cursor,
       count_if(no_key) AS rejected, count(*) - count_if(no_key) AS kept FROM l""",
)
def q_stage_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING2, WIN2: rows without a cursor land once over two loads, rows without a key are set
    aside and counted; nothing is dropped in silence."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "stage_rejects")), specs=(A.spec("sales_orders"),))
    source = A.table(spark, sf_dir, "orders").select(
        F.when(~F.expr(_NO_KEY), F.col("o_orderkey")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(~F.expr(_NO_CURSOR), F.col("o_orderdate")).alias("last_edited_when"),
    )
    cutoff = F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz")
    early = source.filter((F.col("last_edited_when") < cutoff) | F.col("last_edited_when").isNull())
    stages.run(ctx, "extract", sources={"sales_orders": early}, load_id=1)
    stages.run(ctx, "extract", sources={"sales_orders": source}, load_id=2)
    stages.run(ctx, "silver")
    landed = ctx.read("bronze", "sales_orders").agg(
        F.count(F.lit(1)).alias("landed"), F.count_if(F.col("last_edited_when").isNull()).alias("without_cursor")
    )
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    rejected = count(lake.read_table(spark, ctx.layout.rejected("sales_orders")), "rejected")
    kept = count(ctx.read("silver", "sales_orders"), "kept")
    one = [df.withColumn("__one", F.lit(1)) for df in (landed, rejected, kept)]  # one row each
    return one[0].join(one[1], "__one").join(one[2], "__one").select(
        F.lit("sales_orders").alias("table"), "landed", "without_cursor", "rejected", "kept"
    )


@register(
    "stage_verify",
    f"""
SELECT 'sales_orders' AS "table", count(*) AS source, count(*) AS bronze, 'OK' AS status FROM orders
UNION ALL
SELECT 'sales_orderlines', count(*), count_if(l_shipdate < {_CUTOFF_SQL}),
       CASE WHEN count(*) = count_if(l_shipdate < {_CUTOFF_SQL}) THEN 'OK' ELSE 'DIFF' END
FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def q_stage_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT1: a written lake against its source; the lines' last load has not run yet."""
    specs = tuple(s for s in A.SPECS if s.name in ("sales_orders", "sales_orderlines"))
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "stage_verify")), specs=specs)
    every = A.landing_sources(spark, sf_dir, None)
    early = A.landing_sources(spark, sf_dir, FIRST_LOAD_CUTOFF)
    stages.run(ctx, "extract", sources={s.name: early[s.name] for s in specs}, load_id=1)
    stages.run(ctx, "extract", sources={"sales_orders": every["sales_orders"]}, load_id=2)
    return stages.verify(ctx, {s.name: every[s.name] for s in specs})


# Parameters of the losses: a week of orders that never landed, a customer removed at the source.
LOST_DAYS = ("1995-06-12", "1995-06-18")
REMOVED_CUSTOMER = 7


@register(
    "missing_keys",
    O.with_(
        O.BRONZE_ORDER_LINES,
        body=f"""
, landed AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '{LOST_DAYS[0]}' AND DATE '{LOST_DAYS[1]}'),
kept AS (SELECT * FROM orders WHERE o_custkey <> {REMOVED_CUSTOMER})
SELECT 'sales_orders' AS "table", '{{"order_id":' || o_orderkey || '}}' AS key, 'missing' AS state
FROM kept WHERE o_orderkey NOT IN (SELECT o_orderkey FROM landed)
UNION ALL SELECT 'sales_orders', '{{"order_id":' || o_orderkey || '}}', 'extra'
FROM landed WHERE o_orderkey NOT IN (SELECT o_orderkey FROM kept)
UNION ALL SELECT 'sales_orderlines', '{{"order_line_id":' || order_line_id || '}}', 'missing'
FROM bronze_lines GROUP BY order_line_id HAVING min(last_edited_when) >= {_CUTOFF_SQL}""",
    ),
)
def q_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT1: the keys behind a DIFF. Orders lack a lost week and hold a customer that the source
    no longer has (decoded from sketches); the lines' last load has not run (compared exactly)."""
    specs = tuple(s for s in A.SPECS if s.name in ("sales_orders", "sales_orderlines"))
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "missing_keys")), specs=specs)
    every, early = A.landing_sources(spark, sf_dir, None), A.landing_sources(spark, sf_dir, FIRST_LOAD_CUTOFF)
    orders = every["sales_orders"]
    first, last = (F.lit(d).cast("date") for d in LOST_DAYS)
    landing = {"sales_orders": orders.filter(~F.col("OrderDate").between(first, last)), "sales_orderlines": early["sales_orderlines"]}
    stages.run(ctx, "extract", sources=landing, load_id=1)
    source = {"sales_orders": orders.filter(F.col("CustomerID") != REMOVED_CUSTOMER), "sales_orderlines": every["sales_orderlines"]}
    return stages.missing_keys(ctx, source)


@register(
    "run_log_roundtrip",
    """
SELECT 'load landed' AS msg, 'sales_orders' AS "table", count(*) AS rows, CAST(1 AS VARCHAR) AS load_id FROM orders
UNION ALL SELECT 'table conformed', 'sales_orders', count(*), NULL FROM orders
UNION ALL SELECT 'stage finished', NULL, NULL, NULL UNION ALL SELECT 'stage finished', NULL, NULL, NULL""",
)
def q_run_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS1, EXP9, EXT5: the stages' JSON-lines log, read back and parsed."""
    specs = (A.spec("sales_orders"),)
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "run_log")), specs=specs)
    stages.run(ctx, "extract", sources={"sales_orders": A.bronze_orders(spark, sf_dir)}, load_id=1)
    stages.run(ctx, "silver")
    return stages.run_log(ctx).select("msg", "table", "rows", F.col("extras").getItem("load_id").alias("load_id"))


@register(
    "run_times",
    """
SELECT 'load landed' AS msg, 'sales_orders' AS name, count(*) AS rows, false AS timed FROM orders
UNION ALL SELECT 'table conformed', 'sales_orders', count(*), false FROM orders
UNION ALL SELECT 'stage finished', 'extract', NULL, true UNION ALL SELECT 'stage finished', 'silver', NULL, true""",
)
def q_run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT5: metrics and times of the stages' runs, from the runs table they leave."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "run_times")), specs=(A.spec("sales_orders"),))
    stages.run(ctx, "extract", sources={"sales_orders": A.bronze_orders(spark, sf_dir)}, load_id=1)
    stages.run(ctx, "silver")
    return lake.read_table(spark, ctx.layout.runs).select("msg", "name", "rows", F.coalesce(F.col("seconds") > 0, F.lit(False)).alias("timed"))


@register(
    "snapshot_accept",
    O.with_(
        *O.ORDERED, O.AGG_SALES_DAILY,
        body="""
SELECT 'fact_sales' AS "table", CAST(order_line_id AS VARCHAR) AS key, 'removed' AS change
FROM fact_sales WHERE strftime(order_date, '%Y-%m') = '1997-12' AND day(order_date) <= 15
UNION ALL
SELECT 'agg_sales_daily', CAST(order_date AS VARCHAR), 'removed'
FROM agg_sales_daily WHERE strftime(order_date, '%Y-%m') = '1997-12' AND day(order_date) <= 15""",
    ),
)
def q_snapshot_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT3: Gold is accepted as a baseline (any change against itself would be a row); after a
    correction of one month the changed keys of every changed table, from its hash tree."""
    ctx = stages.RunContext.start(spark, stages.Layout(work_dir(spark, "snapshot")), specs=A.SPECS)
    mart, trees = gold.ORDERED, work_dir(spark, "snapshot_trees")
    kept = {
        mart.fact: (mart.line_key, merkle.ranged(mart.line_key, 1000)),
        mart.daily: (mart.day, merkle.hashed([mart.day])),
    }

    def roll_up_and_keep(step: str) -> None:
        lake.write_table(gold.daily(mart, ctx.read("gold", mart.fact)), ctx.layout.path("gold", mart.daily), name=mart.daily)
        for table, (key, leaf) in kept.items():
            merkle.save(ctx.read("gold", table), f"{trees}/{step}/{table}", [key], leaf=leaf)

    fact = gold.fact(mart, silver_orders(spark, sf_dir), silver_lines(spark, sf_dir), spread=True)
    lake.write_table(fact, ctx.layout.path("gold", mart.fact), partition_by=mart.months, name=mart.fact, spread=False)
    roll_up_and_keep("accepted")
    stages.accept_baseline(ctx)
    itself = materialize(stages.compare_baseline(ctx))
    month = stages.in_months(ctx.read("gold", mart.fact), mart, BACKFILL_START, BACKFILL_END)
    corrected = materialize(month.filter(F.dayofmonth(mart.day) > 15))  # from the table that is written to
    stages.replace_months(ctx, mart, corrected, BACKFILL_START, BACKFILL_END)
    roll_up_and_keep("corrected")
    changed = materialize(stages.compare_baseline(ctx)).select("table")
    out = itself.select("table", F.lit(None).cast("string").alias("key"), "change")
    for table, (key, _) in kept.items():
        keys, _ = merkle.diff(spark, f"{trees}/accepted/{table}", f"{trees}/corrected/{table}", [key])
        named = keys.select(F.lit(table).alias("table"), F.col(key).cast("string").alias("key"), "change")
        out = out.unionByName(named.join(changed, "table", "left_semi"))
    return out
