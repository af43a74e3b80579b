"""Physical-plan checks of the registered queries: the properties the scale design
relies on, asserted on the plans Catalyst actually produces."""

from __future__ import annotations

import pytest

from terrace.plans import catalog

from .conftest import SF001

# Queries whose callables write intermediate tables (run jobs) are left out here.
WRITING = {
    "stream_collapse", "backfill_month", "staged_run_daily", "documents_json", "invoice_documents_json", "scd2_history", "history_batches", "history_asof",
    "search_combined", "stage_backfill", "staged_cdc_current", "stage_rejects", "stage_verify", "run_log_roundtrip", "snapshot_accept",
}
READ_ONLY = sorted(set(catalog.QUERIES) - WRITING)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name", ["silver_conform_lines", "silver_cdc_collapse", "fact_sales", "agg_sales_daily", "snapshot_diff"]
)
def test_dedupe_limits_rows_per_key_before_the_shuffle(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["search_ranked", "search_filtered"])
def test_top_k_is_partial_before_the_shuffle(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(catalog.QUERIES["description_facets"](spark, SF001))
    # lineitem has 11 columns; the fact needs 8 of them, never l_extendedprice.
    assert "l_extendedprice" not in plan


def test_incremental_watermark_is_pushed_into_the_scan(spark, tmp_root):
    from pyspark.sql import functions as F

    from terrace.operators import ingest
    from terrace.specs import TableSpec

    spec = TableSpec("t", ("id",), cursor="ts")
    spark.range(100).select("id", F.col("id").alias("ts")).write.parquet(f"{tmp_root}/src")
    source = spark.read.parquet(f"{tmp_root}/src")
    landed = ingest.with_load_metadata(source.filter("ts <= 40"), spec, 1)
    plan = _plan(ingest.incremental_batch(source, landed, spec, 2, on_null_cursor="include"))
    assert "GreaterThanOrEqual(ts,40)" in plan and "IsNull(ts)" in plan


def test_corpus_text_stays_out_of_every_exchange(spark):
    """The search of whole documents shuffles words that queries use, never a text."""
    plan = _plan(catalog.QUERIES["search_ranked"](spark, SF001))
    lines = plan.splitlines()
    for n, line in enumerate(lines):
        if "Exchange" in line and "BroadcastExchange" not in line:
            below = next(x for x in lines[n + 1 :] if "Project" in x or "Aggregate" in x or "Scan" in x or "Filter" in x)
            assert "text#" not in below.split("AS")[-1] or "tokens" in below or "explode" in below, below


def test_get_by_id_cuts_the_documents_first(spark, tmp_root):
    from terrace.operators import search

    spark.range(2000).selectExpr("id AS doc_id", "repeat('x', 50) AS doc").write.parquet(f"{tmp_root}/d")
    docs = spark.read.parquet(f"{tmp_root}/d")
    ids = spark.createDataFrame([(5,), (7000,)], "doc_id long")
    df = search.get_by_ids(ids, docs, "doc_id")
    assert {r["doc_id"]: r["found"] for r in df.collect()} == {5: True, 7000: False}
    # The documents meet the ids in an inner join, which can broadcast the ids.
    assert "Inner" in df._jdf.queryExecution().optimizedPlan().toString()


def test_no_setting_changes_the_plans(spark):
    import pathlib

    code = "".join(p.read_text() for p in pathlib.Path(catalog.__file__).parents[1].rglob("*.py") if "llm" not in p.parts)
    for gone in ("defaultParallelism", "getNumPartitions", "MAX_BROADCAST", "localCheckpoint"):
        assert gone not in code, gone
