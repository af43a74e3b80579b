"""Incremental ingest, lake I/O and the medallion stages end to end on a temp lake."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrace.operators import ingest
from terrace.plans import stages
from terrace.sources import adapters as A
from terrace.sources import lake
from terrace.specs import LOAD_ID, ROW_ID, TableSpec

from .conftest import SF001

SPEC = TableSpec("t", ("id",), cursor="ts")


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("OrderID", "order_id"),
        ("LastEditedWhen", "last_edited_when"),
        ("SalespersonPersonID", "salesperson_person_id"),
        ("InvoiceLineID", "invoice_line_id"),
        ("HTTPServer", "http_server"),
        ("already_snake", "already_snake"),
        ("Line 2 Total", "line_2_total"),
    ],
)
def test_snake_case(name, expected):
    assert ingest.snake_case(name) == expected


def test_normalize_names_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["OrderID", "order_id"])
    with pytest.raises(ValueError, match="normalise"):
        ingest.normalize_names(df)


def _src(spark, rows):
    return spark.createDataFrame(rows, "id long, ts string, v string")


def test_first_load_takes_everything(spark):
    src = _src(spark, [(1, "a", "x"), (2, "b", "y")])
    out = ingest.incremental_batch(src, None, SPEC, 1)
    assert out.count() == 2
    assert set(out.columns) == {"id", "ts", "v", ROW_ID, LOAD_ID}


def test_boundary_rows_already_landed_are_skipped(spark):
    bronze = ingest.with_load_metadata(_src(spark, [(1, "a", "x"), (2, "b", "y")]), SPEC, 1)
    src = _src(spark, [(1, "a", "x"), (2, "b", "y"), (3, "b", "late"), (4, "c", "new"), (0, "a", "old")])
    out = ingest.incremental_batch(src, bronze, SPEC, 2)
    assert sorted(r["id"] for r in out.collect()) == [3, 4]


def test_rerun_of_a_load_recomputes_the_same_rows(spark):
    first = ingest.with_load_metadata(_src(spark, [(1, "a", "x")]), SPEC, 1)
    src = _src(spark, [(1, "a", "x"), (2, "b", "y")])
    second = ingest.incremental_batch(src, first, SPEC, 2)
    bronze = first.unionByName(second)
    again = ingest.incremental_batch(src, bronze, SPEC, 2)  # retry of load 2
    assert sorted(r["id"] for r in again.collect()) == [2]
    assert sorted(r[ROW_ID] for r in again.collect()) == sorted(r[ROW_ID] for r in second.collect())


def test_row_id_is_deterministic(spark):
    src = _src(spark, [(1, "a", "x")])
    a = ingest.with_load_metadata(src, SPEC, 7).first()[ROW_ID]
    b = ingest.with_load_metadata(src, SPEC, 7).first()[ROW_ID]
    assert a == b


def test_try_read_missing_table(spark, tmp_root):
    assert lake.try_read_table(spark, f"{tmp_root}/nothing") is None
    import os

    os.makedirs(f"{tmp_root}/empty/_load_id=1")
    assert lake.try_read_table(spark, f"{tmp_root}/empty") is None


def test_write_table_counts_rows_with_observation(spark, tmp_root):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    m = lake.write_table(df, f"{tmp_root}/t", partition_by=("p",), name="t")
    assert m["rows"] == 10
    assert spark.read.parquet(f"{tmp_root}/t").count() == 10


def _sources(spark, cutoff: str | None):
    orders = A.table(spark, SF001, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        (F.col("o_custkey") % 20).alias("SalespersonPersonID"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.col("o_orderdate").alias("LastEditedWhen"),
    )
    lines = A.bronze_order_lines(spark, SF001)
    if cutoff:
        orders = orders.filter(F.col("LastEditedWhen") < F.lit(cutoff).cast("timestamp_ntz"))
        lines = lines.filter(F.col("last_edited_when") < F.lit(cutoff).cast("timestamp_ntz"))
    return {"sales_orders": orders, "sales_orderlines": lines}


def test_medallion_run_is_idempotent_and_gold_matches_lazy_plan(spark, tmp_root):
    layout = stages.Layout(tmp_root)
    ctx = stages.RunContext.start(spark, layout, "test-run", specs=A.SPECS)
    e1 = stages.run(ctx, "extract", sources=_sources(spark, "1998-01-01"), load_id=1)
    e2 = stages.run(ctx, "extract", sources=_sources(spark, None), load_id=2)
    e3 = stages.run(ctx, "extract", sources=_sources(spark, None), load_id=3)
    rows = {(e["table"], e["load_id"]): e["rows"] for e in e1 + e2 + e3 if "load_id" in e}
    assert rows[("sales_orders", 3)] == 0 and rows[("sales_orderlines", 3)] == 0
    # Retrying load 2 replaces its partition with the same rows.
    e2b = stages.run(ctx, "extract", sources=_sources(spark, None), load_id=2)
    assert {e["table"]: e["rows"] for e in e2b if "load_id" in e} == {
        t: n for (t, lid), n in rows.items() if lid == 2
    }
    bronze_orders = spark.read.parquet(layout.path("bronze", "sales_orders"))
    assert bronze_orders.count() == A.table(spark, SF001, "orders").count()
    stages.run(ctx, "silver")
    silver_lines = spark.read.parquet(layout.path("silver", "sales_orderlines"))
    assert silver_lines.count() == A.bronze_order_lines(spark, SF001).select("order_line_id").distinct().count()
    assert spark.read.parquet(layout.runs).filter(F.col("correlation_id") == "test-run").count() > 0


def test_gold_stage_and_backfill(spark, tmp_root):
    from terrace.operators import gold
    from terrace.plans import catalog

    layout = stages.Layout(tmp_root)
    ctx = stages.RunContext.start(spark, layout, specs=A.SPECS)
    lake.write_table(catalog.silver_orders(spark, SF001), layout.path("silver", "sales_orders"))
    lake.write_table(catalog.silver_lines(spark, SF001), layout.path("silver", "sales_orderlines"))
    lake.write_table(catalog.silver_invoices(spark, SF001), layout.path("silver", "sales_invoices"))
    lake.write_table(catalog.silver_invoice_lines(spark, SF001), layout.path("silver", "sales_invoicelines"))
    events = stages.build_gold(ctx)
    counts = {e["table"]: e["rows"] for e in events}
    assert counts["fact_sales"] == catalog.fact_sales(spark, SF001).count()
    fact_path = layout.path("gold", "fact_sales")
    written = spark.read.parquet(fact_path)
    assert set(written.columns) >= {"order_year", "order_month"}
    daily = spark.read.parquet(layout.path("gold", "agg_sales_daily"))
    assert daily.count() == gold.daily(gold.ORDERED, catalog.fact_sales(spark, SF001)).count()
    # Backfill one month: only that month's partition is rewritten, others untouched.
    before = written.groupBy("order_year", "order_month").count().collect()
    stages.backfill_gold(ctx, dt.date(1996, 3, 10), dt.date(1996, 3, 20))
    after = spark.read.parquet(fact_path).groupBy("order_year", "order_month").count().collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))


def test_month_bounds_cover_whole_months():
    assert stages.month_bounds(dt.date(2024, 2, 10), dt.date(2024, 3, 5)) == (
        dt.date(2024, 2, 1),
        dt.date(2024, 3, 31),
    )
    assert stages.month_bounds(dt.date(2024, 12, 31), dt.date(2024, 12, 31)) == (
        dt.date(2024, 12, 1),
        dt.date(2024, 12, 31),
    )


def test_silver_cdc_skips_missing_feed(spark, tmp_root):
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root))
    events = stages.build_silver_cdc(ctx)
    assert events and all(e["msg"] == "no changes landed, table left out" for e in events)


def test_extract_cdc_is_forward_only(spark, tmp_root):
    layout = stages.Layout(tmp_root)
    ctx = stages.RunContext.start(spark, layout, feed_specs=A.FEED_SPECS)
    ct = A.change_table(spark, SF001)
    e1 = stages.extract_cdc(ctx, {"user_events": ct}, load_id=1)
    e2 = stages.extract_cdc(ctx, {"user_events": ct}, load_id=2)
    assert e1[0]["rows"] == ct.count() and e2[0]["rows"] == 0
    # A new change after the landed max LSN is picked up.
    later = ct.limit(1).withColumn("__$start_lsn", F.unhex(F.lit("FFFFFFFFFFFFFFFFFFFF")))
    e3 = stages.extract_cdc(ctx, {"user_events": ct.unionByName(later)}, load_id=3)
    assert e3[0]["rows"] == 1


def test_null_key_policies(spark):
    from terrace.operators.silver import NullKeyError, conform

    df = spark.createDataFrame(
        [(None, "a", "x"), (None, "b", "y"), (1, "a", "z")], "id long, ts string, v string"
    )
    assert conform(df, "id", "ts").count() == 2  # NULL keys form one group
    assert [r["id"] for r in conform(df, "id", "ts", on_null_key="drop").collect()] == [1]
    with pytest.raises(NullKeyError, match="2 rows"):
        conform(df, "id", "ts", on_null_key="fail")


def test_emitted_events_parse_back_into_run_metrics(spark, tmp_root):
    import json

    from terrace.operators import runlog

    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), "run-42")
    events = [ctx.emit("one", table="t", rows=3, destination="x"),
              ctx.emit("two", table="t", rows=4, destination="y")]
    lines = spark.createDataFrame([(json.dumps(e, default=str),) for e in events], "value string")
    [m] = runlog.run_metrics(runlog.parse_run_events(lines)).collect()
    assert (m["correlation_id"], m["table"], m["events"], m["rows"]) == ("run-42", "t", 2, 7)


def test_cli_runs_a_stage(tmp_root, capsys):
    import subprocess
    import sys as _sys

    out = subprocess.run(
        [_sys.executable, "-m", "terrace", "silver", "--root", tmp_root, "--master", "local[1]"],
        capture_output=True, text=True, timeout=600, cwd=str(__import__("pathlib").Path(__file__).parents[1]),
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "nothing landed, table left out" in out.stdout


def test_state_watermark_compares_numeric_cursors_as_numbers(spark):
    spec = TableSpec("t", ("id",), cursor="c")
    bronze = spark.createDataFrame([(1, 9, 1), (2, 10, 2)], "id long, c long, _load_id long")
    state = spark.createDataFrame([("9", 1), ("10", 2)], "max_cursor string, _load_id long")
    assert ingest.high_watermark(bronze, "c", 3, state) == ("10", [2])
    assert ingest.high_watermark(bronze, "c", 3) == ("10", None)
    src = spark.createDataFrame([(2, 10), (3, 10), (4, 11)], "id long, c long")
    out = ingest.incremental_batch(src, bronze, spec, 3, state)
    assert sorted(r["id"] for r in out.collect()) == [3, 4]


def test_inspect_layer_reports_partition_columns_from_layout(spark, tmp_root):
    from terrace.plans import catalog

    layout = stages.Layout(tmp_root)
    ctx = stages.RunContext.start(spark, layout, specs=A.SPECS)
    for name, fn in (
        ("sales_orders", catalog.silver_orders), ("sales_orderlines", catalog.silver_lines),
        ("sales_invoices", catalog.silver_invoices), ("sales_invoicelines", catalog.silver_invoice_lines),
    ):
        lake.write_table(fn(spark, SF001), layout.path("silver", name))
    stages.build_gold(ctx)
    profile, samples = stages.inspect(ctx, "gold")
    rows = {r["table"]: r for r in profile.collect()}
    assert rows["fact_sales"]["partition_columns"] == "order_year,order_month"
    assert rows["agg_sales_daily"]["partition_columns"] == ""
    assert rows["fact_sales"]["rows"] == catalog.fact_sales(spark, SF001).count()
    assert samples.filter(F.col("table") == "fact_sales").count() == 3


def test_read_run_log_from_json_lines(spark, tmp_root):
    import json

    from terrace.operators import runlog

    path = f"{tmp_root}/log.jsonl"
    with open(path, "w") as fh:
        for i in range(3):
            fh.write(json.dumps({"ts": "2024-01-01T00:00:00+00:00", "level": "INFO", "logger": "l", "msg": "m",
                                 "correlation_id": "c", "table": "t", "rows": i}) + "\n")
    [m] = runlog.run_metrics(runlog.read_run_log(spark, path)).collect()
    assert (m["events"], m["rows"]) == (3, 3)


def test_publish_then_serve_search_and_get(spark, tmp_root):
    import json

    from terrace.operators import search
    from terrace.plans import catalog

    layout = stages.Layout(tmp_root)
    ctx = stages.RunContext.start(spark, layout)
    fact = catalog.fact_sales(spark, SF001)
    lake.write_table(fact, layout.path("gold", "fact_sales"), partition_by=("order_year", "order_month"))
    stages.publish_documents(ctx)
    assert spark.read.parquet(layout.serving("fact_sales/documents")).count() == fact.count()
    # Text search through the published index equals the lazy batch search.
    total, rows = stages.serve_search(ctx, q="red plate", limit=5)
    lazy = search.search_texts(
        fact, spark.createDataFrame([(0, "red plate")], "query_id long, q string"), "order_line_id", "description", k=5
    ).collect()
    got = rows.collect()
    assert total == lazy[0]["total"]
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in sorted(lazy, key=lambda r: r["rank"])]
    # Filter-only request: constant score, ids ascending, total over all matches.
    some = fact.select("customer_id").first()["customer_id"]
    total, rows = stages.serve_search(ctx, customer_id=some, min_total=0.0, limit=3)
    expected = fact.filter((F.col("customer_id") == some) & (F.col("line_total") >= 0)).count()
    assert total == expected and len(rows.collect()) == min(3, expected)
    # Get by id: found and not found.
    first_id = fact.select("order_line_id").first()["order_line_id"]
    got = {r["doc_id"]: r for r in stages.serve_get(ctx, [first_id, -1]).collect()}
    assert got[first_id]["found"] and json.loads(got[first_id]["doc"])["order_line_id"] == first_id
    assert not got[-1]["found"]


def test_jdbc_watermark_filter_uses_source_column_names(spark):
    from terrace.sources import jdbc

    spec = TableSpec("sales_orders", ("order_id",), source_schema="Sales", source_table="Orders")
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-03 00:00:00")], "OrderID long, LastEditedWhen string"
    ).withColumn("LastEditedWhen", F.col("LastEditedWhen").cast("timestamp"))
    assert jdbc.source_column(df.columns, "last_edited_when") == "LastEditedWhen"
    out = jdbc.since_watermark(df, spec, "2024-01-02 00:00:00")
    assert [r["OrderID"] for r in out.collect()] == [2]
    assert jdbc.since_watermark(df, spec, None).count() == 2


def test_cold_rebuild_gives_identical_gold_fingerprints(spark, tmp_root):
    from terrace.operators import quality

    fingerprints = []
    for run in ("a", "b"):
        ctx = stages.RunContext.start(spark, stages.Layout(f"{tmp_root}/{run}"), specs=A.SPECS)
        stages.run(ctx, "extract", sources=A.landing_sources(spark, SF001, "1998-01-01 00:00:00"), load_id=1)
        stages.run(ctx, "extract", sources=A.landing_sources(spark, SF001, None), load_id=2)
        stages.run(ctx, "all")
        fingerprints.append(
            {t: tuple(quality.fingerprint(spark.read.parquet(ctx.layout.path("gold", t))).first())
             for t in stages.LAYER_TABLES["gold"]}
        )
    assert fingerprints[0] == fingerprints[1]
    # And the keyed diff between the two builds of the fact is empty.
    a = spark.read.parquet(stages.Layout(f"{tmp_root}/a").path("gold", "fact_sales"))
    b = spark.read.parquet(stages.Layout(f"{tmp_root}/b").path("gold", "fact_sales"))
    assert quality.snapshot_diff(a, b, ["order_line_id"]).count() == 0


def test_rows_without_a_cursor_are_kept_or_refused(spark):
    bronze = ingest.with_load_metadata(_src(spark, [(1, "a", "x"), (7, None, "landed")]), SPEC, 1)
    src = _src(spark, [(1, "a", "x"), (2, "b", "y"), (7, None, "landed"), (8, None, "new")])
    with pytest.raises(ingest.NullCursorError):
        ingest.incremental_batch(src, bronze, SPEC, 2).count()
    out = ingest.incremental_batch(src, bronze, SPEC, 2, on_null_cursor="include")
    assert sorted(r["id"] for r in out.collect()) == [2, 8]
    only = ingest.with_load_metadata(_src(spark, [(7, None, "landed")]), SPEC, 1)
    out = ingest.incremental_batch(src, only, SPEC, 2, on_null_cursor="include")
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 8]


def test_rows_without_a_key_are_set_aside(spark, tmp_root):
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=(SPEC,))
    stages.extract(ctx, {"t": _src(spark, [(None, "a", "x"), (None, "b", "y"), (1, "a", "z")])}, load_id=1)
    [event] = stages.build_silver(ctx)
    assert (event["rows"], event["rejected"]) == (1, 2)
    assert lake.read_table(spark, ctx.layout.rejected("t")).count() == 2


def test_a_load_that_died_before_its_state_lands_nothing_twice(spark, tmp_root):
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=(SPEC,))
    rows = [(1, "a", "x"), (2, "b", "y")]
    stages.extract(ctx, {"t": _src(spark, rows)}, load_id=1)
    # Load 2 dies between its Bronze write and its state write.
    died = ingest.with_load_metadata(_src(spark, [(3, "c", "z"), (4, "c", "w")]), SPEC, 2)
    lake.overwrite_partitions(died, ctx.layout.path("bronze", "t"), (LOAD_ID,))
    [event] = stages.extract(ctx, {"t": _src(spark, [*rows, (3, "c", "z"), (4, "c", "w"), (5, "d", "v")])}, load_id=3)
    assert event["rows"] == 1
    assert spark.read.parquet(ctx.layout.path("bronze", "t")).count() == 5


def test_a_failed_gate_keeps_the_last_silver(spark, tmp_root):
    from terrace.operators import quality

    rules = {"t": (quality.Rule("enough", "min_rows", threshold=2),)}
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=(SPEC,), rules=rules)
    stages.extract(ctx, {"t": _src(spark, [(1, "a", "x")])}, load_id=1)
    with pytest.raises(quality.QualityGateError):
        stages.run(ctx, "silver")
    assert lake.try_read_table(spark, ctx.layout.path("silver", "t")) is None


def test_backfill_empties_months_and_rebuilds_the_roll_up(spark, tmp_root):
    from terrace.operators import gold
    from terrace.plans import catalog

    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=A.SPECS)
    built = {
        "sales_orders": catalog.silver_orders, "sales_orderlines": catalog.silver_lines,
        "sales_invoices": catalog.silver_invoices, "sales_invoicelines": catalog.silver_invoice_lines,
    }
    for name, build in built.items():
        lake.write_table(build(spark, SF001), ctx.layout.path("silver", name))
    stages.build_gold(ctx)
    for mart in gold.MARTS:
        kept = built[mart.headers](spark, SF001).filter(F.date_format(mart.day, "yyyy-MM") != "1996-03")
        lake.write_table(kept, ctx.layout.path("silver", mart.headers))
    events = stages.backfill_gold(ctx, dt.date(1996, 3, 10), dt.date(1996, 3, 20))
    assert [e["months_emptied"] for e in events if "months_emptied" in e] == [1, 1]
    for mart in gold.MARTS:
        rows, daily = ctx.read("gold", mart.fact), ctx.read("gold", mart.daily)
        assert rows.filter(F.date_format(mart.day, "yyyy-MM") == "1996-03").count() == 0
        assert daily.exceptAll(gold.daily(mart, rows)).isEmpty() and daily.agg(F.sum("num_lines")).first()[0] == rows.count()


def test_run_metrics_keep_the_stage_times(spark, tmp_root):
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=(SPEC,))
    stages.run(ctx, "extract", sources={"t": _src(spark, [(1, "a", "x")])}, load_id=1)
    rows = {r["name"]: r for r in spark.read.parquet(ctx.layout.runs).collect()}
    assert rows["t"]["rows"] == 1 and rows["extract"]["seconds"] > 0
    assert stages.run_log(ctx).filter("msg = 'load landed'").count() == 1


def test_verify_without_a_source_reports_what_landed(spark, tmp_root):
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=(SPEC,))
    stages.extract(ctx, {"t": _src(spark, [(1, "a", "x")])}, load_id=1)
    assert [r.asDict() for r in stages.verify(ctx, None).collect()] == [{"table": "t", "bronze": 1}]


def test_cdc_chain_from_the_command_line(tmp_root):
    import pathlib
    import subprocess
    import sys as _sys

    for stage, more in (("extract-cdc", ["--sf-dir", SF001, "--load-id", "1"]), ("silver-cdc", [])):
        out = subprocess.run(
            [_sys.executable, "-m", "terrace", stage, "--root", tmp_root, "--master", "local[2]", *more],
            capture_output=True, text=True, timeout=600, cwd=str(pathlib.Path(__file__).parents[1]),
        )
        assert out.returncode == 0, out.stderr[-2000:]
    assert "changes collapsed" in out.stdout
