"""Tables in buckets: no shuffle where they are grouped or joined, the same rows however they are read."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrace.operators import gold, silver
from terrace.plans import stages
from terrace.sources import lake
from terrace.specs import SALES_TABLES

M = gold.ORDERED


@pytest.fixture()
def small_buckets(spark, monkeypatch):
    monkeypatch.setattr(lake, "BUCKET_BYTES", 0)
    monkeypatch.setattr(lake, "BUCKETS", 8)
    monkeypatch.setattr(stages, "MONTHS_BYTES", 1)


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _rows(df):
    return sorted(map(repr, (r.asDict() for r in df.select(sorted(df.columns)).collect())))


def _versions(spark, tmp_root, n):
    rows = [(i % 40 if i % 13 else None, i % 7, i, f"it's {i}" if i % 3 else None) for i in range(n)]
    source = spark.createDataFrame(rows, "k long, o int, v int, s string")
    return source


def test_loads_in_buckets_are_grouped_without_a_shuffle(spark, tmp_root, small_buckets):
    path, source = f"{tmp_root}/t", _versions(spark, tmp_root, 300)
    for load in (1, 2, 2):  # the second one is landed again
        batch = source.filter(F.col("v") % 2 == load - 1).withColumn("_load_id", F.lit(load).cast("long"))
        m = lake.overwrite_partitions(batch, path, ("_load_id",), bucket_by=("k",))
        assert m["rows"] == 150
    plain, got = lake.read_table(spark, path), lake.read_bucketed(spark, path)
    assert got.schema == plain.schema and _rows(got) == _rows(plain)
    latest = lambda rows: silver.conform(rows, "k", "v", on_null_key="group")
    assert _rows(latest(got)) == _rows(latest(plain))
    assert _shuffles(latest(got)) == 0 and _shuffles(latest(plain)) == 1


def test_a_table_without_rows_keeps_its_columns(spark, tmp_root, small_buckets):
    path = f"{tmp_root}/t"
    source = _versions(spark, tmp_root, 30)
    assert lake.write_table(source.filter("v < 0"), path, bucket_by=("k",))["rows"] == 0
    assert lake.read_bucketed(spark, path).columns == source.columns and lake.read_bucketed(spark, path).count() == 0


def test_files_outside_buckets_and_uneven_buckets_are_read_plainly(spark, tmp_root, small_buckets):
    path, source = f"{tmp_root}/t", _versions(spark, tmp_root, 300)
    lake.write_table(source, path, bucket_by=("k",))
    assert lake.bucket_size(spark, path, ("k",)) > 0 and lake.bucket_size(spark, path, ("o",)) == 0
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1b")
    try:
        hot = f"{tmp_root}/hot"
        lake.write_table(spark.range(200000).select(F.lit(1).alias("k"), F.xxhash64("id").alias("v")), hot, bucket_by=("k",))
        assert lake.bucket_size(spark, hot, ("k",)) == 0 and lake.read_bucketed(spark, hot).count() == 200000
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    source.write.mode("append").parquet(path)
    assert _rows(lake.read_bucketed(spark, path)) == _rows(source.unionByName(source))
    lake.write_table(source, path)  # no longer in buckets
    assert lake.bucket_size(spark, path, ("k",)) == 0 and _rows(lake.read_bucketed(spark, path)) == _rows(source)


def test_staged_loads_move_no_rows_between_bronze_and_gold(spark, tmp_root, monkeypatch):
    day = lambda i: dt.date(2020, 1 + i % 5, 1 + i % 28)
    at = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(hours=n)
    orders = spark.createDataFrame([(i, i % 5, i % 3, day(i), at(i % 9)) for i in range(60)], "order_id long, customer_id long, salesperson_person_id long, order_date date, last_edited_when timestamp_ntz")
    lines = spark.createDataFrame(
        [(i % 150, (i * 7) % 66, i % 7, f"part {i % 4}", i % 9, (i % 90) + 0.25, 7.5, i % 9, at(i % 17)) for i in range(500)],
        "order_line_id long, order_id long, stock_item_id long, description string, quantity int, unit_price double, tax_rate double, picked_quantity int, last_edited_when timestamp_ntz",
    ).selectExpr(*[f"cast({c} as decimal(12,2)) {c}" if c in ("quantity", "unit_price", "tax_rate") else c for c in (
        "order_line_id", "order_id", "stock_item_id", "description", "quantity", "unit_price", "tax_rate", "picked_quantity", "last_edited_when")])
    specs = [s for s in SALES_TABLES if s.name in (M.headers, M.lines)]
    monkeypatch.setattr(gold, "MARTS", (M,))

    def staged(root):
        ctx = stages.RunContext.start(spark, stages.Layout(root), specs=specs)
        for load, until in ((1, at(8)), (2, at(99))):
            sources = {n: t.filter(F.col("last_edited_when") < F.lit(until)) for n, t in ((M.headers, orders), (M.lines, lines))}
            stages.extract(ctx, sources, load)
        stages.build_silver(ctx)
        stages.build_gold(ctx)
        return ctx

    plain = staged(f"{tmp_root}/a")
    monkeypatch.setattr(lake, "BUCKET_BYTES", 0)
    monkeypatch.setattr(lake, "BUCKETS", 8)
    monkeypatch.setattr(stages, "MONTHS_BYTES", 1)
    ctx = staged(f"{tmp_root}/b")
    for layer, name in (("bronze", M.headers), ("bronze", M.lines), ("silver", M.headers), ("silver", M.lines), ("gold", M.fact), ("gold", M.daily)):
        assert _rows(ctx.read(layer, name)) == _rows(plain.read(layer, name)), name
    spec = specs[1]
    raw = ctx.read_bucketed("bronze", M.lines)
    assert _shuffles(silver.conform(raw, spec.primary_key, spec.cursor, spec.tiebreakers, on_null_key="drop")) == 0
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _shuffles(stages._fact(ctx, M)) == 0 and _shuffles(stages._fact(plain, M)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
