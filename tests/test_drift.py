"""Drift statistics from sketches against exact ones, and the gate."""

from __future__ import annotations

import math
import random

import pytest

from terrace.operators import drift
from terrace.plans import stages
from terrace.sources import lake
from terrace.specs import LOAD_ID, TableSpec

SCHEMA = "x double, y long"


def exact_ks(a, b):
    points = sorted({*a, *b})
    share = lambda v, p: sum(x <= p for x in v) / len(v)
    return max(abs(share(a, p) - share(b, p)) for p in points)


def frame(spark, xs):
    return spark.createDataFrame([(None if x is None else float(x), 1) for x in xs], SCHEMA).repartition(6)


def compare(spark, a, b):
    return {r["column"]: r for r in drift.compare(drift.profile(frame(spark, a), ["x", "y"]), drift.profile(frame(spark, b), ["x", "y"])).collect()}


def test_statistic_is_within_the_sketch_error(spark):
    rng = random.Random(1)
    a = [rng.gauss(0, 1) for _ in range(4000)]
    for b in ([rng.gauss(0, 1) for _ in range(3000)], [rng.gauss(0.5, 1) for _ in range(3000)], [rng.gauss(0, 3) for _ in range(2000)]):
        got = compare(spark, a, b)
        assert abs(got["x"]["ks"] - exact_ks(a, b)) <= 2 * drift.RANK_ERROR
        assert got["y"]["ks"] == 0 and got["y"]["stability"] < 1e-9
    assert got["x"]["stability"] > 0.25


def test_profiles_merge(spark):
    rng = random.Random(2)
    parts = [[rng.random() for _ in range(700)] for _ in range(4)]
    profiles = [drift.profile(frame(spark, p), ["x"]) for p in parts]
    whole = profiles[0]
    for p in profiles[1:]:
        whole = whole.union(p)
    one = drift.merged(whole)
    row = one.first()
    assert (row["rows"], row["nulls"]) == (2800, 0)
    got = drift.compare(one, drift.profile(frame(spark, sum(parts, [])), ["x"])).first()
    assert got["ks"] <= 2 * drift.RANK_ERROR


def test_gate_refuses_a_drifted_load(spark):
    rng = random.Random(3)
    accepted = drift.profile(frame(spark, [rng.gauss(10, 2) for _ in range(2000)]), ["x"])
    drift.enforce(accepted, drift.profile(frame(spark, [rng.gauss(10, 2) for _ in range(2000)]), ["x"]))
    with pytest.raises(drift.DriftError, match="x: ks"):
        drift.enforce(accepted, drift.profile(frame(spark, [rng.gauss(14, 2) for _ in range(2000)]), ["x"]))
    with pytest.raises(drift.DriftError):
        drift.enforce(accepted, drift.profile(frame(spark, [rng.gauss(10, 2) if i % 3 else None for i in range(2000)]), ["x"]))


def test_empty_and_null_columns(spark):
    got = compare(spark, [1, 2, 3], [])
    assert (got["x"]["rows"], got["x"]["ks"]) == (0, 1.0) and math.isinf(got["x"]["stability"])
    got = compare(spark, [None, None], [None, float("nan")])
    assert (got["x"]["ks"], got["x"]["stability"], got["x"]["nulls"]) == (0.0, 0.0, 0.0)
    got = compare(spark, [], [])
    assert got["x"]["ks"] == 0.0
    with pytest.raises(ValueError):
        drift.profile(frame(spark, [1]), [])
    one = drift.compare(drift.profile(frame(spark, [1, 2]), ["x"]), drift.profile(frame(spark, [1, 2]), ["y"]))
    assert {r["column"]: r["ks"] for r in one.collect()} == {"x": 1.0, "y": 1.0}


def test_silver_is_not_replaced_by_a_drifted_load(spark, tmp_root):
    rng = random.Random(4)
    spec = TableSpec("t", ("k",), "c")
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=[spec])

    def land(load, mean):
        rows = [(k, load, rng.gauss(mean, 1), load) for k in range(1000)]
        df = spark.createDataFrame(rows, f"k long, c long, v double, {LOAD_ID} long")
        lake.overwrite_partitions(df, ctx.layout.path("bronze", "t"), (LOAD_ID,))

    land(1, 5.0)
    stages.accept_profile(ctx, "t", ["v"])
    stages.build_silver(ctx)
    land(2, 5.0)
    stages.build_silver(ctx)
    land(3, 8.0)
    with pytest.raises(drift.DriftError):
        stages.build_silver(ctx)
    assert {r["c"] for r in ctx.read("silver", "t").select("c").distinct().collect()} == {2}
