"""Keys that one side lacks: decoded from sketches where few differ, exact everywhere."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrace.operators import key_sketch
from terrace.plans import stages
from terrace.specs import TableSpec

SCHEMA = "k long, s string"


def frame(spark, keys, schema=SCHEMA):
    return spark.createDataFrame(keys, schema)


def listed(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def expected(a, b):
    return {(*k, "missing") for k in set(a) - set(b)} | {(*k, "extra") for k in set(b) - set(a)}


def decoded(spark, a, b, parts, keys=("k", "s")):
    left, right = (key_sketch.sketch(frame(spark, x), keys, parts) for x in (a, b))
    return key_sketch.decode(key_sketch.subtract(left, right), parts).collect()


def test_few_differences_come_out_of_the_sketch(spark):
    a = [(n, str(n % 5)) for n in range(20_000)]
    b = [k for k in a if not 700 <= k[0] < 900] + [(n, None) for n in range(30)]
    found = decoded(spark, a, b, 4)
    assert all(r["decoded"] for r in found) and len(found) == 230
    assert listed(key_sketch.differences(frame(spark, a), frame(spark, b), ["k", "s"], 4)) == expected(a, b)


def test_many_differences_are_compared_exactly(spark):
    a = [(n, "x") for n in range(6000)]
    b = a[:2000] + [(n, "y") for n in range(50)]
    assert not any(r["decoded"] for r in decoded(spark, a, b, 2))
    assert listed(key_sketch.differences(frame(spark, a), frame(spark, b), ["k", "s"], 2)) == expected(a, b)


def test_parts_that_decode_beside_parts_that_do_not(spark):
    a = [(n, "x") for n in range(2200)]
    b = a[1100:]
    found = decoded(spark, a, b, 4)
    open_parts = {r["part"] for r in found if not r["decoded"]}
    heavy = [(n, "z") for n in range(4000)]
    marked = key_sketch._marked(frame(spark, heavy), ["k", "s"], 4).filter("_part = 1").select("k", "s").collect()
    b += [tuple(r) for r in marked]
    found = decoded(spark, a, b, 4)
    assert {r["part"] for r in found if not r["decoded"]} == open_parts | {1}
    assert listed(key_sketch.differences(frame(spark, a), frame(spark, b), ["k", "s"], 4)) == expected(a, b)


def test_repeated_keys_are_never_listed_wrongly(spark):
    a = [(1, "a")] * 2 + [(2, "a")] + [(3, "a")] * 3 + [(4, "a")] * 2 + [(5, "a")]
    b = [(1, "a"), (2, "a"), (2, "a"), (6, "a"), (6, "a"), (3, "a"), (7, "a")]
    for parts in (1, 64):
        assert listed(key_sketch.differences(frame(spark, a), frame(spark, b), ["k", "s"], parts)) == expected(a, b)


def test_nulls_types_and_clashing_columns(spark):
    a = [(None, "a"), (1, None), (None, None)]
    b = [(1, "a"), (None, "a")]
    assert listed(key_sketch.differences(frame(spark, a), frame(spark, b), ["k", "s"])) == expected(a, b)
    ints = frame(spark, [(1, 9, 9), (2, 9, 9)], "k int, part int, n int")
    longs = frame(spark, [(2, 5, 5), (3, 5, 5)], "k long, part long, h1 long")
    assert listed(key_sketch.differences(ints, longs, ["k"])) == {(1, "missing"), (3, "extra")}
    assert listed(key_sketch.differences(ints, longs, ["part"])) == {(9, "missing"), (5, "extra")}


def test_empty_sides(spark):
    none, some = frame(spark, []), frame(spark, [(n, "x") for n in range(5)])
    assert listed(key_sketch.differences(none, none, ["k"])) == set()
    assert listed(key_sketch.differences(some, none, ["k"])) == {(n, "missing") for n in range(5)}
    assert listed(key_sketch.differences(none, some, ["k"])) == {(n, "extra") for n in range(5)}


def test_stage_lists_keys_of_landed_and_absent_tables(spark, tmp_root):
    specs = (TableSpec("one", ("id",), cursor="ts"), TableSpec("two", ("id", "line"), cursor="ts"))
    ctx = stages.RunContext.start(spark, stages.Layout(tmp_root), specs=specs)
    one = spark.range(6).selectExpr("id AS ID", "timestamp_ntz'2020-01-01 00:00:00' AS Ts")
    two = spark.range(2).selectExpr("id", "'a' AS line", "timestamp_ntz'2020-01-01 00:00:00' AS ts")
    stages.run(ctx, "extract", sources={"one": one.filter("ID <> 3")}, load_id=1)
    found = {tuple(r) for r in stages.missing_keys(ctx, {"one": one.filter("ID <> 5"), "two": two}).collect()}
    assert found == {
        ("one", '{"id":3}', "missing"), ("one", '{"id":5}', "extra"),
        ("two", '{"id":0,"line":"a"}', "missing"), ("two", '{"id":1,"line":"a"}', "missing"),
    }
    with pytest.raises(ValueError):
        stages.missing_keys(ctx, {})


keys = st.lists(st.tuples(st.integers(-30, 30) | st.none(), st.sampled_from(["", "a", None])), max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=keys, b=keys)
def test_equals_set_differences(spark, a, b):
    assert listed(key_sketch.differences(frame(spark, a), frame(spark, b), ["k", "s"], 2)) == expected(a, b)
