"""Hash trees: the rows of a full diff, from few leaves where changes are local."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators import merkle, quality

SCHEMA = "k long, s string, v string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, table):
    return spark.createDataFrame([(k, s, v) for k, (s, v) in table.items()], SCHEMA)


def both(spark, root, a, b, keys=("k",), **options):
    x, y = frame(spark, a), frame(spark, b)
    merkle.save(x, f"{root}/a", keys, **options)
    merkle.save(y, f"{root}/b", keys, **options)
    got, work = merkle.diff(spark, f"{root}/a", f"{root}/b", keys, options.get("depth", merkle.DEPTH))
    assert rows(got) == rows(quality.snapshot_diff(x, y, list(keys)))
    return work


def test_a_local_correction_reads_few_rows(spark, tmp_root):
    a = {k: ("x", str(k % 17)) for k in range(20_000)}
    b = {k: v for k, v in a.items() if not 900 <= k < 940}
    b |= {k: (None, "changed") for k in range(7000, 7030)} | {20_000: ("x", "new")}
    work = both(spark, tmp_root, a, b, leaf=merkle.ranged("k", 50))
    assert work[1] == len(a) + len(b) and 0 < work[0] < 0.02 * work[1]
    assert both(spark, f"{tmp_root}/same", a, a) == (0, 2 * len(a))


def test_values_that_swap_places_differ(spark, tmp_root):
    work = both(spark, tmp_root, {1: (None, "a"), 2: ("a", "b")}, {1: ("a", None), 2: ("a", "b")})
    assert work[0] >= 2


def test_empty_tables(spark, tmp_root):
    x = spark.createDataFrame([], SCHEMA)
    y = frame(spark, {1: ("a", "b"), 2: (None, None)})
    for n, (a, b) in enumerate([(x, y), (y, x), (x, x)]):
        merkle.save(a, f"{tmp_root}/{n}/a", ["k"], depth=1)
        merkle.save(b, f"{tmp_root}/{n}/b", ["k"], depth=1)
        if n < 2:
            got, _ = merkle.diff(spark, f"{tmp_root}/{n}/a", f"{tmp_root}/{n}/b", ["k"], depth=1)
            assert rows(got) == [(1, ("added", "removed")[n]), (2, ("added", "removed")[n])]
    assert merkle.differing_leaves(spark, f"{tmp_root}/2/a", f"{tmp_root}/2/b", 1)[0].count() == 0


table = st.dictionaries(st.integers(-50, 50), st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from(["", "v", None])), max_size=30)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=table, b=table)
def test_equals_the_full_diff(spark, tmp_path_factory, a, b):
    if a and b:
        both(spark, str(tmp_path_factory.mktemp("merkle")), a, b, depth=2)


def test_leaves_that_differ_are_sent_to_the_rows(spark, tmp_root):
    """Rows are not shuffled by leaf, and a NULL and the character that once stood for it differ."""
    a = {k: ("s", "v") for k in range(60)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both(spark, tmp_root, a, a | {1: ("s", None)})
        plan = merkle.diff(spark, f"{tmp_root}/a", f"{tmp_root}/b", ["k"])[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(_leaf" not in plan and "BroadcastHashJoin [_leaf" in plan
    both(spark, f"{tmp_root}/n", {1: ("s", None)}, {1: ("s", "\0")})


def test_rows_are_compared_by_hashes_unless_types_differ(spark, tmp_root):
    x = frame(spark, {k: (f"s{k}", "v") for k in range(40)}).withColumn("n", F.lit(5))
    y = x.withColumn("n", F.when(F.col("k") == 3, 6).otherwise(F.col("n")))
    for name, table in (("x", x), ("y", y), ("z", y.withColumn("n", F.col("n").cast("long")))):
        merkle.save(table, f"{tmp_root}/{name}", ["k"])
    for other, hashed in (("y", True), ("z", False)):
        got, _ = merkle.diff(spark, f"{tmp_root}/x", f"{tmp_root}/{other}", ["k"])
        assert rows(got) == [(3, "changed")]
        assert ("xxhash64(second" in got._jdf.queryExecution().optimizedPlan().toString()) == hashed
