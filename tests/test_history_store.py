from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from terrace.operators import history_store
from terrace.operators.history import scd2_history
from terrace.session import materialize

SCHEMA = "k int, t int, b int, v string"


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _versions(seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice([0, 0, 0, 0, *range(1, 30), None]), rng.choice([None, *range(60)]), rng.randint(0, 3), f"v{i}") for i in range(n)]
    return rows + rows[:5]  # repeated versions


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_give_the_whole_history(spark, tmp_root, seed):
    rows = _versions(seed)
    random.Random(seed).shuffle(rows)
    path = f"{tmp_root}/h"
    cuts = [0, 120, 121, 121, 250, len(rows)]  # one version alone, and an empty load
    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        batch = spark.createDataFrame(rows[a:b], SCHEMA)
        assert history_store.merge(batch, path, n, ["k"], "t", ("b",), pieces=4)
        if n == 2:
            history_store.compact(spark, path)
            history_store.compact(spark, path)
        assert not history_store.merge(batch, path, n, ["k"], "t", ("b",))  # a replay, also after the compaction
        so_far = spark.createDataFrame(rows[:b], SCHEMA).withColumn("h", F.xxhash64("k", "t", "b", "v"))
        whole = scd2_history(so_far, ["k"], "t", ("b", "h"), partitions=3).drop("h")
        assert _rows(history_store.current(spark, path)) == _rows(whole)


def test_a_late_version_writes_what_it_changes(spark, tmp_root):
    path = f"{tmp_root}/h"
    rows = [(k, t, 0, "x") for k in range(40) for t in range(0, 100, 10)] + [(7, t, 0, "hot") for t in range(1000, 3000)]
    history_store.merge(spark.createDataFrame(rows, SCHEMA), path, 1, ["k"], "t", ("b",))
    history_store.merge(spark.createDataFrame([(7, 1500, 1, "late"), (8, 500, 0, "new")], SCHEMA), path, 2, ["k"], "t", ("b",))
    written = spark.read.parquet(f"{path}/rows/segment=0000000002~2").select("k", "t", "b", "valid_to", "is_current", "__sign").collect()
    assert sorted(map(tuple, written), key=repr) == sorted(
        [
            (7, 1500, 0, 1501, False, -1), (7, 1500, 0, 1500, False, 1), (7, 1500, 1, 1501, False, 1),  # the interval split
            (8, 90, 0, None, True, -1), (8, 90, 0, 500, False, 1), (8, 500, 0, None, True, 1),  # the open row closed
        ],
        key=repr,
    )


def test_a_merge_or_compaction_that_stopped_is_not_read(spark, tmp_root):
    path = f"{tmp_root}/h"
    one = spark.createDataFrame([(1, 1, 0, "a")], SCHEMA)
    history_store.merge(one, path, 1, ["k"], "t")
    # Folders without a success mark.
    for torn in ("rows/segment=0000000002~2", "rows/segment=0000000001~base"):
        spark.createDataFrame([(9, 9, 0, "torn", 9, None, True, 1, 0)], SCHEMA + ", valid_from int, valid_to int, is_current boolean, __sign long, __piece int") \
            .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("__piece").parquet(f"{path}/{torn}")
    assert [r["v"] for r in history_store.current(spark, path).collect()] == ["a"]
    assert history_store.merge(spark.createDataFrame([(1, 2, 0, "b")], SCHEMA), path, 2, ["k"], "t")
    history_store.compact(spark, path)
    got = {r["v"]: (r["valid_to"], r["is_current"]) for r in history_store.current(spark, path).collect()}
    assert got == {"a": (2, False), "b": (None, True)}


@pytest.mark.parametrize("partitions", [1, 7])
def test_as_of_against_a_loop(spark, partitions):
    """A hot key split over ranges, ties, facts before every version, NULL keys and times, no versions at all."""
    rng = random.Random(5)
    versions = list(dict.fromkeys((k, t, b, "") for k, t, b, _ in _versions(3, 400)))
    facts = [(n, rng.choice([0, 0, 0, None, *range(35)]), rng.choice([None, *range(-2, 70)])) for n in range(600)] + [(0, 0, 30)] * 50
    expected = []
    for n, k, t in facts:
        fits = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] is not None and v[1] <= t]
        expected.append((n, k, t, max(fits, key=lambda v: (v[1], v[2]))[:3] if fits else None))
    f = spark.createDataFrame(facts, "n int, k int, at int")
    v = materialize(spark.createDataFrame(versions, SCHEMA))
    out = history_store.as_of(f, v, ["k"], "at", "t", ("b",), partitions=partitions).collect()
    got = [(*r["fact"], tuple(r["version"])[:3] if r["version"] else None) for r in out]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r["version"] is None for r in history_store.as_of(f, v.limit(0), ["k"], "at", "t").collect())
    assert history_store.as_of(f.limit(0), v, ["k"], "at", "t").count() == 0


def test_a_batch_in_files_is_not_written_again_and_a_base_alone_is_not_shuffled(spark, tmp_root, monkeypatch):
    kept = []
    monkeypatch.setattr(history_store, "materialize", lambda df: kept.append(df) or materialize(df))
    batch = materialize(spark.createDataFrame([(k, t, 0, "x") for k in range(40) for t in range(3)], SCHEMA))
    path = f"{tmp_root}/h"
    history_store.merge(batch, path, 1, ["k"], "t", written=True)
    history_store.merge(materialize(batch.filter("k < 9").withColumn("t", F.lit(1))), path, 2, ["k"], "t", written=True)
    assert not [df for df in kept if set(SCHEMA.replace(",", "").split()[::2]) == set(df.columns)]  # the batch as it came
    old = [df for df in kept if "valid_to" in df.columns]
    assert [df.count() for df in old] == [0, 27]
    assert "hashpartitioning(k#" not in old[1]._jdf.queryExecution().executedPlan().toString()  # no sum of signs by whole rows
    whole = scd2_history(batch.union(batch.filter("k < 9").withColumn("t", F.lit(1))), ["k"], "t")
    assert _rows(history_store.current(spark, path).select("k", "t", "valid_to")) == _rows(whole.select("k", "t", "valid_to"))
