"""Streaming collapse against the batch collapse (replay, out-of-order, tombstones),
randomized dedupe checks against a plain-Python oracle, and SCD2 history."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators.cdc import collapse_changes
from terrace.operators.history import scd2_history
from terrace.operators.silver import dedupe_latest
from terrace.sources import lake
from terrace.streaming import cdc_stream

FEED_SCHEMA = "k long, change_lsn string, change_seqval string, change_operation int, v string"


def _lsn(i: int) -> str:
    return format(i, "X").rjust(20, "0")


def _write_batches(spark, root, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, FEED_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/feed")


def _run(spark, root, batches, max_files=1):
    _write_batches(spark, root, batches)
    schema = spark.read.parquet(f"{root}/feed").schema
    cdc_stream.run_stream(spark, f"{root}/feed", schema, ["k"], f"{root}/sink", f"{root}/ckpt", max_files_per_trigger=max_files)
    return {r["k"]: r["v"] for r in cdc_stream.current_state(spark, f"{root}/sink", ["k"]).collect()}


def test_stream_equals_batch_with_out_of_order_batches(spark, tmp_root):
    batches = [
        [(1, _lsn(5), _lsn(1), 4, "k1-new"), (2, _lsn(2), _lsn(1), 2, "k2")],
        [(1, _lsn(3), _lsn(1), 4, "k1-old"), (3, _lsn(9), _lsn(1), 2, "k3")],  # older change arrives late
        [(3, _lsn(10), _lsn(1), 1, "k3-del"), (4, _lsn(1), _lsn(1), 2, "k4")],
    ]
    got = _run(spark, tmp_root, batches)
    batch = collapse_changes(spark.createDataFrame([r for b in batches for r in b], FEED_SCHEMA), "k")
    assert got == {r["k"]: r["v"] for r in batch.collect()} == {1: "k1-new", 2: "k2", 4: "k4"}


def test_stream_tombstone_blocks_late_insert(spark, tmp_root):
    batches = [
        [(1, _lsn(5), _lsn(1), 2, "ins")],
        [(1, _lsn(8), _lsn(1), 1, "del")],
        [(1, _lsn(6), _lsn(1), 2, "late-ins")],  # older than the delete
    ]
    assert _run(spark, tmp_root, batches) == {}


def test_stream_resume_takes_only_new_files(spark, tmp_root):
    first = [[(1, _lsn(1), _lsn(1), 2, "a")]]
    assert _run(spark, tmp_root, first) == {1: "a"}
    second = [[(1, _lsn(2), _lsn(1), 4, "b"), (2, _lsn(2), _lsn(1), 2, "c")]]
    assert _run(spark, tmp_root, second) == {1: "b", 2: "c"}


def test_stream_replayed_batch_is_harmless(spark, tmp_root):
    rows = [(1, _lsn(1), _lsn(1), 2, "a"), (2, _lsn(2), _lsn(1), 2, "b")]
    assert _run(spark, tmp_root, [rows, rows]) == {1: "a", 2: "b"}


def _python_latest(rows):
    best = {}
    for r in rows:
        k = r[0]
        key = (r[2] is not None, r[2], r[3], r[4])  # cursor (NULL last), load id, tiebreak
        if k not in best or key > best[k][0]:
            best[k] = (key, r)
    return {k: v[1][1] for k, v in best.items()}


@settings(max_examples=20, deadline=None)
@given(
    rows=st.lists(
        st.tuples(
            st.integers(0, 5),
            st.text(min_size=1, max_size=3),
            st.one_of(st.none(), st.integers(0, 4)),
            st.integers(0, 3),
            st.integers(0, 1000),
        ),
        min_size=1,
        max_size=40,
        unique_by=lambda r: (r[0], r[2], r[3], r[4]),
    )
)
def test_dedupe_matches_python_oracle_and_is_shuffle_invariant(spark, rows):
    schema = "k int, v string, cursor int, _load_id int, tb int"
    df = spark.createDataFrame(rows, schema)
    got = {r["k"]: r["v"] for r in dedupe_latest(df, "k", "cursor", ("tb",)).collect()}
    assert got == _python_latest(rows)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    df2 = spark.createDataFrame(shuffled, schema).repartition(3)
    assert {r["k"]: r["v"] for r in dedupe_latest(df2, "k", "cursor", ("tb",)).collect()} == got


def test_scd2_history_including_a_hot_key_split_across_partitions(spark):
    # Key 0 holds most rows, so the range partitioning must split it.
    rows = [(0, t, f"v{t}") for t in range(200)] + [(k, t, f"k{k}t{t}") for k in range(1, 20) for t in (5, 1, 3)]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    out = scd2_history(df, ["k"], "t", partitions=8).collect()
    assert len(out) == len(rows)
    by = {(r["k"], r["t"]): r for r in out}
    for t in range(199):
        assert by[(0, t)]["valid_to"] == t + 1 and not by[(0, t)]["is_current"]
    assert by[(0, 199)]["is_current"] and by[(0, 199)]["valid_to"] is None
    for k in range(1, 20):
        assert (by[(k, 1)]["valid_to"], by[(k, 3)]["valid_to"], by[(k, 5)]["valid_to"]) == (3, 5, None)


def test_compact_folds_batches_into_current_table(spark, tmp_root):
    batches = [[(1, _lsn(1), _lsn(1), 2, "a"), (2, _lsn(1), _lsn(1), 2, "b")], [(2, _lsn(2), _lsn(1), 1, "gone")]]
    _run(spark, tmp_root, batches)
    cdc_stream.compact(spark, f"{tmp_root}/sink", ["k"])
    state = lambda: {r["k"]: r["v"] for r in cdc_stream.current_state(spark, f"{tmp_root}/sink", ["k"]).collect()}
    assert state() == {1: "a"}
    assert not lake.folders(spark, f"{tmp_root}/sink/batches") and len(lake.folders(spark, f"{tmp_root}/sink/base")) == 1
    # Tombstones live on in the base: an older insert that arrives later stays out.
    assert _run(spark, tmp_root, [[(2, _lsn(1), _lsn(2), 2, "late"), (3, _lsn(4), _lsn(1), 2, "c")]]) == {1: "a", 3: "c"}
    cdc_stream.compact(spark, f"{tmp_root}/sink", ["k"])
    assert state() == {1: "a", 3: "c"} and len(lake.folders(spark, f"{tmp_root}/sink/base")) == 1


def test_scd2_versions_without_a_cursor(spark):
    """A version that another one follows is not current, whatever the cursors."""
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (1, 3, "c"), (2, None, "d")], "k int, t int, v string")
    out = {r["v"]: (r["valid_to"], r["is_current"]) for r in scd2_history(df, ["k"], "t", ("v",), partitions=3).collect()}
    assert out == {"a": (None, False), "b": (3, False), "c": (None, True), "d": (None, True)}


def test_scd2_history_shuffles_rows_once_and_splits_a_hot_key(spark):
    plain = spark.createDataFrame([(k, t) for k in range(300) for t in range(3)], "k int, t int")
    out = scd2_history(plain, ["k"], "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    hot = spark.createDataFrame([(0, t, t) for t in range(500)] + [(None, t, t) for t in range(300)] + [(k, 1, 0) for k in range(1, 50)], "k int, t int, b int")
    dealt = scd2_history(hot.withColumn("d", F.coalesce("k", F.lit(7)) % 3), ["k"], "t", (F.col("b"),), partitions=8, written=True, deal=("d",))
    assert "hashpartitioning(d#" in (plan := dealt._jdf.queryExecution().executedPlan().toString()) and "__range" in plan
    got = {(r["k"], r["t"]): (r["valid_to"], r["is_current"]) for r in dealt.collect()}
    want = {(0, t): (t + 1 if t < 499 else None, t == 499) for t in range(500)} | {(None, t): (t + 1 if t < 299 else None, t == 299) for t in range(300)}
    assert got == want | {(k, 1): (None, True) for k in range(1, 50)}
