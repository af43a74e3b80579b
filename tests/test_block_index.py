"""Block index: publishes against a rebuild, exact top-k against full scoring, skipped blocks."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from terrace.operators import block_index, search


def corpus(seed, n, start=0):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(4000)]
    return {start + i: " ".join(rng.choices(words, k=rng.randrange(0, 40))) for i in range(n)}


def frame(spark, docs, gone=()):
    rows = [(i, t, False) for i, t in docs.items()] + [(i, None, True) for i in gone]
    return spark.createDataFrame(rows, "doc_id long, text string, deleted boolean")


QUERIES = [(1, "w1"), (2, "w1 w2 w2 w7"), (3, "w250 w3"), (4, "nothing"), (5, ""), (6, None), (7, "w2 w3 w4 w5 w6")]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_publishes_equal_a_rebuild(spark, tmp_root):
    queries = spark.createDataFrame(QUERIES, "query_id int, q string")
    state, root = {}, f"{tmp_root}/index"
    steps = [
        (corpus(1, 300), ()), ({**corpus(2, 60, 100), 900: None, 901: "w1"}, (5, 6, 7, 12345)), (corpus(3, 20, 290), tuple(range(100, 140))),
        ({}, (0, 1, 2)), (corpus(4, 25, 400), ()), (corpus(5, 25, 430), (431,)[:0]), (corpus(6, 25, 460), ()), (corpus(7, 25, 490), (900,)),
    ]
    for docs, gone in steps:
        st = block_index.publish(frame(spark, docs, gone), root, deleted_col="deleted")
        state = {i: t for i, t in {**state, **docs}.items() if i not in gone}
        assert st.doc_count == len(state)
    # Four segments of one size class have merged on the way.
    assert len(st.segments) < sum(bool(d) for d, _ in steps)
    want = search.search_text(frame(spark, state), queries, k=5)
    got, work = block_index.search(spark, root, queries, k=5)
    assert rows(got) == rows(want)
    rebuilt = f"{tmp_root}/rebuilt"
    one = block_index.publish(frame(spark, state), rebuilt)
    assert (one.doc_count, one.total_length) == (st.doc_count, st.total_length)
    assert rows(block_index.search(spark, rebuilt, queries, k=5)[0]) == rows(want)


def test_blocks_below_the_threshold_are_skipped(spark, tmp_root):
    rng = random.Random(9)
    docs = {i: " ".join(rng.choice("abcdefghij") for _ in range(30)) for i in range(6000)}
    for i in range(640, 650):
        docs[i] = "rare rare a"
    root = f"{tmp_root}/index"
    block_index.publish(frame(spark, docs), root)
    queries = spark.createDataFrame([(1, "rare a"), (2, "a")], "query_id int, q string")
    got, work = block_index.search(spark, root, queries, k=3)
    assert rows(got) == rows(search.search_text(frame(spark, docs), queries, k=3))
    seen = {r["query_id"]: (r["blocks"], r["scored"]) for r in work.collect()}
    assert seen[1][0] >= 6000 // block_index.BLOCK and seen[1][1] <= 3
    assert seen[2][1] < seen[2][0]


def test_odd_publishes(spark, tmp_root):
    root = f"{tmp_root}/index"
    queries = spark.createDataFrame([(1, "a")], "query_id int, q string")
    assert block_index.search(spark, root, queries)[0].count() == 0
    st = block_index.publish(spark.createDataFrame([(None, "a"), (3, "a b")], "doc_id long, text string"), root)
    assert (st.doc_count, st.total_length) == (1, 2)
    with pytest.raises(ValueError):
        block_index.publish(spark.createDataFrame([(4, "a"), (4, "b")], "doc_id long, text string"), root)
    assert block_index.read_state(spark, root).doc_count == 1
    st = block_index.publish(frame(spark, {}, (3,)), root, deleted_col="deleted")
    assert st.doc_count == 0 and block_index.search(spark, root, queries)[0].count() == 0
    # Documents that match by a word of no live document are in neither ranking nor total.
    block_index.publish(frame(spark, {7: "zz a", 8: "zz"}), f"{root}2")
    block_index.publish(frame(spark, {6: "a"}, (7, 8)), f"{root}2", deleted_col="deleted")
    two = spark.createDataFrame([(1, "zz a")], "query_id int, q string")
    assert [(r["doc_id"], r["total"]) for r in block_index.search(spark, f"{root}2", two)[0].collect()] == [(6, 1)]
    # A publish that stopped before its manifest changes nothing that can be seen.
    frame(spark, {9: "a"}).select("doc_id").write.parquet(f"{root}/segments/{st.next_segment}/docs")
    assert block_index.search(spark, root, queries)[0].count() == 0
    block_index.publish(frame(spark, {9: "a"}), root)
    assert [r["doc_id"] for r in block_index.search(spark, root, queries)[0].collect()] == [9]


def test_failed_publish_is_replaced(spark, tmp_root):
    root = f"{tmp_root}/index"
    st = block_index.publish(frame(spark, {1: "a", 2: "a"}), root)
    dead = spark.createDataFrame([(1, 2, 1, ["a"])], "segment int, doc_id long, dl int, tokens array<string>")
    dead.write.parquet(f"{root}/dead/{st.version + 1:09d}")
    queries = spark.createDataFrame([(1, "a")], "query_id int, q string")
    assert {r["doc_id"] for r in block_index.search(spark, root, queries)[0].collect()} == {1, 2}
    block_index.publish(frame(spark, {1: "b"}), root)
    assert {r["doc_id"] for r in block_index.search(spark, root, queries)[0].collect()} == {2}


def test_postings_of_a_block():
    docs = pa.table({
        "block": pa.array([7, 7, 7], pa.int64()), "pos": pa.array([63, 0, 5], pa.int32()), "doc_id": pa.array([90, 10, 30], pa.int64()),
        "dl": pa.array([3, 2, 0], pa.int32()), "tokens": pa.array([["b", "a", "b"], ["a", "é"], []], pa.list_(pa.string())),
    })
    got = {r.pop("term"): r for r in block_index._block_postings(docs).to_pylist()}
    bits = lambda *pos: sum(1 << p for p in pos).to_bytes(8, "little")
    one = lambda gap, tf, dl: {"gap": gap, "tf": tf, "dl": dl}
    assert got == {
        "a": {"block": 7, "n": 2, "max_tf": 1, "min_dl": 2, "first_id": 10, "bits": bits(0, 63), "entries": [one(0, 1, 2), one(80, 1, 3)]},
        "b": {"block": 7, "n": 1, "max_tf": 2, "min_dl": 3, "first_id": 90, "bits": bits(63), "entries": [one(0, 2, 3)]},
        "é": {"block": 7, "n": 1, "max_tf": 1, "min_dl": 2, "first_id": 10, "bits": bits(0), "entries": [one(0, 1, 2)]},
    }
    assert block_index._block_postings(docs.slice(2)).num_rows == 0


def test_postings_are_counted_without_a_shuffle_of_their_own(spark):
    docs = spark.createDataFrame([(1, "a b a"), (1, "c"), (None, "a"), (2, None)], "doc_id long, text string")
    posts = search._postings(search._tokenised(search._by_id(docs, "doc_id", "text"), "doc_id", "text"), None)
    keys = re.findall(r"hashpartitioning\((\w+)#\d+L?, (\S+)", posts._jdf.queryExecution().executedPlan().toString())
    assert [k for k, _ in keys] == ["doc_id"] and keys[0][1].startswith("4")
    assert sorted(map(str, posts.collect())) == sorted(map(str, search._postings(search._tokenised(docs, "doc_id", "text"), None).collect()))
