from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from terrace.llm.components import components
from terrace.llm.near_dedup import deduplicate, near_duplicates
from terrace.llm.superminhash import signatures

from .helpers import ODD, no_docs, odd_docs, prose, words


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, size, percent=80):
    """doc_id -> (set size, component) with all pairs compared."""
    sets = {}
    for doc_id, text in rows:
        w = words(lower(text))
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    """Copies, near copies around a hub at distances about the threshold, and short texts."""
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        base = prose(rng, rng.choice([4, 12, 80, 300]), 5000).split()
        rows.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 6, 20])):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 12))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "size"), [(1, 2), (2, 5)])
def test_groups_against_all_pairs(spark, seed, size):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, size=size).collect()}
    assert got == brute(rows, size)


def test_a_cloud_around_a_hub_loses_no_link(spark):
    """Near copies that mostly miss each other: the rounds beyond the leaders must find the rest."""
    rng = random.Random(9)
    base = prose(rng, 150, 10**6).split()
    rows = []
    for _ in range(150):
        w = list(base)
        for p in rng.sample(range(150), rng.choice([4, 8, 9, 10])):
            w[p] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(w))
    rows = list(enumerate(rows))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: c for k, (_, c) in brute(rows, 2).items()}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for n, same in ((5, 4), (40, 30), (2000, 1500)):
        pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        a, b = pool[:n], np.concatenate([pool[:same], pool[n : 2 * n - same]])
        s = signatures(np.concatenate([a, b]), np.array([n, n]), 512)
        true = same / (2 * n - same)
        assert abs((s[0] == s[1]).mean() - true) < 0.1
    assert (signatures(np.empty(0, np.uint64), np.array([0]), 8) == np.iinfo(np.uint64).max).all()


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1200)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for node, component in got.items():
        seen, todo = {node}, [node]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert component == min(seen)


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    got = near_duplicates(docs).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == (5 if r["doc_id"] in (5, 6) else r["doc_id"])
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 8] and ids.count(None) == 2
    assert near_duplicates(no_docs(spark)).count() == 0 and deduplicate(no_docs(spark)).count() == 0
