from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrace.llm.mixing import SHARE, WEIGHTS, mix, mix_decisions, sainte_lague

from .helpers import no_docs, odd_docs, prose, words


def targets(sizes: dict, share=SHARE, weights=WEIGHTS, cap=2) -> dict:
    """Brute force: share out by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, budget = {}, set(order), share * sum(sizes.values())
    while free:
        level = (budget - sum(out.values())) / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > cap * sizes[s]}
        out |= {s: cap * sizes[s] for s in full} if full else {s: level * weight[s] for s in free}
        free = free - full if full else set()
    return out


def corpus(spark, seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "é", "zz", None])
        rows.append((i, prose(rng, rng.choice([0, 3, 40, 200])), "en", source))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_targets_and_takes(spark):
    rows, docs = corpus(spark)
    got = mix_decisions(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    expected, taken = targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows)
    for s, t in expected.items():
        assert abs(taken[s] - t) <= 0.02 * t + 40


def test_reruns_and_partitions_agree(spark):
    _, docs = corpus(spark, 2)
    a = sorted(map(tuple, mix_decisions(docs).select("doc_id", "taken").collect()))
    b = sorted(map(tuple, mix_decisions(docs.repartition(7, "text")).select("doc_id", "taken").collect()))
    assert a == b
    assert a != sorted(map(tuple, mix_decisions(docs, seed=5).select("doc_id", "taken").collect()))


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 12_345])
def test_highest_quotients(spark, seats):
    rng = random.Random(seats)
    votes = {i: rng.choice([0, 1, 5, 50, 50, 1000 * rng.random()]) for i in range(30)}
    df = spark.createDataFrame([(k, float(v), seats) for k, v in votes.items()], "k int, v double, seats long")
    got = {r["k"]: r["_seats"] for r in sainte_lague(df, [], "v", "seats", "k").collect()}
    won = Counter()
    for _ in range(min(seats, 200)):
        best = max(votes, key=lambda k: (votes[k] / (2 * won[k] + 1), -k))
        won[best] += 1
    if seats <= 200:
        assert got == {k: won[k] for k in votes}
    else:
        assert sum(got.values()) == seats
        total = sum(votes.values())
        assert all(abs(got[k] - seats * v / total) < 30 for k, v in votes.items())


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    got = mix_decisions(docs).collect()
    assert len(got) == docs.count()
    assert all(r["size"] == r["taken"] == 0 for r in got if r["size"] == 0)
    mixed = mix(docs)
    assert mixed.columns == [*docs.columns, "mix_words"]
    assert mixed.filter(F.col("mix_words") <= 0).count() == 0
    assert mix_decisions(no_docs(spark)).count() == 0 and mix(no_docs(spark)).count() == 0
