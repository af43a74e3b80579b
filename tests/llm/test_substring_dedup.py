from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from terrace.llm import substring_dedup
from terrace.llm.fm_index import FMIndex, WaveletMatrix
from terrace.llm.substring_dedup import anchors, repeated_passages, without_repeats, word_hashes
from tests.llm.helpers import ODD, no_docs, odd_docs, prose, words


def brute(docs, window=35):
    cut = [words(t) for _, t in docs]
    n = Counter(tuple(w[i : i + window]) for w in cut for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, cut, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if n[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def check(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = repeated_passages(df, **options)
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in got.collect()) == brute(docs, options.get("window", 35))
    return got


def planted(seed, n, passage_words=(20, 70)):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randrange(*passage_words)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [prose(rng, rng.randrange(0, 60)) for _ in range(rng.randrange(0, 4))] + rng.choices(passages, k=rng.randrange(0, 3))
        rng.shuffle(parts)
        docs.append((i, rng.choice([" ", "\n", " \t\x0b"]).join(parts)))
    return docs + docs[: n // 10]


def test_equals_brute_force(spark):
    check(spark, planted(1, 120))


def test_hot_anchors_and_small_shards(spark):
    check(spark, planted(2, 120, (36, 50)), hot=3, shard_words=300)
    check(spark, planted(3, 60), hot=1, shard_words=50, window=12)


def test_equal_runs_under_a_hot_anchor_are_broken_up_once(spark, monkeypatch):
    rng = random.Random(8)
    passage, kept = prose(rng, 300), {}
    near = passage.split()
    docs = [(i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(60)]
    docs += [(100 + i, " ".join([*near[:150], f"other{i}", *near[151:]])) for i in range(3)]
    real = substring_dedup.staged
    monkeypatch.setattr(substring_dedup, "staged", lambda df, name: kept.setdefault(name, real(df, name)))
    check(spark, docs, hot=5)
    # Segments, and the windows broken out of them: 60 texts hold 266 repeated ones each.
    dealt = sum(kept[name].count() for name in ("substring-segments", "substring-pieces") if name in kept)
    assert dealt < 60 * 266 / 3


def test_few_words_and_periods(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 90)))) for i in range(40)] + [(99, "a " * 500), (98, "b a " * 40)]
    check(spark, docs, window=9)
    check(spark, docs, window=35, hot=2)


def test_odd_rows_and_columns(spark):
    docs = [(r[0], r[1]) for r in ODD]
    check(spark, docs)
    assert repeated_passages(no_docs(spark)).count() == 0 and without_repeats(no_docs(spark)).count() == 0
    rows = odd_docs(spark)
    got = without_repeats(rows, window=5)
    assert got.columns == rows.columns and got.count() == rows.count()
    assert {r.text for r in got.collect() if r.doc_id in (5, 6)} == {""}
    assert [r.text for r in got.collect() if r.doc_id == 2] == [None]


def test_wavelet_matrix_and_backward_search():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 11, 900)
    matrix = WaveletMatrix(symbols, 11)
    for _ in range(200):
        s, at = int(rng.integers(0, 11)), int(rng.integers(0, 901))
        assert matrix.rank(np.array([s]), np.array([at]))[0] == (symbols[:at] == s).sum()
    sequences = [rng.integers(0, 3, int(n)) for n in rng.integers(1, 40, 30)]
    index = FMIndex(sequences, np.ones(30, np.int64), 3)
    for size in (1, 2, 4, 7):
        pattern = rng.integers(0, 3, size)
        low, high = np.array([0]), np.array([index.first[-1]])
        for s in pattern[::-1]:
            low, high = index.step(np.array([s]), low, high)
        want = sum((q[i : i + size] == pattern).all() for q in sequences for i in range(len(q) - size + 1))
        assert index.occurrences(low, high)[0] == want
    n = Counter(tuple(q[i : i + 5]) for q in sequences for i in range(len(q) - 4))
    for q, got in zip(sequences, index.repeated(sequences, 5), strict=True):
        assert got.tolist() == [i for i in range(len(q) - 4) if n[tuple(q[i : i + 5])] > 1]


def test_equal_windows_have_equal_anchors():
    text = prose(random.Random(6), 60)
    whole = anchors(word_hashes(text.encode()), 35)
    inner = anchors(word_hashes(("x y  z\n" + text + " end").encode()), 35)
    assert len(whole) == 26 and (inner[3:29] == whole).all()
