from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from terrace.llm.cover_tree import LEAF, assign, build, squared
from terrace.llm.vector_codes import book_digest, compress

SCHEMA = "vec_id long, embedding array<float>, label int, _row string"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab, _ in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // parts
    books = [[r[1][p * w : p * w + w] for r in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = defaultdict(list)
            for r in kept:
                x = r[1][p * w : p * w + w]
                got[nearest(x, books[p])[1]].append(x)
            for k, xs in got.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out, by = [], defaultdict(int)
    for i, v, lab in kept:
        best = [nearest(v[p * w : p * w + w], books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by[lab] += error
        out.append((i, lab, "".join(f"{k:02x}" for _, k in best), error))
    return sorted(((*r, by[r[1]]) for r in out), key=repr), [np.array(b) for b in books]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got, books = compress(df, **options)
    want, want_books = brute(rows, **options)
    assert got.columns == ["vec_id", "label", "_row", "_code", "_error", "_label_error"]
    assert sorted(((r.vec_id, r.label, r._code, r._error, r._label_error) for r in got.collect()), key=repr) == want
    assert book_digest(books) == book_digest(want_books)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], i % 3, "x") for i in range(600)]
    rows += [(1000 + i, rows[7][1], None, "x") for i in range(60)]  # a hot vector
    rows = [(i, np.float32(v).tolist(), lab, x) for i, v, lab, x in rows]
    check(spark, rows, entries=16)


def test_odd_rows(spark):
    v = [0.25, -0.5, 1.0, 2.0]
    rows = [
        (5, v, 1, "a"), (5, v, 1, "a"), (None, v, None, "b"), (2, None, 1, None), (3, [], 1, None), (4, [1.0, None, 1.0, 1.0], 1, None),
        (6, [1.0, float("nan"), 1.0, 1.0], 1, None), (7, [1.0, float("inf"), 1.0, 1.0], 1, None), (8, [1.0, 2.0], 1, None), (1, [-0.25, 0.5, 0.125, 0.0], None, "c"),
    ]
    check(spark, rows)
    check(spark, rows, entries=2, rounds=1)


def test_far_components_are_clipped(spark):
    rows = [(i, [3e38 if i % 2 else -3e38, 0.0, 1.0, 2.0], 0, "") for i in range(6)]
    got, _ = compress(spark.createDataFrame(rows, SCHEMA), entries=2)
    assert sorted({r._code for r in got.collect()}) == ["00000000", "01000000"]


def test_empty_and_refused(spark):
    got, books = compress(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and book_digest(books) == book_digest([])
    with pytest.raises(ValueError):
        compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 0, "")], SCHEMA))


def test_tree_covers_separates_and_settles_whole_subtrees():
    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (20, 4))
    points = centres[rng.integers(0, 20, 3000)] + rng.integers(-30, 30, (3000, 4))
    order, nodes, radii = build(points)
    assert sorted(order) == list(range(3000))
    points = points[order]
    for (lo, hi, loose, first, last, mid), r in zip(nodes, radii, strict=True):
        assert lo <= mid < hi
        far = np.sqrt(((points[lo:hi] - points[mid]) ** 2).sum(1))
        assert far.max() <= r + 1e-9
        assert sum(hi2 - lo2 for lo2, hi2, *_ in nodes[first:last]) == loose - lo
        assert all(radii[c] <= r / 2 + 1e-6 for c in range(first, last))
        mids = [points[nodes[c][5]] for c in range(first, last)]
        assert all(((a - b) ** 2).sum() > (r / 2) ** 2 for i, a in enumerate(mids) for b in mids[:i])
        assert first == last or hi - lo > LEAF
    code, count, total, compared = assign(points, nodes, radii, centres)
    want = squared(points, centres).argmin(1)
    assert (code == want).all() and compared < 600
    assert (count == np.bincount(want, minlength=20)).all()
    assert all((total[k] == points[want == k].sum(0)).all() for k in range(20))


def test_large_integers_stay_exact():
    rng = np.random.default_rng(3)
    points = rng.integers(-(1 << 26), 1 << 26, (50, 16))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in points[:9]] for p in points]
    assert squared(points, points[:9]).tolist() == want
