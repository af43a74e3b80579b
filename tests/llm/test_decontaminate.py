from __future__ import annotations

import random

import pytest

from terrace.llm.decontaminate import MIN_CHARS, RATE, Pattern, matches, normal, remove

from .helpers import ODD, no_docs, odd_docs, prose


def distance(item: str, text: str) -> int:
    """Least edits between ``item`` and any stretch of ``text``, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    t = list(text)
    for _ in range(edits):
        at = rng.randrange(len(t))
        match rng.randrange(3):
            case 0:
                t[at] = rng.choice("abcxyz ")
            case 1:
                del t[at]
            case _:
                t.insert(at, rng.choice("abcxyz "))
    return "".join(t)


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        text = edited(rng, item, rng.randrange(6)) if rng.random() < 0.5 else ""
        text = "".join(rng.choice("abc ") for _ in range(20)) + text + "cab"
        assert Pattern(item).distance(text)[0] == min(distance(item, text), len(item))


def test_matches_against_brute_force(spark):
    rng = random.Random(2)
    items = [(k, prose(rng, rng.choice([6, 20, 45]), 60)) for k in range(12)] + [(90, "Tiny"), (91, None), (92, "")]
    docs = []
    for i in range(80):
        text = prose(rng, 40, 60)
        if i % 2:
            k, item = items[rng.randrange(12)]
            change = rng.choice([0, 1, int(RATE * len(item)), int(RATE * len(item)) + 3])
            text = text[:90] + " " + edited(rng, item.upper() if i % 4 == 1 else item.replace(" ", ",  "), change) + "! " + text[90:]
        docs.append((i, text))
    got = {
        (r["doc_id"], r["item_id"])
        for r in matches(
            spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        ).collect()
    }
    expected = set()
    forms = normal([t for _, t in items])
    for (i, _), text in zip(docs, normal([t for _, t in docs]), strict=True):
        for (k, _), item in zip(items, forms, strict=True):
            short = item and len(item) < MIN_CHARS and f" {item} " in f" {text} "
            if short or len(item) >= MIN_CHARS and distance(item, text) <= int(RATE * len(item)):
                expected.add((i, k))
    assert got == expected and len(expected) > 20


@pytest.mark.parametrize("part_chars", [200, 10**6])
def test_a_large_benchmark_takes_more_passes(spark, part_chars):
    rng = random.Random(3)
    items = [(k, prose(rng, 12, 10**6)) for k in range(20)]
    docs = [(k, f"lead {t} tail") for k, t in items] + [(100, prose(rng, 50, 10**6))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in matches(d, b, part_chars=part_chars).collect()} == {(k, k, 0) for k in range(20)}
    assert [r["doc_id"] for r in remove(d, b, part_chars=part_chars).collect()] == [100]


def test_short_items_are_whole_words_without_edits(spark):
    items = [(1, "Four"), (2, "the Red-Sea"), (3, "..."), (4, "x")]
    docs = [(1, "four"), (2, "The red, sea!"), (3, "fourteen of the red seas"), (4, "it took four days at the red sea"), (5, "..."), (6, "")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r["doc_id"], r["item_id"], r["edits"]) for r in matches(d, b).collect())
    assert found == [(1, 1, 0), (2, 2, 0), (4, 1, 0), (4, 2, 0)]
    assert sorted(r["doc_id"] for r in remove(d, b).collect()) == [3, 4, 5, 6]


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, "SAME words, in a row for all of us here"), (None, None)], "item_id long, text string")
    ids = [r["doc_id"] for r in matches(docs, items).collect()]
    assert sorted(i for i in ids if i) == [5, 5, 6] and ids.count(None) == 1
    left = remove(docs, items)
    assert left.columns == docs.columns and left.count() == len(ODD) - 4
    none = spark.createDataFrame([], "item_id long, text string")
    assert remove(docs, none).count() == len(ODD) and matches(docs, none).count() == 0
    assert matches(no_docs(spark), items).count() == 0
