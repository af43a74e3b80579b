from __future__ import annotations

import random
import zlib

import numpy as np

from terrace.llm import string_kernel as kernel
from terrace.llm.toxicity import keep_clean, score

from .helpers import ODD, no_docs, odd_docs

INSULTS = ["blorkface", "snivelwort", "grubhead"]


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    syllables = ["an", "er", "th", "in", "on", "st", "re", "ou", "ti", "el", "da", "mo"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(20, 120))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(INSULTS)
        docs.append((i, " ".join(w), "en", "s"))
        labels.append((i, 1, toxic))
    return docs, labels


def kernel_by_hand(s, t):
    """Sum over common three-character subsequences of the product of their gap weights."""
    total = 0.0
    for a in kernel.TRIPLES:
        for b in kernel.TRIPLES:
            if a[2] < len(s) and b[2] < len(t) and [s[i] for i in a] == [t[i] for i in b]:
                total += kernel.DECAY ** (a[2] - a[0] - 2 + b[2] - b[0] - 2)
    return total / (kernel._NORM[len(s)] * kernel._NORM[len(t)])


def test_kernel_against_its_definition():
    pairs = [("abcdefg", "abcdefg"), ("abcdefg", "abxcdef"), ("^idiot$", "^idixot"), ("abc", "abc"), ("aaaaaaa", "aaaa"), ("abcdefg", "hijklmn")]
    for s, t in pairs:
        codes = np.zeros((2, kernel.WIDTH), np.uint32)
        for row, text in enumerate((s, t)):
            codes[row, : len(text)] = [ord(c) for c in text]
        place, phi = kernel.features(codes)
        assert abs(float(phi[:, 0] @ phi[:, 1]) - kernel_by_hand(s, t)) < 1e-3
        assert np.allclose(kernel.project(codes, phi[:, 0].copy(), place), phi.T @ phi[:, 0], atol=1e-4)


def test_words_keep_gapped_forms_together():
    letters, offsets, owner = kernel.words(["He said i.d.i.o.t! and i d i o t", None, "\0x"])
    found = ["".join(map(chr, letters[offsets[k] : offsets[k + 1]])) for k in range(len(owner))]
    assert found == ["he", "said", "idiot", "and", "idiot", "x"] and list(owner) == [0, 0, 0, 0, 0, 2]


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    truth = {i: t for i, _, t in labels}
    got = score(d, lab).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 200
    assert sum(r["predicted"] != truth[r["doc_id"]] for r in held) <= 3
    # An inserted character and spelled-out forms still reach a text's score.
    odd = spark.createDataFrame(
        [(10_001, "an er b.l.o.r.k.f.a.c.e th in snivel-wort re grubhead", "en", "s"), (10_002, "an er th in", "en", "s")],
        "doc_id long, text string, lang string, source string",
    )
    both = {r["doc_id"]: r["predicted"] for r in score(d.union(odd), lab).collect()}
    assert both[10_001] == 1 and both[10_002] == 0


def test_odd_inputs(spark):
    docs, labels = corpus(300, 3)
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (5, 1, 1), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    d = odd_docs(spark)
    known = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = score(known.union(d.select("doc_id", "text", "lang", "source")), lab).collect()
    assert len(got) == len(docs) + len(ODD) and all(r["score"] is not None for r in got)
    kept = keep_clean(d, lab)
    assert kept.columns == d.columns
    for some in ([], [(1, 1, 0)], [(5, 1, 1)]):
        none = spark.createDataFrame(some, "doc_id long, quality int, toxic int")
        assert score(d, none).count() == len(ODD)
    assert score(no_docs(spark), lab).count() == 0
