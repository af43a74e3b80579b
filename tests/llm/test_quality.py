from __future__ import annotations

import random
from collections import Counter

from terrace.llm.quality import MIN_WORDS, base_statistics, judge

from .helpers import no_docs, odd_docs, prose, words


def brute(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def corpus(n=700):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        text = "\n".join(prose(rng, rng.randrange(12, 40), 3000) for _ in range(3))
        kind = i % 10
        if kind == 8:
            text = " ".join(w + "###" for w in text.split(" "))
        elif kind == 9:
            text = "\n".join([prose(rng, 6)] * 30)
        rows.append((i, text, "en" if i % 3 else "de", "hot" if i % 2 else f"s{i % 5}"))
    return rows


def test_statistics_against_brute_force(spark):
    rows = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").union(
        odd_docs(spark).select("doc_id", "text", "lang", "source")
    )
    got = base_statistics(docs, "doc_id", "text").collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["text"])


def test_verdicts(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string")
    for r in judge(docs, "doc_id").collect():
        kind = r["doc_id"] % 10
        assert r["kept"] == (kind < 8), r
        assert r["base_failed"] == (kind == 9)


def test_thresholds_follow_the_data(spark):
    """Texts that all carry symbols are normal in their language: a fixed cut-off would drop them."""
    rng = random.Random(6)
    rows = [(i, " ".join(w + "#" for w in prose(rng, 60, 5000).split()), "md", "s") for i in range(400)]
    rows += [(400 + i, prose(rng, 60, 5000), "en", "s") for i in range(400)]
    rows.append((999, " ".join(w + "#" for w in prose(rng, 60, 5000).split()), "en", "s"))
    got = {r["doc_id"]: r["kept"] for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), "doc_id").collect()}
    assert all(got[i] for i in range(800)) and not got[999]


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    got = judge(docs, "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < MIN_WORDS)
    assert judge(no_docs(spark), "doc_id").count() == 0
