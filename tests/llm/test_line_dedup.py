from __future__ import annotations

import random
from collections import defaultdict

from terrace.llm.line_dedup import cleaned, lines, remove_boilerplate, spread_lines

from .helpers import no_docs, odd_docs, prose, words


def brute(rows, min_sites=4, min_words=3):
    """doc_id -> text without the lines on many sites, their first place kept."""
    sites, first = defaultdict(set), {}
    key = lambda line: line.strip(" \t\r\x0b\x0c")
    for doc_id, text, site in sorted(rows, key=lambda r: r[0]):
        for at, line in enumerate(text.split("\n")):
            if len(words(line)) >= min_words:
                sites[key(line)].add(site)
                first.setdefault(key(line), (doc_id, at))
    return {
        doc_id: "\n".join(
            line for at, line in enumerate(text.split("\n"))
            if len(words(line)) < min_words or len(sites[key(line)]) < min_sites or first[key(line)] == (doc_id, at)
        )
        for doc_id, text, site in rows
    }


def corpus():
    rng = random.Random(8)
    common = [prose(rng, n) for n in (2, 3, 9, 60)]
    rows = []
    for i in range(300):
        body = [prose(rng, 10, 10**6) for _ in range(rng.randrange(3))]
        body += [rng.choice([c, f" {c}\t"]) for c in common if rng.random() < 0.2]
        if rng.random() < 0.2:
            body.append(f"near {i % 12} threshold line")  # spread over few sites each
        rng.shuffle(body)
        rows.append((i, "\n".join(body), None if i % 7 == 0 else f"site{rng.randrange(9)}"))
    return rows


def test_against_exact_counts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["_text"] for r in cleaned(docs).collect()}
    assert got == brute(rows)
    left = {r["doc_id"] for r in remove_boilerplate(docs).collect()}
    assert left == {i for i, text, _ in rows if words(got[i]) or got[i] == text}


def test_sketches_beyond_their_exact_range(spark):
    """Lines on about 3000 sites: estimates decide away from the threshold, exact counts near it."""
    spread = {f"line number {k}": n for k, n in enumerate((2_700, 2_990, 2_999, 3_000, 3_010, 3_400))}
    rows = [(i, text, f"s{i}") for text, n in spread.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    each = lines(docs)
    found = {r["line"] for r in spread_lines(each, 3_000).collect()}
    names = {r["line"]: r["n"] for r in each.groupBy("line").count().withColumnRenamed("count", "n").collect()}
    assert {names[x] for x in found} == {3_000, 3_010, 3_400}


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    out = remove_boilerplate(docs, min_sites=2)
    assert out.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    # The two lines stand on the sites a, c and NULL; the row without an id comes first.
    assert any(i is None and t and "second line" in t for i, t in texts)
    assert not any(i in (5, 6) for i, t in texts)
    assert (2, None) in texts and (1, "") in texts
    assert cleaned(no_docs(spark)).count() == 0


def test_passages_on_few_sites(spark):
    """Passages in 2 or 3 sources, or often in one, go after the near copies; short lines stay."""
    import corpus_pipeline

    rng = random.Random(11)
    own = lambda n: prose(rng, n, 10**6)
    two, three, one, short, edge, twice = own(51), own(80), own(60), own(50), own(51), own(70)
    rows = [(i, f"{own(60)}\n{p}\n{own(40)}", f"s{i % k}") for k, p, at in ((2, two, 0), (3, three, 10), (1, one, 20), (2, short, 70)) for i in range(at, at + (40 if k == 1 else k))]
    rows += [(90, f"{edge}\n{own(30)}", "a"), (91, f"{own(30)} {edge}", "b"), (92, f"{twice}\n{own(9)}\n{twice}", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, ""), "")
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(got) == {i for i, _, _ in rows}
    for passage, first in ((two, 0), (three, 10), (one, 20)):
        assert [i for i, text in got.items() if passage in text] == [first]
    # 50 words are not over 50; inside a longer line and inside one document nothing is looked for.
    untouched = {70, 71, 90, 91, 92, 0, 10, 20}
    assert {i: got[i] for i in untouched} == {i: t for i, t, _ in rows if i in untouched}
    assert all(got[i].split("\n") == [x for x in t.split("\n") if x not in (two, three, one)] for i, t, _ in rows if i not in untouched)
