from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from terrace.llm.resampling import importance, resample
from tests.llm.helpers import ODD, no_docs, odd_docs, prose, same_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def hashes(text, n, dims):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [crc32(" ".join(words[i : i + k]).encode()) % dims for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n=1, dims=10_000, min_words=20, percent=10):
    found = [(i, *hashes(t, n, dims)) for i, t in docs]
    s, t = Counter(b for *_, x in found for b in x), Counter(b for x in target for b in hashes(x, n, dims)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + dims) / ((s[b] + 1) * (total_t + dims)))) for b in range(dims)]
    rows = []
    for i, words, x in found:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in x)
        rows.append((i, words, len(x), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = Counter()
    rank = {}
    for k, r in enumerate(able[: len(able) * percent // 100]):
        rank.setdefault(r, []).append(k + 1)
    out = []
    for r in rows:
        mine = rank.get(r, [])
        out.append((*r, mine[drawn[r]] if drawn[r] < len(mine) else None))
        drawn[r] += 1
    return out


def texts(seed, n):
    rng = random.Random(seed)
    common = [prose(rng, 9) for _ in range(20)]
    return ["\n".join(rng.choice([prose(rng, rng.randrange(0, 30)), rng.choice(common), "", "--- !"]) for _ in range(rng.randrange(0, 9))) for _ in range(n)]


def check(spark, docs, target, **options):
    df = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    tg = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance(df, tg, **options)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(docs, target, **options)))


def test_equals_brute_force(spark):
    docs = list(enumerate(texts(1, 150)))
    check(spark, docs, ["T1 t2, t3 t4!", "t5 t6"])


def test_runs_across_lines(spark):
    docs = list(enumerate(texts(2, 90)))
    check(spark, docs, texts(3, 5), n=3, dims=500, percent=30)


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in ODD]
    check(spark, docs, ["same words in a row", None, "", "ÉTÉ été 123"], percent=60, min_words=1)
    same_rows(importance(odd_docs(spark), no_docs(spark)), importance(odd_docs(spark).select("text", "doc_id"), no_docs(spark)))


def test_empty(spark):
    assert importance(no_docs(spark), no_docs(spark)).count() == 0
    assert importance(no_docs(spark), odd_docs(spark)).count() == 0
    assert resample(no_docs(spark), odd_docs(spark)).count() == 0


def test_ties_and_ranks_over_partitions(spark):
    rows = [(7, prose(random.Random(4), 25))] * 40 + [(None, prose(random.Random(4), 25))] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = importance(df, no_docs(spark), percent=50)
    assert sorted(r.rank for r in got.collect() if r.rank is not None) == list(range(1, 41))


def test_draw_leans_to_the_target(spark):
    rng = random.Random(5)
    near = [(i, " ".join(f"law{rng.randrange(50)}" for _ in range(40))) for i in range(100)]
    far = [(100 + i, " ".join(f"cake{rng.randrange(50)}" for _ in range(40))) for i in range(900)]
    df = spark.createDataFrame(near + far, "doc_id long, text string").withColumn("rank", F.lit("kept"))
    target = spark.createDataFrame([(" ".join(f"law{i}" for i in range(50)),)], "text string")
    got = resample(df, target).collect()
    assert len(got) == 100 and all(r.rank == "kept" for r in got)
    assert sum(r.doc_id < 100 for r in got) >= 90
