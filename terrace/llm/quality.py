"""Quality rules with adaptive thresholds per (language, source).

Every document gets exact base statistics, computed in one pass inside its row. The rules
compare ratios of these statistics with thresholds that follow the data: KLL quantile
sketches are built per (lang, source) from the documents that pass the base rules, merged
to languages and to the whole corpus, and a threshold is the upper fence

    q75 + FENCE * max(q75 - q25, the ratio's resolution)

of the smallest group that holds the document and at least ``min_docs`` documents. A fence
moves with the bulk of its group and rejects only what lies far outside it; a fixed
percentile would reject a share of clean documents in every group. Only statistics are
shuffled, never texts, and sketches have a fixed size, so a source with a third of all rows
costs its task one sketch per map task.

Defined cases. NULL or empty text: no words, all counts 0, base_failed. NULL lang or
source: a group of its own. Fewer than ``min_docs`` documents in the whole corpus: the
corpus fence is used all the same. No document passes the base rules: no thresholds, and
``kept`` is false everywhere. Repeated rows and repeated doc_ids: each row is judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import staged

SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
FENCE = 3.0
MIN_DOCS = 200
SKETCH_K = 400  # rank error about 0.7 %

# Ratio of a rule: (expression over the base statistics, resolution). The resolution is the
# spread below which two documents of a group are not told apart; it keeps a fence open
# where most of a group has one value, such as no symbols at all.
RATIOS: dict[str, tuple[str, float]] = {
    "symbol_ratio": ("n_symbols / word_chars", 0.02),
    "dup_line_ratio": ("n_dup_lines / n_lines", 0.15),
    "repeat_ratio": ("n_repeat_words / n_words", 0.07),
    "long_word_ratio": ("word_chars / n_words", 1.5),
    "capital_ratio": ("n_capitals / word_chars", 0.05),
}


def _chars_of(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def base_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals.

    n_repeat_words: every 5-word window is hashed to 64 bits. Where some hash occurs twice
    (one set operation per text tells), windows are sorted by hash, those with an equal
    neighbour keep their positions, and the covered words are added up as min(5, distance
    to the next such window). Sorting keeps a text of any length at n log n.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    t = docs.select(
        *keep,
        F.array_remove(F.split(text, SPACE_RUN), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "").alias("_lines"),
        (F.length(text) - _chars_of(text, SPACES)).cast("long").alias("word_chars"),
        _chars_of(text, SYMBOLS).alias("n_symbols"),
        _chars_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
    )
    n = F.size("_words")
    # The last four entries cover fewer than five words; slice() drops them.
    hashes = F.transform(
        "_words", lambda w, i: F.xxhash64(w, *(F.get("_words", i + k) for k in range(1, WINDOW)))
    )
    t = t.select(
        *keep, "word_chars", "n_symbols", "n_capitals",
        n.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.slice(hashes, 1, F.greatest(n - (WINDOW - 1), F.lit(0))).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    by_hash = F.when(
        repeats, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )
    t = t.withColumn("_sorted", by_hash).drop("_windows")
    same = lambda x, j: F.get("_sorted", j)["h"].eqNullSafe(x["h"])
    t = t.withColumn(
        "_at",
        F.array_sort(
            F.transform(
                F.filter("_sorted", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]
            )
        ),
    ).drop("_sorted")
    covered = F.aggregate(
        F.transform("_at", lambda p, j: F.least(F.coalesce(F.get("_at", j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return t.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines", "n_capitals",
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _ratios() -> list[Column]:
    return [F.coalesce(F.expr(f"try_divide({e.replace(' / ', ', ')})"), F.lit(0.0)).alias(f"_{n}") for n, (e, _) in RATIOS.items()]


def thresholds(stats: DataFrame, min_docs: int = MIN_DOCS, fence: float = FENCE) -> DataFrame:
    """Fences per (lang, source) group, from sketches merged up to language and corpus.

    ``stats``: base statistics with lang and source. One row per (lang, source) seen.
    """
    sound = stats.filter(~base_failed()).select("lang", "source", *_ratios())
    leaf = staged(
        sound.groupBy("lang", "source").agg(
            F.count(F.lit(1)).alias("_n"),
            *(F.expr(f"kll_sketch_agg_double(_{r}, {SKETCH_K})").alias(f"_s_{r}") for r in RATIOS),
        ),
        "quality-sketches",
    )
    merged = lambda p: [
        F.sum("_n").alias(f"_n{p}"),
        *(F.expr(f"kll_merge_agg_double(_s_{r}, {SKETCH_K})").alias(f"_s{p}_{r}") for r in RATIOS),
    ]
    by_lang = leaf.groupBy("lang").agg(*merged("1")).withColumnRenamed("lang", "_lang")
    corpus = leaf.agg(*merged("2"))
    groups = (
        stats.select("lang", "source").distinct()
        .join(leaf.select(F.col("lang").alias("_l0"), F.col("source").alias("_s0"), "_n", *(f"_s_{r}" for r in RATIOS)),
              F.col("lang").eqNullSafe(F.col("_l0")) & F.col("source").eqNullSafe(F.col("_s0")), "left")
        .join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .join(F.broadcast(corpus), how="left")  # one row of sketches of fixed size
    )
    out = []
    for r, (_, resolution) in RATIOS.items():
        sketch = (
            F.when(F.col("_n") >= min_docs, F.col(f"_s_{r}"))
            .when(F.col("_n1") >= min_docs, F.col(f"_s1_{r}"))
            .otherwise(F.col(f"_s2_{r}"))
        )
        groups = groups.withColumn(f"_s_{r}", sketch)
        low, high = (F.expr(f"kll_sketch_get_quantile_double(_s_{r}, {q}D)") for q in (0.25, 0.75))
        out.append((high + F.lit(fence) * F.greatest(high - low, F.lit(resolution))).alias(f"max_{r}"))
    return groups.filter(F.col("_n2") > 0).select("lang", "source", *out)


def judge(docs: DataFrame, *keep: str, min_docs: int = MIN_DOCS, fence: float = FENCE) -> DataFrame:
    """Base statistics, ratios' fences, base_failed and kept for every row of ``docs``."""
    stats = staged(base_statistics(docs, "lang", "source", *keep), "quality-statistics")
    limits = staged(thresholds(stats, min_docs, fence), "quality-thresholds")
    s, t = stats.alias("s"), limits.alias("t")
    joined = s.join(
        t,
        F.col("s.lang").eqNullSafe(F.col("t.lang")) & F.col("s.source").eqNullSafe(F.col("t.source")),
        "left",
    ).select("s.*", *_ratios(), *(f"t.max_{r}" for r in RATIOS))
    within = F.lit(True)
    for r in RATIOS:
        within = within & (F.col(f"_{r}") <= F.col(f"max_{r}"))
    failed = base_failed()
    return joined.select(
        *keep, "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.coalesce(within, F.lit(False))).alias("kept"),
        *(f"max_{r}" for r in RATIOS),
    )
