"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Labels are given per text, while an insult is a word of it, so training finds the words:

1. Documents of the labelled sample are cut into words; document frequencies per label are
   aggregated for words and for the character runs (grams) inside ``^word$``.
2. Grams that set toxic texts apart beyond chance are taken by a likelihood-ratio statistic,
   then weaker ones greedily for the toxic texts that no taken gram is in. Grams cover
   families of words that share a stem; copies of a text count once.
3. Windows around the taken grams are the positive examples; words of clean documents are
   the negative ones, and the clean words that score highest are added in further rounds.
4. The machine of ``string_kernel`` is trained on them and folded into one weight vector.

There are two machines, for words that occur in toxic texts only and for those that clean
texts have at times. A document's features are its largest decision values, its hits and
their density: gapped, spelled-out or inserted-character forms of an insult share most
subsequences with it. A logistic curve fitted on labelled documents that took no part in training turns them
into a score.

Sets of grams and the machines are worked in one task over the bounded sample; the driver holds
the weights. Training reads at most ``TOXIC_ROWS + CLEAN_ROWS`` labelled rows for the machine and as many
for the curve, chosen by a hash of doc_id; scoring reads every whole text, without a shuffle.

Defined cases. NULL or empty text, or one without letters: no word, the lowest decision
value. Several labels for one doc_id: toxic if any is. Labels of unknown doc_ids, NULL
labels or NULL doc_ids: not used. No toxic or no clean label: every score is the share of
toxic labels. Repeated rows: scored alike. Extra columns: passed through by ``keep_clean``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm import string_kernel as kernel
from terrace.llm.common import in_task, staged
from terrace.llm.textvec import mix64, pieces

TOXIC_ROWS, CLEAN_ROWS = 3_000, 15_000
GRAMS = (4, 6)
CANDIDATES = 1_000  # grams looked at by the greedy cover
WORDS_PER_GRAM = 60
NEGATIVES = 15_000
MINED = 3_000
ROUNDS = 2
LANDMARKS = 192
EVIDENCE = 7.0  # least log-likelihood gain of a gram over texts nothing else explains
PURITY = 0.8  # least share of toxic texts among those a gram is in, were both classes alike in number
THRESHOLD = 0.7
SURE = 0.97  # least balanced share of toxic texts for a window of the first machine
FLOOR_OF_HARD = -1.0  # mined windows above it become negatives
# Curve where no labels are left to fit one, and the point the fit is drawn to.
_PLAIN = (np.array([2.0, 0.5, 1.0, 0.5, 0.5]), 0.0)


@dataclass
class Model:
    """Two machines (columns of weights over hashed subsequences) and the curve over text features."""

    weights: np.ndarray | None
    bias: np.ndarray | None
    curve: np.ndarray
    offset: float

    def features(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), kernel.N_FEATURES))
        if self.weights is not None:
            for first, end, _, _ in pieces(column):
                texts = column.slice(first, end - first).to_pylist()
                out[first:end] = kernel.text_features(texts, self.weights, self.bias)
        return out

    def probability(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(column) @ self.curve + self.offset, -30, 30)))


def _constant(log_odds: float) -> Model:
    return Model(None, None, np.zeros(kernel.N_FEATURES), log_odds)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """doc_id, toxic, text of a bounded number of labelled rows of one part of the doc_ids."""
    known = (
        labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .filter(part)
    )
    by_hash = F.xxhash64("doc_id")
    rows = known.filter("toxic = 1").orderBy(by_hash, "doc_id").limit(TOXIC_ROWS).union(
        known.filter("toxic <> 1").orderBy(by_hash, "doc_id").limit(CLEAN_ROWS)
    )
    return docs.select("doc_id", "text").join(rows, "doc_id")


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) -> one row (toxic, family, word) per distinct word of a text.

    The family is the smallest hash among the text's pairs of neighbouring words (a min-hash),
    so that copies and near copies of a text mostly count once.
    """
    for batch in batches:
        toxic = batch.column(0)
        for first, end, _, _ in pieces(batch.column(1)):
            letters, offsets, owner = kernel.words(batch.column(1).slice(first, end - first).to_pylist())
            if not len(owner):
                continue
            once, back = kernel.distinct(letters, offsets)
            names = [letters[offsets[i] : offsets[i + 1]].tobytes().decode("utf-32-le", "surrogatepass") for i in once]
            codes = np.array([zlib.crc32(n.encode("utf-8", "surrogatepass")) for n in names], np.uint64)[back]
            pair = np.where(np.append(owner[1:] == owner[:-1], False), np.append(codes[1:], np.uint64(0)), np.uint64(0))
            family = np.full(end - first, np.iinfo(np.uint64).max, np.uint64)
            np.minimum.at(family, owner, mix64(codes * np.uint64(1 << 32) + pair))
            pairs = np.unique(owner.astype(np.int64) * len(once) + back)
            row = pairs // len(once)
            yield pa.RecordBatch.from_arrays(
                [
                    toxic.take(pa.array(first + row)),
                    pa.array(family[row].view(np.int64)),
                    pa.array(names, pa.string()).take(pa.array(pairs % len(once))),
                ],
                ["toxic", "family", "word"],
            )


def _grams(word: str) -> Column:
    chain = F.concat(F.lit("^"), F.col(word), F.lit("$"))

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(chain) - (n - 1)))
        return F.transform(starts, lambda i: F.substr(chain, i, F.lit(n)))

    return F.array_distinct(F.flatten(F.array(*(of(n) for n in GRAMS))))


def _gain(t: Column, c: Column, p: float) -> Column:
    """Log-likelihood gain of 'toxic with its own share' over 'toxic with share p'."""
    n = t + c
    return t * F.log((t + 0.01) / (n * p)) + c * F.log((c + 0.01) / (n * (1 - p)))


def _chosen_grams(toxic_in: dict[str, set], clean: dict[str, int], p: float, tested: int) -> list[str]:
    """Grams whose own gain is beyond chance among all tested, then a greedy cover of the rest.

    The cover counts only toxic texts that no taken gram is in, so a weak gram is taken for
    what it adds and not for standing beside an insult.
    """

    def gain(t: int, c: int) -> float:
        n = t + c
        if t <= p * n:
            return 0.0
        return t * np.log(t / (n * p)) + (c * np.log(c / (n * (1 - p))) if c else 0.0)

    pure = toxic_in
    strong = np.log(max(tested, 2)) + 2
    taken = [g for g, f in sorted(pure.items()) if gain(len(f), clean[g]) >= strong]
    left = {x for f in pure.values() for x in f} - {x for g in taken for x in pure[g]}
    rest = {g: f for g, f in pure.items() if g not in set(taken)}
    while rest:
        best = max(rest, key=lambda g: (gain(len(rest[g] & left), clean[g]), -len(g), g))
        if gain(len(rest[best] & left), clean[best]) < EVIDENCE:
            break
        taken.append(best)
        left -= rest.pop(best)
    return taken


def _around(words: list[str], grams: list[str]) -> np.ndarray:
    """One window per word, placed so that it holds the gram."""
    out = []
    for word, gram in zip(words, grams, strict=True):
        codes, count = kernel.windows_of([word])
        at = max(0, f"^{word}$".find(gram))
        out.append(codes[min(at, int(count[0]) - 1)])
    return np.array(out, np.uint32)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled rows that are not held out (see the module for the bounds)."""
    usable = ~held_out(F.col("doc_id"))
    fold = F.pmod(F.xxhash64(F.lit("curve"), F.col("doc_id")), F.lit(4))
    sample = _sample(docs, labels, usable & (fold != 0))
    words = sample.select("toxic", "text").mapInArrow(_words_of, "toxic int, family long, word string")
    words = staged(words.distinct(), "toxic-words")
    vocab = staged(
        words.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")),
        "toxic-vocabulary",
    )
    counts = {r["toxic"]: r["n"] for r in words.groupBy("toxic").agg(F.countDistinct("family").alias("n")).collect()}
    n_t, n_c = counts.get(1, 0), counts.get(0, 0)
    if not n_t or not n_c:
        return _constant(30.0 if n_t else -30.0)
    p = n_t / (n_t + n_c)

    grams = staged(
        vocab.withColumn("gram", F.explode(_grams("word"))).groupBy("gram").agg(F.sum("t").alias("t"), F.sum("c").alias("c")),
        "toxic-grams",
    )
    likely = staged(
        grams.filter((F.col("t") >= 2) & (F.col("t") / n_t >= PURITY * (F.col("t") / n_t + F.col("c") / n_c)))
        .orderBy(F.desc(_gain(F.col("t"), F.col("c"), p)), "gram").limit(CANDIDATES),
        "toxic-candidates",
    )
    places = words.filter("toxic = 1").withColumn("gram", F.explode(_grams("word"))).join(likely, "gram")
    found = places.groupBy("gram").agg(F.collect_set("family").alias("families"), F.first("c").alias("c"))
    tested = grams.count()
    taken = in_task(
        found.orderBy("gram"),  # CANDIDATES rows of at most TOXIC_ROWS families
        lambda rows: _chosen_grams({r["gram"]: set(r["families"]) for r in rows}, {r["gram"]: r["c"] for r in rows}, p, tested),
    )
    if not taken:
        return _constant(float(np.log(p / (1 - p))))

    order = Window.partitionBy("gram").orderBy(F.desc("t"), "word")
    chosen = (
        vocab.filter("t > 0").withColumn("gram", F.explode(_grams("word"))).filter(F.col("gram").isin(taken))
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= WORDS_PER_GRAM)
        .select("word", "gram", "place").orderBy("place", "gram").collect()
    )
    odds = {r["gram"]: (r["c"] / n_c) / (r["t"] / n_t) for r in likely.collect()}
    windows = _around([r["word"] for r in chosen], [r["gram"] for r in chosen])
    positive, back = np.unique(windows, axis=0, return_inverse=True)
    # A window that clean texts have too is a negative example as well, with their share.
    against = np.full(len(positive), np.inf)
    np.minimum.at(against, back, [odds[r["gram"]] for r in chosen])
    clean_words = vocab.filter("c > 0 and c >= t")
    frequent = [r["word"] for r in clean_words.orderBy(F.desc("c"), "word").limit(NEGATIVES).select("word").collect()]
    negative = np.unique(kernel.windows_of(frequent)[0], axis=0) if frequent else np.zeros((0, kernel.WIDTH), np.uint32)
    rng = np.random.default_rng(11)

    def some(x: np.ndarray, n: int) -> np.ndarray:
        return x if len(x) <= n else x[rng.choice(len(x), n, replace=False)]

    sure = against <= 1 - SURE
    columns, biases = [], []
    for mine in (sure, ~sure):
        if not mine.any():
            mine = ~mine
        weights, bias = _machine(positive[mine], against[mine], negative, clean_words, some)
        columns.append(weights)
        biases.append(bias)
    return _with_curve(docs, labels, Model(np.column_stack(columns), np.array(biases), *_PLAIN), usable & (fold == 0))


def _machine(positive: np.ndarray, against: np.ndarray, negative: np.ndarray, clean_words: DataFrame, some):
    """One machine, trained again with the clean words that score highest as more negatives."""
    negative = _without(negative, positive)
    hard = negative[:0]
    for round_ in range(ROUNDS + 1):
        fit = np.vstack([some(negative, NEGATIVES), hard])
        marks = [some(positive, LANDMARKS // 2), some(hard, LANDMARKS // 4), some(negative, LANDMARKS // 4)]
        codes = np.vstack([positive, positive, fit])
        y = np.repeat([1.0, -1.0], [len(positive), len(positive) + len(fit)])
        share = np.concatenate([np.ones(len(positive)), against * len(fit) / max(1, len(positive)), np.ones(len(fit))])
        landmarks = np.unique(np.vstack(marks), axis=0)
        # The kernel features of the sample are tables of their own size; they stay in the task.
        weights, bias = in_task(
            clean_words.sparkSession.range(1), lambda _, x=(landmarks, codes, y, share): kernel.train_svm(*x)
        )
        if round_ == ROUNDS:
            return weights, bias
        found = kernel.windows_of(_best_words(clean_words, weights, bias))[0]
        found = _without(np.unique(found[kernel.project(found, weights) + bias > FLOOR_OF_HARD], axis=0), positive)
        hard = np.unique(np.vstack([hard, found]), axis=0)


def _best_words(clean_words: DataFrame, weights: np.ndarray, bias: float) -> list[str]:
    """The MINED words of clean texts with the highest values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, count = kernel.windows_of(b.column(0).to_pylist())
            value = np.maximum.reduceat(kernel.project(codes, weights), np.cumsum(count) - count) if len(count) else np.empty(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((value + bias).astype(np.float64))], ["word", "value"])

    top = clean_words.select("word").mapInArrow(run, "word string, value double").orderBy(F.desc("value"), "word").limit(MINED)
    return [r["word"] for r in top.select("word").collect()]


def _without(rows: np.ndarray, gone: np.ndarray) -> np.ndarray:
    known = {r.tobytes() for r in gone}
    return rows[[r.tobytes() not in known for r in rows]] if len(rows) else rows


def _with_curve(docs: DataFrame, labels: DataFrame, model: Model, part: Column) -> Model:
    """Logistic curve over the text features of labelled documents not trained on.

    The curve is shifted so that it is THRESHOLD at the cut with the best F1.
    """
    sample = _sample(docs, labels, part)
    names = [f"x{i}" for i in range(kernel.N_FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = model.features(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in x.T)], ["toxic", *names])

    schema = ", ".join(["toxic int", *(f"{n} double" for n in names)])
    rows = sample.select("toxic", "text").mapInArrow(run, schema).toArrow()
    y = rows.column("toxic").to_numpy().astype(float)
    x = np.column_stack([rows.column(c).to_numpy() for c in names])
    if not y.any() or y.all():
        return model
    z = np.column_stack([x, np.ones(len(x))])
    prior = np.append(model.curve, 0.0)
    ridge, u = np.append(np.full(x.shape[1], 0.5), 1e-6), prior.copy()
    for _ in range(50):  # Newton
        prob = 1 / (1 + np.exp(-np.clip(z @ u, -30, 30)))
        s = prob * (1 - prob) + 1e-6
        step = np.linalg.solve(z.T @ (z * s[:, None]) + np.diag(ridge), z.T @ (prob - y) + ridge * (u - prior))
        u = u - step / max(1.0, np.abs(step).max())
    curve = np.maximum(u[:-1], 0.05)  # more evidence never lowers a score
    value = x @ curve
    order = np.argsort(-value, kind="stable")
    value, hit = value[order], y[order]
    f1 = 2 * np.cumsum(hit) / (np.arange(1, len(hit) + 1) + hit.sum())
    gap = np.append(value[:-1] - value[1:], 0.1)
    at = max(np.flatnonzero(gap > 0), key=lambda i: (round(f1[i], 3), gap[i]))
    cut = value[at] - gap[at] / 2
    return Model(model.weights, model.bias, curve, float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut))


def scored(docs: DataFrame, model: Model) -> tuple[DataFrame, str]:
    """``docs`` with the score as last column, and that column's name (one ``docs`` has not)."""
    at = docs.columns.index("text")
    name = "_score"
    while name in docs.columns:
        name = f"_{name}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = pa.array(model.probability(b.column(at)))
            yield pa.RecordBatch.from_arrays([*b.columns, score], [*b.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(run, schema), name


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    model = train(docs, labels)
    out, name = scored(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(name).alias("score"),
        (F.col(name) >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, all columns unchanged."""
    out, name = scored(docs, train(docs, labels))
    return out.filter(F.col(name) < threshold).drop(name)
