"""Importance resampling of documents towards a target text: hashed n-grams, lines worked once.

A feature is a run of 1 to ``n`` consecutive words of a text; its bucket is the CRC-32 of its
words joined by a space, modulo ``dims``. A bucket's gain is the logarithm of its share in the
target over its share in the documents; a document's weight is the sum of its features' gains,
and seeded Gumbel noise on the weight turns the highest scores into a draw without replacement.

Line breaks separate words, so a text's features are those of its lines and those that cross a
line break. The work follows that:

1. Texts are cut into lines. Every distinct line is kept once, with its number of occurrences
   (pre-aggregated before the shuffle, so a line that stands everywhere is one row a task).
2. The features of each distinct line are computed once and written.
3. Corpus counts: a line's feature counts times its occurrences, and the features that cross a
   line break (none for n = 1), which are counted document by document.
4. A line's gains are summed once; documents get them by the digests of their lines, in a join
   on small rows that adaptive execution splits where a line is frequent.
5. Ranks come from range-partitioned scores: the place in the partition and the number of
   rows in the partitions before it.

Held in one place: ``dims`` counts and one row per partition, whatever the number of documents.

Defined results: a NULL or empty text has no feature and weight 0. A NULL id hashes as an empty
one. Every input row is scored, repeated rows and ids too; equal scores rank by id (NULL last),
then by input order. An empty target gives gains from its smoothed zero counts; empty documents
give no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import staged

DIMS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Separators are the ASCII characters that are neither digits nor (lower-case) letters.
_WORD_CHAR = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_BLANKED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
SLICE = 500  # rows worked at once in a batch


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BLANKED).lower().split()


def _runs(words: list[bytes], n: int) -> list[int]:
    found = [crc32(w) for w in words]
    for k in range(2, n + 1):
        found += [crc32(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)]
    return found


def _crossing(text: str, n: int) -> list[int]:
    """Hashes of the runs of at most ``n`` words that hold words of several lines."""
    words, line = [], []
    for at, part in enumerate(text.split("\n")):
        new = _words(part)
        words += new
        line += [at] * len(new)
    found = []
    for i in range(len(words)):
        for k in range(2, n + 1):
            if i + k <= len(words) and line[i] != line[i + k - 1]:
                found.append(crc32(b" ".join(words[i : i + k])))
    return found


def _features(texts: DataFrame, text: str, n: int, dims: int, crossing: bool) -> DataFrame:
    """``texts`` with column ``text`` replaced by n_words and the buckets of its features."""
    kept = [c for c in texts.columns if c != text]
    fields = [texts.schema[c] for c in kept]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + ["n_words long", "buckets array<int>"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                sizes, buckets = [], []
                for t in some.column(text).to_pylist():
                    words = [] if t is None or crossing else _words(t)
                    sizes.append(len(words))
                    hashes = _crossing(t or "", n) if crossing else _runs(words, n)
                    buckets.append((np.array(hashes, np.int64) % dims).astype(np.int32))
                offsets = np.cumsum([0, *map(len, buckets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(buckets)))
                yield pa.RecordBatch.from_arrays(
                    [some.column(c) for c in kept] + [pa.array(sizes, pa.int64()), lists], [*kept, "n_words", "buckets"]
                )

    return texts.mapInArrow(work, schema)


def _summed(featured: DataFrame, dims: int) -> DataFrame:
    """(bucket, count): ``buckets`` counted ``n`` times each, added up within tasks first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, np.int64)
        for batch in batches:
            lists = batch.column("buckets")
            times = np.repeat(batch.column("n").to_numpy(), pa.compute.list_value_length(lists).to_numpy())
            np.add.at(total, lists.flatten().to_numpy(), times)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "count"])

    return featured.select("n", "buckets").mapInArrow(work, "bucket int, count long").groupBy("bucket").agg(F.sum("count").alias("count"))


def _lines(lowered: Column) -> Column:
    return F.filter(F.split(lowered, "\n"), lambda x: x.rlike(_WORD_CHAR))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


class Corpus:
    """A text table cut into distinct lines, their features and the features across lines."""

    def __init__(self, rows: DataFrame, id_col: str, text: str, n: int, dims: int):
        base = rows.select(
            F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
            F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER).alias("text"),
        )
        lines = base.select(F.explode(_lines(F.col("text"))).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
        self.lines = staged(
            _features(lines.select(_digest(F.col("line")).alias("key"), "n", "line"), "line", n, dims, False), "resampling-lines"
        )
        own = base.select("uid", "id", F.transform(_lines(F.col("text")), _digest).alias("keys"), "text")
        own = _features(own, "text", n, dims, True) if n > 1 else own.select(
            "uid", "id", "keys", F.array().cast("array<int>").alias("buckets")
        )
        self.rows = staged(own, "resampling-rows")
        self.n, self.dims = n, dims

    def counts(self) -> np.ndarray:
        """Occurrences of every bucket: at most ``dims`` rows reach the driver."""
        found = _summed(self.lines, self.dims)
        if self.n > 1:
            across = _summed(self.rows.select(F.lit(1).cast("long").alias("n"), "buckets"), self.dims)
            found = found.union(across).groupBy("bucket").agg(F.sum("count").alias("count"))
        total = np.zeros(self.dims, np.int64)
        for bucket, count in found.collect():
            total[bucket] = count
        return total

    def weighed(self, gains: np.ndarray) -> DataFrame:
        """(uid, id, n_words, n_features, weight) of every row."""
        line = _gained(self.lines.select("key", "n_words", "buckets"), gains)
        own = self.rows.select("uid", "id", F.explode_outer("keys").alias("key"))
        found = own.join(line, "key", "left").groupBy("uid", "id").agg(
            *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_words", "n_features", "weight"))
        )
        if self.n == 1:
            return found
        across = _gained(self.rows.select("uid", "id", F.lit(0).cast("long").alias("n_words"), "buckets"), gains)
        return found.union(across).groupBy("uid", "id").agg(
            *(F.sum(c).alias(c) for c in ("n_words", "n_features", "weight"))
        )


def _gained(featured: DataFrame, gains: np.ndarray) -> DataFrame:
    """``buckets`` replaced by their number and the sum of their gains."""
    kept = [c for c in featured.columns if c != "buckets"]
    schema = ", ".join([f"{c} {featured.schema[c].dataType.simpleString()}" for c in kept] + ["n_features long", "weight long"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            sizes = pa.compute.list_value_length(lists).to_numpy().astype(np.int64)
            running = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy()])]).astype(np.int64)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sizes), pa.array(running[ends] - running[ends - sizes])],
                [*kept, "n_features", "weight"],
            )

    return featured.mapInArrow(work, schema)


def gains(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the documents."""
    dims, total_s, total_t = len(s), int(s.sum()), int(t.sum())
    return np.array(
        [math.floor(1000 * math.log((float(b) + 1) * (total_s + dims) / ((float(a) + 1) * (total_t + dims)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)],
        np.int64,
    )


def gumbel(seed: str, id_col: Column) -> Column:
    """Seeded Gumbel noise of an id, times 1000, as a long."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3, ... in ``order``, without bringing them to one task.

    The order must be total. Range partitions are sorted and written; a row's rank is its place
    there plus the sizes of the partitions before (one row a partition).
    """
    placed = staged(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "resampling-order"
    )
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    own = placed.withColumn("_part", part)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition of the sort, so this side is bounded by the number of partitions.
    return own.join(F.broadcast(before), "_part").withColumn("rank", F.col("_before") + within + 1).drop("_part", "_place", "_before")


def importance(
    docs: DataFrame, target: DataFrame, *, n: int = 1, dims: int = DIMS, seed: str = SEED, min_words: int = MIN_WORDS,
    percent: int = PERCENT, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document.

    Of the N documents with ``min_words`` words and more, floor(percent * N / 100) have a rank.
    """
    corpus = Corpus(docs, id_col, text, n, dims)
    wanted = Corpus(target, target_text, target_text, n, dims).counts()
    scored = corpus.weighed(gains(corpus.counts(), wanted))
    scored = staged(scored.withColumn("score", F.col("weight") + gumbel(seed, F.col("id"))), "resampling-scored")
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("uid").asc()]
    out = ranked(scored.filter(able), order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = out.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; rows that share an id go together."""
    drawn = importance(docs, target, id_col=id_col, **options).filter("rank is not null").select(F.col(id_col).alias("_drawn")).distinct()
    return docs.join(drawn, docs[id_col].eqNullSafe(F.col("_drawn")), "left_semi")
