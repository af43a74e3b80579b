"""Block index: postings in blocks with score bounds, kept in segments that publishes add.

Layout under a root, every folder written once and never changed:

* ``segments/<n>/docs``: (block, pos, doc_id, dl, tokens) of a segment's documents, in ranges of
  the id; a block is ``BLOCK`` neighbouring documents;
* ``segments/<n>/blocks``: one row per (term, block) with the number of postings, the largest
  term frequency and the smallest length among them, the documents as a bitmap, and the postings
  (id as the gap to the block's first id, term frequency, length), range-clustered by term;
* ``dead/<v>``: documents of older segments that publish ``v`` changed or removed;
* ``manifest/<v>``: the state after publish ``v`` (live segments with their sizes, documents and
  words in all). It is written last, so a publish that fails leaves the state before it.

A publish writes a segment of the new and changed documents, marks their former versions dead,
and keeps the corpus statistics by differences. Segments of about one size merge, ``FAN`` at a
time, from their stored tokens, so a document is rewritten a logarithmic number of times.

Search is exact BM25 top-k (see ``search``), worked from bounds. BM25 rises with the term
frequency and falls with the length, so a block's largest frequency and smallest length bound
the score of its documents under any corpus statistics. The k blocks with the largest bounds are
scored first; their k-th score is a threshold, and blocks whose bound is below it are skipped.
Totals come from the bitmaps of all matching blocks, less the dead documents that match.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.functions.expressions import tokenize
from terrace.operators.search import bm25_weight, query_terms
from terrace.session import materialize
from terrace.sources import lake

BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS
FAN = 4  # segments of one size class that merge
ROUNDED = 2e-6  # scores are rounded to 6 decimals; a bound is not


@dataclass(frozen=True)
class State:
    """What a manifest says: live segments with their documents, and the corpus statistics."""

    version: int = 0
    segments: tuple[tuple[int, int], ...] = ()
    doc_count: int = 0
    total_length: int = 0
    next_segment: int = 1


def _manifest(version: int) -> str:
    return f"{version:09d}"


def read_state(spark: SparkSession, root: str) -> State:
    """The state after the last completed publish."""
    versions = lake.folders(spark, f"{root}/manifest")
    if not versions:
        return State()
    found = json.loads(spark.read.text(f"{root}/manifest/{versions[-1]}").first()["value"])
    return State(**{**found, "segments": tuple(tuple(s) for s in found["segments"])})


def _write_state(spark: SparkSession, root: str, state: State) -> None:
    row = json.dumps(state.__dict__)
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/manifest/{_manifest(state.version)}")


def _all(spark: SparkSession, root: str, table: str, segments: list[int]) -> DataFrame | None:
    parts = [spark.read.parquet(f"{root}/segments/{n}/{table}").withColumn("segment", F.lit(n)) for n in segments]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _dead(spark: SparkSession, root: str, state: State, since: int = 0) -> DataFrame | None:
    """(segment, doc_id, dl, tokens) of dead documents in live segments."""
    live = [n for n, _ in state.segments]
    parts = [spark.read.parquet(f"{root}/dead/{v}") for v in lake.folders(spark, f"{root}/dead") if since < int(v) <= state.version]
    return reduce(DataFrame.unionByName, parts).filter(F.col("segment").isin(live)) if parts and live else None


def live_documents(spark: SparkSession, root: str, state: State, segments: list[int] | None = None) -> DataFrame | None:
    """(segment, doc_id, dl, tokens) of the documents that searches can find."""
    docs = _all(spark, root, "docs", [n for n, _ in state.segments] if segments is None else segments)
    dead = _dead(spark, root, state)
    if docs is None or dead is None:
        return docs
    return docs.join(dead.select("segment", "doc_id"), ["segment", "doc_id"], "left_anti")


_ENTRIES = pa.list_(pa.struct([("gap", pa.int64()), ("tf", pa.int32()), ("dl", pa.int32())]))
_POSTINGS = "term string, block long, n int, max_tf int, min_dl int, first_id long, bits binary, entries array<struct<gap:long,tf:int,dl:int>>"


def _block_postings(docs: pa.Table) -> pa.Table:
    """One row per term of a block's documents, at most ``BLOCK`` of them."""
    docs = docs.combine_chunks().sort_by("pos")
    ids, lengths, pos = (docs.column(c).to_numpy() for c in ("doc_id", "dl", "pos"))
    tokens = docs.column("tokens").combine_chunks()
    each = tokens.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(ids)), tokens.value_lengths().to_numpy())
    places, tf = np.unique(each.indices.to_numpy().astype(np.int64) * BLOCK + owner, return_counts=True)
    code, owner = places // BLOCK, places % BLOCK
    start = np.flatnonzero(np.diff(code, prepend=-1))
    n = np.diff(np.append(start, len(code)))
    first, dl, tf = ids[owner[start]], lengths[owner].astype(np.int32), tf.astype(np.int32)
    low, most, bits = dl, tf, np.left_shift(np.uint64(1), pos[owner].astype(np.uint64))
    if len(start):
        low, most, bits = np.minimum.reduceat(dl, start), np.maximum.reduceat(tf, start), np.bitwise_or.reduceat(bits, start)
    raw = bits.astype("<u8").tobytes()
    entries = pa.StructArray.from_arrays([pa.array(ids[owner] - np.repeat(first, n)), pa.array(tf), pa.array(dl)], fields=list(_ENTRIES.value_type))
    return pa.table({
        "term": each.dictionary.take(pa.array(code[start])).cast(pa.string()), "block": pa.array(np.full(len(start), docs.column("block")[0].as_py(), np.int64)),
        "n": pa.array(n.astype(np.int32)), "max_tf": pa.array(most), "min_dl": pa.array(low), "first_id": pa.array(first),
        "bits": pa.array([raw[i : i + BLOCK // 8] for i in range(0, len(raw), BLOCK // 8)], pa.binary()),
        "entries": pa.ListArray.from_arrays(pa.array(np.append(start, len(code)).astype(np.int32)), entries),
    })


def _write_segment(docs: DataFrame, path: str) -> tuple[int, int]:
    """Write (doc_id, dl, tokens) as a segment; (documents, words).

    The row number inside a sorted range partition numbers the documents, so no task sees more
    than its range. The posting list of a term in a block has at most ``BLOCK`` entries, and a
    block's documents are worked together, so single postings are never shuffled.
    """
    spark = docs.sparkSession
    place = F.monotonically_increasing_id()  # partition in the upper bits, row in the lower 33
    ordered = docs.select("doc_id", "dl", "tokens").repartitionByRange("doc_id").sortWithinPartitions("doc_id").withColumn("_place", place)
    ordered.select(
        F.shiftright("_place", BLOCK_BITS).alias("block"), F.col("_place").bitwiseAND(F.lit(BLOCK - 1)).cast("int").alias("pos"), "doc_id", "dl", "tokens"
    ).write.mode("overwrite").parquet(f"{path}/docs")
    written = spark.read.parquet(f"{path}/docs")
    blocks = written.select("block", "pos", "doc_id", "dl", "tokens").groupBy("block").applyInArrow(_block_postings, _POSTINGS)
    blocks.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/blocks")
    n, words = written.agg(F.count(F.lit(1)), F.coalesce(F.sum("dl"), F.lit(0))).first()
    return int(n), int(words)


def publish(changes: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", deleted_col: str | None = None) -> State:
    """Add the documents in ``changes``, replace those that are there, remove those marked deleted.

    Ids are integers, one row per id; a row without an id is left out, a NULL text is empty. Ids
    that are removed but not there are ignored.
    """
    spark = changes.sparkSession
    gone = F.coalesce(F.col(deleted_col), F.lit(False)) if deleted_col else F.lit(False)
    tokens = F.coalesce(tokenize(F.col(text_col)), F.array().cast("array<string>"))
    rows = changes.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), gone.alias("gone"), tokens.alias("tokens"))
    rows = materialize(rows.withColumn("dl", F.size("tokens")))
    repeated = rows.groupBy("doc_id").count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"changes hold document {repeated[0]['doc_id']} more than once")
    state = read_state(spark, root)
    version, count, words = state.version + 1, state.doc_count, state.total_length
    live = live_documents(spark, root, state)
    if live is not None:
        killed = live.join(rows.select("doc_id"), "doc_id", "left_semi").select("segment", "doc_id", "dl", "tokens")
        killed.write.mode("overwrite").parquet(f"{root}/dead/{_manifest(version)}")
        n, lost = spark.read.parquet(f"{root}/dead/{_manifest(version)}").agg(F.count(F.lit(1)), F.coalesce(F.sum("dl"), F.lit(0))).first()
        count, words = count - n, words - lost
    segments, following = list(state.segments), state.next_segment
    kept = rows.filter(~F.col("gone"))
    if not kept.isEmpty():
        n, more = _write_segment(kept, f"{root}/segments/{following}")
        segments.append((following, n))
        count, words, following = count + n, words + more, following + 1
    state = State(version, tuple(segments), count, words, following)
    _write_state(spark, root, state)
    return _merged(spark, root, state)


def _size_class(documents: int) -> int:
    return (max(1, documents).bit_length() - 1) // 2  # powers of FAN


def _merged(spark: SparkSession, root: str, state: State) -> State:
    """Merge size classes that hold ``FAN`` segments; each merge is a state of its own."""
    while True:
        classes: dict[int, list[int]] = {}
        for n, documents in state.segments:
            classes.setdefault(_size_class(documents), []).append(n)
        full = [c for c in sorted(classes) if len(classes[c]) >= FAN]
        if not full:
            return state
        old = classes[full[0]]
        kept = [s for s in state.segments if s[0] not in old]
        n, _ = _write_segment(live_documents(spark, root, state, old), f"{root}/segments/{state.next_segment}")
        state = State(state.version + 1, (*kept, (state.next_segment, n)), state.doc_count, state.total_length, state.next_segment + 1)
        _write_state(spark, root, state)


def _top(scored: DataFrame, k: int, *order) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def search(
    spark: SparkSession, root: str, queries: DataFrame, k: int = 10, query_id: str = "query_id", q: str = "q"
) -> tuple[DataFrame, DataFrame]:
    """(query_id, rank, doc_id, score, total) of the k best documents of every query, and how many
    matching blocks each query had and scored (query_id, blocks, scored)."""
    state = read_state(spark, root)
    blocks = _all(spark, root, "blocks", [n for n, _ in state.segments])
    if blocks is None:
        kind = queries.schema[query_id].dataType.simpleString()
        return (
            spark.createDataFrame([], f"query_id {kind}, rank int, doc_id long, score double, total long"),
            spark.createDataFrame([], f"query_id {kind}, blocks long, scored long"),
        )
    terms = materialize(query_terms(queries, query_id, q))
    # A block's postings are kept together: sums per query and block or document are then nearly
    # complete before they are shuffled. The number keeps tasks: hits are small beside what queries
    # make of them.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hits = materialize(blocks.join(terms.select("term").distinct(), "term", "left_semi").repartition(tasks, "segment", "block"))
    dead = _dead(spark, root, state)
    gone = None
    if dead is not None:
        gone = dead.select("segment", "doc_id", F.explode(F.array_distinct("tokens")).alias("term"))
        gone = materialize(gone.join(terms.select("term").distinct(), "term", "left_semi"))
    df = hits.groupBy("term").agg(F.sum("n").alias("df"))
    if gone is not None:
        lost = gone.groupBy("term").agg(F.count(F.lit(1)).alias("lost"))
        df = df.join(lost, "term", "left").select("term", (F.col("df") - F.coalesce("lost", F.lit(0))).alias("df")).filter("df > 0")
    asked = materialize(terms.join(df, "term"))

    def weight(tf, dl):
        return F.col("qtf") * bm25_weight(F.col(tf), F.col(dl), F.col("df"), state.doc_count, state.total_length)

    bounds = hits.select("segment", "block", "term", "max_tf", "min_dl", "bits").join(asked, "term")
    bounds = materialize(
        bounds.groupBy("query_id", "segment", "block").agg(F.sum(weight("max_tf", "min_dl")).alias("bound"), F.bitmap_or_agg("bits").alias("bits"))
        .select("query_id", "segment", "block", "bound", F.bitmap_count("bits").alias("n"))
    )

    def scores(chosen: DataFrame) -> DataFrame:
        """Exact scores of the live documents in the chosen (query_id, segment, block)."""
        found = chosen.select("query_id", "segment", "block").join(hits.select("segment", "block", "term", "first_id", "entries"), ["segment", "block"])
        found = found.join(asked, ["query_id", "term"]).select(
            "query_id", "segment", "term", "qtf", "df", (F.col("first_id")).alias("first_id"), F.inline("entries")
        ).withColumn("doc_id", F.col("first_id") + F.col("gap"))
        found = found.groupBy("query_id", "segment", "doc_id").agg(F.round(F.sum(weight("tf", "dl")), 6).alias("score"))
        if gone is not None:  # of a document's versions at most one is alive
            found = found.join(gone.select("segment", "doc_id").distinct(), ["segment", "doc_id"], "left_anti")
        return found.select("query_id", "doc_id", "score")

    best_first = [F.col("score").desc(), F.col("doc_id").asc()]
    first = _top(bounds, k, F.col("bound").desc(), F.col("segment"), F.col("block"))
    threshold = _top(scores(first), k, *best_first).filter(F.col("rank") == k).select("query_id", F.col("score").alias("threshold"))
    chosen = materialize(
        bounds.join(threshold, "query_id", "left").filter(F.col("bound") + ROUNDED >= F.coalesce("threshold", F.lit(0.0)))
        .select("query_id", "segment", "block")
    )
    totals = bounds.groupBy("query_id").agg(F.sum("n").alias("n"))
    if gone is not None:
        matching = gone.join(asked.select("query_id", "term"), "term").groupBy("query_id").agg(F.count_distinct("segment", "doc_id").alias("lost"))
        totals = totals.join(matching, "query_id", "left").withColumn("n", F.col("n") - F.coalesce("lost", F.lit(0)))
    out = _top(scores(chosen), k, *best_first).join(totals.select("query_id", F.col("n").alias("total")), "query_id")
    work = bounds.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks")).join(
        chosen.groupBy("query_id").agg(F.count(F.lit(1)).alias("scored")), "query_id", "left"
    )
    return out.select("query_id", "rank", "doc_id", "score", "total"), work.select("query_id", "blocks", F.coalesce("scored", F.lit(0)).alias("scored"))
