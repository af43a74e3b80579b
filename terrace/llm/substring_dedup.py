"""Substring dedup: windows of words that start at two places and more, by FM-index shards.

Every document is streamed through the shards that can hold its repeats, never through all:

1. Anchors. The anchor of a window is the least hash of its ``GRAM``-word runs. Equal windows
   have equal anchors, and consecutive windows mostly share one, so a document has an anchor
   for about every 14 words. An anchor that stands once, in one distinct text, is settled.
2. Texts are grouped by digest (identical texts count once, with their copies) and joined with
   their repeated anchors. Texts without one are finished there.
3. A run of windows under one anchor is a segment. Segments are dealt by anchor to shards of
   about ``SHARD_WORDS`` words, equal segments once with their number.
4. A shard is a compressed FM-index of its segments (``fm_index``). They stream against it:
   backward search over the wavelet matrix gives matching statistics, and intervals of at
   least the window's length that occur twice or more are reported.
5. Intervals go back to the texts and to all documents by digests.

An anchor with more than ``HOT`` places would fill a shard by itself, mostly with words around
the repeated ones. Its equal segments are counted first: one that stands twice and more is
repeated as a whole, however many texts hold it. Different segments are broken up, each once:
their windows are dealt one by one, by the hash of the whole window, once another window is
known to have the same hash; equal windows count once with their number. So a shard's size does
not depend on the most frequent passage, and no place is left out.

Hashes only decide what meets in a shard; the index compares words.

Defined results: a word is a run of characters other than ASCII white space, taken as it is. A
NULL text is an empty one. Texts shorter than the window keep all words. Repeated rows, rows that
share an id and rows without one count as documents of their own, so a text that stands in two
rows loses every word if it is as long as a window. Columns other than the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import staged
from terrace.llm.fm_index import FMIndex

WINDOW = 35
GRAM = 8
HOT = 1000
SHARD_WORDS = 1 << 20
ROWS = 2000  # texts worked at once in a batch

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {False: np.ones(1, np.uint64), True: np.ones(1, np.uint64)}


def _power(n: int, inverse: bool) -> np.ndarray:
    """_BASE (or its inverse) to the powers 0 .. n - 1, modulo 2**64."""
    have = _powers[inverse]
    if len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        have = np.full(max(n, 2 * len(have)), base, np.uint64)
        have[0] = 1
        have = have.cumprod(dtype=np.uint64)
        _powers[inverse] = have
    return have[:n]


def _spans_hash(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of values[start:stop] for many ranges, from one cumulative sum."""
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _power(len(values), False), dtype=np.uint64)])
    mixed = (running[stop] - running[start]) * _power(len(values) + 1, True)[start]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def word_hashes(text: bytes) -> np.ndarray:
    letters = np.frombuffer(text, np.uint8)
    word = np.concatenate([[False], ~_SPACE[letters], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    return _spans_hash(letters.astype(np.uint64) + np.uint64(1), edges[::2], edges[1::2])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    start = np.arange(max(0, len(words) - size + 1))
    return _spans_hash(words, start, start + size)


def anchors(words: np.ndarray, window: int) -> np.ndarray:
    """Anchor of every window: the least hash of the word runs in it."""
    gram = min(GRAM, window)
    low, span, width = window_hashes(words, gram), window - gram + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
        width *= 2
    more = span - width
    return np.minimum(low[: len(low) - more], low[more:]) if len(low) > more else low[:0]


def anchor_counts(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, places) of every run of windows: in how many places of the run its anchor stands.

    A periodic text has one long run, with equal windows inside it.
    """
    gram = min(GRAM, window)
    grams, own = window_hashes(words, gram), anchors(words, window)
    lo, hi = runs(own)
    sizes = hi - lo + window - gram
    ends = np.cumsum(sizes)
    within = np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - sizes), sizes)
    same = np.concatenate([[0], np.cumsum(grams[within] == np.repeat(own[lo], sizes))])
    return own[lo], same[ends] - same[ends - sizes]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], edges]), np.concatenate([edges, [len(values)]])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _counted(texts: DataFrame, values: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], name: str) -> DataFrame:
    """(key, value, times) of every distinct value of every text, written.

    ``values`` gives the values of a text's word hashes and how often each stands there.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            keys, owner, found, times = some.column("key"), [], [], []
            for i, text in enumerate(some.column("text").to_pylist()):
                own, n = values(word_hashes(text))
                own, at = np.unique(own, return_inverse=True)
                found.append(own)
                times.append(np.bincount(at, n, minlength=len(own)))
                owner.append(np.full(len(own), i))
            owner = np.concatenate(owner)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(owner)), pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(times).astype(np.int64))],
                ["key", "value", "times"],
            )

    return staged(texts.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(work, "key binary, value long, times long"), name)


def _repeated(counted: DataFrame) -> DataFrame:
    """(value, places) of the values that stand at two places and more of distinct texts."""
    text = F.xxhash64("key")
    found = counted.groupBy("value").agg(
        F.min(text).alias("_low"), F.max(text).alias("_high"), F.max("times").alias("_times"), F.count(F.lit(1)).alias("places")
    )
    return found.filter("_low <> _high or _times > 1").select("value", "places")


def _once(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return values, np.ones(len(values), np.int64)


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


_DONE = "n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,stop:int>>"


def _finished(words: list[bytes], spans: list[tuple[int, int]]) -> tuple[int, int, str, list[dict[str, int]]]:
    kept, at, removed = [], 0, 0
    for lo, hi in spans:
        kept += words[at:lo]
        removed += hi - lo
        at = hi
    kept += words[at:]
    return len(words), removed, hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": a, "stop": b} for a, b in spans]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _done_columns(rows: list[tuple]) -> list[pa.Array]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    kinds = [pa.int64(), pa.int64(), pa.string(), span]
    return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]


def _settle(texts: DataFrame, window: int) -> DataFrame:
    """Texts without a repeated anchor finished, the others passed on with their text."""
    names = ["key", "copies", "n_words", "n_removed", "kept_sha256", "spans", "text", "cold", "hot"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            rows, rest = [], []
            open_ = some.column("cold").is_valid().to_pylist()
            for text, copies, is_open in zip(some.column("text").to_pylist(), some.column("copies").to_pylist(), open_, strict=True):
                if is_open:
                    rows.append((None,) * 4)
                    rest.append(text)
                else:
                    words = text.encode("utf-8", "surrogatepass").split()
                    rows.append(_finished(words, [(0, len(words))] if copies > 1 and len(words) >= window else []))
                    rest.append(None)
            yield pa.RecordBatch.from_arrays(
                [some.column("key"), some.column("copies"), *_done_columns(rows), pa.array(rest, pa.string()), some.column("cold"), some.column("hot")], names
            )

    return texts.mapInArrow(work, f"key binary, copies long, {_DONE}, text string, cold array<long>, hot array<long>")


def _segments(texts: DataFrame, window: int) -> DataFrame:
    """(key, start, size, hot, deal, segment) of the runs of windows under a repeated anchor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            owner, starts, deals, found, sizes, many = [], [], [], [], [], []
            cold, hot = some.column("cold"), some.column("hot")
            for i, text in enumerate(some.column("text").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                words = raw.split()
                own = anchors(word_hashes(raw), window)
                lo, hi = runs(own)
                frequent = np.isin(own[lo], np.array(hot[i].as_py(), np.int64).view(np.uint64))
                mine = frequent | np.isin(own[lo], np.array(cold[i].as_py(), np.int64).view(np.uint64))
                lo, hi = lo[mine], hi[mine]
                found += [b" ".join(words[a : b + window - 1]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                starts.append(lo)
                sizes.append(hi - lo + window - 1)
                deals.append(own[lo])
                many.append(frequent[mine])
                owner.append(np.full(len(lo), i))
            owner = np.concatenate(owner)
            yield pa.RecordBatch.from_arrays(
                [some.column("key").take(pa.array(owner)), pa.array(np.concatenate(starts).astype(np.int64)), pa.array(np.concatenate(sizes).astype(np.int64)),
                 pa.array(np.concatenate(many)), pa.array(np.concatenate(deals).astype(np.uint64).view(np.int64)), pa.array(found, pa.binary())],
                ["key", "start", "size", "hot", "deal", "segment"],
            )

    return texts.select("key", "text", "cold", "hot").mapInArrow(work, "key binary, start long, size long, hot boolean, deal long, segment binary")


def _pieces(different: DataFrame, window: int) -> DataFrame:
    """(key, starts, deal, piece) of every different one of the windows of a segment whose hash is repeated."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            owner, starts, deals, found = [], [], [], []
            for i, (text, repeated) in enumerate(zip(some.column("text").to_pylist(), some.column("windows").to_pylist(), strict=True)):
                words, own = text.split(), window_hashes(word_hashes(text), window)
                places: dict[bytes, list[int]] = {}
                for a in np.flatnonzero(np.isin(own, np.array(repeated, np.int64).view(np.uint64))).tolist():
                    places.setdefault(b" ".join(words[a : a + window]), []).append(a)
                found += places
                starts += places.values()
                deals.append(own[[at[0] for at in places.values()]])
                owner += [i] * len(places)
            yield pa.RecordBatch.from_arrays(
                [some.column("key").take(pa.array(owner, pa.int64())), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(np.concatenate(deals).view(np.int64)), pa.array(found, pa.binary())],
                ["key", "starts", "deal", "piece"],
            )

    return different.select("key", "text", "windows").mapInArrow(work, "key binary, starts array<int>, deal long, piece binary")


def _intervals(distinct: DataFrame, window: int) -> DataFrame:
    """(digest, spans) of the segments with windows that their shard's index holds twice and more."""

    def work(table: pa.Table) -> pa.Table:
        symbols: dict[bytes, int] = {}
        texts = table.column("segment").to_pylist()
        sequences = [np.array([symbols.setdefault(w, len(symbols)) for w in t.split(b" ")], np.int64) for t in texts]
        index = FMIndex(sequences, table.column("n").to_numpy(), len(symbols))
        digests, spans = [], []
        for text, starts in zip(texts, index.repeated(sequences, window), strict=True):
            if len(starts):
                digests.append(hashlib.md5(text).digest())
                spans.append([{"start": a, "stop": b} for a, b in _merged([(s, s + window) for s in starts.tolist()])])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return pa.table({"digest": pa.array(digests, pa.binary()), "spans": pa.array(spans, kind)})

    return distinct.groupBy("shard").applyInArrow(work, "digest binary, spans array<struct<start:int,stop:int>>")


def _close(texts: DataFrame, window: int) -> DataFrame:
    """The texts passed on, finished by their intervals."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            rows = []
            for text, copies, found in zip(*(some.column(c).to_pylist() for c in ("text", "copies", "found")), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                spans = _merged([(s["start"], s["stop"]) for s in found or []])
                rows.append(_finished(words, [(0, len(words))] if copies > 1 and len(words) >= window else spans))
            yield pa.RecordBatch.from_arrays([some.column("key"), *_done_columns(rows)], ["key", "n_words", "n_removed", "kept_sha256", "spans"])

    return texts.mapInArrow(work, f"key binary, {_DONE}")


def repeats(docs: DataFrame, *, text: str = "text", window: int = WINDOW, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256, spans) of every distinct text; ``key`` is its MD5.

    ``spans`` are the word ranges covered by repeated windows, in order and apart.
    """
    own = docs.select(_key(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    anchored = _counted(own, lambda words: anchor_counts(words, window), "substring-anchors")
    known = anchored.join(_repeated(anchored), "value").groupBy("key").agg(
        F.collect_set(F.when(F.col("places") <= hot, F.col("value"))).alias("cold"),
        F.collect_set(F.when(F.col("places") > hot, F.col("value"))).alias("hot"),
    )
    texts = own.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    settled = staged(_settle(texts.join(known, "key", "left").select("key", "copies", "text", "cold", "hot"), window), "substring-texts")
    waiting = settled.filter("text is not null")
    segments = staged(
        _segments(waiting, window).select("key", "start", "size", "hot", "deal", F.unhex(F.md5("segment")).alias("digest"), "segment"), "substring-segments"
    )
    frequent = segments.filter("hot").groupBy("digest", "segment").agg(F.count(F.lit(1)).alias("n"), F.max("size").cast("int").alias("size"))
    frequent = staged(frequent.select(F.col("digest").alias("key"), F.col("segment").alias("text"), "n", "size"), "substring-frequent")
    windows = _counted(frequent, lambda words: _once(window_hashes(words, window)), "substring-windows")
    windows = windows.join(_repeated(windows), "value", "left_semi").groupBy("key").agg(F.collect_set("value").alias("windows"))
    pieces = staged(
        _pieces(frequent.join(windows, "key"), window).select("key", "starts", "deal", F.unhex(F.md5("piece")).alias("digest"), "piece"), "substring-pieces"
    )
    words = (segments.filter("not hot").agg(F.sum("size")).first()[0] or 0) + window * pieces.count()
    shards = max(1, -(-words // shard_words))
    distinct = segments.filter("not hot").groupBy("deal", "segment").agg(F.count(F.lit(1)).alias("n")).union(
        pieces.groupBy("deal", "piece").agg(F.sum(F.size("starts")).alias("n"))
    )
    found = staged(_intervals(distinct.select(F.pmod(F.xxhash64("deal"), F.lit(shards)).alias("shard"), "segment", "n"), window), "substring-intervals")
    span = lambda start, stop: F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"))
    whole = frequent.filter("n > 1").select(F.col("key").alias("digest"), F.array(span(F.lit(0), F.col("size"))).alias("spans"))
    parts = pieces.join(frequent.filter("n = 1").select("key"), "key", "left_semi").join(found.select("digest"), "digest", "left_semi").groupBy("key").agg(
        F.flatten(F.collect_list(F.transform("starts", lambda a: span(a, a + window)))).alias("spans")
    )
    covered = found.union(whole).union(parts.select(F.col("key").alias("digest"), "spans"))
    spans = segments.select("key", "start", "digest").join(covered, "digest").select(
        "key", F.transform("spans", lambda s: span(s["start"] + F.col("start"), s["stop"] + F.col("start"))).alias("spans")
    )
    spans = spans.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("found"))
    closed = _close(waiting.select("key", "copies", "text").join(spans, "key", "left"), window)
    return settled.filter("text is null").select("key", "n_words", "n_removed", "kept_sha256", "spans").union(closed)


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, spans) of every document."""
    found = staged(repeats(docs, text=text, **options), "substring-found")
    own = docs.select(F.col(id_col), _key(F.col(text)).alias("_key"))
    return own.join(found, F.col("_key") == found["key"]).select(id_col, "n_words", "n_removed", "kept_sha256", "spans")


def without_repeats(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated words gone and the words left joined by one space."""
    found = staged(repeats(docs, text=text, **options), "substring-found").select(F.col("key").alias("_key"), "spans")
    rows = docs.select(F.struct("*").alias("_row"), _key(F.col(text)).alias("_own")).join(found, F.col("_own") == F.col("_key"))
    words = F.filter(F.split(F.coalesce(F.col(f"_row.{text}"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    kept = F.filter(words, lambda w, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["stop"])))
    return rows.select(
        *(F.when(F.col(f"_row.{c}").isNotNull(), F.array_join(kept, " ")).alias(c) if c == text else F.col(f"_row.{c}").alias(c) for c in docs.columns)
    )
