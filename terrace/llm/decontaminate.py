"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared in lower case, with every run of other characters than letters
and digits as one space. An item of L characters may be found with up to k = RATE * L edits
anywhere in a text:

1. The item is cut into k + 1 pieces. k edits cannot touch all of them, so a text that holds
   the item holds one piece unchanged. One Aho-Corasick automaton finds the pieces of all
   items in a single pass over a text.
2. The same argument holds for groups: if the whole has at most k edits, some half of the
   pieces has fewer edits than pieces, then some half of that, down to one exact piece. A
   hit is therefore checked from its pair upwards, and most chance hits end at the pair.
3. Groups and the whole are verified with Myers' bit-parallel edit distance on the stretch
   of text they can lie in; the integers are as wide as the item.

An item under ``MIN_CHARS`` characters is a single piece without edits, found as a run of whole
words. ``matches`` reports it wherever it stands. A few words inside a longer text are no sign
of a leak, so ``remove`` takes a document for a short item only if it is the document's whole text.

Items travel to the tasks in parts of about ``PART_CHARS`` characters; a larger benchmark
takes more passes over the documents, each written before the next one is planned, so driver
and tasks hold the items of one part. Documents are never shuffled or collected.

Defined cases. NULL or empty text: nothing found. NULL item, or one without letters and digits:
not searched. NULL ids: carried as they are. Repeated items or documents: each is reported.
Empty tables: empty result, and ``remove`` keeps everything. Extra columns: passed through by
``remove``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from terrace.llm.common import staged
from terrace.llm.string_kernel import KIND
from terrace.llm.textvec import pieces

RATE = 0.08
MIN_CHARS = 24
PART_CHARS = 4_000_000


def normal(texts: list[str | None]) -> list[str]:
    """The compared form of many texts, handled as one array of code points."""
    if not texts:
        return []
    joined = "\0".join((t or "").replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = KIND[np.minimum(codes, 0xFFFF)]
    gap = (kind == 0) | (kind == 2)
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    codes = np.where(gap, np.uint32(0x20), codes)[keep]
    return [t.strip(" ") for t in codes.tobytes().decode("utf-32-le", "surrogatepass").split("\0")]


class Pattern:
    """Bit masks of a piece group for Myers' algorithm."""

    def __init__(self, text: str):
        self.size = len(text)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def distance(self, text: str) -> tuple[int, int]:
        """(least edit distance to any stretch of ``text``, end of the first such stretch)."""
        full, high = (1 << self.size) - 1, 1 << self.size - 1
        up, down, now = full, 0, self.size
        best, at, get = self.size, 0, self.masks.get
        for end, c in enumerate(text, 1):
            eq = get(c, 0)
            diagonal = eq | down
            across = ((eq & up) + up ^ up) | eq
            rise = down | full & ~(across | up)
            fall = up & across
            if rise & high:
                now += 1
            elif fall & high:
                now -= 1
                if now < best:
                    best, at = now, end
            rise = rise << 1 & full
            fall = fall << 1 & full
            up = fall | full & ~(diagonal | rise)
            down = rise & diagonal
        return best, at


class Searcher:
    """The pieces of a bounded set of items, and the search for them in one text."""

    def __init__(self, items: list[str], rate: float):
        import ahocorasick

        self.items, self.cuts, self.patterns = items, [], {}
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(items):
            pieces = 1 if len(item) < MIN_CHARS else int(rate * len(item)) + 1
            cuts = [i * len(item) // pieces for i in range(pieces + 1)]
            self.cuts.append(cuts)
            for i in range(pieces):
                owners.setdefault(item[cuts[i] : cuts[i + 1]], []).append((n, i))
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def _pattern(self, n: int, low: int, high: int) -> Pattern:
        key = (n, low, high)
        if key not in self.patterns:
            cuts = self.cuts[n]
            self.patterns[key] = Pattern(self.items[n][cuts[low] : cuts[high]])
        return self.patterns[key]

    def _grown(self, text: str, n: int, piece: int, at: int) -> tuple[int, int] | None:
        """(edits, end in the text) of item ``n`` around an exact piece, or None beyond its budget."""
        cuts = self.cuts[n]
        count, size = len(cuts) - 1, 1
        if count == 1:
            end = at + cuts[1]
            inside = text[at - 1 : at].strip() or text[end : end + 1].strip()
            return None if inside and len(self.items[n]) < MIN_CHARS else (0, end)
        while size < count:
            size *= 2
            low = piece // size * size
            high = min(low + size, count)
            if high - low <= size // 2:  # the last group of a level stands alone
                continue
            budget = high - low - 1
            start = max(0, at - (cuts[piece] - cuts[low]) - budget)
            edits, end = self._pattern(n, low, high).distance(text[start : at + cuts[high] - cuts[piece] + budget])
            if edits > budget:
                return None
        return edits, start + end

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """Per item found: (least edits, end of that place in the normal form)."""
        found: dict[int, tuple[int, int]] = {}
        tried: dict[tuple[int, int], int] = {}
        if self.empty:
            return found
        for last, (size, places) in self.automaton.iter(text):
            at = last + 1 - size
            for n, piece in places:
                best = found.get(n)
                if best and best[0] == 0:
                    continue
                # A place already verified for this item is verified from one piece only.
                slack = len(self.cuts[n]) - 2
                origin = at - self.cuts[n][piece]
                if best and abs(tried[n, -1] - origin) <= slack:
                    continue
                hit = self._grown(text, n, piece, at)
                if hit and (best is None or hit[0] < best[0]):
                    found[n] = hit
                    tried[n, -1] = origin
        return found


def _parts(benchmark: DataFrame, item: str, part_chars: int) -> Iterator[tuple[bool, list[tuple]]]:
    """The items as (id, normal form), in lists of about ``part_chars`` characters, and whether
    more of them follow."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = math.ceil(total / part_chars)
    place = F.pmod(F.xxhash64("text", F.col(item).cast("string")), F.lit(max(parts, 1)))
    for part in range(parts):
        rows = benchmark.filter(place == part).select(item, "text").collect()
        yield part + 1 < parts, [(r[0], t) for r, t in zip(rows, normal([r[1] for r in rows]), strict=True) if t]


def _found(searcher: Searcher, column: pa.Array) -> Iterator[tuple[str, dict[int, tuple[int, int]]]]:
    for first, end, _, _ in pieces(column):
        for text in normal(column.slice(first, end - first).to_pylist()):
            yield text, searcher.find(text)


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, part_chars: int = PART_CHARS) -> DataFrame:
    """doc_id, item_id, edits, item_chars, end of every item found in every document."""
    doc_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", doc_type),
            T.StructField("item_id", item_type),
            T.StructField("edits", T.LongType()),
            T.StructField("item_chars", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
    written = []
    for more, items in _parts(benchmark, "item_id", part_chars):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            searcher = Searcher([t for _, t in items], rate)
            for batch in batches:
                rows, ids, edits, sizes, ends = [], [], [], [], []
                for row, (_, found) in enumerate(_found(searcher, batch.column(1))):
                    for n, (least, end) in found.items():
                        rows.append(row)
                        ids.append(items[n][0])
                        edits.append(least)
                        sizes.append(len(items[n][1]))
                        ends.append(end)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(ids, to_arrow_type(item_type)),
                        pa.array(edits, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(ends, pa.int64()),
                    ],
                    schema.fieldNames(),
                )

        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        written.append(staged(one, "decontaminate-matches") if more or written else one)
    if not written:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.union, written)


def remove(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, part_chars: int = PART_CHARS) -> DataFrame:
    """The documents that hold no item, all columns unchanged."""
    at = docs.columns.index("text")
    for more, items in _parts(benchmark, "item_id", part_chars):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            searcher = Searcher([t for _, t in items], rate)

            def clean(text: str, found: dict[int, tuple[int, int]]) -> bool:
                return not any(len(items[n][1]) >= MIN_CHARS or items[n][1] == text for n in found)

            for batch in batches:
                kept = [clean(text, found) for text, found in _found(searcher, batch.column(at))]
                yield batch.filter(pa.array(kept, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if more:
            docs = staged(docs, "decontaminate-pass")
    return docs
