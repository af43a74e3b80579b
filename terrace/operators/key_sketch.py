"""Key-level reconciliation: which keys one side has and the other lacks, from sketches.

A sketch is an invertible Bloom lookup table built by one aggregation. Keys are dealt by hash to
``parts`` parts; within a part a key falls into one cell of each of three rows of ``WIDTH``
cells. A cell holds the number of its keys and the XOR of two 64-bit hashes and of a check sum.
One side's cells less the other's leave the keys that only one side has: a cell with a single
key left shows its hashes, taking that key out of its other cells uncovers more, and a part whose
cells all become zero is decoded. Parts are decoded on their own, each from at most 3 * ``WIDTH``
cells, so a sketch has one size for every table and the tables themselves are not shuffled.

``differences`` then looks the decoded hashes up on both sides (at most 3 * ``WIDTH`` * ``parts``
of them, broadcast). Keys of parts that did not decode are compared exactly, by grouping. A part
decodes up to about 250 differences; more parts let larger differences decode.

Defined results: keys may be repeated on either side, a key counts as there if any row holds it.
A repeated key makes its part undecodable or is looked up and found on both sides, never listed
wrongly. Key parts that are NULL are values of their own. An empty side lacks every key of the
other. Types of the second side's keys are cast to the first's.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.session import materialize

PARTS = 64
ROWS = 3
WIDTH = 128  # a power of two: a cell is taken from bits of a hash
SHIFT = 20  # bits between the cells of two rows

MISSING, EXTRA = "missing", "extra"
_H1, _H2, _PART = "_h1", "_h2", "_part"


def _marked(rows: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """The keys with two hashes and their part; a hash skips NULLs, so their places are hashed too."""
    told = [c for k in keys for c in (F.isnull(k), F.col(k))]
    marked = rows.select(*keys, F.xxhash64(*told).alias(_H1), F.xxhash64(F.lit("second"), *told).alias(_H2))
    return marked.withColumn(_PART, F.pmod(F.col(_H1), F.lit(parts)))


def _cells(h2: int) -> list[int]:
    return [row * WIDTH + ((h2 >> (SHIFT * row)) & (WIDTH - 1)) for row in range(ROWS)]


def sketch(rows: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """(part, cell, n, h1, h2, chk): at most 3 * WIDTH cells in each part."""
    places = [
        F.lit(row * WIDTH) + F.shiftright(_H2, SHIFT * row).bitwiseAND(F.lit(WIDTH - 1)) for row in range(ROWS)
    ]
    each = _marked(rows, keys, parts).select(
        F.col(_PART).alias("part"), F.explode(F.array(*places)).alias("cell"), F.col(_H1).alias("h1"), F.col(_H2).alias("h2"),
        F.crc32(F.col(_H1).cast("string").cast("binary")).alias("chk"),
    )
    xors = [F.bit_xor(c).alias(c) for c in ("h1", "h2", "chk")]
    return each.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("n"), *xors)


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """The sketch of the difference of two sketches with the same number of parts."""
    both = left.unionByName(right.withColumn("n", -F.col("n")))
    return both.groupBy("part", "cell").agg(F.sum("n").alias("n"), *(F.bit_xor(c).alias(c) for c in ("h1", "h2", "chk")))


def _peel(cells: dict[int, list[int]], part: int, parts: int) -> list[tuple[int, int]] | None:
    """Hashes of the keys in one part's cells, or None if they do not come out."""

    def single(cell: int) -> bool:
        n, h1, h2, chk = cells[cell]
        return n in (1, -1) and cell in _cells(h2) and h1 % parts == part and zlib.crc32(str(h1).encode()) == chk

    waiting, found = [c for c in cells if single(c)], []
    while waiting and len(found) <= len(cells):
        cell = waiting.pop()
        if not single(cell):
            continue
        n, *key = cells[cell]
        found.append((key[0], key[1]))
        for other in _cells(key[1]):
            if other not in cells:  # every key is in all its cells; this one was no key
                return None
            held = cells[other]
            cells[other] = [held[0] - n, *(a ^ b for a, b in zip(held[1:], key))]
            if single(other):
                waiting.append(other)
    return found if not any(any(c) for c in cells.values()) else None


def decode(difference: DataFrame, parts: int = PARTS) -> DataFrame:
    """(part, decoded, h1, h2): one row per key that came out, one with ``decoded`` false for a
    part that has to be compared exactly."""

    def peel(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        columns = (group[c].tolist() for c in ("cell", "n", "h1", "h2", "chk"))
        found = _peel({cell: held for cell, *held in zip(*columns)}, part, parts)
        rows = [(part, False, 0, 0)] if found is None else [(part, True, *key) for key in found]
        return pd.DataFrame(rows, columns=["part", "decoded", "h1", "h2"])

    return difference.groupBy("part").applyInPandas(peel, "part long, decoded boolean, h1 long, h2 long")


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """(keys, state): ``missing`` keys are in ``left`` only, ``extra`` ones in ``right`` only.

    Both sides are read twice, their key columns alone; a side that changes in between should be
    a snapshot.
    """
    types = {f.name: f.dataType for f in left.select(*keys).schema}
    right = right.select(*(F.col(k).cast(types[k]).alias(k) for k in keys))
    found = materialize(decode(subtract(sketch(left, keys, parts), sketch(right, keys, parts)), parts))
    # A row per decoded key and per open part: bounded by the size of the sketch.
    listed = F.broadcast(found.filter("decoded").select(F.col("h1").alias(_H1), F.col("h2").alias(_H2), F.lit(True).alias("_listed")).distinct())
    opened = F.broadcast(found.filter("NOT decoded").select(F.col("part").alias(_PART), F.lit(True).alias("_open")))

    def candidates(rows: DataFrame, here: bool) -> DataFrame:
        marked = _marked(rows, keys, parts).join(listed, [_H1, _H2], "left").join(opened, _PART, "left")
        return marked.filter(F.coalesce("_listed", "_open", F.lit(False))).select(
            *keys, F.lit(here).alias("_left"), F.lit(not here).alias("_right")
        )

    seen = candidates(left, True).unionByName(candidates(right, False))
    seen = seen.groupBy(*keys).agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    state = F.when(F.col("_left"), F.lit(MISSING)).otherwise(F.lit(EXTRA))
    return seen.filter(F.col("_left") != F.col("_right")).select(*keys, state.alias("state"))
