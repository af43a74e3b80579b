"""Connected components of an edge table: union-find inside partitions, stars across them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import staged


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of a partition -> edges (b, a) from each node to its smallest known node.

    The forest holds one entry per node of the partition, whatever the number of edges.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 50_000):
        some = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array([root(x) for x in some], np.int64)), pa.array(np.array(some, np.int64))], ["a", "b"]
        )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component = its smallest node.

    Each partition first shrinks its edges to a forest by union-find. Rounds of large-star
    and small-star then move every edge to the smallest neighbour until nothing changes
    (about log(diameter) rounds). Minima are pre-aggregated before each shuffle, and a hot
    node is a hot join key that adaptive execution may split; no task holds the
    neighbours of a node as a list.
    """
    e = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    e = staged(e.mapInArrow(_union_find, "a long, b long").distinct(), "component-edges")
    seen = None
    while True:
        # Large star: every larger neighbour of u is tied to the smallest of u and its neighbours.
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(low.select(F.col("m"), "b"))
            .filter("a <> b").distinct()
        )
        e = staged(small, "component-edges")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    # At the fixed point every node hangs on its component's smallest node.
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        e.select("a", "a").distinct()
    )
