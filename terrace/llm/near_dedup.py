"""Near-duplicate documents: SuperMinHash, banding, exact verification, union-find groups.

1. One pass over the texts: distinct word shingles, a 128-bit fingerprint of each set, a
   SuperMinHash signature and its band keys. Nothing but these leaves the task.
2. Documents with equal sets form a class; one member stands for it from here on, so
   thousands of copies cost one row each and are never paired.
3. Members of a band bucket are candidates. Buckets are worked in rounds, so that no bucket
   has to list all its pairs: first every member of the leading bands meets its bucket's
   leader (a different, hashed choice per band); then, in all bands, members not yet in
   their leader's group meet the leader; last, members of a bucket that are still in
   different groups are compared by bitmaps of their differences from a common hub, an
   exact bound that lets through next to nothing but links (``_may_link``). Pairs inside one
   group are skipped, as they cannot change it.
4. Every pair met is verified on the full sets: 100 * |A and B| >= 80 * |A or B|.
5. Verified links are grouped by union-find; a group's id is its smallest doc_id.

With 40 bands of 6 slots a pair at exactly 0.8 is missed with probability
(1 - 0.8 ** 6) ** 40 = 5e-6.

Defined cases. NULL, empty or white-space text: an empty set, linked with nothing. NULL
doc_id: linked with nothing, component_id NULL, kept. Repeated rows: copies like any other;
``deduplicate`` leaves one of them. Ties: the smallest doc_id stays. Empty input: empty result. Extra columns: passed through by
``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import packed, staged
from terrace.llm.components import components
from terrace.llm.superminhash import band_keys, signatures
from terrace.llm.textvec import mix64, pieces, shingles

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 40, 6
LEADING = 4  # bands of the first round
WORDS = 8  # 64-bit words of a difference bitmap


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _describe(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, off in pieces(batch.column(1)):
                values, counts = shingles(raw, off, size)
                at = np.concatenate([[0], np.cumsum(counts)])
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ np.uint64(s)))]) for s in (1, 2)]
                one, two = (s[at[1:]] - s[at[:-1]] for s in sums)
                keys = band_keys(signatures(values, counts, bands * rows), rows)
                some = np.where(counts > 0, bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(counts),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        _lists(keys[counts > 0].reshape(-1), some),
                    ],
                    ["doc_id", "n_shingles", "one", "two", "bands"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, off in pieces(batch.column(1)):
                values, counts = shingles(raw, off, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), _lists(values, counts)], ["node", "items"]
                )

    return run


def _delta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, node, items, hub_items) -> size of the symmetric difference and its bitmap."""
    for batch in batches:
        n = batch.num_rows
        size, bits, table = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, WORDS * 64), np.uint8)
        for row in range(n):
            x, h = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (2, 3))
            delta = np.setxor1d(x, h, assume_unique=True)
            size[row] = len(delta)
            table[row, (delta.view(np.uint64) % np.uint64(WORDS * 64)).astype(np.int64)] = 1
            bits[row] = table[row].sum()
        words = np.packbits(table, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(size), pa.array(bits), *(pa.array(w.copy()) for w in words.T)],
            ["hub", "node", "d", "bits", *(f"w{i}" for i in range(WORDS))],
        )


def _may_link(percent: int):
    """Whether two members may be similar enough, by their differences from a common hub.

    With D the symmetric difference to the hub, |x ^ y| = |Dx ^ Dy| = |Dx| + |Dy| - 2 |Dx & Dy|,
    and a similarity of at least p % means (100 + p) |x ^ y| <= (100 - p) (|x| + |y|). The bits
    two bitmaps share, plus the elements that fell on a taken bit of one of them, bound
    |Dx & Dy| from above, so no pair that links is lost.
    """
    shared = sum((F.bit_count(F.col(f"w{i}_x").bitwiseAND(F.col(f"w{i}_y"))) for i in range(1, WORDS)),
                 F.bit_count(F.col("w0_x").bitwiseAND(F.col("w0_y"))))
    common = shared + F.least(F.col("d_x") - F.col("bits_x"), F.col("d_y") - F.col("bits_y"))
    apart = F.col("d_x") + F.col("d_y") - 2 * common
    return (100 + percent) * apart <= (100 - percent) * (F.col("n_shingles_x") + F.col("n_shingles_y"))


def describe(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set fingerprint (one, two) and band keys of every row."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _describe(size, bands, rows), "doc_id long, n_shingles long, one long, two long, bands array<long>"
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    x = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(x, "a").join(y, "b")
        .filter(100 * both >= percent * (F.size("x") + F.size("y") - both))
        .select("a", "b").distinct()
    )


def _pairs(a: str, b: str, na: str, nb: str, percent: int) -> list:
    """Filter of two columns of nodes by set size: sets of too unlike sizes cannot be similar."""
    low, high = F.least(na, nb), F.greatest(na, nb)
    return [(F.col(a) != F.col(b)) & (100 * low >= percent * high), F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def links(docs: DataFrame, described: DataFrame, size: int = SHINGLE, percent: int = PERCENT, leading: int = LEADING):
    """(classes, groups): classes as node, one, two; groups as node, component of linked classes."""
    classes = staged(
        described.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("one", "two", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")),
        "dedup-classes",
    )
    entries = classes.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = (
        entries.select("key", "band", "node")
        .groupBy("key").agg(
            F.count(F.lit(1)).alias("members"),
            F.first("band").alias("band"),
            F.min(F.struct(F.xxhash64("node", "key"), F.col("node"))).getField("node").alias("leader"),
        )
        .filter("members > 1")
    )
    members = staged(
        entries.select("node", "n_shingles", "key").join(buckets, "key")
        .select("key", "band", "members", "node", "n_shingles", "leader"),
        "dedup-members",
    )
    sizes = members.select(F.col("node").alias("leader"), F.col("n_shingles").alias("n_leader")).distinct()
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi")
    sets = staged(texts.mapInArrow(_sets(size), "node long, items array<long>"), "dedup-sets")
    keep, a, b = _pairs("node", "leader", "n_shingles", "n_leader", percent)

    def grouped(found: DataFrame) -> DataFrame:
        return staged(components(found), "dedup-groups")

    stars = members.join(sizes, "leader").filter(keep)
    found = staged(_verified(stars.filter(F.col("band") < leading).select(a, b).distinct(), sets, percent), "dedup-links")
    groups = grouped(found)

    def with_group(rows: DataFrame, node: str, name: str) -> DataFrame:
        g = groups.select(F.col("node").alias(node), F.col("component").alias("_c"))
        return rows.join(g, node, "left").withColumn(name, F.coalesce("_c", node)).drop("_c")

    # Second round: all bands, where member and leader are not yet in one group.
    apart = with_group(with_group(stars, "node", "c1"), "leader", "c2").filter("c1 <> c2 and band >= " + str(leading))
    more = staged(_verified(apart.select(a, b).distinct(), sets, percent), "dedup-links")
    found = found.union(more)
    groups = grouped(found)

    # Third round: members of one bucket, neither of them its leader, still in different groups.
    open_ = with_group(members.filter("members > 2"), "node", "c").select("key", "node", "n_shingles", "leader", "c")
    per_group = open_.groupBy("key", "c").agg(F.count(F.lit(1)).alias("_n"))
    hubs = per_group.groupBy("key").agg(
        F.count(F.lit(1)).alias("_groups"), F.max(F.struct("_n", F.col("c").alias("hub"))).getField("hub").alias("hub")
    ).filter("_groups > 1").select("key", "hub")
    open_ = staged(open_.filter("node <> leader").join(hubs, "key"), "dedup-open")
    hub_sets = sets.select(F.col("node").alias("hub"), F.col("items").alias("hub_items"))
    deltas = staged(
        open_.select("hub", "node").distinct().join(sets, "node").join(hub_sets, "hub")
        .select("hub", "node", "items", "hub_items")
        .mapInArrow(_delta, ", ".join(["hub long, node long, d long, bits long", *(f"w{i} long" for i in range(WORDS))])),
        "dedup-deltas",
    )
    rows = open_.join(deltas, ["hub", "node"]).drop("leader", "hub")
    left, right = (
        rows.select("key", *(F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "key")) for side in "xy"
    )
    keep, a, b = _pairs("node_x", "node_y", "n_shingles_x", "n_shingles_y", percent)
    across = left.join(right, ["key"]).filter("c_x < c_y").filter(keep).filter(_may_link(percent)).select(a, b).distinct()
    more = staged(_verified(across, sets, percent), "dedup-links")
    if not more.isEmpty():
        groups = grouped(found.union(more))
    return classes.select("node", "one", "two"), groups


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    described = staged(describe(docs, size, bands, rows), "dedup-described")
    classes, groups = links(docs, described, size, percent)
    label = classes.join(groups, "node", "left").select(
        "one", "two", F.coalesce("component", "node").alias("component_id")
    )
    own = described.select("doc_id", "n_shingles", "one", "two")
    some = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    linked = own.filter(some).join(label, ["one", "two"]).select("doc_id", "n_shingles", "component_id")
    alone = own.filter(~some).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, all columns unchanged."""
    judged = staged(near_duplicates(docs, **options).select("doc_id", "kept"), "dedup-judged")
    some = judged.filter("doc_id is not null")
    dropped = some.filter("not kept").select("doc_id")
    repeated = some.filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("doc_id")
    # Shuffled by hash at every size: a plan that broadcasts small lists would turn into another
    # one, with other needs, as the corpus grows.
    once = docs.join(dropped.union(repeated).hint("shuffle_hash"), "doc_id", "left_anti")
    copies = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    first = (
        packed(docs.join(repeated, "doc_id", "left_semi"), doc_id=F.col("doc_id"), text=F.col("text"))
        .withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1").select("_row.*")
    )
    return once.select(*docs.columns).union(first.select(*docs.columns))
