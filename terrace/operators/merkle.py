"""Localised snapshot diff: hash trees over the key space, equal subtrees never read.

A key belongs to one of FAN ** depth leaves, by its hash or by an expression of the caller (a
range of an integer key keeps neighbouring keys together, so a correction of some months or
orders touches few leaves). A node holds the number of its rows and two sums of their hashes.
``save`` writes the rows in folders per lowest inner node, sorted by leaf, and the tree beside
them; both are made from the rows as written.

``diff`` walks two trees from the root: only children of nodes that differ are compared, and
only leaves that differ are read, from the folders of their nodes, with the leaf as a pushed
predicate. Within them rows are compared as ``quality.snapshot_diff`` does, by key and two hashes
of the row (by the row itself where the types of the two tables differ).

What reaches the driver is the list of differing nodes above the leaves, at most
FAN ** (depth - 1); ``depth`` is a parameter of the table, and both sides must share it.

Defined results: empty tables differ from others by all their rows; NULL key parts are values
of their own for the tree, but as in any keyed diff a NULL key equals no other. Rows with equal
keys must not be repeated (``contracts.duplicate_keys`` finds them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from terrace.operators import quality

FAN = 16
DEPTH = 3
LEAF, NODE = "_leaf", "_node"


def hashed(keys: Sequence[str], depth: int = DEPTH) -> Column:
    """Leaf of a key by its hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(FAN**depth))


def ranged(key: str, width: int, depth: int = DEPTH) -> Column:
    """Leaf of an integer key: ranges of ``width`` keys, dealt round when there are more of them
    than leaves."""
    return F.pmod(F.floor(F.col(key) / width).cast("long"), F.lit(FAN**depth))


def _told(names: Sequence[str]) -> list[Column]:
    """Columns to hash: a hash skips NULLs, so their places are hashed too."""
    return [c for n in names for c in (F.isnull(n), F.col(n))]


def save(rows: DataFrame, path: str, keys: Sequence[str], depth: int = DEPTH, leaf: Column | None = None) -> None:
    """Write rows and their tree under ``path``."""
    spark = rows.sparkSession
    placed = rows.withColumn(LEAF, F.coalesce(leaf if leaf is not None else hashed(keys, depth), F.lit(0)).cast("long"))
    placed = placed.withColumn(NODE, F.floor(F.col(LEAF) / FAN).cast("long"))
    # Rebalancing splits a node that is much larger than the others.
    placed.hint("rebalance", NODE).sortWithinPartitions(NODE, LEAF).write.mode("overwrite").partitionBy(NODE).parquet(f"{path}/rows")
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/columns")  # an empty table has no files to read them from
    written = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    content = F.abs(F.xxhash64(*_told(rows.columns)) % F.lit(1 << 60)).cast("decimal(38,0)")
    tree = written.select(F.col(LEAF).alias("node"), content.alias("h")).groupBy("node").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("h").alias("total"), F.bit_xor(F.xxhash64("h")).alias("mixed")
    )
    tree = tree.withColumn("level", F.lit(depth))
    every = tree
    for level in range(depth - 1, -1, -1):
        up = F.floor(F.col("node") / FAN ** (depth - level)).cast("long")
        every = every.unionByName(
            tree.groupBy(up.alias("node")).agg(F.sum("rows").alias("rows"), F.sum("total").cast(tree.schema["total"].dataType).alias("total"), F.bit_xor("mixed").alias("mixed"))
            .withColumn("level", F.lit(level))
        )
    every.write.mode("overwrite").partitionBy("level").parquet(f"{path}/tree")


def _tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("node long, rows long, total decimal(38,0), mixed long, level int").parquet(f"{path}/tree")


def _differing(before: DataFrame, after: DataFrame) -> DataFrame:
    b, a = before.alias("b"), after.alias("a")
    same = F.col("b.rows").eqNullSafe(F.col("a.rows")) & F.col("b.total").eqNullSafe(F.col("a.total")) & F.col("b.mixed").eqNullSafe(F.col("a.mixed"))
    return b.join(a, F.col("b.node") == F.col("a.node"), "full_outer").filter(~same).select(
        F.coalesce("b.node", "a.node").alias("node"),
        (F.coalesce("b.rows", F.lit(0)) + F.coalesce("a.rows", F.lit(0))).alias("rows"),
    )


def differing_leaves(spark: SparkSession, before: str, after: str, depth: int = DEPTH) -> tuple[DataFrame, list[int]]:
    """(node, rows) of the leaves that differ, and the inner nodes right above them."""
    old, new = _tree(spark, before), _tree(spark, after)
    nodes = [0]
    for level in range(depth):
        of = lambda t: t.filter((F.col("level") == level) & F.col("node").isin(nodes))  # noqa: E731, B023
        differ = [r["node"] for r in _differing(of(old), of(new)).select("node").collect()]
        if level == depth - 1 or not differ:
            break
        nodes = [n * FAN + i for n in differ for i in range(FAN)]
    under = lambda t: t.filter((F.col("level") == depth) & F.floor(F.col("node") / FAN).isin(differ))
    return _differing(under(old), under(new)), sorted(differ)


def diff(spark: SparkSession, before: str, after: str, keys: Sequence[str], depth: int = DEPTH) -> tuple[DataFrame, tuple[int, int]]:
    """(keys, change) as ``quality.snapshot_diff`` gives them, and (read, held): how many rows stand
    in differing leaves, and in both tables."""
    leaves, nodes = differing_leaves(spark, before, after, depth)
    leaf = F.broadcast(leaves.select(F.col("node").alias(LEAF)))  # at most FAN ** depth

    old, new = (spark.read.parquet(f"{path}/columns").schema for path in (before, after))
    alike = [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new]

    def side(path: str, own: StructType) -> DataFrame:
        stored = StructType([*own, StructField(LEAF, LongType()), StructField(NODE, LongType())])
        rows = spark.read.schema(stored).parquet(f"{path}/rows").filter(F.col(NODE).isin(nodes))
        rows = rows.join(leaf, LEAF, "left_semi").drop(LEAF, NODE)
        # Two hashes of a row go with its key in place of the row.
        told = _told(own.names)
        return rows.select(*keys, F.xxhash64(*told).alias("_h"), F.xxhash64(F.lit("second"), *told).alias("_g")) if alike else rows

    roots = _tree(spark, before).union(_tree(spark, after)).filter("level = 0")
    count = lambda t: t.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return quality.snapshot_diff(side(before, old), side(after, new), keys), (count(leaves), count(roots))
