"""A version history kept by batches, and facts looked up in it as of their time.

``merge`` takes a batch of new versions, in any order of time: a late version splits the
interval it falls into, a newer one closes the open row. Only the keys of the batch are worked:

1. Keys are dealt to a fixed number of pieces by hash; only the folders of the batch's pieces
   are read, and of these only the rows of its keys.
2. Their intervals are drawn again by ``history.scd2_history``, which splits a hot key by time.
3. What differs is written as one segment of signed rows: +1 for a row that holds now, -1 for
   one that no longer does. One late version costs three rows, however long its key's history.
   A stored row carries what it said through step 2, so the two are compared without a shuffle.

``current`` adds the signs up. ``compact`` folds all segments into a base, which replaces them
when its folder is complete; a merge or compaction that stops half-way leaves nothing that is
read. A load that was merged is not merged again, also after a compaction.

``as_of`` joins each fact to the last version of its key at or before its time. Versions and
facts are range-partitioned together by (key, time), so a key with a third of all rows is spread
over many tasks; a fact whose version stands in an earlier range gets it from a table with one
row per range.

Defined cases. Repeated versions: each kept, and equal rows are counted. Versions equal in key,
cursor and tiebreakers: ordered by a hash of the row. NULL cursor: before all others. NULL key:
a key like any other in ``merge``; in ``as_of`` a fact without key or time has no version. Empty
batch: an empty segment. Columns must be such that Spark can group by them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from terrace.operators.history import scd2_history
from terrace.session import materialize
from terrace.sources import lake

PIECES = 64
DEAL = 1 << 20  # rows of a piece that are worked together
_SIGN, _PIECE, _DEAL, _WAS, _PART, _SEGMENT, BASE = "__sign", "__piece", "__deal", "__was", "__part", "segment", "base"


def _layout(spark: SparkSession, path: str) -> tuple[StructType, int]:
    """(columns of a stored row, number of pieces) of a history."""
    kept = spark.read.parquet(f"{path}/layout")
    row = kept.first()
    return StructType.fromJson(json.loads(row["columns"])), row["pieces"]


def _segments(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(numbers and loads ``N~load`` of the folders that count, load ids merged): the newest base and what follows."""
    names = [n.partition("=")[2] for n in lake.folders(spark, f"{path}/rows")]
    base = max((n for n in names if n.endswith(f"~{BASE}")), default="")
    after = base.partition("~")[0]
    live = [n for n in names if n.partition("~")[0] > after]
    return [base] * bool(base) + live, [n.partition("~")[2] for n in live] + lake.folders(spark, f"{path}/loads")


def _changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Signed rows of all segments, with their piece."""
    names, _ = _segments(spark, path)
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(StructType([*schema, StructField(_SEGMENT, StringType())])).option("basePath", f"{path}/rows")
    return reader.parquet(*(f"{path}/rows/{_SEGMENT}={n}" for n in names)).drop(_SEGMENT)


def _repeated(held: DataFrame) -> DataFrame:
    """Rows with a positive number of signs, as often as that."""
    held = held.filter(F.col(_SIGN) > 0)
    return held.withColumn(_SIGN, F.explode(F.sequence(F.lit(1), F.col(_SIGN).cast("int")))).drop(_SIGN)


def _fold(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows that hold, each as often as its signs add up to; ``by`` are further columns that follow from a row."""
    columns = [c for c in changes.columns if c != _SIGN]
    return _repeated(changes.groupBy(*by, *(c for c in columns if c not in by)).agg(F.sum(_SIGN).alias(_SIGN)).select(*columns, _SIGN))


def _dealt(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` with a number that parts a large piece by ``by``, about ``DEAL`` rows in each part."""
    counted = materialize(rows.groupBy(_PIECE).agg(F.ceil(F.count(F.lit(1)) / DEAL).alias("__parts")))  # a row per piece
    joined = rows.join(F.broadcast(counted), _PIECE)
    return joined.withColumn(_DEAL, F.pmod(F.xxhash64(F.lit("part"), *by), F.col("__parts"))).select(*rows.columns, _DEAL)


def merge(
    batch: DataFrame,
    path: str,
    load_id: int,
    key: Sequence[str],
    cursor: str,
    tiebreakers: Sequence[str] = (),
    pieces: int = PIECES,
    written: bool = False,
) -> bool:
    """Add a load's versions to the history at ``path``; False if that load is in it already.

    ``pieces`` counts when the history is created. ``written``: the batch lies in files, so it is
    read again where it is needed and not written once more.
    """
    spark = batch.sparkSession
    if "layout" not in lake.folders(spark, path):
        empty = scd2_history(batch.limit(0), key, cursor, tiebreakers, partitions=1)
        kept = empty.withColumn(_SIGN, F.lit(0).cast("long")).schema.add(_PIECE, IntegerType())
        spark.createDataFrame([(kept.json(), pieces)], "columns string, pieces int").write.mode("overwrite").parquet(f"{path}/layout")
    schema, pieces = _layout(spark, path)
    names, loads = _segments(spark, path)
    if str(load_id) in loads:
        return False

    piece = F.pmod(F.xxhash64(*key), F.lit(pieces)).cast("int")
    new = (batch if written else materialize(batch)).withColumn(_PIECE, piece)
    keys = materialize(new.select(_PIECE, *(F.col(k).alias(f"__{k}") for k in key)).distinct())
    touched = [r[0] for r in keys.select(_PIECE).distinct().collect()]  # at most ``pieces`` numbers
    stored = _changes(spark, path, schema).filter(F.col(_PIECE).isin(touched))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
    mine = stored.join(keys.drop(_PIECE), same, "left_semi")
    # One folder alone holds no retraction that another row would have to meet.
    old = materialize(_fold(mine) if len(names) > 1 else _repeated(mine))

    was = F.struct("is_current", "valid_to")
    versions = old.select(*new.columns, was.alias(_WAS)).union(new.withColumn(_WAS, F.lit(None).cast(old.select(was).schema[0].dataType)))
    # Equal versions stay in the order they had, so that what holds on is not written again.
    now = scd2_history(
        _dealt(versions, key), key, cursor, (*tiebreakers, F.xxhash64(*batch.columns), F.col(_WAS)), written=True, deal=(_PIECE, _DEAL)
    )
    holds = F.struct("is_current", "valid_to")
    one = F.lit(1).cast("long")
    signed = [F.struct(holds.alias("is"), one.alias(_SIGN)), F.struct(F.col(_WAS).alias("is"), (-one).alias(_SIGN))]
    now = now.filter(~F.col(_WAS).eqNullSafe(holds))
    each = now.withColumn("__each", F.explode(F.when(F.col(_WAS).isNull(), F.array(signed[0])).otherwise(F.array(*signed))))
    told = {"valid_to": F.col("__each.is.valid_to"), "is_current": F.col("__each.is.is_current"), _SIGN: F.col(f"__each.{_SIGN}")}
    changed = each.select(*(told.get(c, F.col(c)).alias(c) for c in schema.names))
    number = 1 + max((int(n.partition("~")[0]) for n in names), default=0)
    lake.write_table(changed, f"{path}/rows/{_SEGMENT}={number:010d}~{load_id}", partition_by=(_PIECE,), spread=False)
    return True


def current(spark: SparkSession, path: str) -> DataFrame:
    """Every version with ``valid_from``, ``valid_to`` and ``is_current``."""
    return _fold(_changes(spark, path, _layout(spark, path)[0])).drop(_PIECE)


def compact(spark: SparkSession, path: str) -> None:
    """Fold all segments into one base; the load ids stay known."""
    names, loads = _segments(spark, path)
    if all(n.endswith(f"~{BASE}") for n in names):
        return
    for load in set(loads) - set(lake.folders(spark, f"{path}/loads")):  # the loads since the last compaction
        spark.range(0).write.mode("overwrite").parquet(f"{path}/loads/{load}")
    changes = _changes(spark, path, _layout(spark, path)[0])
    # One shuffle adds the signs up and brings a piece's rows together.
    dealt = _dealt(changes, [c for c in changes.columns if c != _SIGN]).repartition(_PIECE, _DEAL)
    rows = _fold(dealt, (_PIECE, _DEAL)).drop(_DEAL).withColumn(_SIGN, F.lit(1).cast("long"))
    number = names[-1].partition("~")[0]
    lake.write_table(rows, f"{path}/rows/{_SEGMENT}={number}~{BASE}", partition_by=(_PIECE,), spread=False)
    for n in names:
        lake.remove(spark, f"{path}/rows/{_SEGMENT}={n}")


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: Sequence[str],
    time: str,
    cursor: str,
    tiebreakers: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``fact`` and ``version`` (structs) per fact: the last version of its key at or before its time, or NULL."""
    spark = facts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"__k{i}" for i in range(len(key))]
    ties = F.struct(*(F.col(c) for c in (*tiebreakers, cursor)))
    order = [*keys, "__time", "__fact", "__tie", "__row"]
    left = versions.filter(F.col(cursor).isNotNull()).select(
        *(F.col(k).alias(a) for k, a in zip(key, keys, strict=True)), F.col(cursor).alias("__time"), F.lit(0).alias("__fact"),
        ties.alias("__tie"), F.xxhash64(*versions.columns).alias("__row"), F.struct(*versions.columns).alias("version"),
        F.lit(None).cast(facts.schema).alias("fact"),
    )
    # Facts follow the versions of their time in any order: a number spreads those of one moment.
    right = facts.select(
        *(F.col(k).alias(a) for k, a in zip(key, keys, strict=True)), F.col(time).alias("__time"), F.lit(1).alias("__fact"),
        F.lit(None).cast(left.schema["__tie"].dataType).alias("__tie"), F.monotonically_increasing_id().alias("__row"),
        F.lit(None).cast(versions.schema).alias("version"), F.struct(*facts.columns).alias("fact"),
    )
    # Written once, as range bounds are sampled anew by every exchange.
    ranged = materialize(left.union(right).repartitionByRange(n, *order).withColumn(_PART, F.spark_partition_id()))
    before = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    held = F.when(F.col("__fact") == 0, F.struct(*keys, "version"))
    found = ranged.select(_PART, *keys, "__time", "__fact", "fact", F.last(held, ignorenulls=True).over(before).alias("__held"))

    # The last version of the ranges before each: at most ``n`` rows.
    lasts = ranged.groupBy(_PART).agg(F.max_by(held, F.when(F.col("__fact") == 0, F.struct(*order))).alias("__last"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(_PART, F.last("__last", ignorenulls=True).over(earlier).alias("__carried"))
    joined = found.filter("__fact = 1").join(F.broadcast(carried), _PART, "left")
    held = F.coalesce("__held", "__carried")
    same = F.col("__time").isNotNull()
    for k in keys:
        same = same & F.coalesce(held[k] == F.col(k), F.lit(False))
    return joined.select("fact", F.when(same, held["version"]).alias("version"))
