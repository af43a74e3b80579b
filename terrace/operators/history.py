"""Slowly changing dimension, type 2: every version of a key with its validity range.

``valid_to`` of a version is the cursor of the key's next version (NULL for the
current one, which is the one that no version follows, whatever the cursors). A per-key window (``lead() over (partition by key)``) would put all
versions of a key in one task, so a key holding a third of the table would be one
task's work. Such keys are found from a sample, and their versions are dealt by ranges
of (cursor, tiebreakers) whose bounds come from it too: a key holds a range for about
every partition's share of rows. ``lead`` then runs within each range, and the last row
of a range takes its successor from the first row of the next one - a table with a row
per range of a frequent key, so its size is bounded by the partition count and it is
broadcast. The sample only decides where rows are worked, never the result. Rows are
shuffled once; what is computed is written first, as it is read several times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.session import materialize

SAMPLED = 100  # rows of the sample for a partition's share of rows
_RANGE, _BOUNDS, _ORDINAL, _NEXT, _AT = "__range", "__bounds", "__ordinal", "__next", "at"


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in names:
        cond = cond & left[c].eqNullSafe(right[f"__{c}"])
    return cond


def _frequent(rows: DataFrame, key: Sequence[str], ordinal: Column, partitions: int) -> DataFrame:
    """(key, bounds) of keys with more than two partitions' shares of the rows: at most ``partitions`` bounds."""
    total = rows.count()
    fraction = min(1.0, SAMPLED * partitions / max(total, 1))
    share = max(1, int(fraction * total / partitions))
    sampled = rows.sample(fraction, seed=7).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.collect_list(ordinal).alias("o"))
    places = F.expr(f"sequence({share}, n - 1, {share})")
    found = sampled.filter(F.col("n") > 2 * share).withColumn("o", F.sort_array("o"))
    return materialize(found.select(
        *(F.col(k).alias(f"__{k}") for k in key), F.transform(places, lambda i: F.col("o")[i.cast("int")]).alias(_BOUNDS)
    ))


def scd2_history(
    df: DataFrame,
    key: Sequence[str],
    cursor: str,
    tiebreakers: Sequence[str | Column] = (),
    partitions: int | None = None,
    written: bool = False,
    deal: Sequence[str] = (),
) -> DataFrame:
    """``df`` plus ``valid_from``, ``valid_to`` and ``is_current`` per version.

    ``written``: ``df`` is cheap to read again. ``deal``: columns that follow from the key, by
    which rows are shuffled in place of it, for a writer that wants these together.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df if written else materialize(df)
    ties = [F.col(t) if isinstance(t, str) else t for t in tiebreakers]
    order = [c.asc_nulls_first() for c in (F.col(cursor), *ties)]
    ordinal = F.struct(F.col(cursor).alias(_AT), *(t.alias(f"t{i}") for i, t in enumerate(ties)))
    hot = _frequent(rows, key, ordinal, n)
    split = not hot.isEmpty()
    if split:
        mine = rows.join(F.broadcast(hot), _same(rows, hot, key), "left").drop(*(f"__{k}" for k in key))
        before = F.size(F.filter(_BOUNDS, lambda b: b <= F.col(_ORDINAL)))
        rows = mine.withColumn(_ORDINAL, F.when(F.col(_BOUNDS).isNotNull(), ordinal)).withColumn(
            _RANGE, F.when(F.col(_BOUNDS).isNotNull(), before).otherwise(0)
        ).drop(_BOUNDS)
    ranges = [_RANGE] * split
    if deal:
        rows = rows.repartition(*deal, *ranges)
    within = Window.partitionBy(*deal, *key, *ranges).orderBy(*order)
    found = rows.withColumn(_NEXT, F.lead(F.struct(F.col(cursor).alias(_AT))).over(within))
    if split:
        firsts = rows.filter(F.col(_ORDINAL).isNotNull()).groupBy(*key, _RANGE).agg(F.min(_ORDINAL).alias("first"))
        after = F.lead(F.struct(F.col(f"first.{_AT}").alias(_AT))).over(Window.partitionBy(*key).orderBy(_RANGE))
        after = firsts.select(*(F.col(c).alias(f"__{c}") for c in (*key, _RANGE)), after.alias("__after"))
        found = found.join(F.broadcast(after), _same(found, after, (*key, _RANGE)), "left").withColumn(_NEXT, F.coalesce(_NEXT, "__after"))
    return found.select(
        *[F.col(c) for c in df.columns],
        F.col(cursor).alias("valid_from"),
        F.col(f"{_NEXT}.{_AT}").alias("valid_to"),
        F.col(_NEXT).isNull().alias("is_current"),
    )
