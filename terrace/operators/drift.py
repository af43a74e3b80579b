"""Distribution drift between loads, from mergeable quantile sketches.

Each load leaves a profile: per numeric column its rows, NULLs and a KLL sketch, which is a few
kilobytes whatever the size of the load. Profiles merge (a week from its days, a table from its
loads) and are compared with an accepted one without reading either load again:

* Kolmogorov-Smirnov: the largest difference of the two distribution functions over the points
  of both sketches;
* population stability: sum of (a - e) ln(a / e) over the deciles of the accepted load;
* the share of NULLs.

Sketch errors. A KLL sketch with k = 800 places a rank within 0.5 % (99 % confidence), and its
distribution function is read from ``GRID`` quantiles, so a rank is within ``RANK_ERROR`` and a
Kolmogorov-Smirnov statistic within twice that of the exact one. A load is refused only where a
statistic exceeds its limit by that much, so the sketches refuse none that exact numbers would
pass.

Defined results: NaN counts as NULL; a column without values on one side only has statistic 1,
on both sides 0. Columns are compared by name; a column missing on one side counts as empty. An
empty load has 0 rows and drifts from any load that has some.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 800
GRID = 500  # quantiles that stand for a distribution
RANK_ERROR = 0.005 + 1 / GRID
BINS = 10
FLOOR = 1e-4  # least share of a bin, so that an empty one has a logarithm


class DriftError(ValueError):
    """A load's distribution is too far from the accepted one."""


@dataclass(frozen=True)
class Limits:
    """Largest accepted statistics of a column (a stability index above 0.25 is a shift by custom)."""

    ks: float = 0.1
    stability: float = 0.25
    nulls: float = 0.05


def profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, nulls, sketch): one pass, one sketch per column and task, merged."""
    if not columns:
        raise ValueError("no columns to profile")
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    measures = []
    for i, c in enumerate(columns):
        measures += [F.count(value[c]).alias(f"n{i}"), F.kll_sketch_agg_double(value[c], F.lit(K)).alias(f"s{i}")]
    one = rows.agg(F.count(F.lit(1)).alias("rows"), *measures)
    entry = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"), F.col(f"s{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*entry)))


def merged(profiles: DataFrame) -> DataFrame:
    """One profile from several of the same columns."""
    return profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def _grid(sketch: str, held: Column) -> Column:
    """The quantiles in the middle of GRID equal shares, in order; empty without values."""
    at = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    return F.when(held > 0, F.kll_sketch_get_quantile_double(sketch, at)).otherwise(F.array().cast("array<double>"))


def _ranks(grid: str, points: str) -> Column:
    """Share of a grid at or below each point; 0 for an empty grid."""
    below = lambda p: F.size(F.filter(grid, lambda g: g <= p))
    return F.transform(points, lambda p: below(p) / F.greatest(F.size(grid), F.lit(1)))


def compare(accepted: DataFrame, load: DataFrame) -> DataFrame:
    """(column, rows, ks, stability, nulls): statistics of ``load`` against ``accepted``."""
    e = accepted.select("column", *(F.col(c).alias(f"e_{c}") for c in ("rows", "nulls", "sketch")))
    a = load.select("column", *(F.col(c).alias(f"a_{c}") for c in ("rows", "nulls", "sketch")))
    both = e.join(a, "column", "full_outer")
    zero = F.lit(0).cast("long")
    both = both.select(
        "column", "e_sketch", "a_sketch", *(F.coalesce(c, zero).alias(c) for c in ("e_rows", "e_nulls", "a_rows", "a_nulls"))
    )
    e_held, a_held = F.col("e_rows") - F.col("e_nulls"), F.col("a_rows") - F.col("a_nulls")
    at = both.withColumn("_ge", _grid("e_sketch", e_held)).withColumn("_ga", _grid("a_sketch", a_held))
    deciles = F.transform(F.sequence(F.lit(1), F.lit(BINS - 1)), lambda i: F.get("_ge", (i * GRID / BINS).cast("int")))
    at = at.withColumn("_points", F.array_distinct(F.concat("_ge", "_ga")))
    at = at.withColumn("_cuts", F.when(e_held > 0, F.array_distinct(deciles)).otherwise(F.array().cast("array<double>")))
    at = at.withColumn("_e", _ranks("_ge", "_points")).withColumn("_a", _ranks("_ga", "_points"))
    at = at.withColumn("_ce", _ranks("_ge", "_cuts")).withColumn("_ca", _ranks("_ga", "_cuts"))
    largest = F.coalesce(F.array_max(F.zip_with("_e", "_a", lambda x, y: F.abs(x - y))), F.lit(0.0))
    ks = F.when((e_held > 0) != (a_held > 0), 1.0).otherwise(largest)

    def shares(ranks: str) -> Column:
        """Shares of the bins between the cuts, and of those below and above them."""
        edges = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
        steps = F.sequence(F.lit(1), F.size(edges) - 1)
        return F.transform(steps, lambda i: F.greatest(F.get(edges, i) - F.get(edges, i - 1), F.lit(FLOOR)))

    terms = F.zip_with(shares("_ce"), shares("_ca"), lambda x, y: (y - x) * F.log(y / x))
    index = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    stability = F.when((e_held > 0) & (a_held > 0), index).otherwise(F.when((e_held > 0) != (a_held > 0), F.lit(float("inf"))).otherwise(0.0))
    share = lambda side: F.when(F.col(f"{side}_rows") > 0, F.col(f"{side}_nulls") / F.col(f"{side}_rows")).otherwise(0.0)
    return at.select(
        "column", F.col("a_rows").alias("rows"), ks.alias("ks"), stability.alias("stability"), F.abs(share("e") - share("a")).alias("nulls")
    )


def report(accepted: DataFrame, load: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``compare`` with ``passed``: no statistic is beyond its limit and the sketches' error."""
    found = compare(accepted, load)
    ok = (
        (F.col("ks") <= limits.ks + 2 * RANK_ERROR) & (F.col("stability") <= limits.stability + 2 * BINS * RANK_ERROR) & (F.col("nulls") <= limits.nulls)
    )
    return found.withColumn("passed", ok)


def enforce(accepted: DataFrame, load: DataFrame, limits: Limits = Limits()) -> None:
    """Raise ``DriftError`` naming the columns of a load that drifted; a row per column is read."""
    bad = [r for r in report(accepted, load, limits).filter(~F.col("passed")).collect()]
    if bad:
        said = "; ".join(f"{r['column']}: ks {r['ks']:.3f}, stability {r['stability']:.3f}, nulls {r['nulls']:.3f}" for r in bad)
        raise DriftError(f"load refused, distributions drifted: {said}")
