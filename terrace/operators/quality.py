"""Reconciliation, layer profiles, table fingerprints, snapshot diffs and quality gates.

All checks are aggregates or keyed joins; the only values that reach the driver are
metrics (one row per table or per rule), never table rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Reconciliation status labels.
STATUS_OK = "OK"
STATUS_APPEND = "APPEND"
STATUS_DIFF = "DIFF"


# -- AGG4 / JOI4 / EXP8 / QLT1: counts and reconciliation --------------------------------


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``(table, rows)``. One global aggregate per table, unioned."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile_status(source: Column, bronze: Column) -> Column:
    return (
        F.when(source == bronze, F.lit(STATUS_OK))
        .when(bronze > source, F.lit(STATUS_APPEND))
        .otherwise(F.lit(STATUS_DIFF))
    )


def reconcile(bronze_counts: DataFrame, source_counts: DataFrame | None) -> DataFrame:
    """Source vs landed counts per table; a table missing on one side counts 0.

    Without a source (unreachable), the report has only ``table, bronze``.
    """
    b = bronze_counts.select("table", F.col("rows").alias("bronze"))
    if source_counts is None:
        return b
    s = source_counts.select("table", F.col("rows").alias("source"))
    j = s.join(b, on="table", how="full_outer")
    src = F.coalesce(F.col("source"), F.lit(0)).cast("long")
    brz = F.coalesce(F.col("bronze"), F.lit(0)).cast("long")
    return j.select("table", src.alias("source"), brz.alias("bronze"), reconcile_status(src, brz).alias("status"))


# -- QLT2 / TOP1: layer profile --------------------------------------------------------------


@dataclass(frozen=True)
class ProfiledTable:
    df: DataFrame
    order_by: tuple[str, ...] = ()
    partition_columns: tuple[str, ...] = ()
    version: int | None = None


def profile(tables: Mapping[str, ProfiledTable]) -> DataFrame:
    """Per table: rows, column count and partition columns (``version`` if known)."""
    parts = []
    for name, t in tables.items():
        parts.append(
            t.df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"),
                "rows",
                F.lit(len(t.df.columns)).alias("cols"),
                F.lit(",".join(t.partition_columns)).alias("partition_columns"),
                F.lit(t.version).cast("long").alias("version"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def samples(tables: Mapping[str, ProfiledTable], n: int = 3, max_cols: int = 6) -> DataFrame:
    """Up to ``n`` rows x the first ``max_cols`` columns per table, as JSON text.

    Ordered by the table's key so the sample is deterministic; planned as a
    take-ordered (top-n per task, then merge), never a full sort.
    """
    parts = []
    for name, t in tables.items():
        cols = t.df.columns[:max_cols]
        order = list(t.order_by) or cols[:1]
        top = t.df.select(*cols).orderBy(*order).limit(n)
        parts.append(
            top.select(
                F.lit(name).alias("table"),
                F.to_json(F.struct(*[F.col(c) for c in cols])).alias("sample"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- QLT3: fingerprints and snapshot diffs ------------------------------------------------------


def _canonical(df: DataFrame, columns: Sequence[str]) -> Column:
    # NULL is spelled out so that (NULL, 'a') and ('a', NULL) differ.
    return F.concat_ws(
        "\u0001", *[F.coalesce(F.col(c).cast(StringType()), F.lit("\u0000")) for c in columns]
    )


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, portable: bool = False) -> Column:
    """60-bit non-negative row hash. ``portable`` uses md5 of the canonical text so
    another engine can reproduce it; the default xxhash64 is faster."""
    cols = list(columns or df.columns)
    if portable:
        return F.conv(F.substring(F.md5(_canonical(df, cols)), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.abs(F.xxhash64(*[F.col(c) for c in cols]) % F.lit(1 << 60)).cast("decimal(38,0)")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, portable: bool = False) -> DataFrame:
    """Order-insensitive table fingerprint: row count and the sum of row hashes."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash(df, columns, portable)), F.lit(0).cast("decimal(38,0)")).alias("hash_sum"),
    )


def snapshot_diff(
    before: DataFrame, after: DataFrame, key: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """Keyed diff of two snapshots: ``added``, ``removed`` or ``changed`` per key.

    Values are compared with null-safe equality; unchanged keys are not returned.
    """
    key = list(key)
    cols = list(compare or [c for c in after.columns if c not in key])
    b = before.select(*key, F.struct(*cols).alias("__before"))
    a = after.select(*key, F.struct(*cols).alias("__after"))
    j = b.join(a, on=key, how="full_outer")
    change = (
        F.when(F.col("__before").isNull(), F.lit("added"))
        .when(F.col("__after").isNull(), F.lit("removed"))
        .when(~F.col("__before").eqNullSafe(F.col("__after")), F.lit("changed"))
    )
    return j.select(*key, change.alias("change")).filter(F.col("change").isNotNull())


# -- EXT2: data-quality gate ---------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A named check. ``kind``: ``not_null`` (column), ``min_rows`` (threshold),
    ``range`` (column within [low, high]), ``unique`` (column list), ``freshness``
    (column max >= threshold), ``schema`` (expected column names, comma-separated)."""

    name: str
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    threshold: object | None = None


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate rules lazily: ``rule, kind, failures, passed``, one row per rule.

    Column rules share one aggregate pass over ``df`` (then unpivoted with
    ``inline``); each uniqueness rule is one keyed aggregate. Nothing is collected.
    """
    single: list[Column] = []
    for r in rules:
        if r.kind == "not_null":
            failures = F.count_if(F.col(r.column).isNull())
        elif r.kind == "range":
            c = F.col(r.column)
            failures = F.count_if(F.coalesce((c < F.lit(r.low)) | (c > F.lit(r.high)), F.lit(False)))
        elif r.kind == "min_rows":
            failures = F.when(F.count(F.lit(1)) >= F.lit(int(r.threshold)), 0).otherwise(1)
        elif r.kind == "freshness":
            latest = F.max(F.col(r.column))
            fresh = F.coalesce(latest >= F.lit(r.threshold).cast(df.schema[r.column].dataType), F.lit(False))
            failures = F.when(fresh, 0).otherwise(1)
        elif r.kind == "schema":
            expected = {c.strip() for c in str(r.threshold).split(",")}
            failures = F.lit(len(expected ^ set(df.columns)))
        elif r.kind == "unique":
            continue
        else:
            raise ValueError(f"unknown rule kind {r.kind!r}")
        single.append(
            F.struct(
                F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), failures.cast("long").alias("failures")
            )
        )
    parts: list[DataFrame] = []
    if single:
        parts.append(df.agg(F.array(*single).alias("__r")).select(F.inline("__r")))
    for r in rules:
        if r.kind != "unique":
            continue
        keys = [k.strip() for k in str(r.column).split(",")]
        dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
        parts.append(
            dup.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.col("failures").cast("long")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


class QualityGateError(RuntimeError):
    pass


def enforce(report: DataFrame) -> None:
    """Fail the stage when any rule failed (the report is one row per rule)."""
    failed = [r["rule"] for r in report.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityGateError(f"quality gate failed: {', '.join(failed)}")
