"""Incremental ingest: high watermark, boundary dedupe, name normalisation, load metadata.

A load appends the source rows whose cursor is at or past the stored watermark,
except rows exactly on the watermark that already landed. The watermark is the max
cursor of the earlier loads, kept with the data, never in the job: every load
records its max cursor (observed during its own write) in a one-row-per-load state
table, and without that table it is aggregated from Bronze. A load is idempotent:
it writes its own ``_load_id=<id>`` partition (and state row) with overwrite, and a
retried load recomputes the same rows from the loads before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.expressions import snake_case
from terrace.session import settled
from terrace.specs import LOAD_ID, ROW_ID, TableSpec

_BOUNDARY_CURSOR = "__wm_cursor"


# -- ING3: column names -------------------------------------------------------------------


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case in one projection; fail on collisions."""
    mapping = {c: snake_case(c) for c in df.columns}
    seen: dict[str, str] = {}
    for src, dst in mapping.items():
        if dst in seen:
            raise ValueError(f"columns {seen[dst]!r} and {src!r} both normalise to {dst!r}")
        seen[dst] = src
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


# -- ING4: load metadata --------------------------------------------------------------------


def row_id(primary_key: Sequence[str], cursor: str, load_id: int) -> Column:
    """Deterministic row id: the same under task retry, unlike a random UUID."""
    return F.hex(F.xxhash64(*[F.col(c) for c in primary_key], F.col(cursor), F.lit(load_id)))


def with_load_metadata(df: DataFrame, spec: TableSpec, load_id: int) -> DataFrame:
    return df.withColumns(
        {ROW_ID: row_id(spec.primary_key, spec.cursor, load_id), LOAD_ID: F.lit(load_id).cast("long")}
    )


# -- ING1: high watermark ---------------------------------------------------------------------


def prior_loads(bronze: DataFrame | None, current_load_id: int | None) -> DataFrame | None:
    if bronze is None:
        return None
    if current_load_id is None or LOAD_ID not in bronze.columns:
        return bronze
    return bronze.filter(F.col(LOAD_ID) < F.lit(current_load_id))


# Columns of the per-load watermark state: one row per (table, load).
STATE_MAX_CURSOR = "max_cursor"


def state_covers(state: DataFrame | None, landed: set[int], current_load_id: int | None) -> bool:
    """Whether the state has a row for every load that landed before this one.

    A job that dies between its Bronze write and its state write leaves a load without a
    row; the state would then answer with an older watermark and the load would land twice.
    ``landed`` comes from a folder listing; the missing loads are counted in one small job.
    """
    earlier = [i for i in landed if current_load_id is None or i < current_load_id]
    if not earlier:
        return True
    if state is None:
        return False
    return state.filter(F.col(LOAD_ID).isin(earlier)).select(LOAD_ID).distinct().count() == len(earlier)


def high_watermark(
    bronze: DataFrame | None, cursor: str, current_load_id: int | None = None, state: DataFrame | None = None
) -> tuple[str | None, list[int] | None]:
    """(max cursor over earlier loads in its exact string form, loads that can hold rows at it).

    With ``state`` (one row per load) the answer is one aggregate over that small table, and
    only a load whose own maximum is the watermark can hold rows at it. Without, Bronze's
    cursor column is aggregated and the loads are unknown (None). No earlier load: (None, None).
    Values are compared in the cursor's own type, as string order is wrong for numbers.
    """
    if bronze is None:
        return None, None
    if state is not None:
        maxima = prior_loads(state, current_load_id).filter(F.col(STATE_MAX_CURSOR).isNotNull()).select(
            LOAD_ID, F.col(STATE_MAX_CURSOR).cast(bronze.schema[cursor].dataType).alias("m"), STATE_MAX_CURSOR
        )
        top = maxima.agg(F.max("m").alias("m"), F.max_by(STATE_MAX_CURSOR, "m").alias("wm")).first()
        if top["wm"] is None:
            return None, None
        at_top = maxima.filter(F.col("m") == F.lit(top["wm"]).cast(bronze.schema[cursor].dataType))
        return top["wm"], sorted(r[LOAD_ID] for r in at_top.select(LOAD_ID).collect())
    row = prior_loads(bronze, current_load_id).agg(F.max(F.col(cursor)).cast("string").alias("wm")).first()
    return row["wm"], None


def _typed(df: DataFrame, column: str, value: str) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)


# -- ING2 / JOI3: rows to append ----------------------------------------------------------------


class NullCursorError(ValueError):
    """A source row has no cursor, so it cannot be placed before or after a watermark."""


NULL_CURSOR_RULES = ("include", "fail")


def new_rows(
    source: DataFrame,
    bronze: DataFrame | None,
    spec: TableSpec,
    watermark: str | None,
    current_load_id: int | None = None,
    loads: list[int] | None = None,
    on_null_cursor: str = "fail",
) -> DataFrame:
    """Source rows to append: cursor >= watermark, minus boundary rows already landed.

    The cursor predicate reaches the source scan (Parquet or JDBC pushdown). The
    boundary set is Bronze rows with ``cursor = watermark``, written first so that the
    anti-join on (key, cursor) knows its size before the candidates are shuffled.

    Rows without a cursor are never dropped in silence: ``fail`` raises when there are any
    after the first load, ``include`` appends those whose key has no landed row without a
    cursor yet. They are read by a second, pushed-down IS NULL scan, which a source that
    declares the cursor NOT NULL does not even plan.
    """
    if on_null_cursor not in NULL_CURSOR_RULES:
        raise ValueError(f"on_null_cursor must be one of {NULL_CURSOR_RULES}, not {on_null_cursor!r}")
    if watermark is None:
        return source
    wm = _typed(source, spec.cursor, watermark)
    candidates = source.filter(F.col(spec.cursor) >= wm)
    without = source.filter(F.col(spec.cursor).isNull())
    if on_null_cursor == "fail" and source.schema[spec.cursor].nullable and not without.isEmpty():
        raise NullCursorError(f"{spec.name}: rows without {spec.cursor}; load them with on_null_cursor='include'")
    prior = prior_loads(bronze, current_load_id)
    if prior is None:
        return candidates if on_null_cursor == "fail" else candidates.unionByName(without)
    unplaced = prior.filter(F.col(spec.cursor).isNull())
    if loads is not None and LOAD_ID in prior.columns:
        prior = prior.filter(F.col(LOAD_ID).isin(loads))  # partition pruning
    # Boundary columns are renamed so the join never depends on lineage-based column
    # resolution (Bronze and source may derive from the same scan).
    keys = [F.col(k).alias(f"__b_{k}") for k in spec.primary_key]
    boundary = settled(
        prior.filter(F.col(spec.cursor) == _typed(prior, spec.cursor, watermark)).select(*keys, F.col(spec.cursor).alias(_BOUNDARY_CURSOR))
    )
    same_key = [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in spec.primary_key]
    fresh = candidates.join(boundary, [*same_key, F.col(spec.cursor) == F.col(_BOUNDARY_CURSOR)], "left_anti")
    if on_null_cursor == "fail":
        return fresh
    return fresh.unionByName(without.join(unplaced.select(*keys), same_key, "left_anti"))


def incremental_batch(
    source: DataFrame,
    bronze: DataFrame | None,
    spec: TableSpec,
    load_id: int,
    state: DataFrame | None = None,
    on_null_cursor: str = "fail",
) -> DataFrame:
    """The rows a load appends, with load metadata, ready to write."""
    wm, loads = high_watermark(bronze, spec.cursor, load_id, state)
    if wm is None and bronze is not None and on_null_cursor == "include":
        # Earlier loads landed rows without a cursor only: nothing to compare with but keys.
        landed = prior_loads(bronze, load_id).select(*[F.col(k).alias(f"__b_{k}") for k in spec.primary_key])
        same = [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in spec.primary_key]
        placed = source.filter(F.col(spec.cursor).isNotNull())
        rows = placed.unionByName(source.filter(F.col(spec.cursor).isNull()).join(landed, same, "left_anti"))
    else:
        rows = new_rows(source, bronze, spec, wm, load_id, loads, on_null_cursor)
    return with_load_metadata(rows, spec, load_id)


def max_cursor(spec: TableSpec):
    """Aggregate recorded with every load: its max cursor in exact string form."""
    return F.max(F.col(spec.cursor)).cast("string")
