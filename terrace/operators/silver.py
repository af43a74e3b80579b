"""Bronze -> Silver: keep the latest version of every key, drop load bookkeeping.

``dedupe_latest`` is written as ``row_number() over (partition by key order by ...) = 1``
on purpose: Catalyst turns that shape into a partial ``WindowGroupLimit`` before the
shuffle and a final one after it, so every map task sends at most one row per key.
A key that holds a third of the table therefore costs one row per task in the
exchange, not a third of the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.specs import BOOKKEEPING, LOAD_ID

_RN = "__rn"


def _as_tuple(cols: str | Sequence[str]) -> tuple[str, ...]:
    return (cols,) if isinstance(cols, str) else tuple(cols)


def latest_order(df: DataFrame, cursor: str, tiebreakers: Sequence[str] = ()) -> list[Column]:
    """Newest-first ordering: cursor, then load id when present, then tiebreakers.

    NULLs sort last under every key, so a NULL cursor only wins when it is alone.
    """
    order = [F.col(cursor).desc_nulls_last()]
    if LOAD_ID in df.columns:
        order.append(F.col(LOAD_ID).desc_nulls_last())
    order.extend(F.col(c).desc_nulls_last() for c in tiebreakers)
    return order


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rank rows within each key by ``order`` and keep rank 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedupe_latest(
    df: DataFrame,
    primary_key: str | Sequence[str],
    cursor: str,
    tiebreakers: Sequence[str] = (),
) -> DataFrame:
    """One row per primary key: the newest by cursor, then load id, then tiebreakers."""
    keys = _as_tuple(primary_key)
    return keep_first(df, keys, latest_order(df, cursor, tiebreakers))


def drop_bookkeeping(df: DataFrame, columns: Sequence[str] = BOOKKEEPING) -> DataFrame:
    """Drop load bookkeeping columns that are present; absent ones are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


class NullKeyError(ValueError):
    pass


def null_keys(df: DataFrame, primary_key: str | Sequence[str]) -> DataFrame:
    """Rows with a NULL in any key column (they would collapse into one group)."""
    cond = F.lit(False)
    for k in _as_tuple(primary_key):
        cond = cond | F.col(k).isNull()
    return df.filter(cond)


def conform(
    df: DataFrame,
    primary_key: str | Sequence[str],
    cursor: str,
    tiebreakers: Sequence[str] = (),
    on_null_key: str = "group",
) -> DataFrame:
    """Dedupe to latest, then drop bookkeeping. Pure DataFrame -> DataFrame.

    ``on_null_key``: ``group`` keeps the plain semantics (all NULL keys form one
    group), ``drop`` removes rows with a NULL key, ``fail`` raises when any exist
    (one filtered count; use the quarantine of the contract checks to keep them).
    """
    if on_null_key == "drop":
        keys = _as_tuple(primary_key)
        df = df.dropna(subset=list(keys))
    elif on_null_key == "fail":
        n = null_keys(df, primary_key).count()
        if n:
            raise NullKeyError(f"{n} rows have a NULL primary key {list(_as_tuple(primary_key))}")
    elif on_null_key != "group":
        raise ValueError(f"on_null_key must be group, drop or fail, not {on_null_key!r}")
    return drop_bookkeeping(dedupe_latest(df, primary_key, cursor, tiebreakers))
