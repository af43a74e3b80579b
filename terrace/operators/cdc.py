"""Change-data-capture operators: change-table projection and change-feed collapse.

``project_change_table`` turns a raw change table (binary LSN and sequence value,
operation code, business columns) into the Bronze change feed. The watermark
predicate compares the raw binary LSN, so it reaches the scan; the hex projection
comes after.

``collapse_changes`` keeps the latest change per key and drops keys whose latest
change is a delete. The ordering is (lsn, seqval, operation, tiebreakers), all
descending: with equal (lsn, seqval) an update's after-image (4) beats its
before-image (3), a case the source ordering alone leaves open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.expressions import lsn_hex
from terrace.operators.silver import _as_tuple, drop_bookkeeping, keep_first
from terrace.specs import (
    CHANGE_COLUMNS,
    CHANGE_LSN,
    CHANGE_OPERATION,
    CHANGE_SEQVAL,
    INITIAL_LSN,
    OP_DELETE,
)

# Metadata column names of a source change table.
CT_START_LSN = "__$start_lsn"
CT_SEQVAL = "__$seqval"
CT_OPERATION = "__$operation"
CT_PREFIX = "__$"


def business_columns(df: DataFrame) -> list[str]:
    """All columns not starting with the change-table prefix, in ordinal order."""
    return [c for c in df.columns if not c.startswith(CT_PREFIX)]


def project_change_table(change_table: DataFrame, last_lsn: str = INITIAL_LSN) -> DataFrame:
    """Bronze change feed from a change table: only changes strictly after ``last_lsn``."""
    lsn = F.col(f"`{CT_START_LSN}`")
    return change_table.filter(lsn > F.unhex(F.lit(last_lsn))).select(
        lsn_hex(lsn).alias(CHANGE_LSN),
        lsn_hex(F.col(f"`{CT_SEQVAL}`")).alias(CHANGE_SEQVAL),
        F.col(f"`{CT_OPERATION}`").cast("int").alias(CHANGE_OPERATION),
        *[F.col(f"`{c}`") for c in business_columns(change_table)],
    )


def change_order(tiebreakers: Sequence[str] = ()) -> list[Column]:
    """Newest-change-first ordering used by batch and streaming collapse alike."""
    return [
        F.col(CHANGE_LSN).desc_nulls_last(),
        F.col(CHANGE_SEQVAL).desc_nulls_last(),
        F.col(CHANGE_OPERATION).desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in tiebreakers],
    ]


def drop_change_metadata(df: DataFrame) -> DataFrame:
    return drop_bookkeeping(df, (*CHANGE_COLUMNS, "_row_id", "_load_id"))


def collapse_changes(
    df: DataFrame,
    primary_key: str | Sequence[str],
    tiebreakers: Sequence[str] = (),
) -> DataFrame:
    """Current state per key: latest change wins, deletes removed, metadata dropped.

    A NULL operation is dropped as well (``NULL != 1`` is not true).
    """
    latest = keep_first(df, _as_tuple(primary_key), change_order(tiebreakers))
    current = latest.filter(F.col(CHANGE_OPERATION) != F.lit(OP_DELETE))
    return drop_change_metadata(current)
