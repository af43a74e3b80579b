"""Relational sources over JDBC: incremental table scans and change-table scans.

Both read in parallel: the key range is split into ``num_partitions`` stripes
(``partitionColumn`` / ``lowerBound`` / ``upperBound``), and the watermark predicate
is a DataFrame filter that the JDBC source pushes into each stripe's ``WHERE``.
Column names are normalised by the ingest step, not here.

No JDBC driver ships with this repository; the functions are exercised in tests
through Parquet sources with the same shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.expressions import snake_case
from terrace.operators.cdc import CT_SEQVAL, CT_START_LSN
from terrace.specs import INITIAL_LSN, TableSpec


def _reader(spark: SparkSession, url: str, properties: dict[str, str] | None):
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader


def key_bounds(spark: SparkSession, url: str, table: str, column: str, properties=None) -> tuple[int, int]:
    """Min and max of a numeric key, one aggregate row from the source."""
    row = (
        _reader(spark, url, properties)
        .option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
        .load()
        .first()
    )
    return int(row["lo"] or 0), int(row["hi"] or 0)


def source_column(columns: list[str], normalized: str) -> str:
    """The source-system name of a column the specs know by its snake_case name."""
    for c in columns:
        if c == normalized or snake_case(c) == normalized:
            return c
    raise KeyError(f"no source column normalises to {normalized!r} in {columns}")


def since_watermark(df: DataFrame, spec: TableSpec, watermark: str | None) -> DataFrame:
    """``df`` (source column names) restricted to cursor >= watermark; a literal
    comparison on the raw column, so the JDBC source pushes it into its WHERE."""
    if watermark is None:
        return df
    cursor = source_column(df.columns, spec.cursor)
    return df.filter(F.col(cursor) >= F.lit(watermark).cast(df.schema[cursor].dataType))


def read_incremental(
    spark: SparkSession,
    url: str,
    spec: TableSpec,
    watermark: str | None,
    num_partitions: int = 64,
    properties: dict[str, str] | None = None,
    source_key: str | None = None,
) -> DataFrame:
    """Rows of ``spec``'s source table with cursor at or past the watermark (all rows
    on the first load), read in ``num_partitions`` stripes of the numeric key
    ``source_key`` (default: the source column that normalises to the first key
    column, found from the table's schema - a metadata query, no rows)."""
    table = f"[{spec.source_schema}].[{spec.source_table}]"
    reader = _reader(spark, url, properties).option("dbtable", table)
    source_key = source_key or source_column(reader.load().columns, spec.primary_key[0])
    if num_partitions > 1:
        lo, hi = key_bounds(spark, url, table, source_key, properties)
        reader = (
            reader.option("partitionColumn", source_key)
            .option("lowerBound", lo)
            .option("upperBound", hi + 1)
            .option("numPartitions", num_partitions)
        )
    return since_watermark(reader.load(), spec, watermark)


def read_change_table(
    spark: SparkSession,
    url: str,
    capture_instance: str,
    last_lsn: str = INITIAL_LSN,
    properties: dict[str, str] | None = None,
    num_partitions: int = 16,
) -> DataFrame:
    """Raw change table after ``last_lsn``, as ``cdc.project_change_table`` takes it.

    Read in ``num_partitions`` stripes of a checksum over the change's position, each a
    predicate of its own, so one long-running transaction does not make one task's work.
    """
    place = f"ABS(CONVERT(bigint, CHECKSUM([{CT_START_LSN}], [{CT_SEQVAL}]))) % {num_partitions}"
    stripes = [f"[{CT_START_LSN}] > 0x{last_lsn} AND {place} = {i}" for i in range(num_partitions)]
    return spark.read.jdbc(url, f"cdc.[{capture_instance}_CT]", predicates=stripes, properties=properties or {})


def sales_sources(
    spark: SparkSession, url: str, specs: Sequence[TableSpec], properties: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """The registered tables as the extract stage takes them; it adds the watermark itself."""
    return {s.name: read_incremental(spark, url, s, None, properties=properties) for s in specs}
