"""Document contracts: a closed, typed schema checked with column expressions.

The contract is declared once (field name + kind). Checking it never runs Python per
row: schema-level problems (missing, extra, mistyped columns) come from
``df.schema``; row-level problems (NULL, not coercible, lossy coercion) are an array
column built from ``when`` expressions; duplicate keys are a keyed aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUM_TYPES = (*_INT_TYPES, T.FloatType, T.DoubleType, T.DecimalType)

# Contract kinds and the Spark type a value is coerced to.
KIND_TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
}


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[tuple[str, str], ...]
    key: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [f for f, _ in self.fields]

    def spark_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, KIND_TYPES[k], False) for f, k in self.fields])


# The sales-line search document (16 required fields, no extras).
FACT_SALES_DOC = Contract(
    name="fact_sales",
    fields=(
        ("order_line_id", "int"),
        ("order_id", "int"),
        ("customer_id", "int"),
        ("salesperson_person_id", "int"),
        ("stock_item_id", "int"),
        ("description", "str"),
        ("quantity", "int"),
        ("picked_quantity", "int"),
        ("unit_price", "float"),
        ("tax_rate", "float"),
        ("extended_price", "float"),
        ("tax_amount", "float"),
        ("line_total", "float"),
        ("order_date", "date"),
        ("order_year", "int"),
        ("order_month", "int"),
    ),
    key=("order_line_id",),
)


class ContractError(ValueError):
    pass


def _accepts(kind: str, dtype: T.DataType) -> bool:
    """Can a column of ``dtype`` be coerced to ``kind`` at all (lax coercion)?"""
    if kind == "int":
        return isinstance(dtype, (*_NUM_TYPES, T.StringType))
    if kind == "float":
        return isinstance(dtype, (*_NUM_TYPES, T.StringType))
    if kind == "str":
        return isinstance(dtype, T.StringType)
    if kind == "date":
        return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType))
    if kind == "bool":
        return isinstance(dtype, T.BooleanType)
    return False


def schema_violations(df: DataFrame, contract: Contract) -> list[str]:
    """Closed-schema check on metadata only: missing, extra and mistyped fields."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = [f"missing:{f}" for f in contract.names if f not in types]
    out += [f"extra:{c}" for c in df.columns if c not in contract.names]
    out += [f"type:{f}" for f, k in contract.fields if f in types and not _accepts(k, types[f])]
    return out


def coerced(col: Column, kind: str, dtype: T.DataType) -> Column:
    """Value converted to the contract type, NULL when it cannot be converted."""
    if kind == "date" and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(col)
    return col.try_cast(KIND_TYPES[kind])


def lossless(col: Column, kind: str, dtype: T.DataType) -> Column:
    """True when the coercion keeps the value (integers stay integral, dates keep time 0)."""
    value = coerced(col, kind, dtype)
    if kind == "int" and isinstance(dtype, (T.DecimalType, T.FloatType, T.DoubleType)):
        return value.cast(dtype) == col
    if kind == "int" and isinstance(dtype, T.StringType):
        return value.cast("string") == F.trim(col)
    if kind == "date" and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value.cast(dtype) == col
    if kind == "date" and isinstance(dtype, T.StringType):
        return value.cast("string") == F.trim(col)  # a string with a time of day is no date
    return F.lit(True)


def invalid(col: Column, kind: str, dtype: T.DataType) -> Column:
    """True when a value breaks its field rule: NULL, not coercible, or lossy."""
    value = coerced(col, kind, dtype)
    return col.isNull() | value.isNull() | ~F.coalesce(lossless(col, kind, dtype), F.lit(False))


def row_violations(df: DataFrame, contract: Contract) -> Column:
    """Array of ``null:<f>``, ``type:<f>`` and ``lossy:<f>`` labels for one row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    checks: list[Column] = []
    for f, kind in contract.fields:
        if f not in types or not _accepts(kind, types[f]):
            continue  # schema-level violation, reported once
        col, dtype = F.col(f), types[f]
        value = coerced(col, kind, dtype)
        checks.append(
            F.when(col.isNull(), F.lit(f"null:{f}"))
            .when(value.isNull(), F.lit(f"type:{f}"))
            .when(~lossless(col, kind, dtype), F.lit(f"lossy:{f}"))
        )
    if not checks:
        return F.array().cast("array<string>")
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Project the contract fields in order, converted to the contract types."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[coerced(F.col(f), k, types[f]).alias(f) for f, k in contract.fields])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row: ``(*key, copies)``. A keyed partial aggregate,
    so a hot key costs one partial row per task."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def violation_summary(df: DataFrame, contract: Contract) -> DataFrame:
    """``(rule, violations)``: one row per field rule, ``duplicate_key``, and any
    schema rules (violations -1: the whole column).

    One pass: per-row validity flags (plain boolean expressions, no arrays) are
    summed per key (a partial aggregate, so a hot key costs one partial row per
    task), then the per-key sums are totalled.
    """
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    checked = [(f, k) for f, k in contract.fields if f in types and _accepts(k, types[f])]
    flagged = df.select(
        *contract.key,
        *[
            invalid(F.col(f), k, types[f]).cast("long").alias(f"__f{i}")
            for i, (f, k) in enumerate(checked)
        ],
    )
    per_key = flagged.groupBy(*contract.key).agg(
        F.count(F.lit(1)).alias("__copies"), *[F.sum(f"__f{i}").alias(f"__f{i}") for i in range(len(checked))]
    )
    rules = [
        F.struct(F.lit(f"invalid:{f}").alias("rule"), F.coalesce(F.sum(f"__f{i}"), F.lit(0)).alias("violations"))
        for i, (f, _) in enumerate(checked)
    ]
    rules.append(
        F.struct(
            F.lit("duplicate_key").alias("rule"),
            F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("violations"),
        )
    )
    out = per_key.agg(F.array(*rules).alias("__r")).select(F.inline("__r")).select(
        "rule", F.col("violations").cast("long")
    )
    schema_rules = schema_violations(df, contract)
    if schema_rules:
        out = out.unionByName(
            spark.createDataFrame([(r, -1) for r in schema_rules], "rule string, violations long")
        )
    return out


def validate(df: DataFrame, contract: Contract, sample: int = 5) -> DataFrame:
    """Strict mode: raise with counts and a few offending keys, else return coerced rows."""
    problems = schema_violations(df, contract)
    if problems:
        raise ContractError(f"{contract.name}: schema violations {problems}")
    summary = violation_summary(df, contract).filter(F.col("violations") > 0).collect()
    if summary:
        bad = (
            df.select(*contract.key, row_violations(df, contract).alias("violations"))
            .filter(F.size("violations") > 0)
            .limit(sample)
            .collect()
        )
        counts = {r["rule"]: r["violations"] for r in summary}
        raise ContractError(f"{contract.name}: {counts}; e.g. {[r.asDict() for r in bad]}")
    return coerce(df, contract)


def publish(df: DataFrame, contract: Contract, path: str, sample: int = 5) -> dict[str, object]:
    """Write the documents of ``df`` to ``path``, checked in the pass that writes them.

    Rows are converted, serialised and written once to a place beside ``path``, with each
    rule's violations counted by an ``Observation`` of that write; repeated keys are counted
    on the written documents, which are then copied into place clustered by id. Any
    violation raises and leaves ``path`` as it was.
    """
    problems = schema_violations(df, contract)
    if problems:
        raise ContractError(f"{contract.name}: schema violations {problems}")
    spark, staging = df.sparkSession, f"{path}_unchecked"
    types = {f.name: f.dataType for f in df.schema.fields}
    seen = Observation(contract.name)
    counts = [F.count_if(invalid(F.col(f), k, types[f])).alias(f) for f, k in contract.fields]
    to_documents(df.observe(seen, F.count(F.lit(1)).alias("__rows"), *counts), contract).write.mode("overwrite").parquet(staging)
    written = spark.read.parquet(staging)
    found = seen.get
    bad = {f"invalid:{f}": found[f] for f in contract.names if found.get(f)}
    repeated = duplicate_keys(written, ("doc_id",))
    keys = [r["doc_id"] for r in repeated.limit(sample).collect()]
    if bad or keys:
        raise ContractError(f"{contract.name}: {bad}; repeated keys such as {keys}")
    written.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.mode("overwrite").parquet(path)
    return {"table": contract.name, "rows": found["__rows"], "destination": path}


def quarantine(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Split into (valid coerced rows, invalid rows with their violation labels)."""
    problems = schema_violations(df, contract)
    if problems:
        raise ContractError(f"{contract.name}: schema violations {problems}")
    flagged = df.withColumn("violations", row_violations(df, contract))
    valid = coerce(flagged.filter(F.size("violations") == 0).drop("violations"), contract)
    invalid = flagged.filter(F.size("violations") > 0)
    return valid, invalid


def to_documents(df: DataFrame, contract: Contract) -> DataFrame:
    """Publishable documents: ``(doc_id, doc)`` with ``doc`` the JSON of the contract
    fields in contract order; dates are ISO strings."""
    docs = coerce(df, contract)
    key = contract.key[0]
    return docs.select(
        F.col(key).alias("doc_id"),
        F.to_json(F.struct(*[F.col(f) for f in contract.names])).alias("doc"),
    )


# The billed-line document (searchable invoices).
FACT_INVOICES_DOC = Contract(
    name="fact_invoices",
    fields=(
        ("invoice_line_id", "int"),
        ("invoice_id", "int"),
        ("customer_id", "int"),
        ("salesperson_person_id", "int"),
        ("stock_item_id", "int"),
        ("description", "str"),
        ("quantity", "int"),
        ("unit_price", "float"),
        ("tax_rate", "float"),
        ("line_profit", "float"),
        ("extended_price", "float"),
        ("tax_amount", "float"),
        ("line_total", "float"),
        ("invoice_date", "date"),
        ("is_credit_note", "bool"),
        ("invoice_year", "int"),
        ("invoice_month", "int"),
    ),
    key=("invoice_line_id",),
)
