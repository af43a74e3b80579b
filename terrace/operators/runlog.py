"""Run reconstruction from structured log events.

Each pipeline step logs one JSON object per event: fixed fields ``ts, level,
logger, msg, correlation_id`` plus free extras (``table``, ``rows``,
``destination`` ...). ``parse_run_events`` reads such lines with ``from_json`` (typed
fixed fields, extras kept as a string map); ``run_metrics`` groups them by run and
table. Both are column expressions and keyed aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fixed fields of a log event.
FIXED_FIELDS = ("ts", "level", "logger", "msg", "correlation_id")

EVENT_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in FIXED_FIELDS]
    + [
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("destination", T.StringType()),
    ]
)


def parse_run_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON log lines -> typed columns + ``extras`` (every other key, as strings)."""
    parsed = lines.select(
        F.from_json(F.col(column), EVENT_SCHEMA).alias("e"),
        F.from_json(F.col(column), "map<string,string>").alias("all"),
    )
    known = F.array(*[F.lit(f) for f in EVENT_SCHEMA.fieldNames()])
    return parsed.select(
        F.to_timestamp(F.col("e.ts")).alias("ts"),
        *[F.col(f"e.{f}").alias(f) for f in EVENT_SCHEMA.fieldNames() if f != "ts"],
        F.map_filter("all", lambda k, v: ~F.array_contains(known, k)).alias("extras"),
    )


def json_metric(payload: Column, key: str, dtype: str = "bigint") -> Column:
    """One numeric field of a JSON payload."""
    return F.get_json_object(payload, f"$.{key}").cast(dtype)


def run_metrics(events: DataFrame) -> DataFrame:
    """Per (run, table): number of events, rows reported, first and last event time,
    and (when events carry it) the latest destination written."""
    aggs = [
        F.count(F.lit(1)).alias("events"),
        F.sum("rows").alias("rows"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    ]
    if "destination" in events.columns:
        named = F.when(F.col("destination").isNotNull(), F.col("ts"))  # NULL order: skipped
        aggs.append(F.max_by(F.col("destination"), named).alias("destination"))
    return events.groupBy("correlation_id", "table").agg(*aggs)


def read_run_log(spark, path: str) -> DataFrame:
    """JSON-lines log files (one event per line) parsed into typed events."""
    return parse_run_events(spark.read.text(path), "value")

