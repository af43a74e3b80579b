"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import shared_root

# A word is a run of characters other than the ASCII white space 0x20, 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: one computation, short lineage.

    The folder is below ``spark.checkpoint.dir``, so every executor can read it after the
    writer is lost. Reading with the known schema needs no listing job for the footers.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/terrace/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_task(rows: DataFrame, work: Callable[[list[dict]], Any]) -> Any:
    """``work`` on all ``rows`` inside one task, for bounded tables: only its result reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work([r for b in batches for r in b.to_pylist()])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["result"])

    found = rows.coalesce(1).mapInArrow(run, "result binary").collect()
    return pickle.loads(found[0]["result"]) if found else work([])  # no task runs where there are no partitions


def packed(rows: DataFrame, **derived: Column) -> DataFrame:
    """``rows`` as one struct column ``_row`` beside derived columns.

    Working columns can then never clash with the caller's extra columns; ``unpacked``
    gives the caller's columns back in their order.
    """
    return rows.select(F.struct("*").alias("_row"), *(c.alias(n) for n, c in derived.items()))


def unpacked(df: DataFrame, *more: str) -> DataFrame:
    return df.select("_row.*", *more)
