"""Main-text extraction with a wrapper per host, inferred by aligning its pages.

1. Up to ``SAMPLE`` pages per host are chosen by hash: one per hash class, the smallest hash
   in it; and as many by the hash of their longest text, so that copies of one text under many
   urls count once. The choice is a combined minimum, so a host with a third of all pages
   costs its reducer a few rows.
2. Each host's sample is grouped by layout and each group aligned into a union-free expression
   (``html_wrappers``). It tells template texts from slots and labels the slots of the article:
   article and main elements, roles and class words are evidence for the labels, and where
   there is none, or the slots outside speak against it, the element whose slots carry the content.
3. Every page is read whole and its article extracted under the wrapper of its layout, or by
   its own structure where no sampled layout is found on it. Hosts are joined by a
   runtime-sized join, and nothing else is shuffled.

Defined cases. NULL or empty html: empty text. NULL or malformed url: the host ''. NULL
page_id: carried. A host with one page: its own structure decides. Truncated pages, unclosed
tags, unknown references: read as far as they go; the reference stays as it is written.
Repeated rows: each extracted. Empty table: empty result.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from dataclasses import asdict

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import staged
from terrace.llm.html_wrappers import Model, article, expression, model_of, read

SAMPLE = 8
HIDDEN = r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1\s*>"


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#]*@)?([^/?#:]*)", 1)), F.lit(""))


def _infer_host(rows: pd.DataFrame) -> pd.DataFrame:
    model, wrapper = model_of([read(source) for source in rows.sort_values("hash")["html"]])
    return pd.DataFrame(
        {
            "host": [rows["host"].iloc[0]],
            "n_pages": [len(rows)],
            "wrapper": [expression(wrapper)],
            "model": [json.dumps(asdict(model))],
        }
    )


def wrappers(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """host, n_pages (aligned), wrapper (readable expression) and model (JSON) per host."""
    # Between tags and outside scripts and the like; the longest is mostly a paragraph of the article.
    runs = F.split(F.regexp_replace("html", HIDDEN, ""), "<[^<>]*>")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), F.trim(r).alias("r"))))["r"]
    keyed = pages.select(
        host_of(F.col("url")).alias("host"), F.xxhash64("url", "html").alias("hash"), F.xxhash64(longest).alias("main"), "html"
    )
    slot = lambda c: F.pmod(c, F.lit(sample)).cast("int").alias("slot")
    least = keyed.groupBy("host", slot("hash")).agg(F.min("hash").alias("hash")).select("host", "hash").union(
        keyed.groupBy("host", slot("main")).agg(F.min(F.struct("main", "hash")).alias("m")).select("host", "m.hash")
    ).distinct()
    chosen = keyed.join(least, ["host", "hash"]).groupBy("host", "hash").agg(F.first("html").alias("html"))
    return chosen.groupBy("host").applyInPandas(_infer_host, "host string, n_pages long, wrapper string, model string")


@functools.lru_cache(maxsize=256)
def _model(text: str | None) -> Model:
    return Model(**json.loads(text)) if text else Model({}, "", {})


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            article(read(source.as_py()), _model(model.as_py()))
            for source, model in zip(batch.column(2), batch.column(3), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    models = staged(wrappers(pages, sample).select("host", "model"), "page-wrappers")
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = keyed.join(models, "host", "left").select("page_id", "url", "html", "model")
    kinds = dict(pages.dtypes)
    return rows.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
