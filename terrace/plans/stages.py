"""Stage runners: wire the pure operators to lake paths.

Layout under a lake root (a shared folder)::

    bronze/sales/<table>/_load_id=<id>/     append-only landing, one partition per load
    bronze/sales_cdc/<table>/_load_id=<id>/ change feed
    silver/sales/<table>/                   one row per key (overwrite)
    silver/sales/_rejected/<table>/         landed rows without a key
    silver/sales_cdc/<table>/               current state with deletes applied
    gold/sales/<table>/                     facts (year/month partitions) and daily roll-ups
    serving/sales/<name>/                   documents, filter columns, postings
    _state/watermarks/<table>/              one row per load
    _runs/, _logs/                          table metrics and JSON-lines events of each run

Every stage reads one set of paths and writes another, so no job overwrites a path
its own plan reads. Gold writes the fact once and builds the daily roll-up from the
written fact instead of caching it.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import cdc, drift, gold, ingest, key_sketch, quality, runlog, silver
from terrace.sources import lake
from terrace.specs import CHANGE_LSN, INITIAL_LSN, LOAD_ID, SALES_TABLES, TableSpec

log = logging.getLogger("terrace")

STAGES = ("extract", "extract-cdc", "silver", "silver-cdc", "gold", "all")


@dataclass(frozen=True)
class Layout:
    root: str
    fmt: str = "parquet"
    dataset: str = "sales"

    def path(self, layer: str, table: str, feed: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{feed or self.dataset}/{table}"

    @property
    def cdc(self) -> str:
        return f"{self.dataset}_cdc"

    @property
    def runs(self) -> str:
        return f"{self.root.rstrip('/')}/_runs"

    @property
    def logs(self) -> str:
        return f"{self.root.rstrip('/')}/_logs"

    def rejected(self, table: str) -> str:
        return self.path("silver", f"_rejected/{table}")

    def serving(self, name: str) -> str:
        """Published documents and the postings built from them."""
        return f"{self.root.rstrip('/')}/serving/{self.dataset}/{name}"

    def state(self, table: str) -> str:
        """Per-load watermark state of a Bronze table (one row per load)."""
        return f"{self.root.rstrip('/')}/_state/watermarks/{table}"

    def profile(self, table: str) -> str:
        """The accepted distribution profile of a table's columns."""
        return f"{self.root.rstrip('/')}/_profiles/{table}"

    def baseline(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_baseline/{name}"


@dataclass
class RunContext:
    spark: SparkSession
    layout: Layout
    correlation_id: str
    specs: Sequence[TableSpec] = SALES_TABLES
    feed_specs: Sequence[TableSpec] = SALES_TABLES
    rules: Mapping[str, Sequence[quality.Rule]] = field(default_factory=dict)

    @classmethod
    def start(cls, spark: SparkSession, layout: Layout, correlation_id: str | None = None, **kwargs) -> RunContext:
        return cls(spark, layout, correlation_id or uuid.uuid4().hex[:12], **kwargs)

    def emit(self, msg: str, **extra: object) -> dict[str, object]:
        """One structured event (the same shape the run-log parser reads)."""
        event = {
            "ts": dt.datetime.now(dt.UTC).isoformat(),
            "level": "INFO",
            "logger": "terrace.stages",
            "msg": msg,
            "correlation_id": self.correlation_id,
            **extra,
        }
        log.info(json.dumps(event, default=str))
        return event

    def read(self, layer: str, table: str, feed: str | None = None) -> DataFrame:
        return lake.read_table(self.spark, self.layout.path(layer, table, feed), self.layout.fmt)

    def read_bucketed(self, layer: str, table: str) -> DataFrame:
        return lake.read_bucketed(self.spark, self.layout.path(layer, table), self.layout.fmt)


def concurrently(fn, items: Sequence) -> list:
    """Run ``fn`` over independent items as concurrent Spark jobs (one driver thread
    each), results in input order. Independent tables then share the cluster
    instead of queueing behind each other."""
    items = list(items)
    if len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(fn, items))


# -- extract (SRC1, SNK1, ING1-5) ------------------------------------------------------------


def _landed(ctx: RunContext, path: str) -> set[int]:
    """Load ids with data in a landing table, from its folder names (no job)."""
    return {int(v) for v in lake.partition_values(ctx.spark, path, LOAD_ID)}


def _state(ctx: RunContext, table: str, path: str, load_id: int) -> DataFrame | None:
    """The per-load state, or None when a load that landed has no row in it."""
    state = lake.try_read_table(ctx.spark, ctx.layout.state(table))
    return state if ingest.state_covers(state, _landed(ctx, path), load_id) else None


def _record_state(ctx: RunContext, table: str, load_id: int, top: object) -> None:
    record = ctx.spark.createDataFrame([(top, load_id)], f"{ingest.STATE_MAX_CURSOR} string, {LOAD_ID} long")
    lake.overwrite_partitions(record, ctx.layout.state(table), (LOAD_ID,))


def extract(
    ctx: RunContext, sources: Mapping[str, DataFrame], load_id: int, on_null_cursor: str = "include"
) -> list[dict[str, object]]:
    """Incremental load of every source into its Bronze table.

    Source column names are normalised to snake_case first. A retried load with the
    same ``load_id`` replaces its own partition with the same rows. The event counts rows
    and rows without a cursor.
    """

    def load(spec: TableSpec) -> dict[str, object]:
        source = ingest.normalize_names(sources[spec.name])
        path = ctx.layout.path("bronze", spec.name)
        bronze = lake.try_read_table(ctx.spark, path, ctx.layout.fmt)
        state = _state(ctx, spec.name, path, load_id) if bronze is not None else None
        batch = ingest.incremental_batch(source, bronze, spec, load_id, state, on_null_cursor)
        m = lake.overwrite_partitions(
            batch, path, (LOAD_ID,), ctx.layout.fmt, name=spec.name,
            observe={
                ingest.STATE_MAX_CURSOR: ingest.max_cursor(spec),
                "null_cursors": F.count_if(F.col(spec.cursor).isNull()),
            },
            spread=False,  # all rows go to this load's partition
            bucket_by=spec.primary_key,
        )
        # The load's max cursor, observed during the write, is the next watermark.
        _record_state(ctx, spec.name, load_id, m[ingest.STATE_MAX_CURSOR])
        return ctx.emit("load landed", **m, load_id=load_id)

    return concurrently(load, [s for s in ctx.specs if s.name in sources])


def extract_cdc(ctx: RunContext, change_tables: Mapping[str, DataFrame], load_id: int) -> list[dict[str, object]]:
    """Append each change table's new changes (after the landed max LSN) to Bronze."""

    def load(spec: TableSpec) -> dict[str, object]:
        path = ctx.layout.path("bronze", spec.name, ctx.layout.cdc)
        name = f"{spec.name}_cdc"
        landed = ingest.prior_loads(lake.try_read_table(ctx.spark, path, ctx.layout.fmt), load_id)
        last = INITIAL_LSN
        if landed is not None:
            # Fixed-width hex: string order is LSN order. The recorded per-load maxima
            # answer without scanning the feed; the feed itself is the fallback.
            state = _state(ctx, name, path, load_id)
            source = ingest.prior_loads(state, load_id) if state is not None else landed
            column = ingest.STATE_MAX_CURSOR if state is not None else CHANGE_LSN
            last = source.agg(F.max(column).alias("m")).first()["m"] or INITIAL_LSN
        feed = cdc.project_change_table(change_tables[spec.name], last)
        feed = feed.withColumn(LOAD_ID, F.lit(load_id).cast("long"))
        m = lake.overwrite_partitions(
            feed, path, (LOAD_ID,), ctx.layout.fmt, name=spec.name,
            observe={ingest.STATE_MAX_CURSOR: F.max(CHANGE_LSN)}, spread=False,
        )
        _record_state(ctx, name, load_id, m[ingest.STATE_MAX_CURSOR])
        return ctx.emit("changes landed", **m, last_lsn=last, load_id=load_id)

    return concurrently(load, [s for s in ctx.feed_specs if s.name in change_tables])


# -- Silver (WIN1-3, SNK3) ------------------------------------------------------------------------


def build_silver(ctx: RunContext) -> list[dict[str, object]]:
    """One current row per key; rows without a key go to the table's rejects.

    A table with quality rules (EXT2) must pass them before it replaces the last one, and the
    newest load of a table with an accepted profile must not have drifted from it.
    """

    def conform_one(spec: TableSpec) -> dict[str, object]:
        raw = lake.try_read_table(ctx.spark, ctx.layout.path("bronze", spec.name), ctx.layout.fmt)
        if raw is None:
            return ctx.emit("nothing landed, table left out", table=spec.name)
        _refuse_drift(ctx, spec, raw)
        raw = lake.read_bucketed(ctx.spark, ctx.layout.path("bronze", spec.name), ctx.layout.fmt)
        bad = lake.write_table(
            silver.null_keys(raw, spec.primary_key), ctx.layout.rejected(spec.name), ctx.layout.fmt, name=f"{spec.name}_rejected"
        )
        out = silver.conform(raw, spec.primary_key, spec.cursor, spec.tiebreakers, on_null_key="drop")
        if rules := ctx.rules.get(spec.name):
            quality.enforce(quality.quality_report(out, rules))
        m = lake.write_table(
            out, ctx.layout.path("silver", spec.name), ctx.layout.fmt, name=spec.name, bucket_by=gold.JOINED_ON.get(spec.name, ())
        )
        return ctx.emit("table conformed", **m, rejected=bad["rows"])

    return concurrently(conform_one, ctx.specs)


def accept_profile(ctx: RunContext, table: str, columns: Sequence[str]) -> None:
    """Keep the distributions of what has landed of a table as those that new loads must match."""
    landed = ctx.read("bronze", table)
    drift.profile(landed, columns).write.mode("overwrite").parquet(ctx.layout.profile(table))


def _refuse_drift(ctx: RunContext, spec: TableSpec, raw: DataFrame) -> None:
    accepted = lake.try_read_table(ctx.spark, ctx.layout.profile(spec.name))
    if accepted is None:
        return
    columns = [r["column"] for r in accepted.select("column").collect()]  # a row per column
    newest = raw.agg(F.max(LOAD_ID)).first()[0]
    drift.enforce(accepted, drift.profile(raw.filter(F.col(LOAD_ID) == newest), columns))


def build_silver_cdc(ctx: RunContext) -> list[dict[str, object]]:
    """Collapse every captured change feed; a table without captured changes is skipped."""

    def collapse_one(spec: TableSpec) -> dict[str, object]:
        feed = lake.try_read_table(ctx.spark, ctx.layout.path("bronze", spec.name, ctx.layout.cdc), ctx.layout.fmt)
        if feed is None:
            return ctx.emit("no changes landed, table left out", table=spec.name)
        out = cdc.collapse_changes(silver.drop_bookkeeping(feed), spec.primary_key, spec.tiebreakers)
        m = lake.write_table(out, ctx.layout.path("silver", spec.name, ctx.layout.cdc), ctx.layout.fmt, name=spec.name)
        return ctx.emit("changes collapsed", **m)

    return concurrently(collapse_one, ctx.feed_specs)


# -- Gold (JOI1-2, AGG1-3, SNK4) ------------------------------------------------------------------


def _fact(ctx: RunContext, mart: gold.Mart, spread: bool = False) -> DataFrame:
    return gold.fact(mart, ctx.read_bucketed("silver", mart.headers), ctx.read_bucketed("silver", mart.lines), spread)


def _roll_up(ctx: RunContext, mart: gold.Mart) -> dict[str, object]:
    """The daily roll-up, from the fact as it was written."""
    rows = gold.daily(mart, ctx.read("gold", mart.fact))
    m = lake.write_table(rows, ctx.layout.path("gold", mart.daily), ctx.layout.fmt, name=mart.daily)
    return ctx.emit("mart written", **m)


# Buckets of lines from this size on are written to their months as they lie, a file a month each.
MONTHS_BYTES = 16 << 20


def build_gold(ctx: RunContext) -> list[dict[str, object]]:
    """Ordered and billed marts; the two are independent and run concurrently."""

    def build(mart: gold.Mart) -> list[dict[str, object]]:
        large = lake.bucket_size(ctx.spark, ctx.layout.path("silver", mart.lines), (mart.key,)) >= MONTHS_BYTES
        m = lake.write_table(
            _fact(ctx, mart, spread=not large), ctx.layout.path("gold", mart.fact), ctx.layout.fmt,
            partition_by=mart.months, name=mart.fact, spread=False,  # by the fact, before its wide columns
        )
        return [ctx.emit("mart written", **m), _roll_up(ctx, mart)]

    return [e for events in concurrently(build, gold.MARTS) for e in events]


# -- EXT1: date-range backfill ----------------------------------------------------------------------


def month_bounds(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """Widen [start, end] to whole months: a month partition is replaced whole, so a
    partial month would drop the rows outside the range."""
    first = start.replace(day=1)
    nxt = (end.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return first, nxt - dt.timedelta(days=1)


def in_months(rows: DataFrame, mart: gold.Mart, start: dt.date, end: dt.date) -> DataFrame:
    """Rows of the whole months covering [start, end], with the year/month predicates
    spelled out so the read side prunes partitions too."""
    lo, hi = month_bounds(start, end)
    year, month = mart.months
    number = F.col(year) * 100 + F.col(month)
    return rows.filter(
        (F.col(mart.day) >= F.lit(lo))
        & (F.col(mart.day) <= F.lit(hi))
        & number.between(lo.year * 100 + lo.month, hi.year * 100 + hi.month)
    )


def replace_months(ctx: RunContext, mart: gold.Mart, rows: DataFrame, start: dt.date, end: dt.date) -> dict[str, object]:
    """Replace the mart's whole months covering [start, end] by ``rows`` of those months.

    Dynamic overwrite replaces the months that still have rows; a written month that has
    none any more is overwritten by an empty partition. Which months those are follows from
    folder names and one distinct over the new partitions' columns (a row per month).
    """
    lo, hi = month_bounds(start, end)
    path, (year, month) = ctx.layout.path("gold", mart.fact), mart.months
    part = in_months(rows, mart, start, end)
    m = lake.overwrite_partitions(part, path, mart.months, ctx.layout.fmt, name=mart.fact)
    new = {(r[0], r[1]) for r in part.select(year, month).distinct().collect()}
    written = {
        (int(y), int(n))
        for y in lake.partition_values(ctx.spark, path, year)
        for n in lake.partition_values(ctx.spark, f"{path}/{year}={y}", month)
    }
    emptied = sorted(p for p in written - new if (lo.year, lo.month) <= p <= (hi.year, hi.month))
    nothing = rows.drop(year, month).limit(0)
    for y, n in emptied:
        lake.write_table(nothing, f"{path}/{year}={y}/{month}={n}", ctx.layout.fmt)
    return {**m, "months_emptied": len(emptied)}


def backfill_gold(ctx: RunContext, start: dt.date, end: dt.date) -> list[dict[str, object]]:
    """Recompute both facts for the months covering [start, end] from Silver and rebuild the
    roll-ups from the written facts; other months are not touched."""

    def rebuild(mart: gold.Mart) -> list[dict[str, object]]:
        m = replace_months(ctx, mart, _fact(ctx, mart), start, end)
        return [ctx.emit("months replaced", **m, start=str(start), end=str(end)), _roll_up(ctx, mart)]

    return [e for events in concurrently(rebuild, gold.MARTS) for e in events]


# -- QLT1: verification of a written lake -------------------------------------------------------------


def verify(ctx: RunContext, sources: Mapping[str, DataFrame] | None) -> DataFrame:
    """Landed rows of every Bronze table against its source (table, source, bronze, status);
    without a source that can be reached, the landed counts only."""
    landed = {}
    for spec in ctx.specs:
        found = lake.try_read_table(ctx.spark, ctx.layout.path("bronze", spec.name), ctx.layout.fmt)
        if found is not None:
            landed[spec.name] = found
    if not landed:
        raise ValueError(f"nothing landed under {ctx.layout.root}")
    counts = quality.table_counts(landed)
    return quality.reconcile(counts, quality.table_counts(sources) if sources else None)


def missing_keys(ctx: RunContext, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of every table that only its source or only Bronze holds (table, key as JSON, state);
    a NULL key part is absent from the JSON. A table that never landed lacks all its keys."""
    found = None
    for spec in ctx.specs:
        if spec.name not in sources:
            continue
        keys = list(spec.primary_key)
        source = ingest.normalize_names(sources[spec.name]).select(*keys)
        landed = lake.try_read_table(ctx.spark, ctx.layout.path("bronze", spec.name), ctx.layout.fmt)
        rows = key_sketch.differences(source, source.limit(0) if landed is None else landed, keys)
        rows = rows.select(F.lit(spec.name).alias("table"), F.to_json(F.struct(*keys)).alias("key"), "state")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        raise ValueError("no source of a registered table is given")
    return found


# -- QLT3: regression against an accepted snapshot ----------------------------------------------------


def accept_baseline(ctx: RunContext, layer: str = "gold") -> None:
    """Keep the layer's profile and fingerprints as what later runs are compared with."""
    _snapshot(ctx, layer).write.mode("overwrite").parquet(ctx.layout.baseline(layer))


def _snapshot(ctx: RunContext, layer: str) -> DataFrame:
    """table, rows, cols, hash_sum of every written table of a layer."""
    parts = []
    for name in LAYER_TABLES[layer]:
        rows = lake.try_read_table(ctx.spark, ctx.layout.path(layer, name), ctx.layout.fmt)
        if rows is not None:
            kept = silver.drop_bookkeeping(rows)
            parts.append(quality.fingerprint(kept).select(
                F.lit(name).alias("table"), "rows", F.lit(len(kept.columns)).cast("long").alias("cols"), "hash_sum"
            ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_baseline(ctx: RunContext, layer: str = "gold") -> DataFrame:
    """(table, change) against the accepted snapshot; no rows when nothing changed."""
    before = lake.read_table(ctx.spark, ctx.layout.baseline(layer))
    return quality.snapshot_diff(before, _snapshot(ctx, layer), ("table",))


# -- QLT2: layer inspection --------------------------------------------------------------------------

# The tables of each layer and the key a sample is ordered by.
LAYER_TABLES: dict[str, dict[str, tuple[str, ...]]] = {
    "bronze": {s.name: s.primary_key for s in SALES_TABLES},
    "silver": {s.name: s.primary_key for s in SALES_TABLES},
    "gold": {name: key for m in gold.MARTS for name, key in ((m.fact, (m.line_key,)), (m.daily, (m.day,)))},
}


def inspect(ctx: RunContext, layer: str) -> tuple[DataFrame, DataFrame]:
    """Profile and samples of every written table of a layer (missing tables skipped):
    rows, columns, partition columns from the folder layout; 3 samples of 6 columns."""
    tables = {}
    for name, key in LAYER_TABLES[layer].items():
        path = ctx.layout.path(layer, name)
        df = lake.try_read_table(ctx.spark, path, ctx.layout.fmt)
        if df is not None:
            parts = lake.partition_columns(ctx.spark, path)
            tables[name] = quality.ProfiledTable(df, key, parts)
    if not tables:
        raise ValueError(f"nothing written in layer {layer!r} under {ctx.layout.root}")
    return quality.profile(tables), quality.samples(tables)


def inspection(ctx: RunContext, layer: str) -> dict[str, object]:
    """The layer, its format and one entry per table (a handful of rows), for printing."""
    profile, samples = inspect(ctx, layer)
    tables = {r["table"]: {**r.asDict(), "samples": []} for r in profile.collect()}
    for r in samples.collect():
        tables[r["table"]]["samples"].append(json.loads(r["sample"]))
    return {"layer": layer, "format": ctx.layout.fmt, "tables": list(tables.values())}


# -- SNK6 / SEA2-5: publish documents and the search index, serve requests ----------------------------


def _documents(mart: gold.Mart):
    from terrace.operators import contracts

    return {"fact_sales": contracts.FACT_SALES_DOC, "fact_invoices": contracts.FACT_INVOICES_DOC}[mart.fact]


def publish_documents(ctx: RunContext, mart: gold.Mart = gold.ORDERED) -> list[dict[str, object]]:
    """Publish a written fact: documents checked while they are written, filter columns and
    postings for search, all rebuilt and clustered by what they are looked up by."""
    from terrace.operators import contracts, search

    contract, rows = _documents(mart), ctx.read("gold", mart.fact)
    place = lambda name: ctx.layout.serving(f"{mart.fact}/{name}")
    m = contracts.publish(rows, contract, place("documents"))
    docs = rows.select(F.col(mart.line_key).alias("doc_id"), "description", "customer_id", "line_total")
    clustered = docs.drop("description").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    lake.write_table(clustered, place("filters"), name="filters")
    search.write_postings(docs, "doc_id", "description", place("postings"))
    return [ctx.emit("documents published", **{**m, "table": f"{mart.fact}_documents"})]


def serve_search(
    ctx: RunContext,
    q: str | None = None,
    customer_id: int | None = None,
    min_total: float | None = None,
    limit: int = 10,
    mart: gold.Mart = gold.ORDERED,
) -> tuple[int, DataFrame]:
    """One search request against the published tables: ``(total, results)``; the
    results carry the published document JSON."""
    from terrace.operators import search

    place = lambda name: ctx.layout.serving(f"{mart.fact}/{name}")
    index = search.read_postings(ctx.spark, place("postings"))
    filters = lake.read_table(ctx.spark, place("filters"))
    total, top = search.search_one(
        filters, "doc_id", q=q,
        equals={"customer_id": customer_id}, at_least={"line_total": min_total},
        limit=limit, index=index,
    )
    hits = {r["doc_id"]: r["score"] for r in top.select("doc_id", "score").collect()}  # at most ``limit``
    published = lake.read_table(ctx.spark, place("documents")).filter(F.col("doc_id").isin(list(hits)))
    scores = ctx.spark.createDataFrame(list(hits.items()), "doc_id long, score double")
    results = published.join(F.broadcast(scores), "doc_id")  # at most ``limit`` rows
    return total, results.select("doc_id", "score", "doc").orderBy(F.col("score").desc(), F.col("doc_id"))


def serve_get(ctx: RunContext, ids: Sequence[int], mart: gold.Mart = gold.ORDERED) -> DataFrame:
    """Get documents by id; ids that are not published come back with found = false.

    The ids are literals, so the scan skips the row groups that cannot hold them."""
    from terrace.operators import search

    wanted = sorted({int(i) for i in ids})
    req = ctx.spark.createDataFrame([(i,) for i in wanted], "doc_id long")
    docs = lake.read_table(ctx.spark, ctx.layout.serving(f"{mart.fact}/documents"))
    return search.get_by_ids(req, docs.filter(F.col("doc_id").isin(wanted)), "doc_id")


# -- EXT5 / OPS1: run trace ---------------------------------------------------------------------------


def record_run(ctx: RunContext, events: Sequence[dict[str, object]]) -> None:
    """Append the run's events to ``_logs`` as JSON lines and its metrics to ``_runs``."""
    if not events:
        return
    lines = ctx.spark.createDataFrame([(json.dumps(e, default=str),) for e in events], "value string")
    lines.coalesce(1).write.mode("append").text(ctx.layout.logs)
    rows = [
        (ctx.correlation_id, str(e["msg"]), e.get("table") or e.get("stage"), e.get("rows"), e.get("seconds"), str(e["ts"]))
        for e in events
        if "rows" in e or "seconds" in e
    ]
    schema = "correlation_id string, msg string, name string, rows long, seconds double, ts string"
    ctx.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(ctx.layout.runs)


def run_log(ctx: RunContext) -> DataFrame:
    """Every event of every recorded run, parsed."""
    return runlog.read_run_log(ctx.spark, ctx.layout.logs)


def run(ctx: RunContext, stage: str, **kwargs) -> list[dict[str, object]]:
    """Run one stage (or ``all``: silver then gold) and record it. Returns the emitted events."""
    steps = {
        "extract": lambda: extract(ctx, **kwargs),
        "extract-cdc": lambda: extract_cdc(ctx, **kwargs),
        "silver": lambda: build_silver(ctx),
        "silver-cdc": lambda: build_silver_cdc(ctx),
        "gold": lambda: build_gold(ctx),
        "all": lambda: build_silver(ctx) + build_gold(ctx),
    }
    if stage not in steps:
        raise ValueError(f"unknown stage {stage!r}; choose from {STAGES}")
    t0 = time.time()
    events = steps[stage]()
    events.append(ctx.emit("stage finished", stage=stage, seconds=round(time.time() - t0, 3)))
    record_run(ctx, events)
    return events
