"""Command line: run one stage against a lake root.

    python -m terrace extract --root <lake> --sf-dir <benchmark dir> --load-id 1
    python -m terrace extract-cdc --root <lake> --sf-dir <benchmark dir> --load-id 1
    python -m terrace silver|silver-cdc|gold|all --root <lake>
    python -m terrace backfill --root <lake> --start 1997-12-01 --end 1997-12-31
    python -m terrace publish --root <lake>
    python -m terrace search --root <lake> --q "red plate" --customer-id 7 --min-total 100 --limit 5
    python -m terrace get --root <lake> --ids 501 502
    python -m terrace inspect|accept|compare --root <lake> --layer gold
    python -m terrace verify --root <lake> --sf-dir <benchmark dir>

``--root`` defaults to a folder under the session's ``spark.checkpoint.dir``.
Prints one JSON line per emitted event.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from terrace.operators import gold
from terrace.plans import stages
from terrace.session import build_session, use_local_folder, work_dir
from terrace.sources import adapters, jdbc
from terrace.specs import SALES_TABLES


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="terrace")
    parser.add_argument("stage", choices=[*stages.STAGES, "backfill", "publish", "search", "get", "inspect", "verify", "accept", "compare"])
    parser.add_argument("--q")
    parser.add_argument("--customer-id", type=int)
    parser.add_argument("--min-total", type=float)
    parser.add_argument("--limit", type=int, default=10)
    parser.add_argument("--ids", type=int, nargs="*", default=[])
    parser.add_argument("--layer", default="gold")
    parser.add_argument("--keys-to", help="verify: write the keys that only one side holds to this folder, as JSON lines")
    parser.add_argument("--root")
    parser.add_argument("--fmt", default="parquet")
    parser.add_argument("--sf-dir", help="benchmark tables used as the source system")
    parser.add_argument("--jdbc-url", help="source database instead of --sf-dir (needs a driver on the classpath)")
    parser.add_argument("--load-id", type=int)
    parser.add_argument("--start", type=dt.date.fromisoformat)
    parser.add_argument("--end", type=dt.date.fromisoformat)
    parser.add_argument("--master")
    args = parser.parse_args(argv)

    spark = build_session(master=args.master)
    try:
        use_local_folder(spark)
        root = args.root or work_dir(spark, "lake", unique=False)
        # Without a database the benchmark tables stand in for it, with their own tie-breakers.
        specs = SALES_TABLES if args.jdbc_url else adapters.SPECS
        feeds = SALES_TABLES if args.jdbc_url else adapters.FEED_SPECS
        ctx = stages.RunContext.start(spark, stages.Layout(root, args.fmt), specs=specs, feed_specs=feeds)
        if args.stage == "search":
            total, rows = stages.serve_search(ctx, args.q, args.customer_id, args.min_total, args.limit)
            print(json.dumps({"total": total, "results": [json.loads(r["doc"]) for r in rows.collect()]}))
            return 0
        if args.stage == "get":
            for r in stages.serve_get(ctx, args.ids).collect():
                print(json.dumps({"id": r["doc_id"], "found": r["found"], "doc": json.loads(r["doc"]) if r["doc"] else None}))
            return 0
        if args.stage == "inspect":
            print(json.dumps(stages.inspection(ctx, args.layer), default=str))
            return 0
        if args.stage == "verify":
            sources = adapters.landing_sources(spark, args.sf_dir, None) if args.sf_dir else None
            if args.keys_to:
                if sources is None:
                    parser.error("verify --keys-to needs --sf-dir")
                stages.missing_keys(ctx, sources).write.mode("errorifexists").json(args.keys_to)
                return 0
            for r in stages.verify(ctx, sources).collect():
                print(json.dumps(r.asDict()))
            return 0
        if args.stage in ("accept", "compare"):
            if args.stage == "accept":
                stages.accept_baseline(ctx, args.layer)
                return 0
            for r in stages.compare_baseline(ctx, args.layer).collect():
                print(json.dumps(r.asDict()))
            return 0
        if args.stage == "publish":
            events = [e for mart in gold.MARTS for e in stages.publish_documents(ctx, mart)]
            stages.record_run(ctx, events)
        elif args.stage == "backfill":
            if not (args.start and args.end):
                parser.error("backfill needs --start and --end")
            events = stages.backfill_gold(ctx, args.start, args.end)
            stages.record_run(ctx, events)
        elif args.stage in ("extract", "extract-cdc"):
            if not ((args.sf_dir or args.jdbc_url) and args.load_id is not None):
                parser.error(f"{args.stage} needs --load-id and --sf-dir or --jdbc-url")
            if args.stage == "extract":
                sources = (
                    jdbc.sales_sources(spark, args.jdbc_url, specs) if args.jdbc_url
                    else adapters.landing_sources(spark, args.sf_dir, None)
                )
                events = stages.run(ctx, "extract", sources=sources, load_id=args.load_id)
            else:
                tables = (
                    {s.name: jdbc.read_change_table(spark, args.jdbc_url, f"{s.source_schema}_{s.source_table}") for s in feeds}
                    if args.jdbc_url else {feeds[0].name: adapters.change_table(spark, args.sf_dir)}
                )
                events = stages.run(ctx, "extract-cdc", change_tables=tables, load_id=args.load_id)
        else:
            events = stages.run(ctx, args.stage)
        for e in events:
            print(json.dumps(e, default=str))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
