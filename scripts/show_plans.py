"""Write the physical plans of key registered queries to docs/PLANS.md.

Plans are those that run, on sf0.01, with the session defaults of the library.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY_QUERIES = (
    "silver_conform_lines",
    "silver_cdc_collapse",
    "agg_sales_daily",
    "search_ranked",
    "search_filtered",
    "contract_violations",
)


def main() -> None:
    from terrace.plans import catalog
    from terrace.session import build_session, use_local_folder

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[2]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_folder(spark)
    out = [
        "# Physical plans of key queries",
        "",
        "Generated by `scripts/show_plans.py` (sf0.01). AQE re-plans at run time; these are the initial",
        "physical plans.",
        "",
    ]
    for name in KEY_QUERIES:
        df = catalog.QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", (catalog.QUERIES[name].__doc__ or "").strip(), "", "```", plan.rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()
    print(path)


if __name__ == "__main__":
    main()
