"""Write docs/PLANS.md: the final (adaptive) physical plan of the headline
read queries, run at a given scale, with a per-plan summary of exchanges,
pushed filters and scanned columns.

    python tools/plan_report.py [/root/testdata/sf0.1] [--no-broadcast]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402

NAMES = ["silver_lineitem", "revenue_by_order_date", "top_customers", "yearly_revenue", "top_10_customers", "top_days_1996",
         "stored_top_days_1996", "qc_null_keys", "row_counts"]


def final_plan(df) -> str:
    """Run the DataFrame's own physical plan (rows stay in the JVM), so the
    adaptive plan is finalized, and return it."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    text = plan.toString()
    return text.split("+- == Initial Plan ==")[0].replace("+- == Final Plan ==\n", "")


def summary(text: str) -> str:
    exchanges = re.findall(r"Exchange (\w+)", text)
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", text)))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)))
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", text)
    return (f"- exchanges: {len(exchanges)} ({', '.join(exchanges) or 'none'})\n"
            f"- joins: {', '.join(joins) or 'none'}\n"
            f"- pushed filters: {'; '.join(p for p in pushed if p) or 'none'}\n"
            f"- read schemas: {'; '.join(schemas)}\n")


def main() -> None:
    args = sys.argv[1:]
    sf_dir = next((a for a in args if os.path.isdir(a)), "/root/testdata/sf0.1")
    no_bc = "--no-broadcast" in args
    spark = build_session("local[8]", 16)
    if no_bc:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = [f"# Physical plans at {os.path.basename(sf_dir)}"
           f"{' (broadcast joins disabled: the shape at scale)' if no_bc else ''}\n",
           "Generated by `tools/plan_report.py`; final adaptive plans after execution.\n"]
    for name in NAMES:
        text = final_plan(QUERIES[name](spark, sf_dir))
        out.append(f"## {name}\n\n{summary(text)}\n```\n{text.strip()}\n```\n")
    path = os.path.join(ROOT, "docs", "PLANS_SCALE.md" if no_bc else "PLANS.md")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
