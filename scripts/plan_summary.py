"""Summarise the executed physical plans of registered queries: shuffles,
join strategies, aggregate kinds, windows and what reaches each parquet scan.

usage: python scripts/plan_summary.py [sf_dir] [query ...]  (markdown on stdout)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
        "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "HashAggregate",
        "ObjectHashAggregate", "SortAggregate", "Window", "InMemoryTableScan", "TakeOrderedAndProject"]
DEFAULT = ["claims_view", "predictions_build", "hcp_rolling", "metrics_sales", "signed_rank", "basic_stats",
           "feature_summary", "drug_profile", "html_rows"]


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # run once so AQE's final plan exists
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    try:
        plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    except Exception:  # noqa: BLE001
        pass
    return plan.toString()


def main():
    from rxcast.plans.queries import QUERIES, release_shared
    from rxcast.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = build_session("local[8]", 8)
    print(f"# Executed plans at {sf} (local[8], AQE final plans)\n")
    from rxcast.operators.clean import clean_claims
    from rxcast.operators.predict import predict
    from rxcast.plans.queries import clean
    from rxcast.sources.claims import claims_from_star
    builds = {  # the plans that fill the shared tables
        "claims_view": lambda: clean_claims(claims_from_star(spark, sf)),
        "predictions_build": lambda: predict(clean(spark, sf)),
    }
    for n in names:
        release_shared()
        df = builds[n]() if n in builds else QUERIES[n](spark, sf)
        text = final_plan(df)
        final = text.split("+- == Initial Plan ==")[0]
        counts = {k: len(re.findall(re.escape(k), final)) for k in KEYS}
        print(f"## {n}\n")
        print(", ".join(f"{k}: {v}" for k, v in counts.items() if v))
        scans = re.findall(r"FileScan parquet [^\n]*", final)
        for s in sorted(set(scans)):
            loc = re.search(r"Location: [^\[]*\[([^\],]*)", s)
            path = loc.group(1) if loc else ""
            m = re.search(r"/([a-z]+)\.parquet", path)
            table = m.group(1) if m else ("shared table: " + path.rstrip("/").split("/")[-1].split("-")[0]
                                          if "rxcast-tables" in path else "?")
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", s)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", s)
            print(f"\n- scan `{table}`: pushed {pushed.group(1) if pushed else '[]'}; "
                  f"reads {schema.group(1) if schema else '?'}")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
