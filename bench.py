"""Benchmark: headline queries and the full pipeline at $BENCH_SF_DIR on
local[$BENCH_CPUS]. Prints one JSON line.

Each query is run to completion with the ``noop`` sink (full computation,
no collection to the driver), paying for its own inputs (shared caches are
dropped between queries). Before timing, the JVM is warmed up by one
pipeline run on the smallest scale factor (a different dataset).
``pipeline`` is the reference's end-to-end run (clean -> features -> six
multipliers, the fitted one among them -> predictions -> evaluation with all
tests -> feature analysis -> summary tables) with shared intermediates
persisted; ``pipeline_five_factor`` leaves the fit out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["clean_claims", "predictions", "predictions_five_factor", "mult_temporal", "hcp_rolling", "rolling_rows", "hcp_temporal", "metrics_sales",
            "signed_rank", "basic_stats", "feature_summary", "importance", "hcp_drug_pivot", "drug_profile",
            "html_rows"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from rxcast.plans.pipeline import run_all, run_pipeline
    from rxcast.plans.queries import QUERIES, release_shared
    from rxcast.session import build_session
    from rxcast.sources.claims import claims_from_star

    spark = build_session(f"local[{cpus}]", max(cpus, 8))
    names = sys.argv[1:] or HEADLINE
    times = {}
    # JVM warm-up (JIT of the generated code paths), not timed: one pipeline
    # run over the smallest scale factor, a different dataset than the timed one.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        run_all(run_pipeline(spark, claims_from_star(spark, warm)))
        release_shared()
        spark.catalog.clearCache()
    for n in names:
        release_shared()  # each query pays for its own inputs
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    release_shared()
    t0 = time.perf_counter()
    outs = run_pipeline(spark, claims_from_star(spark, sf_dir))
    run_all(outs)
    times["pipeline"] = round(time.perf_counter() - t0, 3)
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    run_all(run_pipeline(spark, claims_from_star(spark, sf_dir), learned=False))
    times["pipeline_five_factor"] = round(time.perf_counter() - t0, 3)
    spark.catalog.clearCache()
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "pipeline_wall_time", "value": times["pipeline"], "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus,
                      "query_total": round(sum(v for k, v in times.items() if not k.startswith("pipeline")), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
