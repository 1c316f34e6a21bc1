"""End-to-end pipeline (the reference's seven steps) as one Spark job graph,
with the sinks SNK1-SNK6.

Cleaned claims and predictions are each read by many downstream tables, so
they are persisted once (MEMORY_AND_DISK: recomputed from lineage if an
executor is lost). Every output is a DataFrame; ``write_outputs`` writes
them to a shared output folder (Parquet by default, CSV/JSON where the
reference wrote CSV/JSON).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcast.operators import clean as cl
from rxcast.operators import evaluate as ev
from rxcast.operators import external as ex
from rxcast.operators import predict as pr
from rxcast.operators import profile as pf
from rxcast.operators import report as rp
from rxcast.session import materialize
from rxcast.sources import dims


def run_pipeline(spark: SparkSession, claims: DataFrame, learned: bool = True,
                 persist: bool = True) -> dict[str, DataFrame]:
    """Steps 1-7: clean, external tables, components, predictions,
    evaluation, feature analysis, executive-summary tables. All six components
    take part; ``learned=False`` replaces the fitted one by 1.0."""
    clean = cl.clean_claims(claims)
    if persist:
        clean = materialize(clean, "clean")
    comps = pr.train_components(clean, learned=learned)
    pred = pr.predict(clean, comps, keep_components=True)
    if persist:
        pred = materialize(pred, "predictions")
        comps.release()
    pred_out = pred.drop(*pr.WEIGHTS)
    drugs = clean.select(F.col("drug_brand_name").alias("drug_name")).filter(F.col("drug_name").isNotNull()).distinct()
    payers = clean.select(F.col("payer_channel_name").alias("payer"))
    out = {
        # step 1 + SNK1
        "cleaned_data": clean,
        "data_overview": rp.data_overview(clean),
        # step 2 (external intelligence over fixed/landed tables) + SNK2, SNK3
        "pricing": dims.pricing(spark),
        "drug_profile": ex.drug_profile(drugs),
        "payer_landscape": ex.payer_landscape(payers),
        "market_intelligence": ex.market_intelligence(spark, drugs, payers),
        # step 4 + SNK4
        "predictions": pred_out,
        "prediction_summary": rp.prediction_summary(pred_out),
        "top_predictions": rp.top_predictions(pred_out),
        # step 5 + SNK5
        "model_metrics": ev.metrics_table(pred_out),
        "metrics_quantity": ev.metrics_quantity(pred_out),
        "multiplier_stats": ev.multiplier_stats(pred_out),
        "improvement": ev.improvement(pred_out),
        "error_distribution": ev.error_distribution(pred_out),
        "error_bins": ev.error_bins(pred_out),
        "error_bias": ev.error_bias(pred_out),
        "worst_decile": ev.worst_decile(pred_out),
        "by_drug": ev.by_drug(pred_out),
        "by_company": ev.by_company(pred_out),
        "by_quartile": ev.by_quartile(pred_out),
        "stability": ev.stability(pred_out),
        "sensitivity": ev.sensitivity(pred_out),
        "contributions": ev.contributions(pred),
        "component_lines": ev.component_lines(pred),
        "performance_report": ev.performance_report(pred_out),
        "paired_t": ev.paired_t_pvalue(pred_out),
        "signed_rank": ev.signed_rank_pvalue(pred_out),
        "heteroscedasticity": ev.heteroscedasticity(pred_out),
        "normality": ev.normality(pred_out),
        # step 6
        "basic_stats": pf.basic_stats(clean),
        "top_categories": pf.top_categories(clean),
        "correlations": pf.strong_correlations(clean),
        "target_correlations": pf.target_correlations(clean),
        "feature_summary": pf.component_features(clean),
        "monthly_quarterly": pf.monthly_quarterly(clean),
        "month_trend": pf.month_trend(clean),
        "hcp_volume": pf.hcp_volume(clean),
        "top_hcps": pf.top_hcps_by_paid(clean),
        "hcp_hhi": pf.hcp_hhi(clean),
        "drug_performance": pf.drug_performance(clean),
        "switching_rate": pf.switching_rate(clean),
        "payer_impact": pf.payer_impact(clean),
        "hcp_drug_pivot": pf.hcp_drug_pivot(clean),
        "top_rejection_reason": pf.top_rejection_reason(clean),
        "daily_rolling": pf.daily_rolling(clean),
        "rolling_summary": pf.rolling_summary(clean),
        "importance": pf.importance(clean),
        "insights": pf.insights(clean),
        # step 7 (SNK6: the executive summary as tables)
        "drug_insight": rp.drug_insight(pred_out),
        "top_hcps_predicted": rp.top_hcps_predicted(pred_out),
    }
    return out


CSV_OUTPUTS = {"cleaned_data", "pricing", "predictions", "model_metrics"}
JSON_OUTPUTS = {"market_intelligence"}


def _concurrently(tasks, parallel: int) -> None:
    """Submit independent Spark jobs from a few driver threads: the outputs
    are small, separate jobs, and running them side by side keeps task slots
    busy instead of paying each job's scheduling latency in turn."""
    if parallel <= 1:
        for t in tasks:
            t()
        return
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


def write_outputs(outputs: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                  parallel: int = 4) -> list[str]:
    """SNK1-SNK6. CSV for the files the reference wrote as CSV (header row),
    JSON for the nested market-intelligence summary, ``fmt`` otherwise."""
    def writer(name, df):
        path = f"{out_dir}/{name}"

        def run():
            w = df.write.mode("overwrite")
            if name in JSON_OUTPUTS:
                w.json(path)
            elif name in CSV_OUTPUTS and fmt == "csv":
                w.option("header", True).csv(path)
            else:
                w.format(fmt).save(path)
        return path, run

    jobs = [writer(n, d) for n, d in outputs.items()]
    _concurrently([r for _p, r in jobs], parallel)
    return [p for p, _r in jobs]


def run_all(outputs: dict[str, DataFrame], parallel: int = 8) -> None:
    """Run every output without writing it (benchmarking)."""
    _concurrently([lambda d=df: d.write.format("noop").mode("overwrite").save() for df in outputs.values()],
                  parallel)
