"""Model evaluation over the predictions table (EV1-EV19, ST1-ST4,
PRJ13/14/20-22, WIN5-WIN8).

Global statistics are single aggregates (partial + final, no one-task
window). Where a row must be compared with a global statistic (mean, IQR
bounds, 90th percentile) the one-row aggregate is attached with a broadcast
join: its size is one row by construction.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxcast.functions.exprs import nan_to_null, normal_quantile
from rxcast.functions.pvalues import normal_pvalue, t_pvalue
from rxcast.functions.quantiles import exact_quantiles
from rxcast.operators.ordered import positions, value_pieces
from rxcast.operators.predict import WEIGHTS

A, P = "Sales_from_db", "Predicted_sales"
NOISE_KEY = ("hcp_id", "Drug_generic_name", "Drug_name")
EPS = 2.220446049250313e-16  # scikit-learn's MAPE floor for |y|

ERROR_EDGES = [0, 5, 10, 20, 50, 100, math.inf]
ERROR_LABELS = ["<5%", "5-10%", "10-20%", "20-50%", "50-100%", ">100%"]
QUARTILE_LABELS = ["Q1 (Low)", "Q2", "Q3", "Q4 (High)"]


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate to every row (JN11)."""
    return df.join(F.broadcast(one_row), how="inner", on=F.lit(True))


def finite_pairs(pred: DataFrame, a: str = A, p: str = P) -> DataFrame:
    """FLT3: drop pairs with a null/NaN/inf on either side."""
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) < F.lit(math.inf))
    return pred.filter(ok(a) & ok(p))


def error_columns(pred: DataFrame) -> DataFrame:
    """PRJ14: absolute error, percentage error (null when actual = 0) and
    direction, as in ``analyze_prediction_errors``."""
    err = F.col(P) - F.col(A)
    return pred.withColumns({
        "Absolute_Error": F.abs(err),
        "Percentage_Error": F.try_divide(F.abs(err), F.col(A)) * 100,
        "Error_Direction": F.signum(err),
    })


def _r2(sse: Column, sst: Column) -> Column:
    """scikit-learn r2_score with force_finite: constant truth -> 1 if perfect else 0."""
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst)


# ---------------------------------------------------------------- EV1-EV3
def metrics_sales(pred: DataFrame) -> DataFrame:
    d = finite_pairs(pred)
    mean_a = d.agg(F.avg(A).alias("_ma"))
    x = attach(d, mean_a)
    e = F.col(P) - F.col(A)
    return x.agg(
        F.avg(F.abs(e)).alias("MAE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        (F.avg(F.abs(e) / F.greatest(F.abs(F.col(A)), F.lit(EPS))) * 100).alias("MAPE"),
        _r2(F.sum(e * e), F.sum((F.col(A) - F.col("_ma")) ** 2)).alias("R2"),
        (F.avg(F.when(F.signum(F.col(P) - F.col("_ma")) == F.signum(F.col(A) - F.col("_ma")), 1.0)
               .otherwise(0.0)) * 100).alias("Direction_Accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def metrics_quantity(pred: DataFrame) -> DataFrame:
    q, pq = "Quantity_from_DB", "Predicted_quantity"
    d = pred.filter(F.col(q).isNotNull() & F.col(pq).isNotNull())
    x = attach(d, d.agg(F.avg(q).alias("_mq")))
    e = (F.col(pq) - F.col(q)).cast("double")
    return x.agg(F.avg(F.abs(e)).alias("qty_MAE"), F.sqrt(F.avg(e * e)).alias("qty_RMSE"),
                 _r2(F.sum(e * e), F.sum((F.col(q) - F.col("_mq")) ** 2)).alias("qty_R2"))


def metrics_table(pred: DataFrame) -> DataFrame:
    """SNK5: the metrics as (Metric, Value) rows (``model_metrics_*.csv``)."""
    m = metrics_sales(pred)
    names = ["MAE", "RMSE", "MAPE", "R2", "Direction_Accuracy"]
    return m.unpivot([], names, "Metric", "Value")


# ---------------------------------------------------------------- EV4-EV6
def multiplier_stats(pred: DataFrame) -> DataFrame:
    m = F.col("Combined_multiplier")
    q = attach(pred.agg(F.avg(m).alias("mean"), F.stddev_samp(m).alias("std"), F.min(m).alias("min"), F.max(m).alias("max")),
               exact_quantiles(pred, {"_q": m}, [.25, .5, .75]))
    q = q.select("mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q75"), "max")
    iqr = F.col("q75") - F.col("q25")
    out = attach(pred.select("Combined_multiplier"), q).groupBy(*q.columns).agg(
        F.count_if((m < F.col("q25") - 1.5 * iqr) | (m > F.col("q75") + 1.5 * iqr)).alias("outliers"),
        F.count(F.lit(1)).alias("_n"))
    return out.withColumn("outlier_pct", F.col("outliers") / F.col("_n") * 100).drop("_n")


def improvement(pred: DataFrame) -> DataFrame:
    x = attach(pred, pred.agg(F.avg(A).alias("_ma")))
    out = x.agg(F.avg(F.abs(F.col(A) - F.col("_ma"))).alias("baseline_mae"),
                F.avg(F.abs(F.col(A) - F.col(P))).alias("ensemble_mae"))
    return out.withColumn("improvement_pct", (1 - F.try_divide(F.col("ensemble_mae"), F.col("baseline_mae"))) * 100)


# ---------------------------------------------------------------- EV7-EV10
def error_distribution(pred: DataFrame) -> DataFrame:
    e = error_columns(pred)
    one = e.agg(F.avg("Absolute_Error").alias("mean_abs_error"), F.max("Absolute_Error").alias("max_abs_error"),
                F.avg("Percentage_Error").alias("mean_pct_error"))
    return attach(one, exact_quantiles(e, {"_q": F.col("Absolute_Error")}, [.5])).select(
        "mean_abs_error", F.col("_q")[0].alias("median_abs_error"), "max_abs_error", "mean_pct_error")


def error_bin_expr(pct: Column) -> tuple[Column, Column]:
    """PRJ13: right-closed bins; exact zero / null errors fall in no bin."""
    lab = order = None
    for i, (lo, hi, name) in enumerate(zip(ERROR_EDGES[:-1], ERROR_EDGES[1:], ERROR_LABELS)):
        cond = (pct > lo) & (pct <= F.lit(hi))
        lab = F.when(cond, F.lit(name)) if lab is None else lab.when(cond, F.lit(name))
        order = F.when(cond, F.lit(i)) if order is None else order.when(cond, F.lit(i))
    return lab, order


def error_bins(pred: DataFrame) -> DataFrame:
    """EV8: count and share (of all predictions) per error bin, every bin
    present, in bin order. The 6-bin list is a fixed dimension."""
    e = error_columns(pred)
    lab, order = error_bin_expr(F.col("Percentage_Error"))
    counts = e.groupBy(order.alias("bin_order")).agg(F.count(F.lit(1)).alias("count"))
    total = pred.agg(F.count(F.lit(1)).alias("_n"))
    bins = pred.sparkSession.createDataFrame(list(enumerate(ERROR_LABELS)), "bin_order int, bin string")
    out = attach(bins.join(counts, "bin_order", "left"), total)
    return out.select("bin_order", "bin", F.coalesce("count", F.lit(0)).alias("count"),
                      (F.coalesce("count", F.lit(0)) / F.col("_n") * 100).alias("pct"))


def error_bias(pred: DataFrame) -> DataFrame:
    """EV9 + EV18 bias flag."""
    d = error_columns(pred).select(F.col("Error_Direction").alias("d"))
    d = d.withColumn("d", F.when(F.isnan("d"), None).otherwise(F.col("d")))
    out = d.agg((F.avg(F.when(F.col("d") > 0, 1.0).otherwise(0.0)) * 100).alias("over_pct"),
                (F.avg(F.when(F.col("d") < 0, 1.0).otherwise(0.0)) * 100).alias("under_pct"),
                (F.avg(F.when(F.col("d") == 0, 1.0).otherwise(0.0)) * 100).alias("exact_pct"),
                F.avg("d").alias("bias"))
    return out.withColumn("bias_flag", F.when(F.abs("bias") > 0.2, F.when(F.col("bias") > 0, "over-prediction")
                                              .otherwise("under-prediction")).otherwise("none"))


def worst_decile(pred: DataFrame) -> DataFrame:
    """EV10 / FLT4: cases above the 90th percentile of percentage error."""
    e = error_columns(pred)
    thr = exact_quantiles(e, {"_q": F.col("Percentage_Error")}, [.9]).select(F.col("_q")[0].alias("threshold"))
    hi = attach(e, thr).filter(F.col("Percentage_Error") > F.col("threshold"))
    by_hcp = hi.groupBy("hcp_id").agg(F.sum("Absolute_Error").alias("_ae"))
    top_hcp = by_hcp.agg(F.max_by("hcp_id", F.struct(F.col("_ae"), F.col("hcp_id"))).alias("problem_hcp"))
    base = hi.agg(F.count(F.lit(1)).alias("n_cases"), F.avg("Percentage_Error").alias("mean_pct_error"),
                  F.mode("Drug_name", True).alias("problem_drug"))
    return attach(attach(thr, base), top_hcp)


# ---------------------------------------------------------------- EV11-EV13
def by_drug(pred: DataFrame) -> DataFrame:
    e = F.abs(F.col(P) - F.col(A))
    return (pred.filter(F.col("Drug_name").isNotNull()).groupBy("Drug_name")
            .agg(F.avg(e).alias("MAE"),
                 (F.avg(e / F.greatest(F.abs(F.col(A)), F.lit(EPS))) * 100).alias("MAPE")))


def by_company(pred: DataFrame) -> DataFrame:
    """EV12: r2_score per company (SST about the company's own mean)."""
    p = pred.filter(F.col("Company").isNotNull())
    means = p.groupBy("Company").agg(F.avg(A).alias("_ma"))
    x = p.join(means, "Company")
    e = F.col(P) - F.col(A)
    return x.groupBy("Company").agg(_r2(F.sum(e * e), F.sum((F.col(A) - F.col("_ma")) ** 2)).alias("R2"))


def quartile_expr(x: Column) -> Column:
    """WIN7: ``pd.qcut(q=4)`` with interpolated edges (right-closed, lowest
    included); tied edges leave a bucket empty instead of raising."""
    return (F.when(x <= F.col("_q1"), QUARTILE_LABELS[0]).when(x <= F.col("_q2"), QUARTILE_LABELS[1])
             .when(x <= F.col("_q3"), QUARTILE_LABELS[2]).when(x.isNotNull(), QUARTILE_LABELS[3]))


def by_quartile(pred: DataFrame) -> DataFrame:
    edges = exact_quantiles(pred, {"_q": F.col(A)}, [.25, .5, .75]).select(
        *[F.col("_q")[i - 1].alias(f"_q{i}") for i in (1, 2, 3)])
    x = attach(pred, edges).withColumn("Sales_Quartile", quartile_expr(F.col(A)))
    e = F.abs(F.col(P) - F.col(A))
    return (x.filter(F.col("Sales_Quartile").isNotNull()).groupBy("Sales_Quartile")
            .agg((F.avg(e / F.greatest(F.abs(F.col(A)), F.lit(EPS))) * 100).alias("MAPE"),
                 F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- EV14-EV16
def stability(pred: DataFrame) -> DataFrame:
    out = pred.agg(F.try_divide(F.stddev_samp(P), F.avg(P)).alias("cv_predictions"),
                   F.try_divide(F.stddev_samp(A), F.avg(A)).alias("cv_actual"))
    ratio = F.try_divide(F.col("cv_predictions"), F.col("cv_actual"))
    return out.withColumn("ratio", ratio).withColumn(
        "verdict", F.when(F.col("ratio") > 1.2, "overfitting").when(F.col("ratio") < 0.8, "underfitting")
                    .otherwise("appropriate"))


def sensitivity(pred: DataFrame, levels=(0.05, 0.10, 0.20), seed: int = 42) -> DataFrame:
    """EV15: multiply predictions by N(1, sigma) noise; MAE change in %.
    The noise comes from a hash of the row's key and the level (Box-Muller on
    two 32-bit fractions of an MD5), so it doesn't depend on the partitioning.
    One row per noise level: the 3-row level list is joined with broadcast."""
    lv = pred.sparkSession.createDataFrame([(float(x), f"{round(x * 100):d}") for x in levels], "noise double, _name string")
    key = [c for c in NOISE_KEY if c in pred.columns]
    x = pred.select(A, P, *key).join(F.broadcast(lv), how="inner", on=F.lit(True))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), "_name", *[F.coalesce(c, F.lit("")) for c in key]))
    part = lambda i: (F.conv(F.substring(digest, i, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    normal = F.sqrt(F.log(part(1)) * -2.0) * F.cos(part(9) * (2 * math.pi))
    x = x.withColumn("_noisy", F.col(P) * (F.lit(1.0) + F.col("noise") * normal))
    out = x.groupBy("noise").agg(F.avg(F.abs(F.col(A) - F.col(P))).alias("original_mae"),
                                 F.avg(F.abs(F.col(A) - F.col("_noisy"))).alias("perturbed_mae"))
    return out.withColumn("mae_change_pct", (F.col("perturbed_mae") - F.col("original_mae"))
                          / F.col("original_mae") * 100)


# ---------------------------------------------------------------- EV17, WIN5/6
COMPONENTS = [(name, column, WEIGHTS[column]) for name, column in (
    ("Temporal Patterns", "temporal_multiplier"), ("Market Dynamics", "market_multiplier"), ("HCP Specialization", "affinity"),
    ("Transaction Patterns", "transaction_multiplier"), ("Rolling Trends", "rolling_multiplier"), ("Payer Mix", "payer_multiplier"))]


def contributions(components: DataFrame) -> DataFrame:
    """EV17 re-aimed: share of each component in the mean |w * ln(m)| of the
    combined multiplier; ranked with cumulative share (WIN5, WIN6). The
    window runs over the six component rows only."""
    agg = components.agg(*[F.avg(F.abs(F.lit(w) * F.log(F.coalesce(F.col(c), F.lit(1.0))))).alias(name)
                           for name, c, w in COMPONENTS])
    rows = agg.unpivot([], [n for n, _c, _w in COMPONENTS], "component", "impact")
    total = F.sum("impact").over(Window.partitionBy())
    ranked = rows.withColumn("share", F.try_divide(F.col("impact"), total))
    w = Window.orderBy(F.col("share").desc(), F.col("component"))
    return ranked.select("component", "impact", "share", F.row_number().over(w).alias("rank"),
                         F.sum("share").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_share"))


def component_lines(components: DataFrame) -> DataFrame:
    """EV19: the strongest and the weakest component of the report."""
    ranked = contributions(components)
    ends = ranked.agg(*[f("rank").alias(n) for f, n in ((F.min, "_first"), (F.max, "_last"))])
    line = F.when(F.col("rank") == F.col("_first"), "strongest").when(F.col("rank") == F.col("_last"), "weakest")
    return attach(ranked, ends).select(line.alias("section"), F.col("component").alias("item"), "share").where(F.col("section").isNotNull())


# ---------------------------------------------------------------- EV18/19, PRJ20/21
def grade_expr(r2: Column, mape: Column) -> tuple[Column, Column]:
    """PRJ20: A-F grade and assessment from R2 and MAPE."""
    g = (F.when((r2 > 0.8) & (mape < 10), "A").when((r2 > 0.6) & (mape < 20), "B")
          .when((r2 > 0.4) & (mape < 30), "C").when((r2 > 0.2) & (mape < 50), "D").otherwise("F"))
    a = (F.when(g == "A", "Excellent").when(g == "B", "Good").when(g == "C", "Satisfactory")
          .when(g == "D", "Needs Improvement").otherwise("Poor"))
    return g, a


def summary_grade_expr(r2: Column, mape: Column) -> Column:
    """PRJ21: executive-summary grade (three bands, else Needs Improvement)."""
    return (F.when((r2 > 0.8) & (mape < 10), "Excellent (A)").when((r2 > 0.6) & (mape < 20), "Good (B)")
             .when((r2 > 0.4) & (mape < 30), "Satisfactory (C)").otherwise("Needs Improvement"))


def performance_report(pred: DataFrame) -> DataFrame:
    """EV18 + EV19: grade, then one row per strength / improvement / risk flag."""
    m = metrics_sales(pred)
    bias = error_bias(pred).select("bias")
    cells = len(pred.columns)
    miss = pred.agg((F.sum(F.lit(0) + sum(F.col(c).isNull().cast("int") for c in pred.columns))
                     / (F.count(F.lit(1)) * cells) * 100).alias("missing_pct"))
    x = attach(attach(m, bias), miss)
    g, a = grade_expr(F.col("R2"), F.col("MAPE"))
    def item(section, text):
        return F.struct(F.lit(section).alias("section"), (F.lit(text) if isinstance(text, str) else text).alias("item"))

    flags = F.array(
        F.when(F.col("R2") > 0.6, item("strength", "r2_above_0.6")),
        F.when(F.col("Direction_Accuracy") > 70, item("strength", "direction_above_70")),
        F.when(F.col("MAPE") > 20, item("improvement", "mape_above_20")),
        F.when(F.abs(F.col("bias")) > 0.2, item(
            "improvement", F.when(F.col("bias") > 0, "bias_over")
            .otherwise("bias_under"))),
        F.when(F.col("MAPE") > 30, item("risk", "high: mape_above_30")),
        F.when(F.col("missing_pct") > 5, item("risk", "medium: missing_above_5")),
    )
    x = x.select(g.alias("grade"), a.alias("assessment"), summary_grade_expr(F.col("R2"), F.col("MAPE"))
                 .alias("summary_grade"), "missing_pct",
                 F.filter(flags, lambda s: s.isNotNull()).alias("_f"))
    x = x.withColumn("_f", F.when(F.size(F.filter("_f", lambda s: s["section"] == "risk")) == 0,
                                  F.array_union("_f", F.array(F.struct(F.lit("risk").alias("section"), F.lit(
                                      "low: none_found").alias("item")))))
                     .otherwise(F.col("_f")))
    return x.select("grade", "assessment", "summary_grade", "missing_pct",
                    F.inline("_f"))


# ---------------------------------------------------------------- ST1-ST4
def paired_t(pred: DataFrame) -> DataFrame:
    """ST1 statistic (scipy ttest_rel(actual, predicted)): d = actual - pred."""
    d = F.col(A) - F.col(P)
    out = pred.agg(F.count(d).alias("n"), F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("sd_diff"))
    return out.withColumn("t_stat", F.try_divide(F.col("mean_diff"), F.col("sd_diff") / F.sqrt(F.col("n"))))


def paired_t_pvalue(pred: DataFrame) -> DataFrame:
    t = paired_t(pred)
    return t.withColumn("p_value", t_pvalue(F.col("t_stat"), (F.col("n") - 1).cast("double")))


#: Pairs up to which the exact law of the signed-rank sum is computed.
EXACT_PAIRS = 50


def exact_signed_rank(n: Column, w: Column) -> Column:
    """Two-sided p-value of the smaller rank sum ``w`` of n untied pairs: of the
    2^n equally likely sets of signs, twice the share with a sum of at most w.
    Sets are counted by sum, one rank after the other: rank k moves the counts
    of all sums by k. Null above ``EXACT_PAIRS`` pairs (counts stay exact below
    2^53) and without pairs."""
    zeros = lambda k: F.array_repeat(F.lit(0.0), k)
    ways = F.aggregate(F.sequence(F.lit(1), F.least(n, F.lit(EXACT_PAIRS)).cast("int")), F.array(F.lit(1.0)),
                       lambda c, k: F.zip_with(F.concat(c, zeros(k)), F.concat(zeros(k), c), lambda x, y: x + y))
    below = F.aggregate(F.slice(ways, F.lit(1), F.floor(w).cast("int") + 1), F.lit(0.0), lambda x, y: x + y)
    return F.when((n >= 1) & (n <= EXACT_PAIRS), F.least(F.lit(1.0), 2 * below / F.pow(F.lit(2.0), n)))


def signed_rank(pred: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """ST2: Wilcoxon signed-rank (zero differences dropped, average ranks for
    ties, W = min(W+, W-)) with the tie-corrected normal z, over all rows or
    one test per group of ``by``; with ``by`` also ``p_exact``, the exact law's
    p-value (null above ``EXACT_PAIRS`` pairs or with ties).

    Ranks come from the per-distinct-|d| counts and a prefix sum over the
    sorted distinct values (WIN8), cut into pieces whose number follows the
    values."""
    d = (F.col(A) - F.col(P))
    nz = pred.select(*by, d.alias("d")).filter(F.col("d").isNotNull() & (F.col("d") != 0))
    per = nz.groupBy(*by, F.abs("d").alias("ad")).agg(
        F.count(F.lit(1)).alias("t"), F.count_if(F.col("d") > 0).alias("npos"))
    ranked = positions(value_pieces(per, "ad"), list(by), [F.col("ad")], F.col("_piece"), {"t": F.col("t")}, pos_col="_p")
    # average rank of a tie group = (#smaller) + (t + 1) / 2
    avg_rank = F.col("_cum_t") - F.col("t") + (F.col("t") + 1) / 2.0
    out = ranked.groupBy(*by).agg(
        F.sum("t").alias("n"),
        F.sum(F.col("npos") * avg_rank).alias("w_plus"),
        F.sum((F.col("t") - F.col("npos")) * avg_rank).alias("w_minus"),
        F.sum(F.col("t") ** 3 - F.col("t")).alias("_tie"))
    n = F.col("n").cast("double")
    mean = n * (n + 1) / 4
    se = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("_tie") / 48)
    w = F.least("w_plus", "w_minus")
    exact = [F.when(F.col("_tie") == 0, exact_signed_rank(F.col("n"), w)).alias("p_exact")] if by else []
    return out.select(*by, "n", "w_plus", "w_minus", w.alias("w_stat"),
                      F.try_divide(w - mean, se).alias("z"), *exact)


def signed_rank_by_hcp(pred: DataFrame) -> DataFrame:
    """ST2 for every HCP over its drugs: few pairs, so the exact law counts."""
    return signed_rank(pred, ("hcp_id",))


def signed_rank_pvalue(pred: DataFrame) -> DataFrame:
    s = signed_rank(pred)
    return s.withColumn("p_value", normal_pvalue(F.col("z")))


def heteroscedasticity(pred: DataFrame) -> DataFrame:
    """ST3: corr(actual, squared residual), flag above 0.3."""
    r2 = (F.col(P) - F.col(A)) ** 2
    return pred.agg(F.corr(F.col(A), r2).alias("correlation")).withColumn(
        "heteroscedastic", F.abs("correlation") > 0.3)


def normality(pred: DataFrame) -> DataFrame:
    """ST4 re-aimed: Jarque-Bera on all residuals, p = exp(-JB/2)."""
    r = F.col(P) - F.col(A)
    out = pred.agg(F.count(r).alias("n"), F.skewness(r).alias("skew"), F.kurtosis(r).alias("excess_kurtosis"))
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("excess_kurtosis") ** 2 / 4.0)
    return out.withColumn("jb_stat", jb).withColumn("p_value", F.exp(-F.col("jb_stat") / 2.0))



def normal_scores(pred: DataFrame) -> DataFrame:
    """ST4 by order statistics (Shapiro-Francia): the squared correlation of the
    sorted residuals with the normal quantiles of their positions, (i - 3/8) /
    (n + 1/4), over all rows, and the normal z of ln(1 - W') (Royston's fit).
    Positions come from pieces whose number follows the values; among equal
    residuals their order doesn't matter. Null under five residuals, or if all
    are equal."""
    r = (F.col(P) - F.col(A)).alias("r")
    res = pred.select(r).where(F.col("r").isNotNull() & ~F.isnan("r"))
    per = res.groupBy("r").agg(F.count(F.lit(1)).alias("t"))
    placed = positions(value_pieces(per, "r"), [], [F.col("r")], F.col("_piece"), {"t": F.col("t")}, pos_col="_p")
    each = placed.select("r", F.explode(F.sequence(F.col("_cum_t") - F.col("t") + 1, F.col("_cum_t"))).alias("i"))
    total = per.agg(F.sum("t").alias("n"))
    scored = attach(each, total).select("n", "r", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)).alias("m"))
    out = scored.agg(F.count("r").alias("n"), F.corr("r", "m").alias("_c"))
    n, w = F.col("n").cast("double"), nan_to_null(F.col("_c") * F.col("_c"))
    u = F.log(n)
    v = F.log(u)
    z = (F.log(1 - w) - (-1.2725 + 1.0521 * (v - u))) / (1.0308 - 0.26758 * (v + 2 / u))
    enough = F.col("n") >= 5
    return out.select("n", F.when(enough, w).alias("w_stat"), F.when(enough, z).alias("z"))
