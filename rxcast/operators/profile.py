"""Feature analysis and profiling of the cleaned claims (FA0-FA31, WIN3,
WIN9, TOP3, TOP4, TOP6).

All statistics are aggregates with map-side combine; the only windows run
over already-reduced tables (months, days, categories, six scores). Money
totals are summed as exact decimals so that rounding is reproducible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcast.functions.exprs import kurt_unbiased, skew_unbiased
from rxcast.functions.quantiles import exact_quantiles
from rxcast.operators.evaluate import attach

PAID = "total_paid_amt"
NUMERIC_FEATURES = ["patient_age", "days_supply_val", "total_paid_amt", "patient_to_pay_amt", "awp_unit_price_amt"]
CATEGORICAL_FEATURES = ["drug_brand_name", "payer_channel_name", "transaction_status"]


def money_sum(c) -> Column:
    """Exact sum of a double money column (decimal(38,6)), returned as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(38,6)")).cast("double")


def nan_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


# ------------------------------------------------------------------- FA1
STAT_NAMES = ["Mean", "Std", "Min", "Q1", "Median", "Q3", "Max", "Skew", "Kurtosis"]


def basic_stats(df: DataFrame, features=NUMERIC_FEATURES) -> DataFrame:
    """Nine statistics per numeric feature, one row per statistic (as the
    reference's stats table): one aggregate pass and one for all quantiles,
    then ``stack``."""
    feats = [f for f in features if f in df.columns]
    aggs = []
    for f in feats:
        c = F.col(f).cast("double")
        aggs += [F.avg(c).alias(f"{f}__Mean"), F.stddev_samp(c).alias(f"{f}__Std"), F.min(c).alias(f"{f}__Min"),
                 F.max(c).alias(f"{f}__Max"),
                 skew_unbiased(c).alias(f"{f}__Skew"), kurt_unbiased(c).alias(f"{f}__Kurtosis")]
    one = attach(df.agg(*aggs), exact_quantiles(df, {f"{f}__Q": F.col(f) for f in feats}, [.25, .5, .75]))
    one = one.select("*", *[F.col(f"{f}__Q")[i].alias(f"{f}__{n}") for f in feats
                            for i, n in enumerate(["Q1", "Median", "Q3"])])
    rows = ", ".join(f"'{s}', " + ", ".join(f"`{f}__{s}`" for f in feats) for s in STAT_NAMES)
    return one.selectExpr(f"stack({len(STAT_NAMES)}, {rows}) AS (statistic, {', '.join(feats)})")


def top_categories(df: DataFrame, features=CATEGORICAL_FEATURES, k: int = 5) -> DataFrame:
    """TOP4: top-k value shares per categorical column (non-null denominator):
    one scan for all columns, counts combined before the shuffle, and the
    ranking limited to k rows per task and column before it meets."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
                                        for f in features if f in df.columns]))).where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("feature").agg(F.sum("n").alias("_tot"))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.col("n").desc(), "value"))
    top = counts.withColumn("_r", rank).where(F.col("_r") <= k)
    return top.join(total, "feature").select("feature", "value", "n", (F.col("n") / F.col("_tot")).alias("share"))


# ------------------------------------------------------------- FA2, FA3
def numeric_columns(df: DataFrame) -> list[str]:
    """PRJ16: numeric columns of the frame (``select_dtypes(include=number)``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def co_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, n, gx, gy, cxx, cyy, cxy) for every ordered pair of columns: rows
    where both have a value, their means, and the central sums of squares and
    products over them.

    A task holds one matrix of each (its batches are merged by their means) and
    emits them as rows, tasks x columns^2 in all. Two aggregates over these
    rows, whatever the number of columns, give the pair's means and then the
    sums around them, so nothing cancels."""
    k = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mx, cxx, cxy = (np.zeros((k, k)) for _ in range(4))  # mx[i, j]: mean of i where j is present
        for batch in batches:
            x = np.stack([np.asarray(batch.column(i).to_numpy(zero_copy_only=False), np.float64) for i in range(k)], axis=1)
            ok = ~np.isnan(x)
            m, x = ok.astype(np.float64), np.where(ok, x, 0.0)
            shift = x.sum(0) / np.maximum(m.sum(0), 1)
            x = (x - shift) * m
            count = m.T @ m
            safe = np.maximum(count, 1)
            mean = (x.T @ m) / safe
            sq, prod = (x * x).T @ m - count * mean ** 2, x.T @ x - count * mean * mean.T
            mean = mean + shift[:, None]
            total = n + count
            gap = mean - mx
            part = n * count / np.maximum(total, 1)
            cxx, cxy = cxx + sq + part * gap ** 2, cxy + prod + part * gap * gap.T
            mx, n = mx + gap * count / np.maximum(total, 1), total
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i.astype(np.int32), j.astype(np.int32), n.ravel().astype(np.int64), mx.ravel(), mx.T.ravel(),
                                                                cxx.ravel(), cxx.T.ravel(), cxy.ravel())], ["i", "j", "n", "mx", "my", "cxx", "cyy", "cxy"])

    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(cols)]) \
        .mapInArrow(run, "i int, j int, n long, mx double, my double, cxx double, cyy double, cxy double").where("n > 0")
    means = parts.groupBy("i", "j").agg((F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("gx"), (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("gy"))
    n, x, y = F.col("n"), F.col("mx") - F.col("gx"), F.col("my") - F.col("gy")
    return parts.join(means, ["i", "j"]).groupBy("i", "j").agg(F.sum("n").alias("n"), F.first("gx").alias("gx"), F.first("gy").alias("gy"), F.sum(F.col("cxx") + n * x * x).alias("cxx"),
                                                              F.sum(F.col("cyy") + n * y * y).alias("cyy"), F.sum(F.col("cxy") + n * x * y).alias("cxy"))


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """FA2, PRJ16: the full matrix of pairwise-complete Pearson correlations of
    all numeric columns as rows (feature_1, feature_2, n, correlation); null
    where a pair has fewer than two rows or a column is constant."""
    cols = cols or numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "feature_1 string, feature_2 string, n long, correlation double")
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, name string")
    every = names.select("i", F.col("name").alias("feature_1")).crossJoin(names.select(F.col("i").alias("j"), F.col("name").alias("feature_2")))  # column names only
    # squares about a mean that rounding alone may leave are none: the column is constant there
    spread = lambda c, mean: F.col(c) > F.col("n") * F.pow(1e-14 * F.col(mean), F.lit(2))
    r = F.when(spread("cxx", "gx") & spread("cyy", "gy"), F.try_divide(F.col("cxy"), F.sqrt(F.col("cxx")) * F.sqrt(F.col("cyy"))))
    return every.join(co_moments(df, cols), ["i", "j"], "left").select(
        "feature_1", "feature_2", F.coalesce("n", F.lit(0)).alias("n"), F.when((F.col("n") > 1) & r.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r))).alias("correlation"))


def correlation_pairs(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The pairs above the diagonal of the correlation matrix, in the columns' order."""
    cols = cols or numeric_columns(df)
    place = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return correlation_matrix(df, cols).where(place[F.col("feature_1")] < place[F.col("feature_2")]).drop("n")


def strong_correlations(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """FA2: pairs with |r| > threshold, strongest first."""
    return (correlation_pairs(df).filter(F.abs("correlation") > threshold)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.abs("correlation").desc(), "feature_1",
                                                                   "feature_2"))))


def target_correlations(df: DataFrame, target: str = PAID, k: int = 10) -> DataFrame:
    """FA3 + TOP6: correlation of every numeric column with the target,
    descending, top k (the target itself included, r = 1)."""
    cols = numeric_columns(df)
    one = df.agg(*[nan_null(F.corr(F.col(c).cast("double"), F.col(target).cast("double"))).alias(c) for c in cols])
    rows = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = one.selectExpr(f"stack({len(cols)}, {rows}) AS (feature, correlation)")
    return long.orderBy(F.col("correlation").desc_nulls_last(), "feature").limit(k)


# -------------------------------------------------------------- FA13-FA14
def with_calendar(df: DataFrame) -> DataFrame:
    d = F.col("service_date_dd")
    return df.withColumns({"month": F.month(d), "quarter": F.quarter(d), "year": F.year(d),
                           "day_of_week": F.weekday(d)})


def monthly_quarterly(df: DataFrame) -> DataFrame:
    """FA13: mean/sum/count of paid by month and by quarter in one pass
    (GROUPING SETS ((month), (quarter)))."""
    c = with_calendar(df)
    g = c.groupingSets([["month"], ["quarter"]], "month", "quarter").agg(
        F.avg(PAID).alias("mean"), money_sum(PAID).alias("sum"), F.count(PAID).alias("count"))
    return (g.withColumn("level", F.when(F.col("month").isNotNull(), "month").otherwise("quarter"))
            .withColumn("period", F.coalesce("month", "quarter"))
            .filter(F.col("period").isNotNull())
            .select("level", "period", "mean", F.round("sum", 2).alias("sum"), "count"))


def month_trend(df: DataFrame) -> DataFrame:
    """FA14: slope of monthly means over their rank, and direction."""
    m = with_calendar(df).filter(F.col("month").isNotNull()).groupBy("month").agg(F.avg(PAID).alias("_mm"))
    m = m.withColumn("_i", (F.row_number().over(Window.orderBy("month")) - 1).cast("double"))  # <= 12 rows
    out = m.agg(F.regr_slope("_mm", "_i").alias("trend_coef"), F.count(F.lit(1)).alias("n_months"))
    return out.filter(F.col("n_months") > 1).withColumn(
        "direction", F.when(F.col("trend_coef") > 0, "Increasing").otherwise("Decreasing"))


# -------------------------------------------------------------- FA15-FA17, TOP3
def hcp_volume(df: DataFrame, hcp_col: str = "hcp_id") -> DataFrame:
    """FA15: ``groupby(hcp).size().describe()``."""
    v = df.groupBy(hcp_col).agg(F.count(F.lit(1)).cast("double").alias("n"))
    out = v.agg(F.count("n").alias("count"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"),
                F.min("n").alias("min"), F.max("n").alias("max"))
    out = attach(out, exact_quantiles(v, {"_q": F.col("n")}, [.25, .5, .75]))
    return out.select("count", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
                      F.col("_q")[2].alias("q75"), "max")


def top_hcps_by_paid(df: DataFrame, hcp_col: str = "hcp_id", k: int = 10) -> DataFrame:
    """TOP3: top k HCPs by paid amount (distributed take-ordered)."""
    return (df.groupBy(hcp_col).agg(money_sum(PAID).alias("total_paid"))
            .orderBy(F.col("total_paid").desc(), F.col(hcp_col)).limit(k)
            .withColumn("total_paid", F.round("total_paid", 2)))


def hcp_drug_pivot(df: DataFrame, drugs: list[str] | None = None, hcp_col: str = "hcp_id") -> DataFrame:
    """FA16: HCP x drug paid crosstab. Pass ``drugs`` to skip the distinct
    pass; otherwise Spark collects the (bounded) distinct brand list."""
    d = df.filter(F.col(hcp_col).isNotNull() & F.col("drug_brand_name").isNotNull())
    p = d.groupBy(hcp_col).pivot("drug_brand_name", drugs).agg(money_sum(PAID))
    return p.select(hcp_col, *[F.round(F.col(c), 2).alias(c) for c in p.columns if c != hcp_col])


def brand_dictionary(df: DataFrame) -> DataFrame:
    """FA16 columns as a table: (drug_brand_name, position), positions from 0
    by name. The window runs over one row per brand."""
    brands = df.select("drug_brand_name").where(F.col("drug_brand_name").isNotNull()).distinct()
    return brands.withColumn("position", F.row_number().over(Window.orderBy("drug_brand_name")) - 1)


def hcp_drug_matrix(df: DataFrame, brands: DataFrame, hcp_col: str = "hcp_id") -> DataFrame:
    """FA16 for any number of brands: (hcp, paid), one array per HCP with the
    paid amount at each brand's position in ``brands`` (null: no claim). The
    brands stay a table; nothing is listed by the driver."""
    sums = (df.where(F.col(hcp_col).isNotNull() & F.col("drug_brand_name").isNotNull())
            .groupBy(hcp_col, "drug_brand_name").agg(F.round(money_sum(PAID), 2).alias("paid")))
    found = sums.join(brands, "drug_brand_name").groupBy(hcp_col).agg(
        F.sort_array(F.collect_list(F.struct("position", "paid"))).alias("cells"))  # a cell per brand of the HCP at most
    n = brands.agg((F.max("position") + 1).alias("n"))  # one row
    none = F.lit(None).cast("double")
    runs = F.transform("cells", lambda c, i: F.concat(
        F.array_repeat(none, (c["position"] - F.coalesce(F.get("cells", i - 1)["position"], F.lit(-1)) - 1).cast("int")),
        F.array(c["paid"].cast("double"))))
    tail = F.array_repeat(none, (F.col("n") - 1 - F.element_at("cells", -1)["position"]).cast("int"))
    return found.join(F.broadcast(n), how="inner", on=F.lit(True)).select(hcp_col, F.concat(F.flatten(runs), tail).alias("paid"))


def hcp_hhi(df: DataFrame, hcp_col: str = "hcp_id") -> DataFrame:
    """FA17: drug concentration (HHI) of each HCP with positive sales,
    two-level aggregate (HCP x drug, then HCP)."""
    d = df.filter(F.col(hcp_col).isNotNull() & F.col("drug_brand_name").isNotNull())
    per = d.groupBy(hcp_col, "drug_brand_name").agg(F.sum(PAID).alias("_s"))
    tot = per.groupBy(hcp_col).agg(F.sum("_s").alias("_t"))
    return (per.join(tot, hcp_col).filter(F.col("_t") > 0)
            .groupBy(hcp_col).agg(F.sum((F.col("_s") / F.col("_t")) ** 2).alias("HHI")))


# -------------------------------------------------------------- FA18-FA23
def drug_performance(df: DataFrame) -> DataFrame:
    """FA18: per-drug sales, volume, reach and share of all claims."""
    tot = df.agg(F.count(F.lit(1)).alias("_n"))
    per = df.filter(F.col("drug_brand_name").isNotNull()).groupBy(F.col("drug_brand_name").alias("Drug")).agg(
        money_sum(PAID).alias("Total_Sales"), F.avg(PAID).alias("Avg_Sale"), F.count(F.lit(1)).alias("Volume"),
        (F.count_distinct("prescriber_npi_nm") if "prescriber_npi_nm" in df.columns else F.lit(0)).alias("Unique_HCPs"),
        F.count_distinct("patient_id").alias("Unique_Patients"), F.avg("days_supply_val").alias("Avg_Days_Supply"))
    return attach(per, tot).select(
        "Drug", F.round("Total_Sales", 2).alias("Total_Sales"), "Avg_Sale", "Volume", "Unique_HCPs",
        "Unique_Patients", "Avg_Days_Supply", (F.col("Volume") / F.col("_n") * 100).alias("Market_Share"))


def switching_rate(df: DataFrame) -> DataFrame:
    """FA19: share of patients (in %) with more than one distinct drug."""
    p = df.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.count_distinct("drug_brand_name").alias("_k"))
    return p.agg((F.avg(F.when(F.col("_k") > 1, 1.0).otherwise(0.0)) * 100).alias("switch_rate"),
                 F.count(F.lit(1)).alias("patients"))


def payer_impact(df: DataFrame) -> DataFrame:
    """FA20-FA23: channel share, payment mean/median/sum, rejection rate and
    copay mean/median per payer channel."""
    tot = df.agg(F.count("payer_channel_name").alias("_n"))
    named = df.filter(F.col("payer_channel_name").isNotNull())
    medians = exact_quantiles(named, {"_paid": F.col(PAID), "_copay": F.col("patient_to_pay_amt")}, [.5], ("payer_channel_name",))
    ch = named.groupBy("payer_channel_name").agg(
        F.count(F.lit(1)).alias("claims"), F.avg(PAID).alias("mean_paid"),
        money_sum(PAID).alias("sum_paid"),
        (F.avg(F.when(F.col("reject_reason_1_cd").isNotNull(), 1.0).otherwise(0.0)) * 100).alias("rejection_rate"),
        F.avg("patient_to_pay_amt").alias("copay_mean"))
    ch = ch.join(medians, "payer_channel_name", "left").withColumns(
        {"median_paid": F.col("_paid")[0], "copay_median": F.col("_copay")[0]})
    return attach(ch, tot).select("payer_channel_name", "claims", (F.col("claims") / F.col("_n") * 100).alias("share_pct"),
                                  "mean_paid", "median_paid", F.round("sum_paid", 2).alias("sum_paid"),
                                  "rejection_rate", "copay_mean", "copay_median")


# -------------------------------------------------------------- FA4-FA12, FA0
def top_value(value: str, count: str = "_k") -> Column:
    """``value_counts().index[0]``: most frequent value, ties -> smallest."""
    return F.min_by(F.col(value), F.struct((F.lit(0) - F.col(count)).alias("_neg"), F.col(value)))


def component_features(df: DataFrame) -> DataFrame:
    """FA0 with FA4-FA12: the per-component feature summary as
    (component, feature, value, text) rows; every statistic is one small
    aggregate, attached to a single row."""
    c = with_calendar(df)
    n_all = c.agg(F.count(F.lit(1)).alias("n_all"), money_sum(PAID).alias("paid_all"),
                  F.avg("patient_age").alias("age_mean"), F.stddev_samp("patient_age").alias("age_std"),
                  F.avg(F.when(F.col("reject_reason_1_cd").isNotNull(), 1.0).otherwise(0.0)).alias("reject_rate"))

    # Every single-key grouping below comes from ONE grouping-sets aggregate:
    # one scan and one (tiny, partially aggregated) shuffle instead of eight.
    keys = ["patient_gender", "drug_brand_name", "year", "clinical_service_line", "prescriber_npi_nm",
            "payer_channel_name", "month", "day_of_week"]
    sets = c.groupingSets([[k] for k in keys], *keys).agg(
        F.count(F.lit(1)).alias("_k"), F.avg(PAID).alias("_m"), money_sum(PAID).alias("_s"),
        F.grouping_id().alias("_gid"))
    full = (1 << len(keys)) - 1

    def by(key):
        bit = 1 << (len(keys) - 1 - keys.index(key))
        # The selection references an aggregate output (_k), so Catalyst keeps it
        # above the aggregate: all consumers share one aggregate (reused exchange)
        # instead of each pushing its own filter into a separate scan.
        pick = F.when(F.col("_k") > 0, (F.col("_gid") == full - bit) & F.col(key).isNotNull()).otherwise(False)
        return sets.filter(pick).select(key, "_k", "_m", "_s")

    def cv_of_means(key):
        return by(key).agg(F.try_divide(F.stddev_samp("_m"), F.avg("_m")).alias(f"cv_{key}"))

    gender = (by("patient_gender").agg(F.try_divide(F.max("_k"), F.sum("_k")).alias("_top"))
              .select((1 - F.abs(F.col("_top") - 0.5) * 2).alias("gender_balance")))
    market = by("drug_brand_name").agg(F.sum("_k").alias("_t"), F.sum(F.col("_k") * F.col("_k")).alias("_sq"),
                                       F.max("_k").alias("_mx")).select(
        (F.col("_sq") / (F.col("_t") * F.col("_t"))).alias("market_hhi"),
        (F.col("_mx") / F.col("_t") * 100).alias("leader_share_pct"))
    growth = by("year").agg(F.count(F.lit(1)).alias("_ny"), F.min_by("_s", "year").alias("_f"),
                            F.max_by("_s", "year").alias("_l")).select(
        F.when(F.col("_ny") > 1, (F.try_divide(F.col("_l"), F.col("_f")) - 1) * 100).alias("yoy_growth_pct"))
    service = by("clinical_service_line").agg(
        top_value("clinical_service_line").alias("top_service_line"),
        F.max("_k").alias("top_service_line_claims"), F.count(F.lit(1)).alias("service_line_diversity"))
    hcps = by("prescriber_npi_nm").agg(F.avg("_k").alias("avg_claims_per_hcp"), F.max("_k").alias("_top_hcp"))
    status = c.agg(F.try_divide(F.count(F.when(F.col("transaction_status") == "Dispensed", 1)),
                                F.count("transaction_status")).alias("approval_rate"))
    payer = by("payer_channel_name").withColumnRenamed("_s", "_ps")
    pay = payer.agg(F.min_by("payer_channel_name", F.struct((F.lit(0) - F.col("_ps")).alias("_neg"),
                                                            F.col("payer_channel_name"))).alias("top_payer"),
                    F.max("_ps").alias("_top_ps"))
    entropy = payer.agg(F.sum("_k").alias("_pt2"), F.sum(F.col("_k") * F.log("_k")).alias("_klogk")).select(
        (F.log("_pt2") - F.col("_klogk") / F.col("_pt2")).alias("payer_entropy"))
    one = n_all
    for t in (gender, market, growth, service, hcps, status, entropy, cv_of_means("month"),
              cv_of_means("day_of_week"), pay.select("top_payer", "_top_ps")):
        one = attach(one, t)
    rows = [
        ("temporal_demographic", "age_distribution_impact", "1 - age_std / age_mean", None),
        ("temporal_demographic", "gender_balance", "gender_balance", None),
        ("temporal_demographic", "seasonal_patterns", "coalesce(cv_month, 0.1D)", None),
        ("temporal_demographic", "day_of_week_effect", "coalesce(cv_day_of_week, 0.05D)", None),
        ("market_dynamics", "market_hhi", "market_hhi", None),
        ("market_dynamics", "market_leader_share_pct", "leader_share_pct", None),
        ("market_dynamics", "yoy_growth_pct", "yoy_growth_pct", None),
        ("hcp_specialization", "top_service_line", "CAST(top_service_line_claims AS DOUBLE)", "top_service_line"),
        ("hcp_specialization", "service_line_diversity", "CAST(service_line_diversity AS DOUBLE)", None),
        ("hcp_specialization", "avg_claims_per_hcp", "avg_claims_per_hcp", None),
        ("hcp_specialization", "top_hcp_share_pct", "_top_hcp / n_all * 100", None),
        ("transaction", "approval_rate_pct", "approval_rate * 100", None),
        ("transaction", "overall_rejection_rate_pct", "reject_rate * 100", None),
        ("payer", "payer_diversity_score", "payer_entropy", None),
        ("payer", "top_payer_share_pct", "_top_ps / paid_all * 100", "top_payer"),
    ]
    stack = ", ".join(f"'{a}', '{b}', CAST({v} AS DOUBLE), CAST({t or 'NULL'} AS STRING)" for a, b, v, t in rows)
    return one.selectExpr(f"stack({len(rows)}, {stack}) AS (component, feature, value, text)")


def top_rejection_reason(df: DataFrame) -> DataFrame:
    """FA11 detail: most frequent rejection description with its count
    ('Unknown' when the claims carry no description column)."""
    if "reject_reason_1_desc" not in df.columns:
        return df.agg(F.count_if(F.col("reject_reason_1_cd").isNotNull()).alias("_r")).select(
            F.lit("Unknown").alias("reason"), F.lit(None).cast("long").alias("count"))
    return (df.filter(F.col("reject_reason_1_desc").isNotNull()).groupBy(F.col("reject_reason_1_desc").alias("reason"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "reason").limit(1))


# -------------------------------------------------------------- WIN3
def daily_rolling(df: DataFrame, window: int = 30) -> DataFrame:
    """WIN3: daily paid totals with a 30-row rolling mean. The global window
    runs over one row per calendar day (bounded by the date range)."""
    day = F.to_date("service_date_dd").cast(df.schema["service_date_dd"].dataType)  # a time of day doesn't make a day
    d = (df.filter(F.col("service_date_dd").isNotNull()).groupBy(day.alias("service_date"))
         .agg(F.sum(F.col(PAID).cast("decimal(38,6)")).alias("_s")))
    w = Window.orderBy("service_date")
    frame = w.rowsBetween(-(window - 1), 0)
    # exact windowed sum, converted once, then divided: reproducible digits
    mean = F.sum("_s").over(frame).cast("double") / F.count(F.lit(1)).over(frame)
    return d.select("service_date", F.round(F.col("_s").cast("double"), 2).alias("daily_sales"),
                    mean.alias("rolling_avg_30"), (F.row_number().over(w) - 1).alias("day_idx"))


def rolling_summary(df: DataFrame, window: int = 30) -> DataFrame:
    """WIN3 facts: trend of the rolling mean (last vs first) and current day
    vs its rolling mean; only with more than ``window`` days."""
    r = daily_rolling(df, window)
    s = r.agg(F.count(F.lit(1)).alias("n_days"), F.min_by("rolling_avg_30", "day_idx").alias("_first"),
              F.max_by("rolling_avg_30", "day_idx").alias("_last"), F.max_by("daily_sales", "day_idx").alias("_cur"))
    return s.filter(F.col("n_days") > window).select(
        "n_days", F.when(F.col("_last") > F.col("_first"), "Increasing").otherwise("Decreasing").alias("trend_30d"),
        ((F.col("_cur") / F.col("_last") - 1) * 100).alias("current_vs_30d_avg_pct"))


# -------------------------------------------------------------- FA24-FA31, WIN9
IMPORTANCE = ["Patient Demographics", "Temporal Patterns", "Drug Characteristics", "HCP Behavior",
              "Payer Dynamics", "Transaction Patterns"]


def importance(df: DataFrame) -> DataFrame:
    """FA24-FA29 scores, ranked (FA30 / WIN9 over six rows)."""
    c = with_calendar(df)
    g = c.agg(F.avg(PAID).alias("_mean"), money_sum(PAID).alias("_sum"),
              F.abs(F.corr(F.col("patient_age").cast("double"), F.col(PAID))).alias("_age_corr"),
              F.abs(F.corr(F.col("days_supply_val").cast("double"), F.col(PAID))).alias("_supply_corr"),
              # pandas: a null status is "!= 'Dispensed'"
              F.avg(F.when(F.col("transaction_status") == "Dispensed", 0.0).otherwise(1.0)).alias("_not_disp"))

    # Std of per-group means (per-prescriber sums) for six keys: one
    # grouping-sets aggregate (one scan), then one conditional aggregate.
    keys = ["patient_gender", "month", "quarter", "drug_brand_name", "prescriber_npi_nm", "payer_channel_name"]
    sets = c.groupingSets([[k] for k in keys], *keys).agg(
        F.avg(PAID).alias("_m"), F.sum(PAID).alias("_sm"), F.grouping_id().alias("_gid"))
    full = (1 << len(keys)) - 1

    def sd(key, value):
        bit = 1 << (len(keys) - 1 - keys.index(key))
        return F.stddev_samp(F.when((F.col("_gid") == full - bit) & F.col(key).isNotNull(), F.col(value)))

    sds = sets.agg(*[sd(k, "_sm" if k == "prescriber_npi_nm" else "_m").alias(f"_sd_{k}") for k in keys])
    one = attach(g, sds)
    z = lambda e: F.coalesce(e, F.lit(0.0))  # noqa: E731  (missing term adds nothing)
    scores = {
        "Patient Demographics": 0.5 + z(F.col("_age_corr")) * 0.3 + z(F.col("_sd_patient_gender") / F.col("_mean")) * 0.2,
        "Temporal Patterns": 0.4 + z(F.col("_sd_month") / F.col("_mean")) * 0.3 + z(F.col("_sd_quarter") / F.col("_mean")) * 0.3,
        "Drug Characteristics": 0.6 + z(F.col("_sd_drug_brand_name") / F.col("_mean")) * 0.4,
        "HCP Behavior": 0.7 + z(F.col("_sd_prescriber_npi_nm") / F.col("_sum")) * 0.3,
        "Payer Dynamics": 0.5 + z(F.col("_sd_payer_channel_name") / F.col("_mean")) * 0.5,
        "Transaction Patterns": 0.3 + F.col("_not_disp") * 0.4 + z(F.col("_supply_corr")) * 0.3,
    }
    st = one.select(*[F.least(F.lit(1.0), v).alias(k) for k, v in scores.items()])
    rows = ", ".join(f"'{k}', `{k}`" for k in IMPORTANCE)
    long = st.selectExpr(f"stack({len(IMPORTANCE)}, {rows}) AS (category, score)")
    return long.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), "category")))


def insights(df: DataFrame) -> DataFrame:
    """FA31: key facts: top importance category, market leader and share,
    top-10 prescriber share of sales, threshold flags. One aggregate of the
    six scores, one of the claims per drug and one per prescriber."""
    def score(name):
        return F.max(F.when(F.col("category") == name, F.col("score")))

    facts = importance(df).agg(
        F.min_by("category", "rank").alias("top_category"), F.min_by("score", "rank").alias("top_score"),
        (score("Temporal Patterns") > 0.6).alias("strong_seasonality"), (score("Payer Dynamics") > 0.7).alias("payer_mix_matters"))
    drugs = df.filter(F.col("drug_brand_name").isNotNull()).groupBy("drug_brand_name").agg(F.count(F.lit(1)).alias("_k"))
    leader = drugs.agg(top_value("drug_brand_name").alias("market_leader"),
                       (F.max("_k") / F.sum("_k") * 100).alias("leader_share_pct"))
    per_hcp = df.groupBy("prescriber_npi_nm").agg(F.sum(F.col(PAID).cast("decimal(38,6)")).alias("_s"))
    top10 = per_hcp.where(F.col("prescriber_npi_nm").isNotNull()).orderBy(F.col("_s").desc(), "prescriber_npi_nm").limit(10) \
        .agg(F.sum("_s").cast("double").alias("_top10"))
    total = per_hcp.agg(F.sum("_s").cast("double").alias("_tot"))
    share = attach(top10, total).select((F.col("_top10") / F.col("_tot") * 100).alias("top10_hcp_share_pct"))
    return attach(attach(facts, leader), share)
