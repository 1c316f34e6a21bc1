"""Report tables (RPT1-RPT4, TOP1, TOP2, TOP5). Top-k use Spark's
take-ordered (per-partition top k, merged on the driver: k rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxcast.functions.quantiles import exact_quantiles
from rxcast.operators.evaluate import attach
from rxcast.operators.profile import money_sum

A, P = "Sales_from_db", "Predicted_sales"


def data_overview(clean: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """RPT1: claims, distinct HCPs / drugs / patients, total sales. Exact
    distinct counts by default (two-phase aggregation, skew-safe);
    ``approx_distinct`` uses HyperLogLog++ (DST2's option) to skip the
    distinct shuffles on very large inputs."""
    nd = (lambda c: F.approx_count_distinct(c, 0.01)) if approx_distinct else F.count_distinct
    return clean.agg(F.count(F.lit(1)).alias("claims"), nd("hcp_id").alias("hcps"),
                     nd("drug_brand_name").alias("drugs"), nd("patient_id").alias("patients"),
                     F.round(money_sum("total_paid_amt"), 2).alias("total_sales"))


def prediction_summary(pred: DataFrame) -> DataFrame:
    """RPT2: totals, mean/median predicted sales, mean multiplier, uplift %."""
    out = pred.agg(F.round(money_sum(P), 2).alias("total_predicted"), F.round(money_sum(A), 2).alias("total_db"),
                   F.count(F.lit(1)).alias("predictions"), F.count_distinct("hcp_id").alias("hcps"),
                   F.count_distinct("Drug_name").alias("drugs"), F.avg(P).alias("mean_predicted"),
                   F.avg("Combined_multiplier").alias("mean_multiplier"))
    out = attach(out, exact_quantiles(pred, {"_q": F.col(P)}, [.5])).withColumn("median_predicted", F.col("_q")[0]).drop("_q")
    return out.withColumn("uplift_pct", (F.try_divide(F.col("total_predicted"), F.col("total_db")) - 1) * 100)


def drug_insight(pred: DataFrame) -> DataFrame:
    """RPT3: per drug predicted vs historical, pair count, uplift (0 when
    the historical total is not positive)."""
    g = pred.groupBy("Drug_name").agg(F.round(money_sum(P), 2).alias("predicted_sales"),
                                      F.round(money_sum(A), 2).alias("historical_sales"),
                                      F.count("hcp_id").alias("pairs"))
    return g.withColumn("uplift_pct", F.when(F.col("historical_sales") > 0,
                                             (F.col("predicted_sales") / F.col("historical_sales") - 1) * 100)
                        .otherwise(F.lit(0.0)))


def top_hcps_predicted(pred: DataFrame, k: int = 10) -> DataFrame:
    """TOP2 + RPT4: top k HCPs by summed predicted sales, ranked."""
    g = pred.groupBy("hcp_id").agg(F.round(money_sum(P), 2).alias("predicted_sales"))
    top = g.orderBy(F.col("predicted_sales").desc(), "hcp_id").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("predicted_sales").desc(), "hcp_id")))


def top_predictions(pred: DataFrame, k: int = 5) -> DataFrame:
    """TOP1: the k largest predictions with the first prescriber columns."""
    hcp_cols = (["hcp_id"] + [c for c in pred.columns if "prescriber" in c.lower()])[:3]
    return (pred.orderBy(F.col(P).desc(), "hcp_id", "Drug_generic_name", "Drug_name").limit(k)
            .select(*hcp_cols, "Drug_name", P, A, "Combined_multiplier"))


def sample_hcps(clean: DataFrame, k: int = 10) -> DataFrame:
    """TOP5: a bounded sample of k distinct HCP ids (for profile lookups)."""
    return clean.select("hcp_id").distinct().orderBy("hcp_id").limit(k)
