"""Static dimension tables (SRC3-SRC6).

These are small, fixed-size reference tables; joining them with
``F.broadcast`` is safe because their size does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values that must equal the reference's (do not edit) -------------
# Drug -> brand -> company.
DRUG_COMPANY = [
    ("Cemiplimab-Rwlc", "Libtayo", "Regeneron/Sanofi"),
    ("Nivolumab", "Opdivo", "Bristol-Myers Squibb"),
    ("Pembrolizumab", "Keytruda", "Merck"),
]
# Drug market data: drug, efficacy_score, market_share, drug_age_years,
# competitor_count, avg_response_rate, side_effect_score.
DRUG_MARKET = [
    ("Libtayo", 0.85, 0.15, 3, 2, 0.45, 0.3),
    ("Opdivo", 0.87, 0.45, 7, 2, 0.42, 0.28),
    ("Keytruda", 0.89, 0.40, 6, 2, 0.47, 0.25),
]
DRUG_MARKET_DEFAULT = (0.7, 0.1, 1, 3, 0.3, 0.4)
# Specialization classes: name, weight, patient_volume (class order matters
# for the stable-hash fallback).
SPECIALIZATION = [
    ("oncology", 0.9, 150),
    ("hematology", 0.8, 120),
    ("general", 0.3, 50),
]
# Payer channel: reputation, reimbursement_rate.
PAYER_SCORE = [
    ("Medicare", 0.9, 0.85),
    ("Commercial", 0.8, 0.75),
    ("Medicaid", 0.7, 0.65),
    ("Other", 0.6, 0.60),
]
# Market share per drug: drug, market_share, revenue_billions,
# prescription_volume, growth_rate.
DRUG_SHARE = [
    ("Keytruda", 0.42, 14.8, 285000, 0.22),
    ("Opdivo", 0.31, 10.9, 210000, 0.08),
    ("Libtayo", 0.08, 2.8, 54000, 0.35),
    ("Others", 0.19, 6.7, 129000, 0.15),
]
MARKET_TOTALS = (35.2, 0.18)  # total_market_size_billion, growth_rate_yoy
INDICATION = [("NSCLC", 0.45), ("Melanoma", 0.18), ("RCC", 0.12), ("HNSCC", 0.08), ("Others", 0.17)]
# Pricing: drug_name, list_price_per_dose, avg_selling_price,
# medicare_reimbursement, commercial_reimbursement, international_price_index.
PRICING = [
    ("Keytruda", 11500, 10350, 9775, 8625, 0.65),
    ("Opdivo", 9800, 8820, 8330, 7350, 0.62),
    ("Libtayo", 10200, 9180, 8670, 7650, 0.68),
]
# Efficacy: drug, (overall_response_rate, progression_free_survival_months,
# overall_survival_months, complete_response_rate, disease_control_rate),
# (grade_3_4_rate, discontinuation_rate, immune_related_ae_rate).
EFFICACY = [
    ("Keytruda", (0.47, 11.5, 26.3, 0.13, 0.62), (0.22, 0.08, 0.17)),
    ("Opdivo", (0.42, 9.7, 24.2, 0.11, 0.58), (0.19, 0.07, 0.14)),
    ("Libtayo", (0.45, 10.2, 25.1, 0.12, 0.60), (0.20, 0.09, 0.15)),
]
EFFICACY_DEFAULT = ((0.40, 9.0, 22.0, 0.10, 0.55), (0.18, 0.08, 0.15))
# Payer policies, matched by substring of the payer name in this order.
PAYER_POLICY = [
    ("Medicare", True, False, ["FDA-approved indications only"],
     {"Keytruda": 0.85, "Opdivo": 0.83, "Libtayo": 0.80},
     {"Keytruda": "Specialty Tier", "Opdivo": "Specialty Tier", "Libtayo": "Specialty Tier"}),
    ("Commercial", True, True, ["Prior authorization required"],
     {"Keytruda": 0.75, "Opdivo": 0.73, "Libtayo": 0.70},
     {}),
]
MARKET_RANK = [("Keytruda", 1), ("Opdivo", 2), ("Libtayo", 3), ("Others", 4)]
MARKET_RANK_DEFAULT = 5
COMPETITIVE_ADVANTAGE = [
    ("Keytruda", "Market leader with broadest indication portfolio"),
    ("Opdivo", "Strong clinical data and established presence"),
    ("Libtayo", "Competitive pricing and growing market share"),
]
COMPETITIVE_ADVANTAGE_DEFAULT = "Emerging player"
KNOWN_BRANDS = ["Keytruda", "Opdivo", "Libtayo"]
# -----------------------------------------------------------------------------

EFF_FIELDS = ["overall_response_rate", "progression_free_survival_months",
              "overall_survival_months", "complete_response_rate", "disease_control_rate"]
AE_FIELDS = ["grade_3_4_rate", "discontinuation_rate", "immune_related_ae_rate"]




def specialization(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, n, w, v) for i, (n, w, v) in enumerate(SPECIALIZATION)],
        "spec_class int, specialization string, weight double, patient_volume int")



def drug_share(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DRUG_SHARE, "drug string, market_share double, revenue_billions double, "
                    "prescription_volume int, growth_rate double")



def pricing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PRICING, "drug_name string, list_price_per_dose int, avg_selling_price int, "
                 "medicare_reimbursement int, commercial_reimbursement int, "
                 "international_price_index double")


_EFF_T = T.StructType([T.StructField(f, T.DoubleType()) for f in EFF_FIELDS])
_AE_T = T.StructType([T.StructField(f, T.DoubleType()) for f in AE_FIELDS])
EFFICACY_SCHEMA = T.StructType([
    T.StructField("drug", T.StringType()),
    T.StructField("efficacy_metrics", _EFF_T),
    T.StructField("adverse_events", _AE_T),
])


def efficacy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EFFICACY, EFFICACY_SCHEMA)


def efficacy_default(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([EFFICACY_DEFAULT], T.StructType(EFFICACY_SCHEMA.fields[1:]))


PAYER_POLICY_SCHEMA = T.StructType([
    T.StructField("pattern", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("coverage_policies", T.StructType([
        T.StructField("immunotherapy_covered", T.BooleanType()),
        T.StructField("step_therapy_required", T.BooleanType()),
        T.StructField("coverage_restrictions", T.ArrayType(T.StringType())),
    ])),
    T.StructField("reimbursement_rates", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("formulary_tier", T.MapType(T.StringType(), T.StringType())),
])


def payer_policy(spark: SparkSession) -> DataFrame:
    rows = [(p, i, (cov, step, restr), rates, tier)
            for i, (p, cov, step, restr, rates, tier) in enumerate(PAYER_POLICY)]
    return spark.createDataFrame(rows, PAYER_POLICY_SCHEMA)
