"""Claims cleaning (FLT1, PRJ2-PRJ4, JN1) and row-level base features
(PRJ5, PRJ7, PRJ8). All projections/filters; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxcast.functions.exprs import finite_or, right_closed_bins
from rxcast.sources import dims

DROP_STATUSES = ("Reject", "Reversed")
# pd.cut bins for age groups (right-closed); anything else -> "35-50".
AGE_EDGES = [0, 18, 35, 50, 65, 100]
AGE_LABELS = ["<18", "18-35", "35-50", "50-65", "65+"]
AGE_DEFAULT = "35-50"

# Total row order used wherever the reference relied on input row order
# (stable sorts, ``first()``): service date (nulls last) then a full tie-break.
ORDER_COLUMNS = ["service_date_dd", "claim_number", "drug_brand_name",
                 "total_paid_amt", "patient_id", "days_supply_val"]


def order_cols() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ORDER_COLUMNS]


def order_struct() -> Column:
    """The same total order as a single comparable value (for min_by/max_by,
    which aggregate with partial map-side combine instead of a window)."""
    parts = []
    for c in ORDER_COLUMNS:
        parts += [F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c)]
    return F.struct(*parts)


def filter_valid_status(df: DataFrame) -> DataFrame:
    """FLT1: drop Reject/Reversed. A null status is *kept* (pandas ``~isin``)."""
    return df.filter(F.coalesce(~F.col("transaction_status").isin(*DROP_STATUSES), F.lit(True)))


def impute_zero_paid(df: DataFrame) -> DataFrame:
    """PRJ2: paid == 0 -> days_supply * awp (null paid stays null)."""
    paid = F.col("total_paid_amt")
    return df.withColumn(
        "total_paid_amt",
        F.when(paid == 0, F.col("days_supply_val") * F.col("awp_unit_price_amt")).otherwise(paid))


def hcp_id_expr(columns: list[str]) -> Column:
    """PRJ3: hcp_id from type_1_npi (null->0->int->str, '0'->'Unknown'),
    else from prescriber_npi_nbr (null->'Unknown')."""
    if "type_1_npi" in columns:
        as_int = F.coalesce(F.col("type_1_npi"), F.lit(0.0)).cast("bigint").cast("string")
        return F.when(as_int == "0", F.lit("Unknown")).otherwise(as_int)
    if "prescriber_npi_nbr" in columns:
        return F.coalesce(F.col("prescriber_npi_nbr").cast("string"), F.lit("Unknown"))
    raise ValueError("claims need a prescriber id: type_1_npi or prescriber_npi_nbr")


def company_expr(generic: Column) -> Column:
    """PRJ4 / JN1: drug->company lookup with default. The dimension has three
    fixed rows, so it is inlined as a CASE expression (no join at all)."""
    expr = None
    for g, _b, comp in dims.DRUG_COMPANY:
        expr = F.when(generic == g, F.lit(comp)) if expr is None else expr.when(generic == g, F.lit(comp))
    return expr.otherwise(F.lit("Unknown"))


def clean_claims(df: DataFrame) -> DataFrame:
    """FLT1 + PRJ2 + PRJ3 + PRJ4 (``load_and_clean_data``)."""
    hcp = hcp_id_expr(df.columns)
    for c in ("days_supply_val", "awp_unit_price_amt"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    df = impute_zero_paid(filter_valid_status(df))
    return df.withColumns({
        "hcp_id": hcp,
        "company": company_expr(F.col("drug_generic_name")),
    })


def base_features(df: DataFrame) -> DataFrame:
    """PRJ5 + PRJ7 + PRJ8 (``create_base_features``). Unparseable dates give
    null calendar parts row by row (PRJ6 fallback only acts on whole-column
    failure in the reference, which cannot happen with a typed column)."""
    d = F.col("service_date_dd")
    return df.withColumns({
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "day_of_week": F.weekday(d),  # Monday = 0
        "age_group": right_closed_bins("patient_age", AGE_EDGES, AGE_LABELS, AGE_DEFAULT),
        "copay_ratio": finite_or(F.try_divide(F.col("patient_to_pay_amt"), F.col("total_paid_amt") + 1), 0.0),
    })
