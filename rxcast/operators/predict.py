"""Ensemble prediction (MUL7, MUL8, JN6, JN7, AGG10)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcast.operators import features as fe
from rxcast.operators import multipliers as mu
from rxcast.operators import partials as pt
from rxcast.operators.clean import ORDER_COLUMNS, company_expr
from rxcast.session import materialize, release

# Exponents of the six components in the combined multiplier.
WEIGHTS = {"temporal_multiplier": 1.0, "market_multiplier": 0.5, "affinity": 0.5,
           "transaction_multiplier": 0.33, "rolling_multiplier": 0.33, "payer_multiplier": 0.33}


@dataclass
class Components:
    """The keyed tables the prediction joins against (MUL8)."""
    groups: DataFrame
    temporal: DataFrame | None
    affinity: DataFrame
    transaction: DataFrame
    rolling: DataFrame
    payer: DataFrame
    details: DataFrame
    kept: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Give back the intermediates, once what reads them is stored."""
        for df in self.kept:
            release(df)


def columns_read(columns: list[str]) -> list[str]:
    """The columns of the cleaned claims that the prediction reads, in their order."""
    read = {"hcp_id", *pt.DRUG, *ORDER_COLUMNS, fe.PAID, "payer_name", "payer_channel_name", "reject_reason_1_cd", "patient_to_pay_amt",
            "patient_age", "patient_gender", *fe.hcp_detail_columns(columns)}
    return [c for c in columns if c in read]


def train_components(clean: DataFrame, learned: bool = False, registry: DataFrame | None = None) -> Components:
    """MUL8: build every component from the cleaned claims. With
    ``learned=False`` the temporal component is the neutral 1.0. The claims
    are read for the partial states (by drug, month, descriptive values and
    payer), the distinct patients of the fitted component and the row windows."""
    named = fe.hcp_detail_columns(clean.columns)
    drugs = materialize(pt.claim_states(clean, pt.GROUPS, pt.GROUP_STATES), "drug-states")
    states = materialize(pt.claim_states(clean, pt.MONTHS, (*pt.MONTH_STATES, *(pt.LEARNED_STATES if learned else ()))), "claim-states")
    values = materialize(pt.claim_states(clean, list(dict.fromkeys([*named, "payer_name"])), ("first_date",)), "value-dates")
    payers = pt.payer_diversity(values)
    temporal, kept = None, (drugs, states, values)
    if learned:
        patients = materialize(pt.patient_counts(clean), "patient-counts")
        temporal = mu.temporal_multiplier(pt.hcp_temporal(states, patients), pt.target_multiplier(states))
        kept = (*kept, patients)
    summary = pt.transaction_mix(states).join(payers, "hcp_id")
    groups = pt.drug_groups(drugs)
    pairs = groups.groupBy("hcp_id", "drug_brand_name").agg(F.sum("_qty").alias("_n"))
    spec = fe.specialized(payers.select("hcp_id"), registry)
    return Components(
        kept=kept,
        groups=groups,
        temporal=temporal,
        affinity=fe.affinity(clean, spec, pairs).select("hcp_id", "drug_brand_name", "affinity"),
        transaction=mu.transaction_multiplier(summary),
        rolling=mu.rolling_multiplier(fe.hcp_rolling(clean, pt.group_sizes(states), pt.seasonality(states))),
        payer=summary.select("hcp_id", mu.payer_from_mean_score(F.col("_payer_score")).alias("payer_multiplier")),
        details=fe.first_values(clean, pt.value_dates(values, named)),
    )


def predict(clean: DataFrame, comp: Components | None = None, learned: bool = False,
            keep_components: bool = False) -> DataFrame:
    """MUL7: HCP x generic x brand groups joined to the six multipliers
    (missing -> 1.0) and the HCP's first-seen descriptive columns.

    All multiplier tables are keyed by hcp_id (or hcp_id x brand) and are one
    row per key, so these are plain equi-joins; AQE broadcasts them when their
    measured size is small and sort-merges them otherwise.
    """
    comp = comp or train_components(clean, learned)
    groups = comp.groups.filter(F.col("drug_generic_name").isNotNull() & F.col("drug_brand_name").isNotNull())
    j = groups.join(comp.affinity, ["hcp_id", "drug_brand_name"], "left")
    for t in (comp.transaction, comp.rolling, comp.payer):
        j = j.join(t, "hcp_id", "left")
    if comp.temporal is not None:
        j = j.join(comp.temporal, "hcp_id", "left")
    else:
        j = j.withColumn("temporal_multiplier", F.lit(1.0))
    j = j.withColumn("market_multiplier", mu.market_multiplier_expr(F.col("drug_brand_name")))
    mult = None
    for c, w in WEIGHTS.items():
        term = F.pow(F.coalesce(F.col(c), F.lit(1.0)), F.lit(w)) if w != 1.0 else F.coalesce(F.col(c), F.lit(1.0))
        mult = term if mult is None else mult * term
    details = comp.details
    detail_cols = [c for c in details.columns if c != "hcp_id"]
    sales = F.coalesce(F.col("_sales"), F.lit(0)).cast("double")
    j = j.withColumn("_mult", mult).join(details, "hcp_id", "left")
    return j.select(
        "hcp_id", *detail_cols,
        F.col("drug_generic_name").alias("Drug_generic_name"),
        F.col("drug_brand_name").alias("Drug_name"),
        company_expr(F.col("drug_generic_name")).alias("Company"),
        F.round(sales, 2).alias("Sales_from_db"),
        F.round(sales * F.col("_mult"), 2).alias("Predicted_sales"),
        F.col("_qty").cast("int").alias("Quantity_from_DB"),
        (F.col("_qty") * F.col("_mult")).cast("int").alias("Predicted_quantity"),
        F.round(F.col("_mult"), 3).alias("Combined_multiplier"),
        *([F.coalesce(F.col(c), F.lit(1.0)).alias(c) for c in WEIGHTS] if keep_components else []),
    )
