"""Partial states of the prediction's features.

``claim_states`` aggregates the claims with mergeable states: counts, sums,
means with squared deviations, the earliest date. Sales groups, monthly sales,
transaction mix, payer score, training target, first values and group sizes
are roll-ups of it. Over all its keys (HCP x generic x brand x month x
descriptive values) it has nearly as many rows as the claims before the
shuffle, so the prediction takes it by three sets of keys (``GROUPS``,
``MONTHS`` and the descriptive values with the payer), each with the states
that its roll-ups read: few columns of the claims, read three times, instead
of wide rows shuffled once. Distinct payers are a roll-up of the third. What
doesn't merge there takes its own pass: distinct patients per HCP
(``patient_counts``) and the row windows (``features.hcp_rolling``). Where
an HCP has two values of a descriptive column on its first date, the claims of
these dates are read again to decide (``features.first_values``).

The buffers are fixed-width (hash aggregates with a partial step), so a hot
HCP costs each task one row per combination of its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxcast.functions.exprs import clip, flag, nunique_with_null
from rxcast.operators.clean import AGE_LABELS, ORDER_COLUMNS, base_features
from rxcast.operators.features import PAID, TEMPORAL_FEATURES, hcp_detail_columns
from rxcast.operators.multipliers import payer_score_expr

DRUG = ["drug_generic_name", "drug_brand_name"]
CHANNELS = {"medicare_share": "Medicare", "commercial_share": "Commercial", "medicaid_share": "Medicaid"}


def _moments(name: str, value: Column) -> dict[str, Column]:
    """Count, mean and squared deviations of the non-null values."""
    n = F.count(value)
    return {f"{name}_n": n, f"{name}_mean": F.avg(value), f"{name}_m2": F.var_pop(value) * n}


#: Keys and states of the sales groups and of the months; those of the fitted component come on top.
GROUPS, GROUP_STATES = DRUG, ("n", "sales")
MONTHS, MONTH_STATES = ["month"], ("n", "paid", "paid_n", "channels", *CHANNELS, "rejects", "copay", "score", "scored")
LEARNED_STATES = ("paid_mean", "paid_m2", "age_n", "age_mean", "age_m2", "age", "female", "weekend", *[f"age_group_{g}" for g in AGE_LABELS])


def _states() -> dict[str, Column]:
    channel, score = F.col("payer_channel_name"), payer_score_expr()
    return {
        "n": F.count(F.lit(1)), "first_date": F.min(ORDER_COLUMNS[0]),
        "sales": F.sum(F.col(PAID).cast("decimal(38,6)")), "paid": F.sum(PAID), **_moments("paid", F.col(PAID)),
        "channels": F.count(channel), **{k: F.count(F.when(channel == v, 1)) for k, v in CHANNELS.items()},
        "rejects": F.count("reject_reason_1_cd"), "copay": F.sum("copay_ratio"), "score": F.sum(score), "scored": F.count(score),
        **_moments("age", F.col("patient_age")), "age": F.sum("patient_age"),
        "female": F.sum(flag(F.col("patient_gender") == "F")), "weekend": F.sum(flag(F.col("day_of_week").isin(5, 6))),
        **{f"age_group_{g}": F.sum(flag(F.col("age_group") == g)) for g in AGE_LABELS}}


def claim_states(clean: DataFrame, keys: list[str] | None = None, names: tuple[str, ...] | None = None) -> DataFrame:
    """A row per HCP and ``keys`` (all that a roll-up asks for, if not given)
    with the states ``names`` (all); null keys are groups of their own."""
    keys = keys if keys is not None else [*DRUG, "month", *hcp_detail_columns(clean.columns)]
    states = _states()
    return base_features(clean).groupBy("hcp_id", *keys).agg(*[states[k].alias(k) for k in names or states])


def distinct_keys(clean: DataFrame, patients: bool = True) -> DataFrame:
    """Distinct payers (nulls apart) and, on demand, patients (null counted
    once) per HCP. Each distinct key is a group of its own before it is
    counted, so a hot HCP is spread."""
    return clean.groupBy("hcp_id").agg(F.count_distinct("payer_name").alias("payer_diversity"),
                                       *([nunique_with_null("patient_id").alias("patient_count")] if patients else []))


def patient_counts(clean: DataFrame) -> DataFrame:
    """Distinct patients per HCP, null counted once. It is the only distinct
    key of its pass, so no claim is expanded into a row per key."""
    return clean.groupBy("hcp_id").agg(nunique_with_null("patient_id").alias("patient_count"))


def payer_diversity(states: DataFrame) -> DataFrame:
    """Distinct payers per HCP (nulls apart) from states with the payer among their keys."""
    return states.groupBy("hcp_id").agg(F.count_distinct("payer_name").alias("payer_diversity"))


def group_sizes(states: DataFrame) -> DataFrame:
    """Claims per HCP, as ``_n``."""
    return states.groupBy("hcp_id").agg(F.sum("n").alias("_n"))


def drug_groups(states: DataFrame) -> DataFrame:
    """AGG10 with null keys kept: exact sales and claims per HCP x generic x brand."""
    return states.groupBy("hcp_id", *DRUG).agg(F.sum("sales").alias("_sales"), F.sum("n").alias("_qty"))


def transaction_mix(states: DataFrame) -> DataFrame:
    """Additive part of AGG9 and the mean payer score of MUL6 per HCP."""
    total = lambda c: F.sum(c)
    return states.groupBy("hcp_id").agg(
        *[F.coalesce(F.try_divide(total(k), total("channels")), F.lit(0.0)).alias(k) for k in CHANNELS],
        (total("rejects") / total("n")).alias("rejection_rate"), (total("copay") / total("n")).alias("avg_copay_ratio"),
        F.try_divide(total("score"), total("scored")).alias("_payer_score"))


def _deviation(states: DataFrame, name: str) -> DataFrame:
    """(hcp_id, mean, std) of a value: the states' squared deviations and those
    of their means from the HCP's, so nothing cancels; std is null below two."""
    n, mean = F.col(f"{name}_n"), F.col(f"{name}_mean")
    totals = states.groupBy("hcp_id").agg((F.sum(n * mean) / F.nullif(F.sum(n), F.lit(0))).alias("mean"), F.sum(n).alias("_k"))
    apart = (F.col(f"{name}_m2") + n * F.pow(mean - F.col("mean"), F.lit(2.0)))
    return states.join(totals, "hcp_id").groupBy("hcp_id").agg(
        F.first("mean").alias("mean"), F.when(F.first("_k") > 1, F.sqrt(F.sum(apart) / (F.first("_k") - 1))).alias("std"))


def target_multiplier(states: DataFrame) -> DataFrame:
    """AGG16 per HCP."""
    t = F.lit(1.0) + clip(F.try_divide(F.col("std"), F.col("mean") + F.lit(1e-6)), -0.5, 0.5)
    return _deviation(states, "paid").select("hcp_id", F.coalesce(F.when(t != 0, t), F.lit(1.0)).alias("target_multiplier"))


def _monthly(states: DataFrame) -> DataFrame:
    return states.where(F.col("month").isNotNull()).groupBy("hcp_id", "month").agg(
        F.sum("paid").alias("paid"), F.try_divide(F.sum("paid"), F.sum("paid_n")).alias("mean"))


def seasonality(states: DataFrame) -> DataFrame:
    """AGG13 per HCP with a dated claim."""
    return _monthly(states).groupBy("hcp_id").agg(
        (F.stddev_samp("mean") / (F.avg("mean") + F.lit(1e-6))).alias("seasonality_strength"))


def hcp_temporal(states: DataFrame, patients: DataFrame) -> DataFrame:
    """AGG1-AGG3 per HCP; ``patients`` holds (hcp_id, patient_count)."""
    share = lambda c: F.sum(c) / F.sum("n")
    main = states.groupBy("hcp_id").agg(
        (F.sum("age") / F.nullif(F.sum("age_n"), F.lit(0))).alias("avg_patient_age"), share("female").alias("female_ratio"),
        share("weekend").alias("weekend_ratio"), *[share(f"age_group_{g}").alias(f"age_group_{g}") for g in AGE_LABELS])
    seasonal = _monthly(states).groupBy("hcp_id").agg(
        F.stddev_samp(F.coalesce("paid", F.lit(0.0))).alias("seasonal_variation"))
    out = main.join(_deviation(states, "age").select("hcp_id", F.col("std").alias("age_diversity")), "hcp_id") \
        .join(seasonal, "hcp_id", "left").join(patients, "hcp_id", "left")
    return out.select("hcp_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in TEMPORAL_FEATURES])


def value_dates(states: DataFrame, columns: list[str]) -> DataFrame:
    """Earliest date, as ``_t``, of each combination of an HCP's descriptive values."""
    return states.groupBy("hcp_id", *columns).agg(F.min("first_date").alias("_t"))
