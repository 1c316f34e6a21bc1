"""Per-HCP and per-drug feature tables (AGG1-AGG16, WIN1/2/4, JN2-JN4).

Each function is one ``groupBy`` with partial (map-side) aggregation, so a hot
key costs one row per task before the shuffle. Two-level aggregates
(per month, per HCP x drug) pre-aggregate on the finer key first.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxcast.functions.exprs import clip, flag, nunique_with_null
from rxcast.operators import ordered
from rxcast.operators.clean import AGE_LABELS, ORDER_COLUMNS, order_struct
from rxcast.operators.ordered import rolling_windows, split_buckets
from rxcast.session import materialize
from rxcast.sources import dims

PAID = "total_paid_amt"


def _drug_key_filter(df: DataFrame, key: str = "drug_brand_name") -> DataFrame:
    return df.filter(F.col(key).isNotNull())  # FLT5: pandas groupby drops null keys


# ---------------------------------------------------------------- AGG1-AGG3
def hcp_temporal(base: DataFrame) -> DataFrame:
    """Temporal/demographic features per HCP (AGG1, AGG2, AGG3); null -> 0."""
    monthly = (base.filter(F.col("month").isNotNull())
               .groupBy("hcp_id", "month").agg(F.coalesce(F.sum(PAID), F.lit(0.0)).alias("_ms")))
    seasonal = monthly.groupBy("hcp_id").agg(F.stddev_samp("_ms").alias("seasonal_variation"))
    ag = F.col("age_group")
    main = base.groupBy("hcp_id").agg(
        F.avg("patient_age").alias("avg_patient_age"),
        F.avg(flag(F.col("patient_gender") == "F")).alias("female_ratio"),
        F.when(F.count(F.lit(1)) > 1, F.stddev_samp("patient_age")).alias("age_diversity"),
        nunique_with_null("patient_id").alias("patient_count"),
        F.avg(flag(F.col("day_of_week").isin(5, 6))).alias("weekend_ratio"),
        *[F.avg(flag(ag == g)).alias(f"age_group_{g}") for g in AGE_LABELS],
    )
    out = main.join(seasonal, "hcp_id", "left")
    cols = ["avg_patient_age", "female_ratio", "age_diversity", "patient_count",
            "seasonal_variation", "weekend_ratio", *[f"age_group_{g}" for g in AGE_LABELS]]
    return out.select("hcp_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])


TEMPORAL_FEATURES = ["avg_patient_age", "female_ratio", "age_diversity", "patient_count",
                     "seasonal_variation", "weekend_ratio", *[f"age_group_{g}" for g in AGE_LABELS]]


# ------------------------------------------------------------------- AGG16
def target_multiplier(clean: DataFrame, key: str = "hcp_id") -> DataFrame:
    """Training target per HCP (or another key): 1 + clip(std/(mean+1e-6), -.5, .5); NaN/inf/0 -> 1."""
    cvx = F.try_divide(F.stddev_samp(PAID), F.avg(PAID) + F.lit(1e-6))
    t = F.lit(1.0) + clip(cvx, -0.5, 0.5)
    return clean.groupBy(key).agg(F.coalesce(F.when(t != 0, t), F.lit(1.0)).alias("target_multiplier"))


# ------------------------------------------------------------ AGG4/5, JN2
def drug_market(clean: DataFrame) -> DataFrame:
    """Drug volume and market data per brand (AGG4, AGG5, JN2 with default row)."""
    d = _drug_key_filter(clean)
    per_hcp = (d.groupBy("drug_brand_name", "hcp_id")
               .agg(F.coalesce(F.sum(PAID), F.lit(0.0)).alias("_hs")))
    conc = per_hcp.groupBy("drug_brand_name").agg(F.stddev_samp("_hs").alias("revenue_concentration"))
    vol = d.groupBy("drug_brand_name").agg(
        F.count(F.lit(1)).alias("total_volume"),
        F.count_distinct("hcp_id").alias("unique_hcps"),
        F.count_distinct("patient_id").alias("unique_patients"),
        F.avg("days_supply_val").alias("avg_days_supply"),
    )
    mk = drug_market_lookup(F.col("drug_name"))
    return (vol.join(conc, "drug_brand_name", "left")
            .withColumnRenamed("drug_brand_name", "drug_name")
            .select("drug_name", "total_volume", "unique_hcps", "unique_patients", "avg_days_supply",
                    "revenue_concentration", *[mk[k].alias(k) for k in MARKET_FIELDS]))


MARKET_FIELDS = ["efficacy_score", "market_share", "drug_age_years", "competitor_count",
                 "avg_response_rate", "side_effect_score"]


def drug_market_lookup(drug: Column) -> dict[str, Column]:
    """Fixed 3-row dimension with a default row, inlined as CASE expressions."""
    out = {}
    for i, k in enumerate(MARKET_FIELDS):
        e = None
        for row in dims.DRUG_MARKET:
            e = F.when(drug == row[0], F.lit(row[i + 1])) if e is None else e.when(drug == row[0], F.lit(row[i + 1]))
        out[k] = e.otherwise(F.lit(dims.DRUG_MARKET_DEFAULT[i]))
    return out


# ------------------------------------------------------------ AGG6-8, JN3
def spec_class(hcp_id: Column) -> Column:
    """JN3 fallback: stable hash of hcp_id into the specialization classes
    (the reference draws at random; md5 keeps it reproducible across engines)."""
    h = F.conv(F.substring(F.md5(hcp_id.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(len(dims.SPECIALIZATION))).cast("int")


def spec_columns(cls: Column) -> dict[str, Column]:
    name = weight = vol = None
    for i, (n, w, v) in enumerate(dims.SPECIALIZATION):
        c = cls == i
        name = F.when(c, F.lit(n)) if name is None else name.when(c, F.lit(n))
        weight = F.when(c, F.lit(w)) if weight is None else weight.when(c, F.lit(w))
        vol = F.when(c, F.lit(v)) if vol is None else vol.when(c, F.lit(v))
    return {"specialization": name, "specialization_weight": weight, "patient_volume": vol}


def pair_counts(clean: DataFrame) -> DataFrame:
    """Claims per HCP x brand (null brand included). Specialization and
    affinity both use this one expression, so Spark reuses its exchange."""
    return clean.groupBy("hcp_id", "drug_brand_name").agg(F.count(F.lit(1)).alias("_n"))


def modal_state(clean: DataFrame) -> DataFrame:
    """AGG7 per HCP (ties -> smallest, none -> 'Unknown'), from the claims per
    HCP x state: counts are combined before the shuffle."""
    state = "prescriber_npi_state_cd"
    counted = clean.groupBy("hcp_id", state).agg(F.count(F.lit(1)).alias("_n"))
    first = F.min(F.when(F.col(state).isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col(state).alias("s"))))
    return counted.groupBy("hcp_id").agg(F.coalesce(first["s"], F.lit("Unknown")).alias("state"))


def service_lines(clean: DataFrame) -> DataFrame:
    """Distinct service lines of AGG6 per HCP; 1 without the column."""
    csl = "clinical_service_line"
    return clean.groupBy("hcp_id").agg((F.count_distinct(csl) if csl in clean.columns else F.first(F.lit(1))).alias("clinical_complexity"))


def hcp_specialization(clean: DataFrame, registry: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """AGG6 + AGG7 + JN3. ``registry`` (hcp_id, specialization) optionally
    overrides the hashed class with a looked-up one. ``pairs``
    (``pair_counts``) reuses an aggregate that is already computed."""
    pairs = pairs if pairs is not None else pair_counts(clean)
    drug_stats = _drug_key_filter(pairs).groupBy("hcp_id").agg(
        F.count(F.lit(1)).alias("drug_diversity"),
        F.try_divide(F.max("_n"), F.sum("_n")).alias("primary_drug_share"))
    lines = service_lines(clean).withColumnRenamed("hcp_id", "_hcp")
    base = modal_state(clean).join(lines, F.col("hcp_id").eqNullSafe(F.col("_hcp"))).drop("_hcp")
    out = base.join(drug_stats, "hcp_id", "left")
    return specialized(out, registry).select(
        "hcp_id", "state", "specialization", "specialization_weight", "patient_volume",
        F.coalesce("drug_diversity", F.lit(0)).cast("long").alias("drug_diversity"),
        F.coalesce("primary_drug_share", F.lit(0.0)).alias("primary_drug_share"),
        F.col("clinical_complexity").cast("long").alias("clinical_complexity"))


def specialized(hcps: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """JN3: ``hcps`` with their specialization, its weight and patient volume."""
    cls = spec_class(F.col("hcp_id"))
    if registry is not None:
        cls_of = None
        for i, (n, _w, _v) in enumerate(dims.SPECIALIZATION):
            hit = F.lower("specialization") == n.lower()
            cls_of = F.when(hit, F.lit(i)) if cls_of is None else cls_of.when(hit, F.lit(i))
        # one class per HCP, whatever the registry repeats; unknown names keep the hashed class
        reg = registry.groupBy("hcp_id").agg(F.min(cls_of).alias("_reg_cls"))
        hcps = hcps.join(reg, "hcp_id", "left")
        cls = F.coalesce(F.col("_reg_cls"), cls)
    return hcps.withColumns(spec_columns(cls)).drop("_reg_cls")


def affinity(clean: DataFrame, spec: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """MUL3 over *observed* HCP x drug pairs (JN5 re-aimed): the all-pairs
    matrix of the reference is only read back for observed pairs."""
    per_pair = pairs if pairs is not None else pair_counts(clean)
    hcp_n = per_pair.groupBy("hcp_id").agg(F.sum("_n").alias("_tot"))
    share = (per_pair.filter(F.col("drug_brand_name").isNotNull()).join(hcp_n, "hcp_id")
             .withColumn("drug_share", F.col("_n") / F.col("_tot")))
    a = (F.col("specialization_weight") * 0.4 + F.col("drug_share") * 0.3
         + (F.col("patient_volume") / 200.0) * 0.3)
    return (share.join(spec.select("hcp_id", "specialization_weight", "patient_volume"), "hcp_id")
            .select("hcp_id", "drug_brand_name", "drug_share",
                    F.greatest(F.lit(0.5), F.least(F.lit(1.8), a)).alias("affinity")))


# -------------------------------------------------------------------- AGG9
TRANSACTION_FEATURES = ["medicare_share", "commercial_share", "medicaid_share", "rejection_rate",
                        "avg_copay_ratio", "payer_diversity", "specialty_pharmacy_ratio"]


def transaction_aggs(copay: Column) -> list[Column]:
    """AGG9 as per-HCP aggregate expressions (channel shares over non-null
    channels, reject-code rate, mean copay ratio, distinct payers, distinct
    pharmacies per claim)."""
    ch = F.col("payer_channel_name")
    nn = F.count(ch)

    def share(v):
        return F.coalesce(F.try_divide(F.count(F.when(ch == v, 1)), nn), F.lit(0.0))

    return [share("Medicare").alias("medicare_share"), share("Commercial").alias("commercial_share"),
            share("Medicaid").alias("medicaid_share"),
            F.avg(flag(F.col("reject_reason_1_cd").isNotNull())).alias("rejection_rate"),
            F.avg(copay).alias("avg_copay_ratio"),
            F.count_distinct("payer_name").alias("payer_diversity"),
            (F.count_distinct("pharmacy_npi_nbr") / F.count(F.lit(1))).alias("specialty_pharmacy_ratio")]


def hcp_transaction(base: DataFrame) -> DataFrame:
    """Payer mix and transaction features per HCP (AGG9)."""
    return base.groupBy("hcp_id").agg(*transaction_aggs(F.col("copay_ratio")))


# -------------------------------------------------- WIN1/2/4, AGG12-AGG15
def claim_rolling(clean: DataFrame, windows=(7, 30, 90), keep: tuple[str, ...] = (), sizes: DataFrame | None = None) -> DataFrame:
    """Per-claim rolling sums/means over the last n rows of the same HCP x
    drug in date order (WIN1, WIN2), the claim's position in its HCP as
    ``row_idx`` (WIN4) and the columns ``keep``. Null-drug rows get null
    rolling values (pandas transform). The claims are shuffled once; an HCP
    above ``ordered.TARGET_ROWS`` is cut into pieces of its order. ``sizes``
    (hcp_id, _n: claims per HCP, if they are known) saves the pass that looks
    for such HCPs, and, where there are none, those over their pieces."""
    cols = dict.fromkeys(["hcp_id", "drug_brand_name", *ORDER_COLUMNS, PAID, *keep])
    whole = sizes is not None and sizes.where(F.col("_n") > ordered.TARGET_ROWS).isEmpty()
    claims = clean.select(*cols)
    pieces = claims.withColumn("_piece", F.lit(0).cast("long")) if whole \
        else split_buckets(claims, ["hcp_id"], "service_date_dd", "claim_number", days=None, sizes=sizes)
    r = rolling_windows(pieces, ["hcp_id"], ["drug_brand_name"], ORDER_COLUMNS, PAID, list(windows), "row_idx", cut=not whole)
    return r.select(*dict.fromkeys(["hcp_id", "drug_brand_name", "row_idx", PAID, *keep]),
                    *[f"rolling_{x}_{n}" for n in windows for x in ("sum", "avg")])


def hcp_rolling(clean: DataFrame, sizes: DataFrame | None = None, seasons: DataFrame | None = None) -> DataFrame:
    """Rolling-sales features per HCP (AGG12-AGG15). ``sizes`` as in
    ``claim_rolling``; ``seasons`` is ``seasonality`` if it is known."""
    r = claim_rolling(clean, windows=(30, 90), sizes=sizes)
    y = F.coalesce(F.col("rolling_sum_30"), F.lit(0.0))
    x = F.col("row_idx").cast("double")
    n = F.count(F.lit(1))
    first = F.coalesce(F.min_by("rolling_sum_90", "row_idx"), F.lit(0.0))
    last = F.coalesce(F.max_by("rolling_sum_90", "row_idx"), F.lit(0.0))
    feats = r.groupBy("hcp_id").agg(
        F.when(n < 2, F.lit(0.0)).otherwise(F.coalesce(F.regr_slope(y, x), F.lit(0.0))).alias("sales_trend_30d"),
        F.stddev_samp(PAID).alias("sales_volatility"),
        F.when((n < 2) | (first == 0), F.lit(0.0)).otherwise((last - first) / first).alias("growth_rate_90d"),
    )
    return feats.join(seasons if seasons is not None else seasonality(clean), "hcp_id", "left")


def seasonality(clean: DataFrame) -> DataFrame:
    """AGG13: std/(mean+1e-6) of monthly mean paid, month from service date."""
    m = (clean.withColumn("_m", F.month("service_date_dd")).filter(F.col("_m").isNotNull())
         .groupBy("hcp_id", "_m").agg(F.avg(PAID).alias("_mm")))
    return m.groupBy("hcp_id").agg(
        (F.stddev_samp("_mm") / (F.avg("_mm") + F.lit(1e-6))).alias("seasonality_strength"))


# ----------------------------------------------------------- AGG11 / JN7
HCP_DETAIL_CANDIDATES = ["type_1_npi", "type_2_npi", "prescriber_npi_nm",
                         "prescriber_npi_state_cd", "prescriber_npi_nbr"]


def hcp_detail_columns(columns: list[str]) -> list[str]:
    """PRJ15: descriptive HCP columns present in the input (never hcp_id)."""
    return [c for c in columns if c != "hcp_id"
            and (c in HCP_DETAIL_CANDIDATES or "prescriber" in c.lower())]


def hcp_details(clean: DataFrame) -> DataFrame:
    """AGG11: first non-null value per HCP and column in row order.

    One hash aggregate over the claims finds the earliest date of each
    combination of an HCP's descriptive values (the buffer is one date, nulls
    last); there are few combinations, and the first value of a column is that
    of the earliest combination that has one. Only where two values share the
    earliest date does the rest of the row order decide: the claims of these
    HCPs on these dates are read again, and of no others."""
    cols = hcp_detail_columns(clean.columns)
    made = clean.groupBy("hcp_id", *cols).agg(F.min(ORDER_COLUMNS[0]).alias("_t"))
    return first_values(clean, materialize(made, "hcp-details"))


def first_values(clean: DataFrame, made: DataFrame) -> DataFrame:
    """``hcp_details`` from ``made``: the earliest date ``_t`` of each
    combination of an HCP's descriptive values, a table that is at hand."""
    cols, date = hcp_detail_columns(clean.columns), ORDER_COLUMNS[0]
    when = lambda t: F.struct(t.isNull().alias("late"), t.alias("t"))
    first = made.groupBy("hcp_id").agg(*[F.min(F.when(F.col(c).isNotNull(), when(F.col("_t")))).alias(f"_f_{c}") for c in cols])
    here = {c: F.when(when(F.col("_t")) == F.col(f"_f_{c}"), F.col(c)) for c in cols}
    ends = made.join(first, "hcp_id").groupBy("hcp_id").agg(
        *[f(x).alias(f"_{n}_{c}") for c, x in here.items() for n, f in (("low", F.min), ("high", F.max))],
        *[F.first(f"_f_{c}").alias(f"_f_{c}") for c in cols])
    tied = {c: F.col(f"_low_{c}") != F.col(f"_high_{c}") for c in cols}
    some = reduce(or_, [F.coalesce(t, F.lit(False)) for t in tied.values()], F.lit(False))
    # a row per HCP; stored, the dates have a known size: a few HCPs are broadcast and the claims stay where they are
    ends = materialize(ends, "first-values")
    dates = materialize(ends.where(some).select("hcp_id", *[F.col(f"_f_{c}") for c in cols]), "first-dates")
    if dates.isEmpty():
        return ends.select("hcp_id", *[F.col(f"_low_{c}").alias(c) for c in cols])
    order = order_struct()
    decided = clean.join(dates, "hcp_id").where(reduce(or_, [when(F.col(date)) == F.col(f"_f_{c}") for c in cols])).groupBy("hcp_id").agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull() & (when(F.col(date)) == F.col(f"_f_{c}")), order)).alias(f"_d_{c}") for c in cols])
    return ends.join(decided, "hcp_id", "left").select(
        "hcp_id", *[F.when(tied[c], F.col(f"_d_{c}")).otherwise(F.col(f"_low_{c}")).alias(c) for c in cols])
