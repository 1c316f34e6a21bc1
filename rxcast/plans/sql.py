"""Oracle statements keyed like ``rxcast.plans.queries.QUERIES``."""

from __future__ import annotations

from rxcast.functions.exprs import QUANTILE_FAR, QUANTILE_MIDDLE, QUANTILE_TAIL
from rxcast.plans.landed import SQL_PRELUDE
from rxcast.plans.oracle import D, MARKET_EXPR, RND, with_prelude
from rxcast.sources import dims

SQL: dict[str, str] = {}


def sql(name: str, select: str) -> None:
    SQL[name] = with_prelude(select)


def rnd(expr: str, n: int, alias: str) -> str:
    return f"round({expr}, {n}) AS {alias}"


sql("clean_claims", "SELECT * FROM clean")

# crc32 by its polynomial over the claim number's bytes: which supplier landed the claim
_CRC = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(claim_number, ''), lambda ch: ord(ch)::BIGINT)), lambda c, b: "
        "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)")
sql("claims_csv", f"""SELECT claim_number, hcp_id, company, service_date_dd, transaction_dt, transaction_status, patient_age::DOUBLE AS patient_age,
  days_supply_val::DOUBLE AS days_supply_val, awp_unit_price_amt, {RND('total_paid_amt', 4)} AS total_paid_amt, pharmacy_npi_nbr, reject_reason_1_cd,
  CASE WHEN {_CRC} % 3 <> 2 THEN reject_reason_1_desc END AS reject_reason_1_desc FROM clean""")

sql("base_features", f"""
SELECT claim_number, hcp_id, service_date_dd, CAST(month AS INTEGER) AS month, CAST(quarter AS INTEGER) AS quarter,
  CAST(year AS INTEGER) AS year, CAST(day_of_week AS INTEGER) AS day_of_week, age_group,
  {RND('copay_ratio', 9)} AS copay_ratio
FROM base""")

sql("hcp_temporal", "SELECT hcp_id, " + ", ".join(
    f'{RND(c, 6)} AS {c}' for c in
    ["avg_patient_age", "female_ratio", "age_diversity", "patient_count", "seasonal_variation", "weekend_ratio",
     '"age_group_<18"', '"age_group_18-35"', '"age_group_35-50"', '"age_group_50-65"', '"age_group_65+"'])
    + " FROM temporal")

sql("target_multiplier", f"""
SELECT hcp_id, {RND(f"coalesce(CASE WHEN t <> 0 THEN t END, {D(1.0)})", 9)} AS target_multiplier FROM (
  SELECT hcp_id, {D(1.0)} + greatest({D(-0.5)}, least({D(0.5)},
    stddev_samp(total_paid_amt) / (avg(total_paid_amt) + {D(1e-6)}))) AS t
  FROM clean GROUP BY hcp_id)""")

sql("hcp_transaction", "SELECT hcp_id, " + ", ".join(
    f"{RND(c, 9)} AS {c}" for c in ["medicare_share", "commercial_share", "medicaid_share", "rejection_rate",
                                       "avg_copay_ratio"]) + f", payer_diversity, {RND('specialty_pharmacy_ratio', 9)} AS specialty_pharmacy_ratio FROM trans")

sql("hcp_specialization", f"""
SELECT hcp_id, state, specialization, {RND('specialization_weight', 9)} AS specialization_weight, patient_volume,
  drug_diversity, {RND('primary_drug_share', 9)} AS primary_drug_share, clinical_complexity FROM spec""")

sql("affinity", f"SELECT hcp_id, drug_brand_name, {RND('drug_share', 9)} AS drug_share, {RND('affinity', 9)} AS affinity FROM aff")

sql("rolling_rows", "SELECT claim_number, hcp_id, drug_brand_name, service_date_dd, row_idx, " + ", ".join(
    f"CAST(round(rolling_dec_{n}, 2) AS DOUBLE) AS rolling_sum_{n}, {RND(f'rolling_avg_{n}', 2)} AS rolling_avg_{n}"
    for n in (7, 30, 90)) + " FROM r_rows")

sql("hcp_rolling", f"""
SELECT hcp_id, {RND('sales_trend_30d', 4)} AS sales_trend_30d, {RND('sales_volatility', 4)} AS sales_volatility,
  {RND('growth_rate_90d', 9)} AS growth_rate_90d, {RND('seasonality_strength', 9)} AS seasonality_strength FROM rolling""")

_MK_NAMES = ["efficacy_score", "market_share", "drug_age_years", "competitor_count", "avg_response_rate",
             "side_effect_score"]


def _mk_lit(v):
    return D(v) if isinstance(v, float) else str(v)


def _mk_case(i: int) -> str:
    whens = " ".join(f"WHEN drug_brand_name = '{r[0]}' THEN {_mk_lit(r[i + 1])}" for r in dims.DRUG_MARKET)
    return f"CASE {whens} ELSE {_mk_lit(dims.DRUG_MARKET_DEFAULT[i])} END"


_MK_COLS = ", ".join(
    (f"{RND(_mk_case(i), 4)} AS {k}" if isinstance(dims.DRUG_MARKET_DEFAULT[i], float)
     else f"CAST({_mk_case(i)} AS INTEGER) AS {k}") for i, k in enumerate(_MK_NAMES))

sql("drug_market", f"""
SELECT drug_brand_name AS drug_name, count(*) AS total_volume, count(DISTINCT hcp_id) AS unique_hcps,
  count(DISTINCT patient_id) AS unique_patients, {RND('avg(days_supply_val)', 4)} AS avg_days_supply,
  {RND('any_value(rc)', 4)} AS revenue_concentration, {_MK_COLS}
FROM clean c LEFT JOIN (
  SELECT d, stddev_samp(hs) AS rc FROM (
    SELECT drug_brand_name AS d, hcp_id, coalesce(sum(total_paid_amt), {D(0.0)}) AS hs FROM clean
    WHERE drug_brand_name IS NOT NULL GROUP BY ALL) GROUP BY d) r ON c.drug_brand_name = r.d
WHERE drug_brand_name IS NOT NULL
GROUP BY drug_brand_name""")

sql("hcp_details", "SELECT * FROM details")

sql("mult_market", f"""
SELECT drug_brand_name AS drug_name, {RND(MARKET_EXPR('drug_brand_name'), 6)} AS market_multiplier
FROM (SELECT DISTINCT drug_brand_name FROM clean WHERE drug_brand_name IS NOT NULL)""")

sql("mult_transaction", f"SELECT hcp_id, {RND('transaction_multiplier', 9)} AS transaction_multiplier FROM m_trans")
sql("mult_rolling", f"SELECT hcp_id, {RND('rolling_multiplier', 9)} AS rolling_multiplier FROM m_roll")
sql("mult_payer", f"SELECT hcp_id, {RND('payer_multiplier', 9)} AS payer_multiplier FROM m_payer")
sql("predictions", "SELECT * FROM predictions")


# ---------------------------------------------------------------- phase 4
A, P = "Sales_from_db", "Predicted_sales"
EPS = repr(2.220446049250313e-16)


def ev(name: str, select: str, ctes=(), digits: int = 6, cols: list[str] | None = None) -> None:
    """Wrap ``select`` so that every listed column is rounded like Spark's."""
    inner = f"({select})"
    if cols is None:
        SQL[name] = with_prelude(select, ctes)
    else:
        outs = ", ".join(f"{RND(c, digits)} AS {c}" if c.startswith("~") is False else c[1:] for c in cols)
        SQL[name] = with_prelude(f"SELECT {outs} FROM {inner} q", ctes)


FIN = (f"{A} IS NOT NULL AND NOT isnan({A}) AND NOT isinf({A}) AND {P} IS NOT NULL "
       f"AND NOT isnan({P}) AND NOT isinf({P})")

_R2 = ("CASE WHEN sum(({a} - {m}) * ({a} - {m})) = 0 THEN CASE WHEN sum(({p} - {a}) * ({p} - {a})) = 0 "
       "THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE 1 - sum(({p} - {a}) * ({p} - {a})) / sum(({a} - {m}) * ({a} - {m})) END")

ev("metrics_sales", f"""
SELECT avg(abs({P} - {A})) AS MAE, sqrt(avg(({P} - {A}) * ({P} - {A}))) AS RMSE,
  avg(abs({P} - {A}) / greatest(abs({A}), CAST({EPS} AS DOUBLE))) * 100 AS MAPE,
  {_R2.format(a=A, p=P, m='ma')} AS R2,
  avg(CASE WHEN sign({P} - ma) = sign({A} - ma) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS Direction_Accuracy,
  count(*) AS n
FROM (SELECT * FROM predictions WHERE {FIN}) f, (SELECT avg({A}) AS ma FROM predictions WHERE {FIN}) m""",
   cols=["MAE", "RMSE", "MAPE", "R2", "Direction_Accuracy", "~n"])

ev("metrics_quantity", f"""
SELECT avg(abs(CAST(Predicted_quantity - Quantity_from_DB AS DOUBLE))) AS qty_MAE,
  sqrt(avg(CAST(Predicted_quantity - Quantity_from_DB AS DOUBLE) * CAST(Predicted_quantity - Quantity_from_DB AS DOUBLE))) AS qty_RMSE,
  {_R2.format(a='Quantity_from_DB', p='Predicted_quantity', m='mq')} AS qty_R2
FROM predictions, (SELECT avg(Quantity_from_DB) AS mq FROM predictions)""", cols=["qty_MAE", "qty_RMSE", "qty_R2"])

_MS = SQL["metrics_sales"].split("SELECT ", 1)
ev("metrics_table", """
SELECT Metric, Value FROM (SELECT * FROM ms) UNPIVOT (Value FOR Metric IN (MAE, RMSE, MAPE, R2, Direction_Accuracy))""",
   ctes=[f"""ms AS (SELECT avg(abs({P} - {A})) AS MAE, sqrt(avg(({P} - {A}) * ({P} - {A}))) AS RMSE,
  avg(abs({P} - {A}) / greatest(abs({A}), CAST({EPS} AS DOUBLE))) * 100 AS MAPE,
  {_R2.format(a=A, p=P, m='ma')} AS R2,
  avg(CASE WHEN sign({P} - ma) = sign({A} - ma) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS Direction_Accuracy
FROM (SELECT * FROM predictions WHERE {FIN}) f, (SELECT avg({A}) AS ma FROM predictions WHERE {FIN}) m)"""],
   cols=["~Metric", "Value"])

ev("multiplier_stats", """
SELECT mean, std, min, q25, median, q75, max,
  count(*) FILTER (WHERE Combined_multiplier < q25 - 1.5 * (q75 - q25) OR Combined_multiplier > q75 + 1.5 * (q75 - q25)) AS outliers,
  count(*) FILTER (WHERE Combined_multiplier < q25 - 1.5 * (q75 - q25) OR Combined_multiplier > q75 + 1.5 * (q75 - q25)) / count(*) * 100 AS outlier_pct
FROM predictions, (SELECT avg(Combined_multiplier) AS mean, stddev_samp(Combined_multiplier) AS std,
  min(Combined_multiplier) AS min, quantile_cont(Combined_multiplier, 0.25) AS q25,
  quantile_cont(Combined_multiplier, 0.5) AS median, quantile_cont(Combined_multiplier, 0.75) AS q75,
  max(Combined_multiplier) AS max FROM predictions) s
GROUP BY ALL""", cols=["mean", "std", "min", "q25", "median", "q75", "max", "~outliers", "outlier_pct"])

ev("improvement", f"""
SELECT b AS baseline_mae, e AS ensemble_mae, (1 - e / nullif(b, 0)) * 100 AS improvement_pct FROM (
  SELECT avg(abs({A} - ma)) AS b, avg(abs({A} - {P})) AS e FROM predictions, (SELECT avg({A}) AS ma FROM predictions))""",
   cols=["baseline_mae", "ensemble_mae", "improvement_pct"])

_ERR = f"""err AS (SELECT *, abs({P} - {A}) AS ae, CASE WHEN {A} = 0 THEN NULL ELSE abs({P} - {A}) / {A} * 100 END AS pe,
  sign({P} - {A}) AS dir FROM predictions)"""

ev("error_distribution", "SELECT avg(ae) AS mean_abs_error, median(ae) AS median_abs_error, max(ae) AS max_abs_error, "
   "avg(pe) AS mean_pct_error FROM err", ctes=[_ERR],
   cols=["mean_abs_error", "median_abs_error", "max_abs_error", "mean_pct_error"])

_BINS = [(0, 5, "<5%"), (5, 10, "5-10%"), (10, 20, "10-20%"), (20, 50, "20-50%"), (50, 100, "50-100%"),
         (100, None, ">100%")]
_BIN_CASE = "CASE " + " ".join(
    f"WHEN pe > {lo} AND pe <= {hi} THEN {i}" if hi is not None else f"WHEN pe > {lo} THEN {i}"
    for i, (lo, hi, _n) in enumerate(_BINS)) + " END"
ev("error_bins", f"""
SELECT b.bin_order, b.bin, coalesce(c.cnt, 0) AS count, coalesce(c.cnt, 0) / (SELECT count(*) FROM predictions) * 100 AS pct
FROM (VALUES {', '.join(f"({i}, '{n}')" for i, (_l, _h, n) in enumerate(_BINS))}) b(bin_order, bin)
LEFT JOIN (SELECT {_BIN_CASE} AS bo, count(*) AS cnt FROM err GROUP BY ALL) c ON b.bin_order = c.bo""",
   ctes=[_ERR], cols=["~bin_order", "~bin", "~count", "pct"])

ev("error_bias", """
SELECT avg(CASE WHEN dir > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS over_pct,
  avg(CASE WHEN dir < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS under_pct,
  avg(CASE WHEN dir = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS exact_pct,
  avg(dir) AS bias,
  CASE WHEN abs(avg(dir)) > 0.2 THEN CASE WHEN avg(dir) > 0 THEN 'over-prediction' ELSE 'under-prediction' END
       ELSE 'none' END AS bias_flag
FROM err""", ctes=[_ERR], cols=["over_pct", "under_pct", "exact_pct", "bias", "~bias_flag"])

ev("worst_decile", """
SELECT threshold, n_cases, mean_pct_error, problem_drug, problem_hcp FROM
  (SELECT quantile_cont(pe, 0.9) AS threshold FROM err) t,
  (SELECT count(*) AS n_cases, avg(pe) AS mean_pct_error FROM err WHERE pe > (SELECT quantile_cont(pe, 0.9) FROM err)) b,
  (SELECT Drug_name AS problem_drug FROM err WHERE pe > (SELECT quantile_cont(pe, 0.9) FROM err)
     GROUP BY Drug_name ORDER BY count(*) DESC, Drug_name LIMIT 1) m,
  (SELECT hcp_id AS problem_hcp FROM err WHERE pe > (SELECT quantile_cont(pe, 0.9) FROM err)
     GROUP BY hcp_id ORDER BY sum(ae) DESC, hcp_id DESC LIMIT 1) h""",
   ctes=[_ERR], cols=["threshold", "~n_cases", "mean_pct_error", "~problem_drug", "~problem_hcp"])

ev("by_drug", f"""
SELECT Drug_name, avg(abs({P} - {A})) AS MAE, avg(abs({P} - {A}) / greatest(abs({A}), CAST({EPS} AS DOUBLE))) * 100 AS MAPE
FROM predictions WHERE Drug_name IS NOT NULL GROUP BY Drug_name""", cols=["~Drug_name", "MAE", "MAPE"])

ev("by_company", f"""
SELECT p.Company, {_R2.format(a='p.' + A, p='p.' + P, m='m.ma')} AS R2
FROM predictions p JOIN (SELECT Company, avg({A}) AS ma FROM predictions GROUP BY Company) m ON p.Company = m.Company
GROUP BY p.Company""", cols=["~Company", "R2"])

ev("by_quartile", f"""
SELECT Sales_Quartile, avg(abs({P} - {A}) / greatest(abs({A}), CAST({EPS} AS DOUBLE))) * 100 AS MAPE, count(*) AS n FROM (
  SELECT *, CASE WHEN {A} <= q1 THEN 'Q1 (Low)' WHEN {A} <= q2 THEN 'Q2' WHEN {A} <= q3 THEN 'Q3'
                 WHEN {A} IS NOT NULL THEN 'Q4 (High)' END AS Sales_Quartile
  FROM predictions, (SELECT quantile_cont({A}, 0.25) AS q1, quantile_cont({A}, 0.5) AS q2,
                            quantile_cont({A}, 0.75) AS q3 FROM predictions))
WHERE Sales_Quartile IS NOT NULL GROUP BY Sales_Quartile""", cols=["~Sales_Quartile", "MAPE", "~n"])

ev("stability", f"""
SELECT cvp AS cv_predictions, cva AS cv_actual, cvp / nullif(cva, 0) AS ratio,
  CASE WHEN cvp / nullif(cva, 0) > 1.2 THEN 'overfitting' WHEN cvp / nullif(cva, 0) < 0.8 THEN 'underfitting'
       ELSE 'appropriate' END AS verdict
FROM (SELECT stddev_samp({P}) / nullif(avg({P}), 0) AS cvp, stddev_samp({A}) / nullif(avg({A}), 0) AS cva FROM predictions)""",
   cols=["cv_predictions", "cv_actual", "ratio", "~verdict"])

ev("paired_t", f"""
SELECT n, mean_diff, sd_diff, mean_diff / (sd_diff / sqrt(n)) AS t_stat FROM (
  SELECT count({A} - {P}) AS n, avg({A} - {P}) AS mean_diff, stddev_samp({A} - {P}) AS sd_diff FROM predictions)""",
   cols=["~n", "mean_diff", "sd_diff", "t_stat"])

ev("signed_rank", f"""
SELECT n, w_plus, w_minus, least(w_plus, w_minus) AS w_stat,
  (least(w_plus, w_minus) - n * (n + 1) / 4.0) / sqrt(n * (n + 1) * (2 * n + 1) / 24.0 - tie / 48.0) AS z FROM (
  SELECT CAST(sum(t) AS BIGINT) AS n, sum(npos * r) AS w_plus, sum((t - npos) * r) AS w_minus, sum(t * t * t - t) AS tie FROM (
    SELECT ad, t, npos, sum(t) OVER (ORDER BY ad ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t + (t + 1) / 2.0 AS r
    FROM (SELECT abs(d) AS ad, count(*) AS t, count(*) FILTER (WHERE d > 0) AS npos
          FROM (SELECT {A} - {P} AS d FROM predictions) WHERE d IS NOT NULL AND d <> 0 GROUP BY abs(d))))""",
   cols=["~n", "w_plus", "w_minus", "w_stat", "z"])

# every set of signs of n ranks, and its sum
ev("signed_rank_by_hcp", f"""
SELECT h.*, p_exact FROM (
  SELECT hcp_id, n, w_plus, w_minus, least(w_plus, w_minus) AS w_stat,
    (least(w_plus, w_minus) - n * (n + 1) / 4.0) / sqrt(n * (n + 1) * (2 * n + 1) / 24.0 - tie / 48.0) AS z, tie FROM (
    SELECT hcp_id, CAST(count(*) AS BIGINT) AS n, coalesce(sum(r) FILTER (WHERE d > 0), 0.0) AS w_plus, coalesce(sum(r) FILTER (WHERE d < 0), 0.0) AS w_minus,
      sum(t * t - 1) AS tie FROM (
      SELECT hcp_id, d, count(*) OVER (PARTITION BY hcp_id, abs(d)) AS t,
        rank() OVER (PARTITION BY hcp_id ORDER BY abs(d)) + (count(*) OVER (PARTITION BY hcp_id, abs(d)) - 1) / 2.0 AS r
      FROM (SELECT hcp_id, {A} - {P} AS d FROM predictions) WHERE d IS NOT NULL AND d <> 0) GROUP BY hcp_id)) h
LEFT JOIN (SELECT k, w, least(1.0, 2.0 * count(*) / (1 << k)::DOUBLE)::DOUBLE AS p_exact FROM (
  SELECT k, list_sum(list_transform(range(k), lambda i: CASE WHEN (m >> i) & 1 = 1 THEN i + 1 ELSE 0 END)) AS s FROM (
    SELECT k, unnest(range(1::BIGINT << k)) AS m FROM range(1, 17) x(k))) sets
  JOIN (SELECT unnest(range(137)) AS w) v ON s <= w GROUP BY k, w) law
  ON h.n = law.k AND h.w_stat = law.w AND h.tie = 0""", cols=["~hcp_id", "~n", "w_plus", "w_minus", "w_stat", "z", "p_exact"], digits=9)


def _horner(x: str, coefficients) -> str:
    out = D(coefficients[-1])
    for c in coefficients[-2::-1]:
        out = f"({out} * {x} + {D(c)})"
    return out


def _quantile(p: str) -> str:
    """The normal quantile of a probability in SQL."""
    ratio = lambda x, pair: f"{_horner(x, pair[0])} / {_horner(x, pair[1])}"
    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    return (f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))', QUANTILE_MIDDLE)} "
            f"ELSE sign({p} - 0.5) * CASE WHEN {r} <= 5 THEN {ratio(f'({r} - 1.6)', QUANTILE_TAIL)} ELSE {ratio(f'({r} - 5)', QUANTILE_FAR)} END END")


ev("normal_scores", f"""
SELECT n, w AS w_stat, (ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))) AS z FROM (
  SELECT count(*) AS n, corr(r, m) * corr(r, m) AS w FROM (SELECT r, {_quantile('p')} AS m FROM (
    SELECT r, (row_number() OVER (ORDER BY r) - CAST(0.375 AS DOUBLE)) / (count(*) OVER () + CAST(0.25 AS DOUBLE)) AS p
    FROM (SELECT {P} - {A} AS r FROM predictions) WHERE r IS NOT NULL)))""", cols=["~n", "w_stat", "z"])

ev("heteroscedasticity", f"""
SELECT corr({A}, ({P} - {A}) * ({P} - {A})) AS correlation,
  abs(corr({A}, ({P} - {A}) * ({P} - {A}))) > 0.3 AS heteroscedastic FROM predictions""",
   cols=["correlation", "~heteroscedastic"])

ev("normality", f"""
SELECT n, sk AS skew, ku AS excess_kurtosis, n / 6.0 * (sk * sk + ku * ku / 4.0) AS jb_stat,
  exp(-(n / 6.0 * (sk * sk + ku * ku / 4.0)) / 2.0) AS p_value FROM (
  SELECT count(r) AS n, avg(pow(r - m, 3)) / pow(avg(pow(r - m, 2)), 1.5) AS sk,
    avg(pow(r - m, 4)) / pow(avg(pow(r - m, 2)), 2) - 3 AS ku
  FROM (SELECT {P} - {A} AS r FROM predictions WHERE {P} - {A} IS NOT NULL),
       (SELECT avg({P} - {A}) AS m FROM predictions))""",
   cols=["~n", "skew", "excess_kurtosis", "jb_stat", "p_value"])

_CONTRIB = [("Temporal Patterns", "temporal_multiplier", 1.0), ("Market Dynamics", "market_multiplier", 0.5),
            ("HCP Specialization", "affinity", 0.5), ("Transaction Patterns", "transaction_multiplier", 0.33),
            ("Rolling Trends", "rolling_multiplier", 0.33), ("Payer Mix", "payer_multiplier", 0.33)]
ev("contributions", f"""
SELECT component, impact, share, CAST(row_number() OVER (ORDER BY share DESC, component) AS INTEGER) AS rank,
  sum(share) OVER (ORDER BY share DESC, component ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_share
FROM (SELECT component, impact, impact / sum(impact) OVER () AS share FROM (
  {' UNION ALL '.join(f"SELECT '{n}' AS component, avg(abs({D(w)} * ln({c}))) AS impact FROM predictions_c" for n, c, w in _CONTRIB)}))""",
   cols=["~component", "impact", "share", "~rank", "cumulative_share"])

ev("performance_report", f"""
SELECT grade, assessment, summary_grade, missing_pct, section, item FROM (
  SELECT *, CASE WHEN R2 > 0.8 AND MAPE < 10 THEN 'A' WHEN R2 > 0.6 AND MAPE < 20 THEN 'B'
                 WHEN R2 > 0.4 AND MAPE < 30 THEN 'C' WHEN R2 > 0.2 AND MAPE < 50 THEN 'D' ELSE 'F' END AS grade,
    CASE WHEN R2 > 0.8 AND MAPE < 10 THEN 'Excellent' WHEN R2 > 0.6 AND MAPE < 20 THEN 'Good'
         WHEN R2 > 0.4 AND MAPE < 30 THEN 'Satisfactory' WHEN R2 > 0.2 AND MAPE < 50 THEN 'Needs Improvement'
         ELSE 'Poor' END AS assessment,
    CASE WHEN R2 > 0.8 AND MAPE < 10 THEN 'Excellent (A)' WHEN R2 > 0.6 AND MAPE < 20 THEN 'Good (B)'
         WHEN R2 > 0.4 AND MAPE < 30 THEN 'Satisfactory (C)' ELSE 'Needs Improvement' END AS summary_grade
  FROM ms, (SELECT avg(dir) AS bias FROM err),
    (SELECT ({' + '.join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in ['hcp_id', 'type_1_npi', 'prescriber_npi_nm', 'prescriber_npi_state_cd', 'Drug_generic_name', 'Drug_name', 'Company', 'Sales_from_db', 'Predicted_sales', 'Quantity_from_DB', 'Predicted_quantity', 'Combined_multiplier'])}) / (count(*) * 12) * 100 AS missing_pct FROM predictions)
) x, LATERAL (
  SELECT * FROM (VALUES
    (1, 'strength', 'r2_above_0.6', x.R2 > 0.6),
    (2, 'strength', 'direction_above_70', x.Direction_Accuracy > 70),
    (3, 'improvement', 'mape_above_20', x.MAPE > 20),
    (4, 'improvement', CASE WHEN x.bias > 0 THEN 'bias_over' ELSE 'bias_under' END, abs(x.bias) > 0.2),
    (5, 'risk', 'high: mape_above_30', x.MAPE > 30),
    (6, 'risk', 'medium: missing_above_5', x.missing_pct > 5),
    (7, 'risk', 'low: none_found', NOT (x.MAPE > 30 OR x.missing_pct > 5))
  ) v(k, section, item, keep) WHERE keep
)""", ctes=[_ERR, SQL["metrics_table"].split("WITH ", 1)[1].rsplit("ms AS (", 1)[0].rstrip(",") and
            f"""ms AS (SELECT avg(abs({P} - {A})) / 1 AS MAE, avg(abs({P} - {A}) / greatest(abs({A}), CAST({EPS} AS DOUBLE))) * 100 AS MAPE,
  {_R2.format(a=A, p=P, m='ma')} AS R2,
  avg(CASE WHEN sign({P} - ma) = sign({A} - ma) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS Direction_Accuracy
FROM (SELECT * FROM predictions WHERE {FIN}) f, (SELECT avg({A}) AS ma FROM predictions WHERE {FIN}) m)"""],
   cols=["~grade", "~assessment", "~summary_grade", "missing_pct", "~section", "~item"])


# ---------------------------------------------------------------- phase 5
NUM = ["patient_age", "type_1_npi", "days_supply_val", "awp_unit_price_amt", "total_paid_amt",
       "patient_to_pay_amt", "pharmacy_npi_nbr"]
FEATS = ["patient_age", "days_supply_val", "total_paid_amt", "patient_to_pay_amt", "awp_unit_price_amt"]
STATS = [("Mean", "avg({c})"), ("Std", "stddev_samp({c})"), ("Min", "min({c})"),
         ("Q1", "quantile_cont({c}, 0.25)"), ("Median", "quantile_cont({c}, 0.5)"), ("Q3", "quantile_cont({c}, 0.75)"),
         ("Max", "max({c})"), ("Skew", "skewness({c})"), ("Kurtosis", "kurtosis({c})")]
MSUM = "CAST(CAST(sum(CAST({c} AS DECIMAL(38, 6))) AS VARCHAR) AS DOUBLE)"


def msum(c: str) -> str:
    return MSUM.format(c=c)


ev("basic_stats", " UNION ALL ".join(
    f"SELECT '{n}' AS statistic, " + ", ".join(f"{RND(e.format(c=f'CAST({c} AS DOUBLE)'), 4)} AS {c}" for c in FEATS)
    + " FROM clean" for n, e in STATS))

ev("top_categories", " UNION ALL ".join(f"""
SELECT * FROM (SELECT '{f}' AS feature, {f} AS value, count(*) AS n,
  {RND(f'count(*) / (SELECT count({f}) FROM clean)', 9)} AS share
  FROM clean WHERE {f} IS NOT NULL GROUP BY {f} ORDER BY n DESC, value LIMIT 5)""" for f in
    ["drug_brand_name", "payer_channel_name", "transaction_status"]))

_PAIRS = [(a, b) for i, a in enumerate(NUM) for b in NUM[i + 1:]]
_CORR = f"""corrs AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in _PAIRS)}) v(feature_1, feature_2)
  JOIN (SELECT {', '.join(f"CASE WHEN isnan(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) THEN NULL ELSE corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END AS c_{i}" for i, (a, b) in enumerate(_PAIRS))} FROM clean) x ON true)"""
_CELL = "SELECT '{a}' AS feature_1, '{b}' AS feature_2, count(*) AS n, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c FROM clean WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
ev("correlation_matrix", f"""SELECT feature_1, feature_2, n, {RND('CASE WHEN NOT isnan(c) THEN c END', 6)} AS correlation
FROM ({' UNION ALL '.join(_CELL.format(a=a, b=b) for a in NUM for b in NUM)})""")
ev("correlations", f"""
SELECT feature_1, feature_2, {RND('correlation', 6)} AS correlation,
  CAST(row_number() OVER (ORDER BY abs(correlation) DESC, feature_1, feature_2) AS INTEGER) AS rank FROM (
  SELECT feature_1, feature_2, CASE {' '.join(f"WHEN feature_1 = '{a}' AND feature_2 = '{b}' THEN c_{i}" for i, (a, b) in enumerate(_PAIRS))} END AS correlation
  FROM corrs) WHERE abs(correlation) > 0.5""", ctes=[_CORR])

ev("target_correlations", f"""
SELECT feature, {RND('correlation', 6)} AS correlation FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS feature, CASE WHEN isnan(corr(CAST({c} AS DOUBLE), total_paid_amt)) THEN NULL ELSE corr(CAST({c} AS DOUBLE), total_paid_amt) END AS correlation FROM clean" for c in NUM)})
ORDER BY correlation DESC NULLS LAST, feature LIMIT 10""")

ev("monthly_quarterly", f"""
SELECT level, period, {RND('mean', 4)} AS mean, CAST(round(CAST(s AS DECIMAL(38, 6)), 2) AS DOUBLE) AS sum, count FROM (
  SELECT 'month' AS level, CAST(month(service_date_dd) AS INTEGER) AS period, avg(total_paid_amt) AS mean,
    sum(CAST(total_paid_amt AS DECIMAL(38, 6))) AS s, count(total_paid_amt) AS count
  FROM clean WHERE service_date_dd IS NOT NULL GROUP BY 2
  UNION ALL
  SELECT 'quarter', CAST(quarter(service_date_dd) AS INTEGER), avg(total_paid_amt), sum(CAST(total_paid_amt AS DECIMAL(38, 6))),
    count(total_paid_amt)
  FROM clean WHERE service_date_dd IS NOT NULL GROUP BY 2)""")

ev("month_trend", f"""
SELECT {RND('trend_coef', 4)} AS trend_coef, n_months, CASE WHEN trend_coef > 0 THEN 'Increasing' ELSE 'Decreasing' END AS direction
FROM (SELECT regr_slope(mm, i) AS trend_coef, count(*) AS n_months FROM (
  SELECT mm, CAST(row_number() OVER (ORDER BY m) - 1 AS DOUBLE) AS i FROM (
    SELECT month(service_date_dd) AS m, avg(total_paid_amt) AS mm FROM clean WHERE service_date_dd IS NOT NULL GROUP BY 1)))
WHERE n_months > 1""")

ev("hcp_volume", f"""
SELECT count(n) AS count, {RND('avg(n)', 6)} AS mean, {RND('stddev_samp(n)', 6)} AS std, {RND('min(n)', 6)} AS min,
  {RND('quantile_cont(n, 0.25)', 6)} AS q25, {RND('quantile_cont(n, 0.5)', 6)} AS q50,
  {RND('quantile_cont(n, 0.75)', 6)} AS q75, {RND('max(n)', 6)} AS max
FROM (SELECT hcp_id, CAST(count(*) AS DOUBLE) AS n FROM clean GROUP BY hcp_id)""")

ev("top_hcps", f"""
SELECT hcp_id, {RND('total_paid', 2)} AS total_paid FROM (SELECT hcp_id, {msum('total_paid_amt')} AS total_paid FROM clean GROUP BY hcp_id)
ORDER BY total_paid DESC, hcp_id LIMIT 10""")

ev("hcp_drug_pivot", f"""
PIVOT (SELECT hcp_id, drug_brand_name, CAST(round(CAST(CAST(sum(CAST(total_paid_amt AS DECIMAL(38, 6))) AS VARCHAR) AS DECIMAL(38, 6)), 2) AS DOUBLE) AS s
       FROM clean WHERE drug_brand_name IS NOT NULL GROUP BY ALL)
ON drug_brand_name IN ('ECONOMY', 'Keytruda', 'LARGE', 'Libtayo', 'MEDIUM', 'Opdivo', 'PROMO', 'SMALL', 'STANDARD')
USING first(s) GROUP BY hcp_id""")

ev("hcp_hhi", f"""
SELECT hcp_id, {RND('sum((s / t) * (s / t))', 9)} AS HHI FROM (
  SELECT p.hcp_id, s, t FROM (SELECT hcp_id, drug_brand_name, sum(total_paid_amt) AS s FROM clean
                              WHERE drug_brand_name IS NOT NULL GROUP BY ALL) p
  JOIN (SELECT hcp_id, sum(s) AS t FROM (SELECT hcp_id, drug_brand_name, sum(total_paid_amt) AS s FROM clean
                                         WHERE drug_brand_name IS NOT NULL GROUP BY ALL) GROUP BY hcp_id) q ON p.hcp_id = q.hcp_id
  WHERE t > 0) GROUP BY hcp_id""")

ev("drug_performance", f"""
SELECT drug_brand_name AS Drug, {RND(msum('total_paid_amt'), 2)} AS Total_Sales, {RND('avg(total_paid_amt)', 4)} AS Avg_Sale,
  count(*) AS Volume, count(DISTINCT prescriber_npi_nm) AS Unique_HCPs, count(DISTINCT patient_id) AS Unique_Patients,
  {RND('avg(days_supply_val)', 4)} AS Avg_Days_Supply, {RND('count(*) / (SELECT count(*) FROM clean) * 100', 4)} AS Market_Share
FROM clean WHERE drug_brand_name IS NOT NULL GROUP BY drug_brand_name""")

ev("switching_rate", f"""
SELECT {RND('avg(CASE WHEN k > 1 THEN 1.0 ELSE 0.0 END) * 100', 6)} AS switch_rate, count(*) AS patients
FROM (SELECT patient_id, count(DISTINCT drug_brand_name) AS k FROM clean WHERE patient_id IS NOT NULL GROUP BY patient_id)""")

ev("payer_impact", f"""
SELECT payer_channel_name, count(*) AS claims, {RND('count(*) / (SELECT count(payer_channel_name) FROM clean) * 100', 4)} AS share_pct,
  {RND('avg(total_paid_amt)', 4)} AS mean_paid, {RND('quantile_cont(total_paid_amt, 0.5)', 4)} AS median_paid,
  {RND(msum('total_paid_amt'), 2)} AS sum_paid,
  {RND('avg(CASE WHEN reject_reason_1_cd IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100', 4)} AS rejection_rate,
  {RND('avg(patient_to_pay_amt)', 4)} AS copay_mean, {RND('quantile_cont(patient_to_pay_amt, 0.5)', 4)} AS copay_median
FROM clean WHERE payer_channel_name IS NOT NULL GROUP BY payer_channel_name""")

_CAL = "cal AS (SELECT *, month(service_date_dd) AS month, quarter(service_date_dd) AS quarter, year(service_date_dd) AS year, isodow(service_date_dd) - 1 AS day_of_week FROM clean)"


def _cv_means(key: str) -> str:
    return f"(SELECT stddev_samp(m) / avg(m) FROM (SELECT {key}, avg(total_paid_amt) AS m FROM cal WHERE {key} IS NOT NULL GROUP BY {key}))"


def _top(col: str, src: str = "cal", order: str = "count(*)") -> str:
    return f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY {order} DESC, {col} LIMIT 1)"


_FS_ROWS = [
    ("temporal_demographic", "age_distribution_impact", "1 - (SELECT stddev_samp(patient_age) / avg(patient_age) FROM cal)", "NULL"),
    ("temporal_demographic", "gender_balance", "(SELECT 1 - abs(max(k) / sum(k) - 0.5) * 2 FROM (SELECT patient_gender, count(*) AS k FROM cal WHERE patient_gender IS NOT NULL GROUP BY 1))", "NULL"),
    ("temporal_demographic", "seasonal_patterns", f"coalesce({_cv_means('month')}, 0.1)", "NULL"),
    ("temporal_demographic", "day_of_week_effect", f"coalesce({_cv_means('day_of_week')}, 0.05)", "NULL"),
    ("market_dynamics", "market_hhi", "(SELECT sum(k * k) / (sum(k) * sum(k)) FROM (SELECT drug_brand_name, count(*) AS k FROM cal WHERE drug_brand_name IS NOT NULL GROUP BY 1))", "NULL"),
    ("market_dynamics", "market_leader_share_pct", "(SELECT max(k) / sum(k) * 100 FROM (SELECT drug_brand_name, count(*) AS k FROM cal WHERE drug_brand_name IS NOT NULL GROUP BY 1))", "NULL"),
    ("market_dynamics", "yoy_growth_pct", f"(SELECT CASE WHEN count(*) > 1 THEN (arg_max(s, year) / arg_min(s, year) - 1) * 100 END FROM (SELECT year, {msum('total_paid_amt')} AS s FROM cal WHERE year IS NOT NULL GROUP BY year))", "NULL"),
    ("hcp_specialization", "top_service_line", "(SELECT max(k) FROM (SELECT clinical_service_line, count(*) AS k FROM cal WHERE clinical_service_line IS NOT NULL GROUP BY 1))", _top("clinical_service_line")),
    ("hcp_specialization", "service_line_diversity", "(SELECT count(DISTINCT clinical_service_line) FROM cal)", "NULL"),
    ("hcp_specialization", "avg_claims_per_hcp", "(SELECT avg(k) FROM (SELECT prescriber_npi_nm, count(*) AS k FROM cal WHERE prescriber_npi_nm IS NOT NULL GROUP BY 1))", "NULL"),
    ("hcp_specialization", "top_hcp_share_pct", "(SELECT max(k) FROM (SELECT prescriber_npi_nm, count(*) AS k FROM cal WHERE prescriber_npi_nm IS NOT NULL GROUP BY 1)) / (SELECT count(*) FROM cal) * 100", "NULL"),
    ("transaction", "approval_rate_pct", "(SELECT count(*) FILTER (WHERE transaction_status = 'Dispensed') / count(transaction_status) FROM cal) * 100", "NULL"),
    ("transaction", "overall_rejection_rate_pct", "(SELECT avg(CASE WHEN reject_reason_1_cd IS NOT NULL THEN 1.0 ELSE 0.0 END) FROM cal) * 100", "NULL"),
    ("payer", "payer_diversity_score", "(SELECT ln(sum(k)) - sum(k * ln(k)) / sum(k) FROM (SELECT payer_channel_name, count(*) AS k FROM cal WHERE payer_channel_name IS NOT NULL GROUP BY 1))", "NULL"),
    ("payer", "top_payer_share_pct", f"(SELECT max(s) FROM (SELECT payer_channel_name, {msum('total_paid_amt')} AS s FROM cal WHERE payer_channel_name IS NOT NULL GROUP BY 1)) / (SELECT {msum('total_paid_amt')} FROM cal) * 100",
     f"(SELECT payer_channel_name FROM (SELECT payer_channel_name, {msum('total_paid_amt')} AS s FROM cal WHERE payer_channel_name IS NOT NULL GROUP BY 1) ORDER BY s DESC, payer_channel_name LIMIT 1)"),
]
ev("feature_summary", " UNION ALL ".join(
    f"SELECT '{a}' AS component, '{b}' AS feature, {RND(f'CAST({v} AS DOUBLE)', 6)} AS value, CAST({t} AS VARCHAR) AS text"
    for a, b, v, t in _FS_ROWS), ctes=[_CAL])

ev("top_rejection_reason", """
SELECT reject_reason_1_desc AS reason, count(*) AS count FROM clean WHERE reject_reason_1_desc IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")

ev("rolling_30", f"""
SELECT service_date, CAST(round(s, 2) AS DOUBLE) AS daily_sales,
  {RND("CAST(CAST(sum(s) OVER (ORDER BY service_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS VARCHAR) AS DOUBLE) / count(*) OVER (ORDER BY service_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)", 4)} AS rolling_avg_30,
  CAST(row_number() OVER (ORDER BY service_date) - 1 AS INTEGER) AS day_idx
FROM (SELECT service_date_dd AS service_date, sum(CAST(total_paid_amt AS DECIMAL(38, 6))) AS s FROM clean
      WHERE service_date_dd IS NOT NULL GROUP BY 1)""")

ev("rolling_summary", f"""
SELECT n_days, CASE WHEN l > f THEN 'Increasing' ELSE 'Decreasing' END AS trend_30d, {RND('(cur / l - 1) * 100', 4)} AS current_vs_30d_avg_pct
FROM (SELECT count(*) AS n_days, arg_min(r, i) AS f, arg_max(r, i) AS l, arg_max(d, i) AS cur FROM (
  SELECT CAST(round(s, 2) AS DOUBLE) AS d,
    CAST(CAST(sum(s) OVER (ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS VARCHAR) AS DOUBLE)
      / count(*) OVER (ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS r,
    row_number() OVER (ORDER BY dt) - 1 AS i
  FROM (SELECT service_date_dd AS dt, sum(CAST(total_paid_amt AS DECIMAL(38, 6))) AS s FROM clean
        WHERE service_date_dd IS NOT NULL GROUP BY 1)))
WHERE n_days > 30""")


def _sd_means(key: str, agg: str = "avg") -> str:
    return f"coalesce((SELECT stddev_samp(m) FROM (SELECT {key}, {agg}(total_paid_amt) AS m FROM cal WHERE {key} IS NOT NULL GROUP BY {key})) / {{den}}, 0)"


_IMP = [
    ("Patient Demographics", f"0.5 + coalesce(abs(corr(CAST(patient_age AS DOUBLE), total_paid_amt)), 0) * 0.3 + {_sd_means('patient_gender').format(den='avg(total_paid_amt)')} * 0.2"),
    ("Temporal Patterns", f"0.4 + {_sd_means('month').format(den='avg(total_paid_amt)')} * 0.3 + {_sd_means('quarter').format(den='avg(total_paid_amt)')} * 0.3"),
    ("Drug Characteristics", f"0.6 + {_sd_means('drug_brand_name').format(den='avg(total_paid_amt)')} * 0.4"),
    ("HCP Behavior", f"0.7 + {_sd_means('prescriber_npi_nm', 'sum').format(den=msum('total_paid_amt'))} * 0.3"),
    ("Payer Dynamics", f"0.5 + {_sd_means('payer_channel_name').format(den='avg(total_paid_amt)')} * 0.5"),
    ("Transaction Patterns", "0.3 + avg(CASE WHEN transaction_status = 'Dispensed' THEN 0.0 ELSE 1.0 END) * 0.4 + coalesce(abs(corr(CAST(days_supply_val AS DOUBLE), total_paid_amt)), 0) * 0.3"),
]
_IMP_CTE = "imp AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS category, least(1.0, CAST({e} AS DOUBLE)) AS score FROM cal" for n, e in _IMP) + ")"
ev("importance", f"""
SELECT category, {RND('score', 9)} AS score, CAST(row_number() OVER (ORDER BY score DESC, category) AS INTEGER) AS rank FROM imp""",
   ctes=[_CAL, _IMP_CTE])

ev("insights", f"""
SELECT t.category AS top_category, {RND('t.score', 6)} AS top_score, {_top('drug_brand_name', 'clean')} AS market_leader,
  {RND("(SELECT max(k) / sum(k) * 100 FROM (SELECT drug_brand_name, count(*) AS k FROM clean WHERE drug_brand_name IS NOT NULL GROUP BY 1))", 6)} AS leader_share_pct,
  {RND(f"(SELECT sum(s) FROM (SELECT prescriber_npi_nm, {msum('total_paid_amt')} AS s FROM clean WHERE prescriber_npi_nm IS NOT NULL GROUP BY 1 ORDER BY s DESC, prescriber_npi_nm LIMIT 10)) / (SELECT {msum('total_paid_amt')} FROM clean) * 100", 6)} AS top10_hcp_share_pct,
  (SELECT score FROM imp WHERE category = 'Temporal Patterns') > 0.6 AS strong_seasonality,
  (SELECT score FROM imp WHERE category = 'Payer Dynamics') > 0.7 AS payer_mix_matters
FROM (SELECT * FROM imp ORDER BY score DESC, category LIMIT 1) t""", ctes=[_CAL, _IMP_CTE])


# ---------------------------------------------------------------- phase 6
sql("data_overview", f"""
SELECT count(*) AS claims, count(DISTINCT hcp_id) AS hcps, count(DISTINCT drug_brand_name) AS drugs,
  count(DISTINCT patient_id) AS patients, {RND(msum('total_paid_amt'), 2)} AS total_sales FROM clean""")

ev("prediction_summary", f"""
SELECT {RND(msum(P), 2)} AS total_predicted, {RND(msum(A), 2)} AS total_db, count(*) AS predictions,
  count(DISTINCT hcp_id) AS hcps, count(DISTINCT Drug_name) AS drugs, {RND(f'avg({P})', 4)} AS mean_predicted,
  {RND(f'median({P})', 4)} AS median_predicted, {RND('avg(Combined_multiplier)', 4)} AS mean_multiplier,
  {RND(f"({RND(msum(P), 2)} / {RND(msum(A), 2)} - 1) * 100", 4)} AS uplift_pct
FROM predictions""")

ev("drug_insight", f"""
SELECT Drug_name, ps AS predicted_sales, hs AS historical_sales, pairs,
  {RND('CASE WHEN hs > 0 THEN (ps / hs - 1) * 100 ELSE 0.0 END', 4)} AS uplift_pct
FROM (SELECT Drug_name, {RND(msum(P), 2)} AS ps, {RND(msum(A), 2)} AS hs, count(hcp_id) AS pairs
      FROM predictions GROUP BY Drug_name)""")

ev("top_hcps_predicted", f"""
SELECT hcp_id, predicted_sales, CAST(row_number() OVER (ORDER BY predicted_sales DESC, hcp_id) AS INTEGER) AS rank FROM (
  SELECT hcp_id, {RND(msum(P), 2)} AS predicted_sales FROM predictions GROUP BY hcp_id
  ORDER BY predicted_sales DESC, hcp_id LIMIT 10)""")

ev("top_predictions", f"""
SELECT hcp_id, prescriber_npi_nm, prescriber_npi_state_cd, Drug_name, {P}, {A}, Combined_multiplier
FROM predictions ORDER BY {P} DESC, hcp_id, Drug_generic_name, Drug_name LIMIT 5""")

sql("sample_hcps", "SELECT DISTINCT hcp_id FROM clean ORDER BY hcp_id LIMIT 10")

# ---------------------------------------------------------------- phase 7
_DRUGS = "drugs AS (SELECT DISTINCT drug_brand_name AS drug_name FROM clean WHERE drug_brand_name IS NOT NULL)"


def _lk(col: str, rows, default, dbl: bool = True) -> str:
    lit = (lambda v: D(float(v))) if dbl else (lambda v: f"'{v}'" if isinstance(v, str) else str(v))
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {lit(v)}" for k, v in rows) + f" ELSE {lit(default)} END"


_BUCKET = "CASE WHEN drug_name IN ('Keytruda', 'Opdivo', 'Libtayo') THEN drug_name ELSE 'Others' END"
_POS_COLS = (f"{RND(_lk(_BUCKET, [(r[0], r[1]) for r in dims.DRUG_SHARE], 0.0), 6)} AS market_share, "
             f"{RND(_lk(_BUCKET, [(r[0], r[4]) for r in dims.DRUG_SHARE], 0.0), 6)} AS growth_rate, "
             f"CAST({_lk(_BUCKET, dims.MARKET_RANK, dims.MARKET_RANK_DEFAULT, False)} AS INTEGER) AS market_rank, "
             f"{_lk('drug_name', dims.COMPETITIVE_ADVANTAGE, dims.COMPETITIVE_ADVANTAGE_DEFAULT, False)} AS competitive_advantage")

ev("market_position", f"SELECT drug_name, {_POS_COLS} FROM drugs", ctes=[_DRUGS])

_EFF_COLS = ", ".join(
    f"{RND(_lk('drug_name', [(d, m[i]) for d, m, _a in dims.EFFICACY], dims.EFFICACY_DEFAULT[0][i]), 6)} AS {f}"
    for i, f in enumerate(dims.EFF_FIELDS)) + ", " + ", ".join(
    f"{RND(_lk('drug_name', [(d, a[i]) for d, _m, a in dims.EFFICACY], dims.EFFICACY_DEFAULT[1][i]), 6)} AS {f}"
    for i, f in enumerate(dims.AE_FIELDS))
_PRICE = "pricing AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{r[0]}', {r[1]}, {r[2]}, {r[3]}, {r[4]}, {r[5]!r})" for r in dims.PRICING) + \
    ") v(drug_name, list_price_per_dose, avg_selling_price, medicare_reimbursement, commercial_reimbursement, ipi))"
ev("drug_profile", f"""
SELECT d.drug_name, {_POS_COLS.replace('drug_name', 'd.drug_name')},
  list_filter(['Keytruda', 'Opdivo', 'Libtayo'], lambda x: x <> d.drug_name) AS main_competitors,
  {_EFF_COLS.replace('drug_name', 'd.drug_name')},
  CAST(p.list_price_per_dose AS INTEGER) AS list_price, CAST(p.avg_selling_price AS INTEGER) AS avg_selling_price,
  CASE WHEN p.list_price_per_dose IS NULL THEN NULL WHEN p.list_price_per_dose < 10000 THEN 'Highly competitive'
       WHEN p.list_price_per_dose < 11000 THEN 'Competitive' ELSE 'Premium pricing' END AS price_competitiveness,
  CASE WHEN p.list_price_per_dose IS NULL THEN NULL
       WHEN ((p.medicare_reimbursement + p.commercial_reimbursement) / 2) / p.list_price_per_dose > 0.8 THEN 'Favorable'
       WHEN ((p.medicare_reimbursement + p.commercial_reimbursement) / 2) / p.list_price_per_dose > 0.7 THEN 'Moderate'
       ELSE 'Challenging' END AS reimbursement_favorability
FROM drugs d LEFT JOIN pricing p ON d.drug_name = p.drug_name""", ctes=[_DRUGS, _PRICE])

_POL = dims.PAYER_POLICY
ev("payer_landscape", f"""
SELECT payer, pattern AS matched_policy, covered AS immunotherapy_covered, step AS step_therapy_required,
  coalesce(restr, CAST([] AS VARCHAR[])) AS coverage_restrictions,
  {', '.join(f"{RND(f'r_{b.lower()}', 6)} AS reimbursement_{b.lower()}" for b in dims.KNOWN_BRANDS)},
  {', '.join(f"t_{b.lower()} AS tier_{b.lower()}" for b in dims.KNOWN_BRANDS)},
  'synthetic' AS data_source
FROM (SELECT DISTINCT payer_channel_name AS payer FROM clean WHERE payer_channel_name IS NOT NULL) p
LEFT JOIN (SELECT * FROM (VALUES {', '.join(
    f"('{pat}', {i}, {str(cov).lower()}, {str(step).lower()}, {list(restr)!r}, "
    + ", ".join(D(float(rates[b])) if b in rates else "NULL::DOUBLE" for b in dims.KNOWN_BRANDS) + ", "
    + ", ".join(f"'{tier[b]}'" if b in tier else "NULL::VARCHAR" for b in dims.KNOWN_BRANDS) + ")"
    for i, (pat, cov, step, restr, rates, tier) in enumerate(_POL))})
  v(pattern, priority, covered, step, restr, {', '.join(f'r_{b.lower()}' for b in dims.KNOWN_BRANDS)},
    {', '.join(f't_{b.lower()}' for b in dims.KNOWN_BRANDS)})) pol
  ON contains(p.payer, pol.pattern)
QUALIFY row_number() OVER (PARTITION BY payer ORDER BY priority NULLS LAST) = 1""")

_TXT = "trim(" + "".join("replace(" for _ in range(6)) + "regexp_replace({x}, '<[^>]*>', '', 'g')" + "".join(
    f", '{a}', '{b}')" for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
                                    ("&amp;", "&")]) + ")"
ev("html_rows", f"""
SELECT page_id, row_idx, {_TXT.format(x='cells[1]')} AS filing_type, {_TXT.format(x='cells[4]')} AS filing_date FROM (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS row_idx, regexp_extract_all(r, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS cells FROM (
    SELECT page_id, unnest(rs) AS r, generate_subscripts(rs, 1) AS i FROM (
      SELECT page_id, list_slice(regexp_extract_all(html, '(?is)<ul\\b[^>]*>(.*?)</ul>', 1), 1, 5) AS rs FROM pages)))
WHERE len(cells) >= 4""")

ev("page_cache_keys", """
SELECT page_id, base AS base_url,
  md5(base || CASE WHEN q = '' THEN '' ELSE '[' || array_to_string(list_transform(
    list_sort(list_transform(string_split(q, '&'), lambda x: {'k': split_part(x, '=', 1), 'v': regexp_extract(x, '^[^=]*=(.*)$', 1)})),
    lambda e: '(''' || e.k || ''', ''' || e.v || ''')'), ', ') || ']' END) AS cache_key
FROM (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS base, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages)""")


# Noise from a hash of the row's key and the level: both engines draw the same.
_DIGEST = "md5(concat_ws('|', '42', l.name, coalesce(hcp_id, ''), coalesce(Drug_generic_name, ''), coalesce(Drug_name, '')))"
_PART = f"(CAST(CAST('0x' || substr({_DIGEST}, {{i}}, 8) AS BIGINT) AS DOUBLE) + {D(0.5)}) / {D(4294967296.0)}"
sql("sensitivity", f"""
SELECT noise, {RND('o', 6)} AS original_mae, {RND('n', 6)} AS perturbed_mae, {RND(f"(n - o) / o * {D(100.0)}", 6)} AS mae_change_pct FROM (
  SELECT noise, avg(abs(Sales_from_db - Predicted_sales)) AS o, avg(abs(Sales_from_db - Predicted_sales * ({D(1.0)} + noise * z))) AS n FROM (
    SELECT l.noise, Sales_from_db, Predicted_sales,
      sqrt(ln({_PART.format(i=1)}) * {D(-2.0)}) * cos({_PART.format(i=9)} * (2 * pi())) AS z
    FROM predictions, (VALUES ({D(0.05)}, '5'), ({D(0.1)}, '10'), ({D(0.2)}, '20')) l(noise, name))
  GROUP BY noise)""")


# External intelligence: expected facts straight from part, supplier, pages and events.
def ext(name: str, select: str) -> None:
    SQL[name] = SQL_PRELUDE + select


ext("ext_payloads", """
SELECT 'trials' AS source, (SELECT count(*) FROM p) AS landed, (SELECT count(*) FROM trials) AS valid
UNION ALL SELECT 'label', (SELECT count(*) FROM p), (SELECT count(*) FROM label)
UNION ALL SELECT 'pubmed', (SELECT count(*) FROM p), (SELECT count(*) FROM pubmed)
UNION ALL SELECT 'registry', (SELECT count(*) FROM supplier), (SELECT count(*) FROM registry)""")
ext("ext_trials", """
SELECT key AS drug_name, (p_size % 7)::INT AS total_trials, CASE WHEN p_partkey % 2 = 0 THEN p_size % 7 ELSE 0 END::INT AS active_trials,
  CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size % 7 END::INT AS completed_trials,
  CASE WHEN p_partkey % 3 = 0 THEN p_size % 7 ELSE 0 END::INT AS phase_3_trials, least(5, p_size % 7)::INT AS shown FROM trials""")
ext("ext_label", """
SELECT key AS drug_name, 'BLA' || p_partkey AS approval_date, CASE WHEN p_partkey % 4 <> 0 THEN p_brand ELSE 'Unknown' END AS manufacturer,
  p_type AS indications, 'Not available' AS warnings, 'Not available' AS adverse_reactions FROM label""")
ext("ext_registry", "SELECT npi, name, 'MD' AS credential, specialty, state, '' AS enumeration_date FROM registry")
ext("ext_pubmed", """
SELECT key AS drug_name, p_size AS total_publications, array_to_string(list_transform(range(1, least(10, p_size + 1) + 1), lambda i: i::VARCHAR), ',') AS recent_pmids
FROM pubmed""")
ext("ext_efficacy_sources", """
SELECT drug_name, CASE WHEN f AND t THEN 'fda+clinicaltrials' WHEN f THEN 'fda' WHEN t THEN 'clinicaltrials.gov' ELSE 'synthetic' END
    || CASE WHEN (f OR t) AND m THEN '+pubmed' ELSE '' END AS data_source, t AS has_trials, f AS has_label, m AS has_pubmed
FROM (SELECT key AS drug_name, key IN (SELECT key FROM trials) AS t, key IN (SELECT key FROM label) AS f, key IN (SELECT key FROM pubmed) AS m
      FROM (SELECT DISTINCT key FROM p))""")
SQL["ext_market_source"] = f"""
WITH found AS ({SQL['html_rows']}), hosts AS (SELECT page_id, regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) AS company FROM pages),
each AS (SELECT company, count(found.page_id)::BIGINT AS total_found FROM hosts LEFT JOIN found USING (page_id) WHERE company IS NOT NULL GROUP BY company),
every AS (SELECT * FROM each UNION ALL SELECT NULL, coalesce(sum(total_found), 0)::BIGINT FROM each)
SELECT company, total_found, CASE WHEN total_found > 0 THEN 'sec_filings' ELSE 'synthetic' END AS data_source FROM every"""
SQL["ext_snapshot_asof"] = """
WITH r AS (SELECT event_id AS request_id, user_id AS key, ts FROM events WHERE event_type = 'purchase'),
s AS (SELECT user_id AS key, date_trunc('minute', ts) AS t, event_type, event_id FROM events WHERE event_type IN ('view', 'click'))
SELECT request_id, key, event_type, event_id FROM (
  SELECT r.request_id, r.key, s.event_type, s.event_id, row_number() OVER (PARTITION BY r.request_id ORDER BY s.t DESC NULLS LAST, s.event_type DESC, s.event_id DESC) AS i
  FROM r LEFT JOIN s ON r.key = s.key AND s.t <= r.ts AND s.t > r.ts - INTERVAL 24 HOUR) WHERE i = 1"""
SQL["ext_hcp_profiles"] = with_prelude("""
SELECT c.hcp_id AS npi, CASE WHEN s.s_suppkey IS NULL THEN 'synthetic' ELSE 'npi_registry' END AS data_source, 'Dr ' || s_name AS name,
  CASE WHEN s_suppkey % 3 <> 0 THEN 'class ' || s_nationkey WHEN s_suppkey IS NOT NULL THEN 'Unknown' END AS specialization, 'S' || (s_suppkey % 9) AS state
FROM (SELECT DISTINCT hcp_id FROM clean) c LEFT JOIN supplier s
  ON c.hcp_id = (s_suppkey + 1000000000)::VARCHAR AND s_suppkey % 8 <> 1 AND s_suppkey % 6 <> 2""")
SQL["ext_latest_snapshot"] = """
SELECT key, event_type, event_id FROM (SELECT user_id AS key, event_type, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_type DESC, event_id DESC) AS r FROM events) WHERE r = 1"""
ext("ext_fetch_statistics", """
SELECT count(*) AS real_data_attempts, sum(t + f + m + r)::BIGINT AS real_data_successes, count(*) FILTER (WHERE t + f + r = 0) AS synthetic_fallbacks,
  round(sum(t + f + m + r) / count(*) * 100, 2)::DOUBLE AS success_rate_percent
FROM (SELECT key, (SELECT count(*) FROM trials x WHERE x.key = k.key) AS t, (SELECT count(*) FROM label x WHERE x.key = k.key) AS f,
        (SELECT count(*) FROM pubmed x WHERE x.key = k.key) AS m, 0 AS r FROM (SELECT DISTINCT key FROM p) k
      UNION ALL SELECT (s_suppkey + 1000000000)::VARCHAR, 0, 0, 0, CASE WHEN s_suppkey % 8 <> 1 AND s_suppkey % 6 <> 2 THEN 1 ELSE 0 END FROM supplier)""")
sql("hcp_drug_sales", """
SELECT hcp_id, drug_brand_name, CAST(CAST(round(sum(CAST(total_paid_amt AS DECIMAL(38, 6))), 2) AS VARCHAR) AS DOUBLE) AS paid FROM clean
WHERE hcp_id IS NOT NULL AND drug_brand_name IS NOT NULL AND total_paid_amt IS NOT NULL GROUP BY ALL""")

sql("hcp_drug_matrix", """
SELECT * FROM (WITH sales AS (SELECT hcp_id, drug_brand_name, CAST(CAST(round(sum(CAST(total_paid_amt AS DECIMAL(38, 6))), 2) AS VARCHAR) AS DOUBLE) AS paid FROM clean
  WHERE hcp_id IS NOT NULL AND drug_brand_name IS NOT NULL GROUP BY ALL),
brands AS (SELECT drug_brand_name, CAST(row_number() OVER (ORDER BY drug_brand_name) - 1 AS INTEGER) AS position
  FROM (SELECT DISTINCT drug_brand_name FROM clean WHERE drug_brand_name IS NOT NULL))
SELECT h.hcp_id, b.position, b.drug_brand_name, s.paid FROM (SELECT DISTINCT hcp_id FROM sales) h CROSS JOIN brands b
LEFT JOIN sales s ON s.hcp_id = h.hcp_id AND s.drug_brand_name = b.drug_brand_name)""")

# The fitted component has no SQL form; the prediction without it has.
SQL["predictions_five_factor"] = SQL.pop("predictions")

ev("component_lines", f"""
SELECT CASE WHEN r = 1 THEN 'strongest' ELSE 'weakest' END AS section, component AS item, {RND('share', 6)} AS share FROM (
  SELECT component, impact / sum(impact) OVER () AS share, row_number() OVER (ORDER BY impact DESC, component) AS r, count(*) OVER () AS k FROM (
  {' UNION ALL '.join(f"SELECT '{n}' AS component, avg(abs({D(w)} * ln({c}))) AS impact FROM predictions_c" for n, c, w in _CONTRIB)}))
WHERE r IN (1, k)""")
