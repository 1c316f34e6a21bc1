"""DuckDB oracle SQL for the registered queries.

Every statement starts from the same CTE prelude: the claims view over the
star-schema tables, the cleaning rules and the base features, written
independently of the Spark code in plain SQL. Numeric constants are cast to
DOUBLE (DuckDB literals are DECIMAL) so arithmetic matches Spark's doubles.
"""

from __future__ import annotations

from rxcast.sources import dims


def D(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def RND(expr: str, n: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal text of
    the value (DuckDB's own double ``round`` scales in floating point)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def DBL(expr: str) -> str:
    """Correctly rounded DECIMAL -> DOUBLE (DuckDB's direct cast can be 1 ulp off)."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DOUBLE)"


def _case(expr: str, mapping, default: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping)
    return f"CASE {whens} ELSE {default} END"


ORDER = ("service_date_dd NULLS LAST, claim_number NULLS LAST, drug_brand_name NULLS LAST, "
         "total_paid_amt NULLS LAST, patient_id NULLS LAST, days_supply_val NULLS LAST")

_GENERIC = [("0", "Cemiplimab-Rwlc"), ("1", "Nivolumab"), ("2", "Pembrolizumab")]
_BRAND = [("0", "Libtayo"), ("1", "Opdivo"), ("2", "Keytruda")]
_SEG = [("AUTOMOBILE", "Medicare"), ("BUILDING", "Commercial"), ("FURNITURE", "Medicaid"),
        ("HOUSEHOLD", "Other")]

CLAIMS = f"""
claims AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS claim_number,
    CAST(o.o_custkey AS VARCHAR) AS patient_id,
    CAST(18 + c.c_custkey % 67 AS INTEGER) AS patient_age,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS patient_gender,
    CASE WHEN l.l_quantity = 50 THEN NULL ELSE CAST(1000000000 + l.l_suppkey AS DOUBLE) END AS type_1_npi,
    s.s_name AS prescriber_npi_nm,
    n.n_name AS prescriber_npi_state_cd,
    CASE CAST(l.l_partkey % 4 AS VARCHAR) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _GENERIC)} ELSE p.p_type END AS drug_generic_name,
    CASE CAST(l.l_partkey % 4 AS VARCHAR) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _BRAND)} ELSE p.p_type END AS drug_brand_name,
    CAST(l.l_shipdate AS TIMESTAMP) AS service_date_dd,
    CAST(o.o_orderdate AS TIMESTAMP) AS transaction_dt,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'Reject'
         WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN 'Reversed'
         WHEN l.l_returnflag = 'N' AND l.l_tax = 0 THEN NULL
         ELSE 'Dispensed' END AS transaction_status,
    CAST(trunc(l.l_quantity) AS INTEGER) AS days_supply_val,
    p.p_retailprice AS awp_unit_price_amt,
    CASE WHEN l.l_discount = 0 THEN {D(0.0)} ELSE l.l_extendedprice * ({D(1.0)} - l.l_discount) END AS total_paid_amt,
    l.l_extendedprice * l.l_tax AS patient_to_pay_amt,
    {_case('c.c_mktsegment', _SEG, "'Dual (Medicaid/Medicare)'")} AS payer_channel_name,
    substr(o.o_orderpriority, 3) AS payer_name,
    p.p_type AS clinical_service_line,
    CASE WHEN l.l_linenumber >= 6 THEN 'MR' END AS reject_reason_1_cd,
    CASE WHEN l.l_linenumber >= 6 THEN CASE WHEN l.l_partkey % 3 = 0 THEN 'Prior authorization' ELSE 'Not covered' END END AS reject_reason_1_desc,
    CAST(2000000000 + l.l_partkey % 15 AS BIGINT) AS pharmacy_npi_nbr
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

_COMPANY = " ".join(f"WHEN drug_generic_name = '{g}' THEN '{c}'" for g, _b, c in dims.DRUG_COMPANY)

CLEAN = f"""
clean AS (
  SELECT * REPLACE (
      CASE WHEN total_paid_amt = 0 THEN days_supply_val * awp_unit_price_amt ELSE total_paid_amt END AS total_paid_amt),
    CASE WHEN CAST(trunc(coalesce(type_1_npi, 0)) AS BIGINT) = 0 THEN 'Unknown'
         ELSE CAST(CAST(trunc(type_1_npi) AS BIGINT) AS VARCHAR) END AS hcp_id,
    CASE {_COMPANY} ELSE 'Unknown' END AS company
  FROM claims
  WHERE transaction_status IS NULL OR transaction_status NOT IN ('Reject', 'Reversed')
)"""

BASE = f"""
base AS (
  SELECT *,
    month(service_date_dd) AS month,
    quarter(service_date_dd) AS quarter,
    year(service_date_dd) AS year,
    isodow(service_date_dd) - 1 AS day_of_week,
    CASE WHEN patient_age > 0 AND patient_age <= 18 THEN '<18'
         WHEN patient_age > 18 AND patient_age <= 35 THEN '18-35'
         WHEN patient_age > 35 AND patient_age <= 50 THEN '35-50'
         WHEN patient_age > 50 AND patient_age <= 65 THEN '50-65'
         WHEN patient_age > 65 AND patient_age <= 100 THEN '65+'
         ELSE '35-50' END AS age_group,
    CASE WHEN total_paid_amt + 1 = 0 OR patient_to_pay_amt IS NULL OR total_paid_amt IS NULL THEN {D(0.0)}
         WHEN isinf(patient_to_pay_amt / (total_paid_amt + 1)) OR isnan(patient_to_pay_amt / (total_paid_amt + 1)) THEN {D(0.0)}
         ELSE patient_to_pay_amt / (total_paid_amt + 1) END AS copay_ratio
  FROM clean
)"""

AGE_LABELS = ["<18", "18-35", "35-50", "50-65", "65+"]

TEMPORAL = f"""
t_month AS (
  SELECT hcp_id, month, coalesce(sum(total_paid_amt), {D(0.0)}) AS ms FROM base WHERE month IS NOT NULL GROUP BY hcp_id, month
),
t_season AS (SELECT hcp_id, stddev_samp(ms) AS seasonal_variation FROM t_month GROUP BY hcp_id),
temporal AS (
  SELECT m.hcp_id,
    coalesce(CAST(avg(patient_age) AS DOUBLE), {D(0.0)}) AS avg_patient_age,
    coalesce(avg(CASE WHEN patient_gender = 'F' THEN 1 ELSE 0 END), {D(0.0)}) AS female_ratio,
    coalesce(CASE WHEN count(*) > 1 THEN stddev_samp(patient_age) END, {D(0.0)}) AS age_diversity,
    CAST(count(DISTINCT patient_id) + max(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END) AS DOUBLE) AS patient_count,
    coalesce(any_value(s.seasonal_variation), {D(0.0)}) AS seasonal_variation,
    coalesce(avg(CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END), {D(0.0)}) AS weekend_ratio,
    {', '.join(f'''coalesce(avg(CASE WHEN age_group = '{g}' THEN 1 ELSE 0 END), {D(0.0)}) AS "age_group_{g}"''' for g in AGE_LABELS)}
  FROM base m LEFT JOIN t_season s ON m.hcp_id = s.hcp_id
  GROUP BY m.hcp_id
)"""

TRANSACTION = f"""
trans AS (
  SELECT hcp_id,
    coalesce(count(CASE WHEN payer_channel_name = 'Medicare' THEN 1 END) / nullif(count(payer_channel_name), 0), {D(0.0)}) AS medicare_share,
    coalesce(count(CASE WHEN payer_channel_name = 'Commercial' THEN 1 END) / nullif(count(payer_channel_name), 0), {D(0.0)}) AS commercial_share,
    coalesce(count(CASE WHEN payer_channel_name = 'Medicaid' THEN 1 END) / nullif(count(payer_channel_name), 0), {D(0.0)}) AS medicaid_share,
    avg(CASE WHEN reject_reason_1_cd IS NOT NULL THEN 1 ELSE 0 END) AS rejection_rate,
    avg(copay_ratio) AS avg_copay_ratio,
    count(DISTINCT payer_name) AS payer_diversity,
    count(DISTINCT pharmacy_npi_nbr) / count(*) AS specialty_pharmacy_ratio
  FROM base GROUP BY hcp_id
),
m_trans AS (
  SELECT hcp_id, greatest({D(0.8)}, least({D(1.3)},
    ({D(1.0)} + {D(0.2)} * commercial_share) * ({D(1.0)} - {D(0.1)} * rejection_rate)
    * ({D(1.0)} + {D(0.05)} * payer_diversity / {D(10.0)}))) AS transaction_multiplier
  FROM trans
)"""

ROLLING = f"""
r_rows0 AS (
  SELECT hcp_id, drug_brand_name, service_date_dd, claim_number, total_paid_amt, patient_id, days_supply_val,
    row_number() OVER (PARTITION BY hcp_id ORDER BY {ORDER}) - 1 AS row_idx,
    {', '.join(f'''CASE WHEN drug_brand_name IS NOT NULL THEN sum(CAST(total_paid_amt AS DECIMAL(38, 6))) OVER (PARTITION BY hcp_id, drug_brand_name ORDER BY {ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END AS rolling_dec_{n},
    CASE WHEN drug_brand_name IS NOT NULL THEN count(total_paid_amt) OVER (PARTITION BY hcp_id, drug_brand_name ORDER BY {ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END AS rolling_cnt_{n}''' for n in (7, 30, 90))}
  FROM clean
),
r_rows AS (
  SELECT *, {', '.join(f"{DBL(f'rolling_dec_{n}')} AS rolling_sum_{n}, {DBL(f'rolling_dec_{n}')} / nullif(rolling_cnt_{n}, 0) AS rolling_avg_{n}" for n in (7, 30, 90))}
  FROM r_rows0
),
r_season AS (
  SELECT hcp_id, stddev_samp(mm) / (avg(mm) + {D(1e-6)}) AS seasonality_strength
  FROM (SELECT hcp_id, month(service_date_dd) AS m, avg(total_paid_amt) AS mm FROM clean
        WHERE service_date_dd IS NOT NULL GROUP BY hcp_id, month(service_date_dd))
  GROUP BY hcp_id
),
r_feat AS (
  SELECT hcp_id,
    CASE WHEN count(*) < 2 THEN {D(0.0)} ELSE coalesce(regr_slope(coalesce(rolling_sum_30, {D(0.0)}), CAST(row_idx AS DOUBLE)), {D(0.0)}) END AS sales_trend_30d,
    stddev_samp(total_paid_amt) AS sales_volatility,
    count(*) AS n,
    coalesce(arg_min_null(rolling_sum_90, row_idx), {D(0.0)}) AS first_v,
    coalesce(arg_max_null(rolling_sum_90, row_idx), {D(0.0)}) AS last_v
  FROM r_rows GROUP BY hcp_id
),
rolling AS (
  SELECT f.hcp_id, sales_trend_30d, sales_volatility,
    CASE WHEN n < 2 OR first_v = 0 THEN {D(0.0)} ELSE (last_v - first_v) / first_v END AS growth_rate_90d,
    s.seasonality_strength
  FROM r_feat f LEFT JOIN r_season s ON f.hcp_id = s.hcp_id
),
m_roll AS (
  SELECT hcp_id, greatest({D(0.7)}, least({D(1.5)},
    ({D(1.0)} + {D(0.1)} * sign(sales_trend_30d)) * ({D(1.0)} + {D(0.05)} * greatest({D(-0.5)}, least({D(0.5)}, growth_rate_90d))))) AS rolling_multiplier
  FROM rolling
)"""

_SCORE = " ".join(f"WHEN payer_channel_name = '{n}' THEN {D(r * m)}" for n, r, m in dims.PAYER_SCORE)
PAYER = f"""
m_payer AS (
  SELECT hcp_id, greatest({D(0.8)}, least({D(1.4)}, coalesce({D(0.7)} + avg(CASE {_SCORE} END) * {D(0.6)}, {D(1.0)}))) AS payer_multiplier
  FROM clean GROUP BY hcp_id
)"""

_SPEC_W = " ".join(f"WHEN {i} THEN {D(w)}" for i, (_n, w, _v) in enumerate(dims.SPECIALIZATION))
_SPEC_V = " ".join(f"WHEN {i} THEN {v}" for i, (_n, _w, v) in enumerate(dims.SPECIALIZATION))
_SPEC_N = " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _w, _v) in enumerate(dims.SPECIALIZATION))
SPEC = f"""
s_cls AS (
  SELECT hcp_id, CAST(('0x' || substr(md5(hcp_id), 1, 8))::BIGINT % 3 AS INTEGER) AS cls FROM (SELECT DISTINCT hcp_id FROM clean)
),
s_state AS (
  SELECT hcp_id, prescriber_npi_state_cd AS state FROM (
    SELECT hcp_id, prescriber_npi_state_cd, row_number() OVER (PARTITION BY hcp_id ORDER BY count(*) DESC, prescriber_npi_state_cd) AS rk
    FROM clean WHERE prescriber_npi_state_cd IS NOT NULL GROUP BY hcp_id, prescriber_npi_state_cd) WHERE rk = 1
),
s_drug AS (
  SELECT hcp_id, count(*) AS drug_diversity, max(n) / sum(n) AS primary_drug_share FROM (
    SELECT hcp_id, drug_brand_name, count(*) AS n FROM clean WHERE drug_brand_name IS NOT NULL GROUP BY ALL) GROUP BY hcp_id
),
spec AS (
  SELECT c.hcp_id, coalesce(st.state, 'Unknown') AS state,
    CASE c.cls {_SPEC_N} END AS specialization,
    CASE c.cls {_SPEC_W} END AS specialization_weight,
    CASE c.cls {_SPEC_V} END AS patient_volume,
    coalesce(d.drug_diversity, 0) AS drug_diversity,
    coalesce(d.primary_drug_share, {D(0.0)}) AS primary_drug_share,
    cc.clinical_complexity
  FROM s_cls c LEFT JOIN s_state st ON c.hcp_id = st.hcp_id LEFT JOIN s_drug d ON c.hcp_id = d.hcp_id
  LEFT JOIN (SELECT hcp_id, count(DISTINCT clinical_service_line) AS clinical_complexity FROM clean GROUP BY hcp_id) cc
    ON c.hcp_id = cc.hcp_id
),
aff AS (
  SELECT p.hcp_id, p.drug_brand_name, CAST(p.n AS DOUBLE) / t.tot AS drug_share,
    greatest({D(0.5)}, least({D(1.8)}, s.specialization_weight * {D(0.4)} + (CAST(p.n AS DOUBLE) / t.tot) * {D(0.3)}
      + (s.patient_volume / {D(200.0)}) * {D(0.3)})) AS affinity
  FROM (SELECT hcp_id, drug_brand_name, count(*) AS n FROM clean GROUP BY ALL) p
  JOIN (SELECT hcp_id, count(*) AS tot FROM clean GROUP BY hcp_id) t ON p.hcp_id = t.hcp_id
  JOIN spec s ON p.hcp_id = s.hcp_id
  WHERE p.drug_brand_name IS NOT NULL
)"""


def _market_expr(col: str) -> str:
    def lk(i):
        w = " ".join(f"WHEN {col} = '{r[0]}' THEN {D(float(r[i + 1]))}" for r in dims.DRUG_MARKET)
        return f"(CASE {w} ELSE {D(float(dims.DRUG_MARKET_DEFAULT[i]))} END)"
    eff, share, age, side = lk(0), lk(1), lk(2), lk(5)
    m = (f"({D(1.0)} + {D(0.3)} * {eff}) * ({D(1.0)} + {D(0.2)} * {share}) * ({D(1.0)} - {D(0.1)} * {side})"
         f" * ({D(1.0)} + {D(0.05)} * ln({D(1.0)} + {age}))")
    return f"greatest({D(0.7)}, least({D(1.5)}, {m}))"


MARKET_EXPR = _market_expr

DETAILS = f"""
d_rows AS (SELECT *, row_number() OVER (PARTITION BY hcp_id ORDER BY {ORDER}) AS rn FROM clean),
details AS (
  SELECT hcp_id,
    arg_min(type_1_npi, rn) FILTER (WHERE type_1_npi IS NOT NULL) AS type_1_npi,
    arg_min(prescriber_npi_nm, rn) FILTER (WHERE prescriber_npi_nm IS NOT NULL) AS prescriber_npi_nm,
    arg_min(prescriber_npi_state_cd, rn) FILTER (WHERE prescriber_npi_state_cd IS NOT NULL) AS prescriber_npi_state_cd
  FROM d_rows GROUP BY hcp_id
)"""

PREDICTIONS = f"""
p_groups AS (
  SELECT hcp_id, drug_generic_name, drug_brand_name,
    {DBL('sum(CAST(total_paid_amt AS DECIMAL(38, 6)))')} AS sales, count(*) AS qty
  FROM clean WHERE drug_generic_name IS NOT NULL AND drug_brand_name IS NOT NULL
  GROUP BY ALL
),
p_mult AS (
  SELECT g.*, {D(1.0)} AS temporal_multiplier, {_market_expr('g.drug_brand_name')} AS market_multiplier,
    coalesce(a.affinity, {D(1.0)}) AS affinity, coalesce(t.transaction_multiplier, {D(1.0)}) AS transaction_multiplier,
    coalesce(r.rolling_multiplier, {D(1.0)}) AS rolling_multiplier, coalesce(p.payer_multiplier, {D(1.0)}) AS payer_multiplier,
    {D(1.0)}
    * pow({_market_expr('g.drug_brand_name')}, {D(0.5)})
    * pow(coalesce(a.affinity, {D(1.0)}), {D(0.5)})
    * pow(coalesce(t.transaction_multiplier, {D(1.0)}), {D(0.33)})
    * pow(coalesce(r.rolling_multiplier, {D(1.0)}), {D(0.33)})
    * pow(coalesce(p.payer_multiplier, {D(1.0)}), {D(0.33)}) AS mult
  FROM p_groups g
  LEFT JOIN aff a ON g.hcp_id = a.hcp_id AND g.drug_brand_name = a.drug_brand_name
  LEFT JOIN m_trans t ON g.hcp_id = t.hcp_id
  LEFT JOIN m_roll r ON g.hcp_id = r.hcp_id
  LEFT JOIN m_payer p ON g.hcp_id = p.hcp_id
),
predictions_c AS (
  SELECT m.hcp_id, d.type_1_npi, d.prescriber_npi_nm, d.prescriber_npi_state_cd,
    m.drug_generic_name AS Drug_generic_name, m.drug_brand_name AS Drug_name,
    CASE {_COMPANY.replace('drug_generic_name', 'm.drug_generic_name')} ELSE 'Unknown' END AS Company,
    {RND(f"coalesce(m.sales, {D(0.0)})", 2)} AS Sales_from_db,
    {RND(f"coalesce(m.sales, {D(0.0)}) * m.mult", 2)} AS Predicted_sales,
    CAST(m.qty AS INTEGER) AS Quantity_from_DB,
    CAST(trunc(m.qty * m.mult) AS INTEGER) AS Predicted_quantity,
    {RND("m.mult", 3)} AS Combined_multiplier,
    m.temporal_multiplier, m.market_multiplier, m.affinity, m.transaction_multiplier, m.rolling_multiplier,
    m.payer_multiplier
  FROM p_mult m LEFT JOIN details d ON m.hcp_id = d.hcp_id
),
predictions AS (
  SELECT * EXCLUDE (temporal_multiplier, market_multiplier, affinity, transaction_multiplier, rolling_multiplier,
                    payer_multiplier) FROM predictions_c
)"""

PRELUDE = [CLAIMS, CLEAN, BASE, TEMPORAL, TRANSACTION, ROLLING, PAYER, SPEC, DETAILS, PREDICTIONS]


def with_prelude(select: str, ctes: list[str] | tuple = ()) -> str:
    return "WITH " + ",".join([*PRELUDE, *ctes]) + "\n" + select
