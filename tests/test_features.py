"""Features, ordered operators and multipliers, checked against pandas brute
force on small frames (including a hot group spread over many buckets)."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL, claims_rows
from rxcast.operators import clean as cl
from rxcast.operators import features as fe
from rxcast.operators import multipliers as mu
from rxcast.operators import profile as pf
from rxcast.operators.ordered import day_bucket, positions, rolling_rows
from rxcast.sources import dims
from rxcast.sources.claims import claims_from_star


def test_rolling_across_pieces_of_a_hot_group(spark, monkeypatch):
    """A third of the claims in one HCP, cut into many pieces; windows that span several pieces, null drugs and null values."""
    from rxcast.operators import ordered
    rows = [{"hcp_id": r["hcp"], "drug_brand_name": r["drug"], "service_date_dd": r["d"] if i % 9 else None, "claim_number": r["k"],
             "total_paid_amt": r["v"], "patient_id": None, "days_supply_val": 1} for i, r in enumerate(_rows(3000, 11))]
    df = spark.createDataFrame(rows, "hcp_id string, drug_brand_name string, service_date_dd timestamp_ntz, claim_number string, total_paid_amt double, "
                                     "patient_id string, days_supply_val int").repartition(7)
    want = {r.claim_number: tuple(r) for r in fe.claim_rolling(df, (7, 30, 90), ("claim_number",)).collect()}
    monkeypatch.setattr(ordered, "TARGET_ROWS", 100)
    monkeypatch.setattr(ordered, "PER_PIECE", 10)
    cut = ordered.split_buckets(df, ["hcp_id"], "service_date_dd", "claim_number", days=None)
    assert cut.where("hcp_id = 'H0'").select("_piece").distinct().count() > 8
    got = {r.claim_number: tuple(r) for r in fe.claim_rolling(df, (7, 30, 90), ("claim_number",)).collect()}
    assert got == want and len(got) == 3000
    pdf = pd.DataFrame(rows).sort_values(["hcp_id", "service_date_dd", "claim_number"], na_position="last")
    pdf["pos"] = pdf.groupby("hcp_id").cumcount()
    for n in (7, 30, 90):
        pdf[f"s{n}"] = pdf.groupby(["hcp_id", "drug_brand_name"])["total_paid_amt"].transform(lambda x, n=n: x.rolling(n, min_periods=1).sum())
    for r in pdf.itertuples():
        mine = want[r.claim_number]
        assert mine[2] == r.pos
        for i, s in ((5, r.s7), (7, r.s30), (9, r.s90)):
            assert (mine[i] is None and (pd.isna(s))) or math.isclose(mine[i], s, abs_tol=1e-6)


def _rows(n=400, seed=7, hot="H0"):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hcp = hot if rnd.random() < 0.5 else f"H{rnd.randint(1, 4)}"
        rows.append({"hcp": hcp, "drug": rnd.choice(["A", "B", None]),
                     "d": dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 40)),
                     "k": f"c{i:04d}", "v": None if rnd.random() < 0.05 else round(rnd.uniform(-50, 500), 3)})
    return rows


def test_positions_match_pandas_rank_with_hot_group(spark):
    rows = _rows()
    df = spark.createDataFrame(pd.DataFrame(rows))
    out = positions(df, ["hcp"], [F.col("d"), F.col("k")], day_bucket("d"),
                    {"v": F.coalesce(F.col("v"), F.lit(0.0))}).toPandas()
    pdf = pd.DataFrame(rows).sort_values(["hcp", "d", "k"])
    pdf["pos"] = pdf.groupby("hcp").cumcount()
    pdf["cum"] = pdf.assign(v=pdf.v.fillna(0)).groupby("hcp")["v"].cumsum()
    m = out.merge(pdf, on="k")
    assert (m["_pos"] == m["pos"]).all()
    assert np.allclose(m["_cum_v"], m["cum"])


def test_rolling_rows_match_pandas_rolling(spark):
    rows = [r for r in _rows(300, 3) if r["drug"] is not None]
    df = spark.createDataFrame(pd.DataFrame(rows))
    out = rolling_rows(df, ["hcp", "drug"], ["d", "k"], day_bucket("d"), "v", [3, 7]).toPandas()
    key = spark.createDataFrame(pd.DataFrame(rows))
    # re-attach claim keys by position order for comparison
    pdf = pd.DataFrame(rows).sort_values(["hcp", "drug", "d", "k"]).reset_index(drop=True)
    for n in (3, 7):
        pdf[f"s{n}"] = pdf.groupby(["hcp", "drug"])["v"].transform(lambda x: x.rolling(n, min_periods=1).sum())
        pdf[f"a{n}"] = pdf.groupby(["hcp", "drug"])["v"].transform(lambda x: x.rolling(n, min_periods=1).mean())
    assert len(out) == len(pdf) and key.count() == len(pdf)
    exp = sorted(zip(pdf.hcp, pdf.drug, pdf.s3.round(6), pdf.a7.round(6)), key=str)
    got = sorted(zip(out.hcp, out.drug, out.rolling_sum_3.round(6), out.rolling_avg_7.round(6)), key=str)
    for (h1, d1, s1, a1), (h2, d2, s2, a2) in zip(exp, got):
        assert (h1, d1) == (h2, d2)
        assert (pd.isna(s1) and pd.isna(s2)) or math.isclose(s1, s2, abs_tol=1e-6)
        assert (pd.isna(a1) and pd.isna(a2)) or math.isclose(a1, a2, abs_tol=1e-6)


def _claims(spark):
    base = dt.datetime(2023, 1, 1)
    rows = []
    rnd = random.Random(11)
    for i in range(120):
        rows.append({"claim_number": f"{i}", "patient_id": f"p{rnd.randint(1, 30)}", "patient_age": rnd.randint(10, 90),
                     "patient_gender": rnd.choice(["F", "M", None]),
                     "type_1_npi": rnd.choice([1.0e9, 1.0e9 + 1, None]),
                     "prescriber_npi_nm": rnd.choice(["X", "Y"]), "prescriber_npi_state_cd": rnd.choice(["CA", "NY", None]),
                     "drug_generic_name": "Nivolumab", "drug_brand_name": rnd.choice(["Opdivo", "Keytruda", None]),
                     "service_date_dd": base + dt.timedelta(days=rnd.randint(0, 300)),
                     "transaction_status": "Dispensed", "days_supply_val": 30, "awp_unit_price_amt": 10.0,
                     "total_paid_amt": round(rnd.uniform(1, 1000), 2), "patient_to_pay_amt": 5.0,
                     "payer_channel_name": rnd.choice(["Medicare", "Commercial", "Medicaid", "Other", "Dual", None]),
                     "payer_name": rnd.choice(["P1", "P2", None]), "clinical_service_line": "Onc",
                     "reject_reason_1_cd": rnd.choice([None, "MR"]), "pharmacy_npi_nbr": rnd.randint(1, 5)})
    return cl.clean_claims(claims_rows(spark, rows)), pd.DataFrame(rows)


def test_hcp_rolling_matches_reference_semantics(spark):
    clean, pdf = _claims(spark)
    got = {r.hcp_id: r for r in fe.hcp_rolling(clean).collect()}
    pdf["hcp_id"] = pdf.type_1_npi.fillna(0).astype(int).astype(str).replace("0", "Unknown")
    pdf = pdf.sort_values(["hcp_id", "service_date_dd", "claim_number"], key=lambda s: s if s.name != "claim_number" else s)
    for hcp, g in pdf.groupby("hcp_id"):
        g = g.copy()
        g["r30"] = g.groupby("drug_brand_name")["total_paid_amt"].transform(lambda x: x.rolling(30, min_periods=1).sum())
        g["r90"] = g.groupby("drug_brand_name")["total_paid_amt"].transform(lambda x: x.rolling(90, min_periods=1).sum())
        trend = np.polyfit(np.arange(len(g)), g["r30"].fillna(0), 1)[0] if len(g) >= 2 else 0
        f = g["r90"].iloc[0] if not pd.isna(g["r90"].iloc[0]) else 0
        last = g["r90"].iloc[-1] if not pd.isna(g["r90"].iloc[-1]) else 0
        growth = 0 if (len(g) < 2 or f == 0) else (last - f) / f
        assert math.isclose(got[hcp].sales_trend_30d, trend, rel_tol=1e-6, abs_tol=1e-6)
        assert math.isclose(got[hcp].growth_rate_90d, growth, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got[hcp].sales_volatility, g.total_paid_amt.std(), rel_tol=1e-9)


def test_transaction_and_payer_features(spark):
    clean, pdf = _claims(spark)
    pdf["hcp_id"] = pdf.type_1_npi.fillna(0).astype(int).astype(str).replace("0", "Unknown")
    tr = {r.hcp_id: r for r in fe.hcp_transaction(cl.base_features(clean)).collect()}
    pm = {r.hcp_id: r.payer_multiplier for r in mu.payer_multiplier(clean).collect()}
    scores = {"Medicare": 0.9 * 0.85, "Commercial": 0.8 * 0.75, "Medicaid": 0.7 * 0.65, "Other": 0.6 * 0.6}
    for hcp, g in pdf.groupby("hcp_id"):
        dist = g.payer_channel_name.value_counts(normalize=True)
        assert math.isclose(tr[hcp].commercial_share, dist.get("Commercial", 0))
        assert math.isclose(tr[hcp].rejection_rate, g.reject_reason_1_cd.notna().mean())
        assert tr[hcp].payer_diversity == g.payer_name.nunique()
        known = g[g.payer_channel_name.isin(list(scores))]
        exp = 1.0 if len(known) == 0 else 0.7 + known.payer_channel_name.map(scores).mean() * 0.6
        assert math.isclose(pm[hcp], float(np.clip(exp, 0.8, 1.4)))


def test_market_multiplier_golden_values(spark):
    df = spark.createDataFrame([("Libtayo",), ("Opdivo",), ("Keytruda",), ("Other",)], "b string")
    got = {r.b: r.m for r in df.select("b", mu.market_multiplier_expr(F.col("b")).alias("m")).collect()}
    assert round(got["Libtayo"], 6) == 1.340782
    assert round(got["Opdivo"], 6) == 1.474911
    assert round(got["Keytruda"], 6) == 1.463958
    assert round(got["Other"], 6) == 1.225895


def test_multiplier_bounds_and_sales_total(spark):
    from rxcast.operators.predict import predict
    clean, _ = _claims(spark)
    p = predict(clean, keep_components=True)
    b = p.agg(F.min("affinity"), F.max("affinity"), F.min("transaction_multiplier"), F.max("transaction_multiplier"),
              F.min("rolling_multiplier"), F.max("rolling_multiplier"), F.min("payer_multiplier"),
              F.max("payer_multiplier")).first()
    assert 0.5 <= b[0] <= b[1] <= 1.8 and 0.8 <= b[2] <= b[3] <= 1.3
    assert 0.7 <= b[4] <= b[5] <= 1.5 and 0.8 <= b[6] <= b[7] <= 1.4
    tot = p.agg(F.sum("Sales_from_db")).first()[0]
    exp = clean.filter(F.col("drug_brand_name").isNotNull()).agg(F.sum("total_paid_amt")).first()[0]
    assert math.isclose(tot, exp, rel_tol=1e-9)


def test_repartitioned_input_gives_same_predictions(spark):
    from rxcast.operators.predict import predict
    clean, _ = _claims(spark)
    a = sorted(map(tuple, predict(clean).collect()))
    b = sorted(map(tuple, predict(clean.repartition(7, "patient_id")).collect()))
    assert a == b


def test_temporal_features_against_pandas(spark):
    clean, pdf = _claims(spark)
    got = {r.hcp_id: r for r in fe.hcp_temporal(cl.base_features(clean)).collect()}
    pdf["hcp_id"] = pdf.type_1_npi.fillna(0).astype(int).astype(str).replace("0", "Unknown")
    pdf["month"] = pdf.service_date_dd.dt.month
    for hcp, g in pdf.groupby("hcp_id"):
        assert math.isclose(got[hcp].avg_patient_age, g.patient_age.mean())
        assert math.isclose(got[hcp].female_ratio, (g.patient_gender == "F").mean())
        assert math.isclose(got[hcp].patient_count, len(g.patient_id.unique()))
        ms = g.groupby("month")["total_paid_amt"].sum()
        assert math.isclose(got[hcp].seasonal_variation, ms.std() if len(ms) > 1 else 0.0, rel_tol=1e-9)


def test_learned_predictions_bounds(spark):
    from rxcast.operators.predict import predict
    clean, _ = _claims(spark)
    p = predict(clean, learned=True, keep_components=True)
    lo, hi, n = p.agg(F.min("temporal_multiplier"), F.max("temporal_multiplier"), F.count(F.lit(1))).first()
    assert 0.5 <= lo <= hi <= 2.0
    assert n == predict(clean).count()


def test_registry_overrides_the_hashed_class(spark):
    clean = cl.clean_claims(claims_from_star(spark, SF_SMALL))
    ids = [r.hcp_id for r in clean.select("hcp_id").distinct().orderBy("hcp_id").limit(3).collect()]
    name = dims.SPECIALIZATION[1][0]
    registry = spark.createDataFrame([(ids[0], name.upper()), (ids[0], name), (ids[1], "no such field")], "hcp_id string, specialization string")
    plain = {r.hcp_id: r.specialization for r in fe.hcp_specialization(clean).collect()}
    got = {r.hcp_id: r.specialization for r in fe.hcp_specialization(clean, registry).collect()}
    assert got[ids[0]] == name and got[ids[1]] == plain[ids[1]] and got[ids[2]] == plain[ids[2]] and len(got) == len(plain)


def test_one_hcp_and_one_day_are_cut_into_pieces(spark):
    """Every row in one HCP and day, and every row without a date: pieces stay small and positions right."""
    from rxcast.operators.ordered import split_buckets
    rnd = random.Random(3)
    keys = [f"c{i:05d}" for i in range(20000)]
    rnd.shuffle(keys)
    day = dt.datetime(2024, 5, 1)
    rows = [("H", day if i % 2 else None, k, 1.0) for i, k in enumerate(keys)] + [("G", day, "a", 1.0), ("G", None, None, 1.0)]
    df = spark.createDataFrame(rows, "hcp string, d timestamp, k string, v double").repartition(6)
    cut = split_buckets(df, ["hcp"], "d", "k", target=1000)
    sizes = [r["count"] for r in cut.groupBy("hcp", "_piece").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 3000 and len(sizes) >= 12
    got = positions(cut, ["hcp"], [F.col("d").asc_nulls_last(), F.col("k").asc_nulls_last()], F.col("_piece"), pos_col="p") \
        .orderBy("hcp", "p").select("hcp", "d", "k").collect()
    want = sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or day, r[2] is None, r[2] or ""))
    assert [tuple(r) for r in got] == [r[:3] for r in want]
    again = split_buckets(df.repartition(2), ["hcp"], "d", "k", target=1000).groupBy("hcp", "_piece").count().collect()
    assert sorted(r["count"] for r in again) == sorted(sizes)


def test_signed_rank_pieces_do_not_change_the_ranks(spark, monkeypatch):
    from rxcast.operators import evaluate as ev
    from rxcast.operators import ordered
    rnd = random.Random(4)
    df = spark.createDataFrame([(round(rnd.gauss(5, 9), 2), round(rnd.gauss(5, 9), 2)) for _ in range(3000)], "Sales_from_db double, Predicted_sales double")
    whole = ev.signed_rank(df).first()
    monkeypatch.setattr(ordered, "TARGET_ROWS", 128)
    assert ev.signed_rank(df).first() == whole


def test_hcp_details_ties_nulls_and_dates(spark):
    """The first value by the whole row order; two values on one date, no date at all, nulls before values."""
    rows = [("h1", None, "NY", dt.datetime(2024, 1, 1), "c1"), ("h1", "Zed", None, dt.datetime(2024, 1, 2), "c3"), ("h1", "Amy", "CA", dt.datetime(2024, 1, 2), "c2"),
            ("h2", "Late", "TX", None, "c0"), ("h2", "Dated", None, dt.datetime(2024, 5, 1), "c9"), ("h3", "B", "NV", None, "c2"), ("h3", "A", "WA", None, "c1"),
            ("h4", None, None, dt.datetime(2024, 1, 1), "c1"), ("h5", "One", "OR", dt.datetime(2024, 1, 1), "c1"), ("h5", "One", "OR", dt.datetime(2024, 1, 1), "c1")]
    df = spark.createDataFrame(rows, "hcp_id string, prescriber_npi_nm string, prescriber_npi_state_cd string, service_date_dd timestamp_ntz, claim_number string") \
        .selectExpr("*", "'b' AS drug_brand_name", "1.0D AS total_paid_amt", "'p' AS patient_id", "1 AS days_supply_val").repartition(4)
    got = {r.hcp_id: (r.prescriber_npi_nm, r.prescriber_npi_state_cd) for r in fe.hcp_details(df).collect()}
    assert got == {"h1": ("Amy", "NY"), "h2": ("Dated", "TX"), "h3": ("A", "WA"), "h4": (None, None), "h5": ("One", "OR")}
    untied = fe.hcp_details(df.where("hcp_id IN ('h2', 'h5')"))
    plan = untied._jdf.queryExecution().toString()
    assert untied.count() == 2 and "min_by" not in plan


def test_crosstab_of_many_brands_keeps_them_in_a_table(spark):
    n = 100_000
    claims = spark.range(n + 1).select(
        F.when(F.col("id") < 4, F.lit("h1")).when(F.col("id") < n, F.lit("h2")).alias("hcp_id"),
        F.when(F.col("id") == 3, F.lit("b0000000")).when(F.col("id") < n, F.format_string("b%07d", "id")).alias("drug_brand_name"),
        F.when(F.col("id") != 1, F.col("id") / 4).alias("total_paid_amt"))
    brands = pf.brand_dictionary(claims)
    rows = {r.hcp_id: r.paid for r in pf.hcp_drug_matrix(claims, brands).collect()}
    assert set(rows) == {"h1", "h2"} and brands.count() == n - 1
    assert rows["h1"] == [0.75, None, 0.5] + [None] * (n - 4)
    assert rows["h2"] == [None] * 3 + [i / 4 for i in range(4, n)]
