"""Evaluation and statistics against hand/brute-force values."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rxcast.functions.pvalues import betainc, normal_two_sided, t_two_sided
from rxcast.operators import evaluate as ev
from rxcast.operators import profile as pf


def _pred(spark, n=60, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = round(rnd.uniform(100, 1000), 2)
        p = a if i % 10 == 0 else round(a * rnd.uniform(0.7, 1.4), 2)
        if i % 7 == 0:
            p = round(a + 13.0, 2)   # tied |d|
        rows.append((f"h{i % 9}", rnd.choice(["Opdivo", "Keytruda"]), rnd.choice(["Merck", "BMS"]), a, p,
                     rnd.randint(1, 20), rnd.randint(1, 20), round(rnd.uniform(0.8, 1.3), 3)))
    cols = ["hcp_id", "Drug_name", "Company", "Sales_from_db", "Predicted_sales", "Quantity_from_DB",
            "Predicted_quantity", "Combined_multiplier"]
    return spark.createDataFrame(rows, cols), pd.DataFrame(rows, columns=cols)


def test_metrics_sales(spark):
    df, pdf = _pred(spark)
    m = ev.metrics_sales(df).first()
    a, p = pdf.Sales_from_db, pdf.Predicted_sales
    assert math.isclose(m.MAE, (p - a).abs().mean())
    assert math.isclose(m.RMSE, math.sqrt(((p - a) ** 2).mean()))
    assert math.isclose(m.MAPE, ((p - a).abs() / a.abs()).mean() * 100)
    assert math.isclose(m.R2, 1 - ((p - a) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    da = (np.sign(p - a.mean()) == np.sign(a - a.mean())).mean() * 100
    assert math.isclose(m.Direction_Accuracy, da)


def test_r2_constant_truth(spark):
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "Sales_from_db double, Predicted_sales double")
    assert ev.metrics_sales(df).first().R2 == 1.0
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 6.0)], "Sales_from_db double, Predicted_sales double")
    assert ev.metrics_sales(df).first().R2 == 0.0


def test_signed_rank_matches_average_ranks(spark):
    df, pdf = _pred(spark)
    s = ev.signed_rank(df).first()
    d = pdf.Sales_from_db - pdf.Predicted_sales
    d = d[d != 0]
    r = d.abs().rank(method="average")
    wp, wm = r[d > 0].sum(), r[d < 0].sum()
    assert s.n == len(d)
    assert math.isclose(s.w_plus, wp) and math.isclose(s.w_minus, wm)
    n = len(d)
    _, t = np.unique(d.abs(), return_counts=True)
    se = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - (t ** 3 - t).sum() / 48)
    assert math.isclose(s.z, (min(wp, wm) - n * (n + 1) / 4) / se)


def test_paired_t_and_pvalue(spark):
    df, pdf = _pred(spark)
    row = ev.paired_t_pvalue(df).first()
    d = pdf.Sales_from_db - pdf.Predicted_sales
    t = d.mean() / (d.std() / math.sqrt(len(d)))
    assert math.isclose(row.t_stat, t)
    assert 0.0 <= row.p_value <= 1.0


def test_pvalue_helpers_known_values():
    # two-sided t with 10 dof at t = 2.228 is 0.05; normal at z = 1.96 is 0.05
    assert abs(t_two_sided(2.228138851986274, 10) - 0.05) < 1e-9
    assert abs(normal_two_sided(1.959963984540054) - 0.05) < 1e-12
    assert abs(betainc(2.0, 3.0, 0.4) - 0.5248) < 1e-12
    for dof in (1e6, 1e10, 1e12):
        assert abs(t_two_sided(0.001, dof) - 0.9992021155) < 1e-9 and abs(t_two_sided(1.96, dof) / normal_two_sided(1.96) - 1) < 1e-5
    for t in (0.001, 0.5, 1.96, 6.0):
        assert abs(t_two_sided(t, 999_999) / t_two_sided(t, 1_000_001) - 1) < 1e-7


def test_quartiles_and_error_bins(spark):
    df, pdf = _pred(spark)
    got = {r.Sales_Quartile: r.n for r in ev.by_quartile(df).collect()}
    q = pd.qcut(pdf.Sales_from_db, 4, labels=["Q1 (Low)", "Q2", "Q3", "Q4 (High)"]).value_counts()
    assert got == {k: int(v) for k, v in q.items()}
    bins = {r.bin: r["count"] for r in ev.error_bins(df).collect()}
    pe = (pdf.Predicted_sales - pdf.Sales_from_db).abs() / pdf.Sales_from_db * 100
    exp = pd.cut(pe, [0, 5, 10, 20, 50, 100, np.inf],
                 labels=["<5%", "5-10%", "10-20%", "20-50%", "50-100%", ">100%"]).value_counts()
    assert bins == {k: int(v) for k, v in exp.items()}


def test_multiplier_stats_quantiles(spark):
    df, pdf = _pred(spark)
    r = ev.multiplier_stats(df).first()
    m = pdf.Combined_multiplier
    assert math.isclose(r.q25, m.quantile(0.25)) and math.isclose(r.median, m.median())
    iqr = m.quantile(0.75) - m.quantile(0.25)
    assert r.outliers == int(((m < m.quantile(0.25) - 1.5 * iqr) | (m > m.quantile(0.75) + 1.5 * iqr)).sum())


def test_basic_stats_skew_kurtosis_match_pandas(spark):
    df, pdf = _pred(spark)
    st = {r.statistic: r for r in pf.basic_stats(df, ["Sales_from_db"]).collect()}
    s = pdf.Sales_from_db
    assert math.isclose(st["Skew"].Sales_from_db, s.skew(), rel_tol=1e-9)
    assert math.isclose(st["Kurtosis"].Sales_from_db, s.kurtosis(), rel_tol=1e-9)
    assert math.isclose(st["Q1"].Sales_from_db, s.quantile(0.25))


def test_exact_quantiles_match_pandas(spark):
    """One way for every size: groups, ties, nulls, NaN, infinities, tiny and larger columns."""
    from rxcast.functions.quantiles import exact_quantiles

    rng = np.random.default_rng(7)
    rows = [(None if g == 3 else f"g{g}", float(v), float(w)) for g, n in enumerate((1, 2, 5, 400, 3000))
            for v, w in zip(rng.lognormal(3, 2, n).round(2), rng.integers(0, 4, n))]
    rows += [("g1", None, None), ("g4", float("nan"), 1.0), ("empty", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(7)
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in exact_quantiles(df, {"v": F.col("v"), "w": F.col("w")}, qs, ("g",)).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v", "w"])
    for g, d in pdf.groupby("g", dropna=False):
        for c in ("v", "w"):
            r = got.get(None if pd.isna(g) else g)
            if d[c].notna().any():
                assert np.allclose(r[c], d[c].quantile(qs)), (g, c)
            else:
                assert r is None or r[c] is None
    one = exact_quantiles(df, {"v": F.col("v")}, qs).first()
    assert np.allclose(one.v, pdf.v.quantile(qs))
    assert exact_quantiles(df.limit(0), {"v": F.col("v")}, qs).collect() == [(None,)]


def test_noise_does_not_depend_on_partitioning(spark):
    df, _ = _pred(spark)
    a, b = (sorted(map(tuple, ev.sensitivity(x).collect())) for x in (df, df.repartition(5)))
    assert np.allclose(a, b)


def test_exact_signed_rank_equals_enumeration(spark):
    import itertools
    from pyspark.sql import functions as F
    from rxcast.operators.evaluate import exact_signed_rank
    cases = [(n, w) for n in (0, 1, 2, 5, 9, 12, 50, 51) for w in (0.0, 1.0, 3.0, 7.0, 20.0, 400.0)]
    df = spark.createDataFrame(cases, "n long, w double")
    got = {(r.n, r.w): r.p for r in df.select("n", "w", exact_signed_rank(F.col("n"), F.col("w")).alias("p")).collect()}
    for n, w in cases:
        if n in (0, 51):
            assert got[n, w] is None
        elif n <= 12:
            sums = [sum(k for k, s in zip(range(1, n + 1), signs) if s) for signs in itertools.product((0, 1), repeat=n)]
            assert got[n, w] == min(1.0, 2 * sum(x <= w for x in sums) / 2 ** n)
    assert got[50, 400] == pytest.approx(0.0223, abs=2e-3) and got[50, 0] == 2.0 ** -49


def test_signed_rank_by_group_with_ties_zeros_and_nulls(spark):
    from rxcast.operators.evaluate import signed_rank
    rows = [("a", 1.0, 0.0), ("a", 0.0, 2.0), ("a", 5.0, 0.0), ("a", 4.0, 4.0), ("b", 1.0, 0.0), ("b", 0.0, 1.0), ("b", 3.0, 0.0), (None, 1.0, 0.0), ("c", None, 1.0)]
    got = {r.hcp_id: (r.n, r.w_plus, r.w_minus, r.p_exact) for r in signed_rank(spark.createDataFrame(
        rows, "hcp_id string, Sales_from_db double, Predicted_sales double"), ("hcp_id",)).collect()}
    assert got["a"] == (3, 4.0, 2.0, 0.75) and got["b"] == (3, 4.5, 1.5, None) and "c" not in got


def test_normal_quantile_and_scores(spark):
    from statistics import NormalDist, correlation
    from pyspark.sql import functions as F
    from rxcast.functions.exprs import normal_quantile
    from rxcast.operators.evaluate import normal_scores
    ps = [0.0, 1e-300, 1e-12, 1e-5, 0.01, 0.0749, 0.075, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-9, 1.0]
    got = [r.q for r in spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("q")).collect()]
    assert got[0] is None and got[-1] is None
    assert all(math.isclose(g, NormalDist().inv_cdf(p), rel_tol=1e-13, abs_tol=1e-15) for p, g in zip(ps[1:-1], got[1:-1]))
    res = sorted([1.5, -2.0, 0.25, 0.25, 0.25, 9.0, -0.5, 3.0])
    df = spark.createDataFrame([(0.0, r) for r in res] + [(None, 1.0)], "Sales_from_db double, Predicted_sales double")
    n = len(res)
    w = correlation(res, [NormalDist().inv_cdf((i + 1 - 0.375) / (n + 0.25)) for i in range(n)]) ** 2
    out = normal_scores(df).first()
    assert out.n == n and math.isclose(out.w_stat, w, rel_tol=1e-12) and out.z > 0
    assert normal_scores(df.limit(3)).first().w_stat is None


def test_correlation_matrix_with_nulls_and_constants(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(1e6, 1, 400), "b": rng.normal(0, 1, 400), "k": 0.1, "e": np.nan})
    pdf["c"] = pdf.a * 2 + pdf.b
    pdf.loc[rng.random(400) < 0.3, "b"] = np.nan
    pdf.loc[3:, "one"] = np.nan
    pdf.loc[0, "one"] = 5.0
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, k double, e double, c double, one double").repartition(5)
    got = {(r.feature_1, r.feature_2): (r.n, r.correlation) for r in pf.correlation_matrix(df).collect()}
    assert len(got) == 36
    want = pdf.corr()
    for (x, y), (n, r) in got.items():
        both = pdf[x].notna() & pdf[y].notna()
        assert n == both.sum()
        if r is None:
            assert n < 2 or "k" in (x, y)
        else:
            assert math.isclose(r, want.loc[x, y], rel_tol=1e-7, abs_tol=1e-9)
    assert got["a", "c"][1] is not None and got["k", "k"] == (400, None) and got["e", "a"] == (0, None)
    assert pf.correlation_pairs(df, ["c", "a", "b"]).count() == 3 and pf.correlation_matrix(df.select(F.lit("x").alias("s"))).count() == 0
    assert {r.n for r in pf.correlation_matrix(df.limit(0)).collect()} == {0}


def test_quantiles_leave_no_row_expansion_of_the_input(spark):
    from rxcast.functions.quantiles import exact_quantiles
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000), "v": rng.integers(0, 40, 5000).astype(float), "w": rng.normal(size=5000)})
    df = spark.createDataFrame(pdf)
    qs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: r for r in exact_quantiles(df, {"v": F.col("v"), "w": F.col("w")}, qs, ("g",)).collect()}
    for g, part in pdf.groupby("g"):
        assert np.allclose(got[g].v, part.v.quantile(qs)) and np.allclose(got[g].w, part.w.quantile(qs))
