"""The prediction's roll-ups of one table of partial states equal the direct
aggregates, and the claims are read three times."""

import math
import re

import pytest
from pyspark.sql import functions as F

from rxcast.operators import features as fe
from rxcast.operators import ordered
from rxcast.operators import partials as pt
from rxcast.operators.clean import base_features, clean_claims
from rxcast.operators.predict import predict, train_components
from rxcast.sources.claims import claims_from_star

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    """Claims of the star tables with missing dates, ages, amounts and brands among them."""
    c = clean_claims(claims_from_star(spark, DATA))
    hole = lambda c, k: F.when(F.pmod(F.xxhash64("claim_number", "hcp_id"), F.lit(k)) != 0, F.col(c)).alias(c)
    gaps = {"service_date_dd": 11, "patient_age": 7, "total_paid_amt": 5, "drug_brand_name": 13, "payer_name": 4, "patient_id": 17,
            "prescriber_npi_nm": 3}
    return c.select(*[hole(x, gaps[x]) if x in gaps else F.col(x) for x in c.columns]).persist()


def same(a, b):
    """Equal rows by HCP, doubles to nine digits."""
    ra, rb = ({r.hcp_id: r for r in df.collect()} for df in (a, b))
    assert set(ra) == set(rb) and set(a.columns) == set(b.columns)
    for k, r in ra.items():
        for c in a.columns:
            x, y = r[c], rb[k][c]
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)), (k, c, x, y)


@pytest.mark.parametrize("name", ["target", "temporal", "seasonality", "transaction", "details", "rolling"])
def test_rollups_equal_direct_aggregates(spark, star, name):
    states = pt.claim_states(star)
    patients = pt.distinct_keys(star).select("hcp_id", "patient_count")
    if name == "target":
        same(pt.target_multiplier(states), fe.target_multiplier(star))
    elif name == "temporal":
        same(pt.hcp_temporal(states, patients), fe.hcp_temporal(base_features(star)))
    elif name == "seasonality":
        same(pt.seasonality(states), fe.seasonality(star))
    elif name == "transaction":
        direct = fe.hcp_transaction(base_features(star))
        shared = [c for c in direct.columns if c != "specialty_pharmacy_ratio"]
        same(pt.transaction_mix(states).join(pt.distinct_keys(star), "hcp_id").select(*shared), direct.select(*shared))
    elif name == "details":
        same(fe.first_values(star, pt.value_dates(states, fe.hcp_detail_columns(star.columns))), fe.hcp_details(star))
    else:
        same(fe.hcp_rolling(star, pt.group_sizes(states), pt.seasonality(states)), fe.hcp_rolling(star))


def test_known_sizes_cut_like_counted_ones(spark, star, monkeypatch):
    """An HCP above the target is cut into the same pieces, with the same windows."""
    whole = fe.claim_rolling(star, windows=(3, 9), keep=("claim_number",)).collect()
    monkeypatch.setattr(ordered, "TARGET_ROWS", 64)
    cut = fe.claim_rolling(star, windows=(3, 9), keep=("claim_number",), sizes=pt.group_sizes(pt.claim_states(star))).collect()
    key = lambda r: (r.hcp_id, r.row_idx)
    assert sorted(whole, key=key) == sorted(cut, key=key)


def test_an_empty_table_predicts_nothing(spark, star):
    assert predict(star.limit(0)).count() == 0


def test_claims_are_read_three_times(spark, star, tmp_path):
    """One scan for the states, one for the distinct keys, one for the windows."""
    path = str(tmp_path / "claims")
    # one name per HCP: no ties on first dates
    star.withColumns({"prescriber_npi_nm": F.lit("n"), "prescriber_npi_state_cd": F.lit("s"), "type_1_npi": F.lit(1.0)}).write.parquet(path)
    claims = spark.read.parquet(path)
    spark.conf.set("rxcast.materialize", "table")
    try:
        comps = train_components(claims)
        plan = predict(claims, comps)._jdf.queryExecution().optimizedPlan().toString()
        scans = {"states": pt.claim_states(claims), "keys": pt.distinct_keys(claims, patients=False)}
        read = lambda text: len(re.findall(r"Relation \[[^\]]*claim_number[^\]]*\] parquet", text))
        once = {k: read(df._jdf.queryExecution().analyzed().toString()) for k, df in scans.items()}
        assert once == {"states": 1, "keys": 1} and read(plan) == 1
        assert predict(claims, comps).count() == predict(star).count()
        comps.release()
    finally:
        spark.conf.unset("rxcast.materialize")
