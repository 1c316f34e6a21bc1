"""Cleaning and base features: one hand-computed case per pandas trap."""

import datetime as dt
import math

from pyspark.sql import functions as F

from conftest import claims_rows
from rxcast.operators import clean as cl

D = dt.datetime


def test_null_status_is_kept_and_rejects_dropped(spark):
    df = claims_rows(spark, [
        {"claim_number": "a", "transaction_status": None, "type_1_npi": 1.0, "total_paid_amt": 5.0},
        {"claim_number": "b", "transaction_status": "Reject", "type_1_npi": 1.0, "total_paid_amt": 5.0},
        {"claim_number": "c", "transaction_status": "Reversed", "type_1_npi": 1.0, "total_paid_amt": 5.0},
        {"claim_number": "d", "transaction_status": "Dispensed", "type_1_npi": 1.0, "total_paid_amt": 5.0},
    ])
    got = sorted(r.claim_number for r in cl.clean_claims(df).collect())
    assert got == ["a", "d"]


def test_zero_paid_imputed_null_paid_kept(spark):
    df = claims_rows(spark, [
        {"claim_number": "z", "total_paid_amt": 0.0, "days_supply_val": 30, "awp_unit_price_amt": 10.5},
        {"claim_number": "n", "total_paid_amt": None, "days_supply_val": 30, "awp_unit_price_amt": 10.5},
        {"claim_number": "p", "total_paid_amt": 7.0, "days_supply_val": 30, "awp_unit_price_amt": 10.5},
    ])
    got = {r.claim_number: r.total_paid_amt for r in cl.clean_claims(df).collect()}
    assert got == {"z": 315.0, "n": None, "p": 7.0}


def test_hcp_id_from_npi(spark):
    df = claims_rows(spark, [
        {"claim_number": "1", "type_1_npi": 1234567890.0},
        {"claim_number": "2", "type_1_npi": None},
        {"claim_number": "3", "type_1_npi": 0.0},
        {"claim_number": "4", "type_1_npi": 12.9},   # astype(int) truncates
    ])
    got = {r.claim_number: r.hcp_id for r in cl.clean_claims(df).collect()}
    assert got == {"1": "1234567890", "2": "Unknown", "3": "Unknown", "4": "12"}


def test_hcp_id_fallback_and_missing_column(spark):
    df = spark.createDataFrame([("x", None), ("y", "55")], "claim_number string, prescriber_npi_nbr string")
    df = df.withColumns({"transaction_status": F.lit(None).cast("string"), "total_paid_amt": F.lit(1.0),
                         "drug_generic_name": F.lit("Nivolumab")})
    got = {r.claim_number: (r.hcp_id, r.company) for r in cl.clean_claims(df).collect()}
    assert got == {"x": ("Unknown", "Bristol-Myers Squibb"), "y": ("55", "Bristol-Myers Squibb")}
    bad = spark.createDataFrame([("x",)], "claim_number string")
    try:
        cl.clean_claims(bad)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_age_bins_are_right_closed_with_default(spark):
    ages = [0, 1, 18, 19, 35, 50, 65, 66, 100, 101, None]
    df = claims_rows(spark, [{"claim_number": str(a), "patient_age": a, "type_1_npi": 1.0} for a in ages])
    got = {r.claim_number: r.age_group for r in cl.base_features(cl.clean_claims(df)).collect()}
    assert got == {"0": "35-50", "1": "<18", "18": "<18", "19": "18-35", "35": "18-35", "50": "35-50",
                   "65": "50-65", "66": "65+", "100": "65+", "101": "35-50", "None": "35-50"}


def test_weekday_monday_zero_and_copay_ratio(spark):
    df = claims_rows(spark, [
        {"claim_number": "mon", "service_date_dd": D(2024, 1, 1), "total_paid_amt": 9.0, "patient_to_pay_amt": 5.0,
         "type_1_npi": 1.0},
        {"claim_number": "sun", "service_date_dd": D(2024, 1, 7), "total_paid_amt": -1.0, "patient_to_pay_amt": 5.0,
         "type_1_npi": 1.0},
        {"claim_number": "nul", "service_date_dd": None, "total_paid_amt": None, "patient_to_pay_amt": 5.0,
         "type_1_npi": 1.0},
    ])
    got = {r.claim_number: (r.day_of_week, r.copay_ratio, r.month) for r in cl.base_features(cl.clean_claims(df)).collect()}
    assert got["mon"] == (0, 0.5, 1)
    assert got["sun"] == (6, 0.0, 1)   # division by zero -> inf -> 0
    assert got["nul"] == (None, 0.0, None)


def test_claims_view_counts_match_fixture_note(spark):
    """FIXTURES.md: 39,988 cleaned rows, 101 HCPs, 9 drugs, 1,500 patients,
    1,264 null-status rows, total paid 1,957,491,949.93 at sf0.01."""
    from rxcast.sources.claims import claims_from_star
    c = cl.clean_claims(claims_from_star(spark, "/root/testdata/sf0.01"))
    r = c.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("hcp_id").alias("h"),
              F.count_distinct("drug_brand_name").alias("d"), F.count_distinct("patient_id").alias("p"),
              F.count_if(F.col("transaction_status").isNull()).alias("ns"),
              F.sum(F.col("total_paid_amt").cast("decimal(38,6)")).alias("t")).first()
    assert (r.n, r.h, r.d, r.p, r.ns) == (39988, 101, 9, 1500, 1264)
    assert math.isclose(float(r.t), 1957491949.93, abs_tol=0.01)


def test_wall_clock_dates_independent_of_session_zone(spark):
    from rxcast.sources.claims import claims_from_star
    sf = "/root/testdata/sf0.001"

    def sample():
        c = cl.base_features(cl.clean_claims(claims_from_star(spark, sf)))
        return sorted((r.claim_number, r.service_date_dd, r.month, r.day_of_week)
                      for r in c.select("claim_number", "service_date_dd", "month", "day_of_week").collect())

    utc = sample()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert sample() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
