"""End-to-end pipeline and sinks on the smallest scale factor, plus the CSV
source contract."""

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rxcast.operators.clean import clean_claims
from rxcast.plans.pipeline import run_pipeline, write_outputs
from rxcast.sources.claims import claims_from_star, read_claims_csv


def test_pipeline_and_sinks(spark, tmp_path):
    outs = run_pipeline(spark, claims_from_star(spark, "/root/testdata/sf0.001"))
    assert outs["predictions"].count() > 0
    assert outs["model_metrics"].count() == 5
    written = write_outputs({k: outs[k] for k in ("predictions", "model_metrics", "market_intelligence",
                                                  "drug_insight")}, str(tmp_path), fmt="csv")
    assert all(os.path.exists(p) for p in written)
    back = spark.read.option("header", True).csv(str(tmp_path / "model_metrics"))
    assert sorted(r.Metric for r in back.collect()) == ["Direction_Accuracy", "MAE", "MAPE", "R2", "RMSE"]


def test_read_claims_csv_documented_subset(spark, tmp_path):
    p = tmp_path / "claims.csv"
    p.write_text(
        "patient_id,patient_age,patient_gender,prescriber_npi_nm,prescriber_npi_state_cd,drug_generic_name,"
        "drug_brand_name,service_date_dd,transaction_status,days_supply_val,total_paid_amt,patient_to_pay_amt,"
        "payer_channel_name,payer_name,clinical_service_line,reject_reason_1_cd,pharmacy_npi_nbr,type_1_npi,"
        "awp_unit_price_amt\n"
        "P1,65,M,DR A,CA,Pembrolizumab,Keytruda,2024-01-15,Dispensed,30,12500.00,500.00,Medicare,UHC,Onc,,123,"
        "1000000001,10\n"
        "P2,40,F,DR B,NY,Nivolumab,Opdivo,not-a-date,Reject,30,0,1,Commercial,CVS,Onc,MR,124,,10\n"
        "P3,,F,DR B,NY,Nivolumab,Opdivo,2024-02-01,,28,0,1,Commercial,CVS,Onc,MR,124,,10\n")
    df = read_claims_csv(spark, str(p))
    c = clean_claims(df)
    rows = {r.patient_id: r for r in c.collect()}
    assert set(rows) == {"P1", "P3"}
    assert rows["P1"].hcp_id == "1000000001" and rows["P3"].hcp_id == "Unknown"
    assert rows["P3"].total_paid_amt == 280.0
    bad = df.filter(F.col("patient_id") == "P2").first()
    assert bad.service_date_dd is None
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_claims_csv(spark, str(tmp_path / "missing.csv"))


BASE = {"patient_id": "P1", "patient_age": "65", "drug_generic_name": "Nivolumab", "drug_brand_name": "Opdivo",
        "service_date_dd": "2024-01-15", "transaction_status": "Dispensed", "days_supply_val": "30", "total_paid_amt": "5.5",
        "prescriber_npi_nbr": "77", "awp_unit_price_amt": "10"}


def _csv(path, *rows, columns=None):
    names = columns or list(rows[0])
    path.write_text("\n".join([",".join(names), *(",".join(r.get(c, "") for c in names) for r in rows)]) + "\n")


def test_csv_without_type_1_npi_uses_the_prescriber_number(spark, tmp_path):
    _csv(tmp_path / "a.csv", BASE, BASE | {"patient_id": "P2", "prescriber_npi_nbr": ""})
    got = {r.patient_id: r.hcp_id for r in clean_claims(read_claims_csv(spark, str(tmp_path / "a.csv"))).collect()}
    assert got == {"P1": "77", "P2": "Unknown"}
    _csv(tmp_path / "b.csv", {k: v for k, v in BASE.items() if k != "prescriber_npi_nbr"})
    with pytest.raises(ValueError, match="prescriber id"):
        clean_claims(read_claims_csv(spark, str(tmp_path / "b.csv")))


@pytest.mark.parametrize("absent", ["days_supply_val", "awp_unit_price_amt", "patient_age", "drug_brand_name", "total_paid_amt"])
def test_csv_absent_columns_are_null(spark, tmp_path, absent):
    _csv(tmp_path / "a.csv", {k: v for k, v in BASE.items() if k != absent})
    row = clean_claims(read_claims_csv(spark, str(tmp_path / "a.csv"))).first()
    assert row[absent] is None and row.hcp_id == "77"


def test_csv_absent_optional_columns_stay_absent(spark, tmp_path):
    from rxcast.operators.features import hcp_specialization
    from rxcast.operators.profile import top_rejection_reason
    _csv(tmp_path / "a.csv", BASE | {"reject_reason_1_cd": "MR", "prescriber_npi_state_cd": "CA"})
    clean = clean_claims(read_claims_csv(spark, str(tmp_path / "a.csv")))
    assert hcp_specialization(clean).first().clinical_complexity == 1
    assert top_rejection_reason(clean).first().reason == "Unknown"


def test_csv_files_of_one_folder_are_matched_by_name(spark, tmp_path):
    from rxcast.sources.claims import file_headers
    _csv(tmp_path / "a.csv", BASE)
    _csv(tmp_path / "b.csv", BASE | {"patient_id": "P2"})
    _csv(tmp_path / "c.csv", BASE | {"patient_id": "P3", "total_paid_amt": "7"}, columns=list(BASE)[::-1])
    (tmp_path / "d.csv").write_text("\ufeff patient_id ,total_paid_amt,note,note,prescriber_npi_nbr\n\"P,4\",9,\"say \"\"x\"\"\",2,78\nP5\n", encoding="utf-8")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv").write_text(",".join(BASE) + "\n")
    df = read_claims_csv(spark, str(tmp_path))
    got = {r.patient_id: (r.total_paid_amt, r.drug_brand_name, r.prescriber_npi_nbr) for r in df.collect()}
    assert got == {"P1": (5.5, "Opdivo", "77"), "P2": (5.5, "Opdivo", "77"), "P3": (7.0, "Opdivo", "77"),
                   "P,4": (9.0, None, "78"), "P5": (None, None, None)}
    assert {r["note"] for r in df.collect()} == {None, 'say "x"'} and "note.1" in df.columns and "type_1_npi" not in df.columns
    assert read_claims_csv(spark, str(tmp_path / "[ab].csv")).count() == 2
    assert file_headers(spark, str(tmp_path)).where("size(header) = 0").count() == 1


def test_csv_whole_numbers_as_decimals_and_numbers_that_are_none(spark, tmp_path):
    from rxcast.sources.claims import claims_rejects, read_claims_text
    rows = [BASE | {"patient_id": "P1", "patient_age": "45.0", "days_supply_val": "30.0", "total_paid_amt": "0", "awp_unit_price_amt": "2.0",
                    "pharmacy_npi_nbr": "2000000001.0", "payer_id": "7.0", "type_1_npi": "1.000000001E9", "month": "1.5"},
            BASE | {"patient_id": "P2", "patient_age": "NaN", "days_supply_val": "30.5", "total_paid_amt": "0.0", "awp_unit_price_amt": "2",
                    "pharmacy_npi_nbr": "12x", "payer_id": "99999999999", "type_1_npi": "", "month": "NA"},
            BASE | {"patient_id": "P3", "patient_age": " 50 ", "days_supply_val": "n/a", "total_paid_amt": "$5", "awp_unit_price_amt": "-",
                    "pharmacy_npi_nbr": "9007199254740993", "payer_id": "0", "type_1_npi": "1000000002", "month": "12"}]
    _csv(tmp_path / "a.csv", *rows)
    raw = read_claims_text(spark, str(tmp_path / "a.csv"))
    got = {r.patient_id: r for r in clean_claims(read_claims_csv(spark, str(tmp_path / "a.csv"))).collect()}
    assert [got[p].total_paid_amt for p in ("P1", "P2", "P3")] == [60.0, 61.0, None]
    assert [got[p].patient_age for p in ("P1", "P2", "P3")] == [45.0, None, 50.0]
    assert [got[p].pharmacy_npi_nbr for p in ("P1", "P2", "P3")] == [2000000001, None, 9007199254740993]
    assert [got[p].payer_id for p in ("P1", "P2", "P3")] == [7, None, 0] and [got[p].month for p in ("P1", "P2", "P3")] == [None, None, 12]
    assert [got[p].hcp_id for p in ("P1", "P2", "P3")] == ["1000000001", "Unknown", "1000000002"]
    bad = {r.column: (r.filled, r.rejected) for r in claims_rejects(raw).collect()}
    assert bad["total_paid_amt"] == (3, 1) and bad["awp_unit_price_amt"] == (3, 1) and bad["month"] == (2, 1) and bad["payer_id"] == (3, 1)
    assert bad["pharmacy_npi_nbr"] == (3, 1) and bad["patient_age"] == (2, 0) and bad["service_date_dd"] == (3, 0) and "patient_id" not in bad


def test_csv_date_forms(spark, tmp_path):
    forms = {"2024-01-15": 0, "2024-01-15 10:30:00": 10.5, "2024-01-15T10:30:00": 10.5, "20240115": 0, "01/15/2024": 0, "1/15/2024 10:30": 10.5,
             "1/15/2024 10:30 PM": 22.5, "15/01/2024": 0, "1/15/24": 0, "2024/1/15": 0, "01-15-2024": 0, "15.01.2024": 0, "15-Jan-2024": 0,
             "15 Jan 2024": 0, "15 January 2024": 0, "January 15 2024": 0, "15JAN2024": None, "not a date": None, "2024-13-45": None, "": None, "NaT": None}
    _csv(tmp_path / "a.csv", *[BASE | {"patient_id": f"P{i}", "service_date_dd": t} for i, t in enumerate(forms)])
    with open(tmp_path / "a.csv", "a") as f:
        f.write(",".join('"January 15, 2024"' if c == "service_date_dd" else "long" if c == "patient_id" else BASE[c] for c in BASE) + "\n")
    got = {r.patient_id: r.service_date_dd for r in read_claims_csv(spark, str(tmp_path / "a.csv")).collect()}
    day = dt.datetime(2024, 1, 15)
    want = {f"P{i}": None if h is None else day + dt.timedelta(hours=h) for i, h in enumerate(forms.values())} | {"long": day}
    assert {k: v for k, v in got.items() if k != "P16"} == {k: v for k, v in want.items() if k != "P16"}
    assert got["P16"] in (None, day)  # whether months in capitals are read is up to the formatter


def test_days_count_whatever_the_time_of_day(spark):
    from rxcast.operators.profile import daily_rolling
    rows = [(f"2024-01-0{d} {h}:30:00", 1.0) for d in (1, 2) for h in ("08", "17")]
    df = spark.createDataFrame(rows, "t string, total_paid_amt double").select(
        F.col("t").cast("timestamp_ntz").alias("service_date_dd"), "total_paid_amt")
    assert [(r.daily_sales, r.day_idx) for r in daily_rolling(df).orderBy("day_idx").collect()] == [(2.0, 0), (2.0, 1)]


def test_materialize_as_table_cuts_lineage(spark):
    from rxcast.session import materialize
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    spark.conf.set("rxcast.materialize", "table")
    try:
        t = materialize(df, "unit")
        assert t.count() == 100 and t.agg(F.sum("x")).first()[0] == 9900
        assert "parquet" in t._jdf.queryExecution().optimizedPlan().toString().lower()
    finally:
        spark.conf.unset("rxcast.materialize")


def test_data_overview_approx_distinct(spark):
    from rxcast.operators.report import data_overview
    c = clean_claims(claims_from_star(spark, "/root/testdata/sf0.001"))
    exact, approx = data_overview(c).first(), data_overview(c, approx_distinct=True).first()
    assert exact.claims == approx.claims and exact.drugs == approx.drugs
    assert abs(approx.patients - exact.patients) <= 0.05 * exact.patients
