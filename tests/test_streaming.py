"""Streaming ingest applies the same cleaning as the batch path."""

from rxcast.sources.claims import CLAIMS_SCHEMA
from rxcast.streaming.ingest import start_ingest


def test_stream_ingest_available_now(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    cols = CLAIMS_SCHEMA.fieldNames()
    rows = [
        {"claim_number": "1", "transaction_status": "Dispensed", "type_1_npi": "1000000001", "total_paid_amt": "0",
         "days_supply_val": "30", "awp_unit_price_amt": "2.5", "service_date_dd": "2024-01-15",
         "drug_generic_name": "Nivolumab"},
        {"claim_number": "2", "transaction_status": "Reject", "type_1_npi": "1000000001", "total_paid_amt": "9"},
        {"claim_number": "3", "transaction_status": "", "type_1_npi": "", "total_paid_amt": "4"},
    ]
    lines = [",".join(cols)] + [",".join(r.get(c, "") for c in cols) for r in rows]
    (src / "part1.csv").write_text("\n".join(lines) + "\n")
    out, ck = tmp_path / "out", tmp_path / "ck"
    q = start_ingest(spark, str(src), str(out), str(ck), available_now=True)
    q.awaitTermination(120)
    got = {r.claim_number: (r.hcp_id, r.total_paid_amt, r.company) for r in spark.read.parquet(str(out)).collect()}
    assert got == {"1": ("1000000001", 75.0, "Bristol-Myers Squibb"), "3": ("Unknown", 4.0, "Unknown")}


def test_stream_of_files_with_differing_headers(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("claim_number,type_1_npi,days_supply_val,awp_unit_price_amt,total_paid_amt\n1,1000000001.0,30.0,2.0,0\n")
    out, ck = tmp_path / "out", tmp_path / "ck"
    start_ingest(spark, str(src), str(out), str(ck), available_now=True).awaitTermination(120)
    (src / "b.csv").write_text("total_paid_amt,claim_number,transaction_status,type_1_npi\n5,2,Dispensed,\n6,3,Reject,1\n")
    (src / "c.csv").write_text("type_1_npi,claim_number,total_paid_amt\n1000000002,4,x\n")
    start_ingest(spark, str(src), str(out), str(ck), available_now=True, max_files=1).awaitTermination(120)
    start_ingest(spark, str(src), str(out), str(ck), available_now=True).awaitTermination(120)  # nothing new
    got = {r.claim_number: (r.hcp_id, r.total_paid_amt) for r in spark.read.option("mergeSchema", True).parquet(str(out)).collect()}
    assert got == {"1": ("1000000001", 60.0), "2": ("Unknown", 5.0), "4": ("1000000002", None)}
