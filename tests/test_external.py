"""External intelligence parsers on landed-response fixtures."""

import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from rxcast.operators import external as ex

T0 = dt.datetime(2025, 1, 1, 12)


def _raw(spark, rows):
    return spark.createDataFrame(rows, ex.RAW_SCHEMA)


def test_trials_label_registry_pubmed(spark):
    trials = {"StudyFieldsResponse": {"StudyFields": [
        {"NCTId": ["N1"], "OverallStatus": ["Active, not recruiting"], "Phase": ["Phase 3"]},
        {"NCTId": ["N2"], "OverallStatus": ["Completed"], "Phase": ["Phase 2"]},
        {"NCTId": ["N3"], "OverallStatus": ["Completed"], "Phase": ["Phase 3"]}]}}
    label = {"results": [{"openfda": {"application_number": ["BLA1"], "manufacturer_name": ["Acme"]},
                          "warnings": ["w"]}]}
    registry = {"results": [{"basic": {"first_name": "ANA", "last_name": "LEE", "credential": "MD"},
                             "taxonomies": [{"desc": "Oncology"}], "addresses": [{"state": "CA"}]}]}
    pubmed = {"esearchresult": {"count": "42", "idlist": [str(i) for i in range(15)]}}
    raw = _raw(spark, [
        ("trials", "Keytruda", T0, 200, json.dumps(trials)),
        ("trials", "Opdivo", T0, 500, json.dumps(trials)),
        ("label", "Keytruda", T0, 200, json.dumps(label)),
        ("label", "Opdivo", T0, 200, json.dumps({"meta": {}})),
        ("registry", "123", T0, 200, json.dumps(registry)),
        ("pubmed", "Keytruda", T0, 200, json.dumps(pubmed)),
        ("pubmed", "Libtayo", T0, 200, json.dumps(pubmed)),
    ])
    t = ex.parse_trials(raw).collect()
    assert len(t) == 1 and (t[0].total_trials, t[0].active_trials, t[0].completed_trials, t[0].phase_3_trials) == (3, 1, 2, 2)
    lab = ex.parse_label(raw).collect()
    assert len(lab) == 1 and lab[0].approval_date == "BLA1" and lab[0].indications == ["Not available"]
    reg = ex.parse_registry(raw).first()
    assert (reg.name, reg.credential, reg.specialty, reg.state) == ("ANA LEE", "MD", "Oncology", "CA")
    pm = ex.parse_pubmed(raw).filter("drug_name = 'Keytruda'").first()
    assert pm.total_publications == 42 and len(pm.recent_pmids) == 10
    drugs = spark.createDataFrame([("Keytruda",), ("Opdivo",), ("Libtayo",), ("Zzz",)], "drug_name string")
    src = {r.drug_name: r for r in ex.efficacy_sources(drugs, raw).collect()}
    assert src["Keytruda"].data_source == "fda+clinicaltrials+pubmed"
    assert src["Opdivo"].data_source == "synthetic"
    assert src["Libtayo"].data_source == "synthetic"       # PubMed alone does not lift it
    assert src["Zzz"].efficacy_metrics.overall_response_rate == 0.40
    assert src["Keytruda"].efficacy_metrics.overall_response_rate == 0.47


def test_html_rows_table_and_entities(spark):
    html = ("<table><tr><th>h</th></tr><tr><td>10-K</td><td>x</td><td>y</td><td>2024-01-02</td></tr>"
            "<tr><td>8-K &amp; A</td><td>x</td><td>y</td><td><b>2024-02-03</b></td></tr></table>")
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [(r.row_idx, r.filing_type, r.filing_date) for r in ex.html_rows(pages).orderBy("row_idx").collect()]
    assert got == [(1, "10-K", "2024-01-02"), (2, "8-K & A", "2024-02-03")]


def test_latest_snapshot_and_stats(spark):
    raw = _raw(spark, [("s", "k1", T0, 200, "a"), ("s", "k1", T0 + dt.timedelta(hours=1), 200, "b"),
                       ("s", "k2", T0 - dt.timedelta(days=3), 500, "c")])
    got = {r.key: r.body for r in ex.latest_snapshot(raw).collect()}
    assert got == {"k1": "b", "k2": "c"}
    fresh = ex.latest_snapshot(raw, now=F.lit(T0 + dt.timedelta(hours=2)), ttl_hours=24).collect()
    assert [r.key for r in fresh] == ["k1"]
    tie = ex.latest_snapshot(_raw(spark, [("s", "k", T0, 200, "a"), ("s", "k", T0, 200, "b"), ("s", None, T0, 200, "c")])).collect()
    assert {r.key: r.body for r in tie} == {"k": "b", None: "c"}


def test_fetch_statistics_counts_valid_answers(spark):
    raw = _raw(spark, [("label", "d1", T0, 200, '{"meta": 1}'), ("pubmed", "d1", T0, 200, '{"esearchresult": {"count": "3"}}'),
                       ("trials", "d2", T0, 200, '{"StudyFieldsResponse": {"StudyFields": []}}'),
                       ("registry", "n1", T0, 200, '{"results": [{"basic": {"first_name": "A"}}]}'),
                       ("label", "d3", T0, 500, '{"results": [{}]}'), ("label", "d4", T0, 200, '{"results": []}')])
    st = ex.fetch_statistics(raw).first()
    assert (st.real_data_attempts, st.real_data_successes, st.synthetic_fallbacks) == (5, 3, 3)
    assert st.success_rate_percent == 60.0


def test_market_source_reads_the_filings_summary(spark):
    rows = spark.createDataFrame([(1, 0, "10-K", "2024")], "page_id long, row_idx int, filing_type string, filing_date string")
    found = ex.filings_summary(rows)
    assert ex.market_source(found, companies=(1,), company_col="page_id").first().data_source == "sec_filings"
    assert ex.market_source(found, companies=(2,), company_col="page_id").first().data_source == "synthetic"


def test_payer_landscape_substring_priority(spark):
    payers = spark.createDataFrame([("Dual (Medicaid/Medicare)",), ("Commercial",), ("CVS Caremark",)], "payer string")
    got = {r.payer: r for r in ex.payer_landscape(payers).collect()}
    assert got["Dual (Medicaid/Medicare)"].matched_policy == "Medicare"
    assert got["Commercial"].step_therapy_required is True and got["Commercial"].tier_keytruda is None
    assert got["CVS Caremark"].matched_policy is None and got["CVS Caremark"].coverage_restrictions == []


def test_drug_profile_and_cache_key(spark):
    drugs = spark.createDataFrame([("Keytruda",), ("Foo",)], "drug_name string")
    got = {r.drug_name: r for r in ex.drug_profile(drugs).collect()}
    assert got["Keytruda"].market_rank == 1 and got["Keytruda"].price_competitiveness == "Premium pricing"
    assert got["Keytruda"].reimbursement_favorability == "Moderate"
    assert sorted(got["Keytruda"].main_competitors) == ["Libtayo", "Opdivo"]
    assert got["Foo"].market_rank == 4 and got["Foo"].list_price is None
    pages = spark.createDataFrame([(1, "http://a.b/c?z=1&a=2")], "page_id long, url string")
    k = ex.page_cache_keys(pages).first().cache_key
    again = spark.createDataFrame([(2, "http://a.b/c?x=1&x=2&y")], "page_id long, url string")
    assert ex.page_cache_keys(again).first().cache_key == hashlib.md5(
        ("http://a.b/c" + str([("x", "1"), ("x", "2"), ("y", "")])).encode()).hexdigest()
    params = {"z": "1", "a": "2"}
    assert k == hashlib.md5(("http://a.b/c" + str(sorted(params.items()))).encode()).hexdigest()


def test_market_intelligence_json_roundtrip(spark, tmp_path):
    drugs = spark.createDataFrame([("Keytruda",)], "drug_name string")
    payers = spark.createDataFrame([("Medicare",)], "payer string")
    mi = ex.market_intelligence(spark, drugs, payers)
    mi.write.mode("overwrite").json(str(tmp_path / "mi"))
    back = spark.read.json(str(tmp_path / "mi")).first()
    assert back.market_data.total_market_size_billion == 35.2
    assert len(back.market_data.drug_shares) == 4


def test_snapshot_asof_against_brute_force(spark):
    import random
    rng = random.Random(4)
    at = lambda: T0 + dt.timedelta(minutes=rng.randint(0, 4000))
    snaps = [(rng.choice(["hot", "hot", "b", "c", None]), at(), rng.choice("xyz"), i) for i in range(300)] + [("tie", T0, "x", 900), ("tie", T0, "y", 901), ("d", None, "x", 902)]
    reqs = [(i, rng.choice(["hot", "b", "c", "none", None]), at()) for i in range(200)] + [(900, "tie", T0), (901, "tie", T0 + dt.timedelta(hours=24)),
            (902, "tie", T0 + dt.timedelta(hours=23, minutes=59)), (903, "d", T0), (904, "hot", None)]
    got = {r.id: (r.kind, r.no) for r in ex.snapshot_asof(
        spark.createDataFrame(reqs, "id int, key string, requested_at timestamp"),
        spark.createDataFrame(snaps, "key string, fetched_at timestamp, kind string, no int"), ttl_hours=24).collect()}
    for i, key, t in reqs:
        hits = [(s[1], s[2], s[3]) for s in snaps if key is not None and t is not None and s[0] == key and s[1] is not None
                and s[1] <= t and s[1] > t - dt.timedelta(hours=24)]
        assert got[i] == (max(hits)[1:] if hits else (None, None)), (i, key, t)
    assert got[900] == ("y", 901) and got[901] == (None, None) and len(got) == len(reqs)


def test_market_sources_of_every_company(spark):
    companies = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "company string")
    found = spark.createDataFrame([("a", 2), ("z", 4)], "company string, total_found long")
    got = {r.company: (r.total_found, r.data_source) for r in ex.market_sources(companies, found).collect()}
    assert got == {"a": (2, "sec_filings"), "b": (0, "synthetic"), None: (2, "sec_filings")}
    assert [tuple(r) for r in ex.market_sources(companies.limit(0), found).collect()] == [(None, 0, "synthetic")]
