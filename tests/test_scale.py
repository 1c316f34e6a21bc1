"""What the claims send through shuffles and to single tasks stays narrow."""

import random

import pytest
from pyspark.sql import functions as F

from rxcast.functions import quantiles
from rxcast.operators import features as fe
from rxcast.operators import partials as pt
from rxcast.operators import predict as pr
from tests.conftest import claims_rows


@pytest.fixture(scope="module")
def claims(spark):
    """Two HCPs with two names on their first dates, one without a state, null brands and dates among the claims."""
    rows = []
    for i in range(60):
        hcp = f"h{i % 3}"
        rows.append({"claim_number": f"{i:03d}", "prescriber_npi_nm": f"n{i % 2}" if hcp != "h2" else "n", "patient_age": 20 + i,
                     "prescriber_npi_state_cd": None if hcp == "h2" else f"S{i % 2}", "drug_generic_name": f"g{i % 4}",
                     "drug_brand_name": None if i % 7 == 0 else f"b{i % 4}", "clinical_service_line": f"c{i % 5}", "days_supply_val": 1,
                     "total_paid_amt": 10.0 + i, "payer_channel_name": "Medicare", "payer_name": "p"})
    df = claims_rows(spark, rows).withColumn("hcp_id", F.concat(F.lit("h"), F.pmod(F.col("claim_number").cast("int"), F.lit(3))))
    day = F.pmod(F.col("claim_number").cast("int"), F.lit(31)).cast("int")
    return df.withColumn("service_date_dd", F.when(day != 30, F.date_add(F.lit("2024-01-01"), F.when(day < 12, 0).otherwise(day * 5)).cast("timestamp_ntz")))


@pytest.mark.parametrize("learned", [False, True])
def test_state_tables_hold_what_is_read(claims, monkeypatch, learned):
    """No table of states is keyed by drug and month at once; without the fitted component its states aren't built."""
    made = {}
    monkeypatch.setattr(pr, "materialize", lambda df, name: made.setdefault(name, df))
    monkeypatch.setattr(pr.mu, "temporal_multiplier", lambda features, target: features.join(target, "hcp_id"))
    comps = pr.train_components(claims, learned)
    for df in made.values():
        assert not {"month", "drug_brand_name"} <= set(df.columns) and not {"month", "prescriber_npi_nm"} <= set(df.columns)
    assert any("age_mean" in df.columns for df in made.values()) == learned
    whole = pt.claim_states(claims)
    got = {(r.hcp_id, r.drug_brand_name, r.drug_generic_name): (r._sales, r._qty) for r in comps.groups.collect()}
    assert got == {(r.hcp_id, r.drug_brand_name, r.drug_generic_name): (r._sales, r._qty) for r in pt.drug_groups(whole).collect()}
    assert sorted(comps.details.collect()) == sorted(fe.hcp_details(claims).collect())


@pytest.mark.parametrize("learned", [False, True])
def test_payers_take_no_pass_and_patients_one(claims, monkeypatch, learned):
    """Payers are a roll-up of the states; patients are counted without a row per distinct key, and only where they are read."""
    made = {}
    monkeypatch.setattr(pr, "materialize", lambda df, name: made.setdefault(name, df))
    monkeypatch.setattr(pr.mu, "temporal_multiplier", lambda features, target: features.join(target, "hcp_id"))
    rows = claims.withColumn("payer_name", F.when(F.col("claim_number") < "050", F.concat(F.lit("p"), F.pmod(F.crc32(F.col("claim_number").cast("binary")), F.lit(5))))) \
        .withColumn("patient_id", F.when(F.col("claim_number") < "055", F.pmod(F.crc32(F.col("claim_number").cast("binary")), F.lit(7)).cast("string")))
    pr.train_components(rows, learned)
    for df in made.values():
        assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
    wanted = {r.hcp_id: r for r in pt.distinct_keys(rows).collect()}
    payers = {r.hcp_id: r.payer_diversity for r in pt.payer_diversity(made["value-dates"]).collect()}
    assert payers == {k: r.payer_diversity for k, r in wanted.items()} and set(payers.values()) != {1}
    assert ("patient-counts" in made) == learned
    if learned:
        assert {r.hcp_id: r.patient_count for r in made["patient-counts"].collect()} == {k: r.patient_count for k, r in wanted.items()}


def test_the_prediction_lands_the_columns_that_it_reads(spark):
    from rxcast.plans import queries as q
    q.release_shared()
    claims = q.prediction_claims(spark, "/root/testdata/sf0.001")
    assert not {"company", "transaction_dt", "pharmacy_npi_nbr", "clinical_service_line"} & set(claims.columns)
    whole = q.clean(spark, "/root/testdata/sf0.001")
    assert q.prediction_claims(spark, "/root/testdata/sf0.001") is whole
    assert sorted(map(str, pr.predict(claims).collect())) == sorted(map(str, pr.predict(whole).collect()))
    q.release_shared()


def test_claims_of_tied_first_dates_are_not_shuffled(spark, claims, tmp_path):
    """The dates that decide ties are stored first, so their size is known and the claims join them where they lie."""
    path = str(tmp_path / "claims")
    claims.write.parquet(path)
    stored = spark.read.parquet(path)
    wanted = {r.hcp_id: r.asDict() for r in fe.hcp_details(stored).collect()}
    assert wanted["h0"]["prescriber_npi_nm"] == "n0" and wanted["h1"]["prescriber_npi_nm"] == "n1"
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    spark.conf.set("rxcast.materialize", "table")
    try:
        plan = fe.hcp_details(stored)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("rxcast.materialize")
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert any("BroadcastHashJoin" in j and "Inner" in j for j in joins), plan


def test_modal_state_is_counted_not_collected(claims):
    """No buffer of states per HCP and service line: ties go to the smallest state, none is 'Unknown'."""
    out = fe.hcp_specialization(claims)
    assert "mode(" not in out._jdf.queryExecution().analyzed().toString()
    got = {r.hcp_id: (r.state, r.clinical_complexity) for r in out.collect()}
    assert got == {"h0": ("S0", 5), "h1": ("S0", 5), "h2": ("Unknown", 5)}


def test_quantile_summaries_are_small_and_ranks_exact(spark):
    """A task's summary is bounded by ACCURACY; brackets still hold every rank."""
    assert quantiles.ACCURACY <= 100_000
    rng = random.Random(5)
    values = [round(rng.expovariate(0.01), rng.choice((0, 4))) for _ in range(30_011)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    qs = [0.0, .25, .5, .75, .9, 1.0]
    got = quantiles.exact_quantiles(df, {"q": F.col("v")}, qs).first().q
    values.sort()
    for q, x in zip(qs, got):
        pos = q * (len(values) - 1)
        low = int(pos)
        high = min(low + 1, len(values) - 1)
        assert x == pytest.approx(values[low] + (values[high] - values[low]) * (pos - low), rel=1e-12)


def test_landed_claims_are_compressed(spark, tmp_path):
    """The suppliers' text is gzipped and reads back by header."""
    from rxcast.plans.landed import landed_claims_csv
    from rxcast.sources.claims import claims_from_star, read_claims_text
    folder = tmp_path / "landed"
    landed_claims_csv(spark, "/root/testdata/sf0.001", str(folder))
    files = [f.name for f in folder.glob("*/part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    back = read_claims_text(spark, f"{folder}/*")
    assert back.count() == claims_from_star(spark, "/root/testdata/sf0.001").count() and "claim_number" in back.columns
