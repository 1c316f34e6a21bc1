"""External market intelligence over landed data (EXT1-EXT12, JN8-JN10,
PRJ17-PRJ19, PRJ24, TOP7, SRC4-SRC6).

The reference fetched JSON/HTML over HTTP. Here every payload is a row of a
landed table ``raw_responses(source, key, fetched_at, status, body)`` (or the
``pages`` table for HTML) and parsing is ``from_json`` / regex extraction,
so it scales with the number of landed payloads like any other scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcast.functions.markup import scan_pages
from rxcast.sources import dims

RAW_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.StringType()),
])

# --- payload schemas (read from the parsing code of each source) ------------
TRIALS_T = T.StructType([T.StructField("StudyFieldsResponse", T.StructType([
    T.StructField("StudyFields", T.ArrayType(T.MapType(T.StringType(), T.StringType())))]))])
LABEL_T = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("openfda", T.StructType([
        T.StructField("application_number", T.ArrayType(T.StringType())),
        T.StructField("manufacturer_name", T.ArrayType(T.StringType()))])),
    T.StructField("indications_and_usage", T.ArrayType(T.StringType())),
    T.StructField("warnings", T.ArrayType(T.StringType())),
    T.StructField("adverse_reactions", T.ArrayType(T.StringType()))])))])
REGISTRY_T = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("basic", T.StructType([
        T.StructField("first_name", T.StringType()), T.StructField("last_name", T.StringType()),
        T.StructField("credential", T.StringType()), T.StructField("enumeration_date", T.StringType())])),
    T.StructField("taxonomies", T.ArrayType(T.StructType([T.StructField("desc", T.StringType())]))),
    T.StructField("addresses", T.ArrayType(T.StructType([T.StructField("state", T.StringType())])))])))])
PUBMED_T = T.StructType([T.StructField("esearchresult", T.StructType([
    T.StructField("count", T.StringType()), T.StructField("idlist", T.ArrayType(T.StringType()))]))])


def ok_payloads(raw: DataFrame, source: str, schema: T.StructType, root: str) -> DataFrame:
    """EXT1: HTTP-200 rows of one source whose body parses and carries the
    expected root key."""
    p = (raw.filter((F.col("source") == source) & (F.col("status") == 200))
         .withColumn("_p", F.from_json("body", schema, {"mode": "PERMISSIVE"})))
    return p.filter(F.col(f"_p.{root}").isNotNull())


def parse_trials(raw: DataFrame) -> DataFrame:
    """EXT2: totals, active/completed/phase-3 counts by substring, first 5 studies."""
    p = ok_payloads(raw, "trials", TRIALS_T, "StudyFieldsResponse").filter(
        F.col("_p.StudyFieldsResponse.StudyFields").isNotNull())
    s = F.col("_p.StudyFieldsResponse.StudyFields")

    def count_with(field, text):
        return F.size(F.filter(s, lambda x: F.coalesce(x[field], F.lit("")).contains(text)))

    return p.select(F.col("key").alias("drug_name"), "fetched_at", F.size(s).alias("total_trials"),
                    count_with("OverallStatus", "Active").alias("active_trials"),
                    count_with("OverallStatus", "Completed").alias("completed_trials"),
                    count_with("Phase", "Phase 3").alias("phase_3_trials"),
                    F.slice(s, 1, 5).alias("studies"))


def parse_label(raw: DataFrame) -> DataFrame:
    """EXT3: first result with nested defaults. ``approval_date`` holds the
    application number, as in the reference."""
    p = ok_payloads(raw, "label", LABEL_T, "results").filter(F.size("_p.results") > 0)
    r = F.col("_p.results")[0]
    na = F.array(F.lit("Not available"))
    return p.select(
        F.col("key").alias("drug_name"), "fetched_at",
        F.coalesce(F.get(r["openfda"]["application_number"], 0), F.lit("Unknown")).alias("approval_date"),
        F.coalesce(r["indications_and_usage"], na).alias("indications"),
        F.coalesce(r["warnings"], na).alias("warnings"),
        F.coalesce(r["adverse_reactions"], na).alias("adverse_reactions"),
        F.coalesce(F.get(r["openfda"]["manufacturer_name"], 0), F.lit("Unknown")).alias("manufacturer"))


def parse_registry(raw: DataFrame) -> DataFrame:
    """EXT4: name, credential, first taxonomy, first address state."""
    p = ok_payloads(raw, "registry", REGISTRY_T, "results").filter(F.size("_p.results") > 0)
    r = F.col("_p.results")[0]
    b = r["basic"]
    return p.select(
        F.col("key").alias("npi"), "fetched_at",
        F.concat_ws(" ", F.coalesce(b["first_name"], F.lit("")), F.coalesce(b["last_name"], F.lit(""))).alias("name"),
        F.coalesce(b["credential"], F.lit("")).alias("credential"),
        F.coalesce(F.get(r["taxonomies"], 0)["desc"], F.lit("Unknown")).alias("specialty"),
        F.coalesce(F.get(r["addresses"], 0)["state"], F.lit("Unknown")).alias("state"),
        F.coalesce(b["enumeration_date"], F.lit("")).alias("enumeration_date"))


def parse_pubmed(raw: DataFrame) -> DataFrame:
    """EXT6: publication count as int, first 10 ids."""
    p = ok_payloads(raw, "pubmed", PUBMED_T, "esearchresult")
    e = F.col("_p.esearchresult")
    return p.select(F.col("key").alias("drug_name"), "fetched_at",
                    F.coalesce(F.col("_p.esearchresult.count").try_cast("int"), F.lit(0)).alias("total_publications"),
                    F.slice(F.coalesce(e["idlist"], F.array().cast("array<string>")), 1, 10).alias("recent_pmids"))


# ---------------------------------------------------------------- HTML (EXT5)
def html_rows(pages: DataFrame, row_tag: str = "tr", cell_tag: str = "td", max_rows: int = 5,
              body_col: str = "html", key_col: str = "page_id") -> DataFrame:
    """EXT5: the first ``max_rows`` ``row_tag`` elements of each page, cells
    0 and 3 of rows with at least 4 cells (``filing_type``, ``filing_date``),
    by a scan over the tags (``functions.markup``) that ends with the last
    wanted row. TOP7 is that limit; it is part of the operator."""
    key = pages.schema[key_col].dataType.simpleString()
    found = pages.select(F.col(key_col), F.col(body_col)).mapInArrow(
        scan_pages(row_tag, cell_tag, max_rows, (0, 3), key_col), f"`{key_col}` {key}, row_idx int, cell_0 string, cell_3 string")
    return found.withColumnsRenamed({"cell_0": "filing_type", "cell_3": "filing_date"})


def filings_summary(parsed_rows: DataFrame, key_col: str = "page_id") -> DataFrame:
    """EXT5 result per company/page: recent filings and their count."""
    return parsed_rows.groupBy(key_col).agg(
        F.sort_array(F.collect_list(F.struct("row_idx", "filing_type", "filing_date"))).alias("recent_filings"),
        F.count(F.lit(1)).alias("total_found"))


# ---------------------------------------------------------------- EXT7-EXT11
def efficacy_sources(drugs: DataFrame, raw: DataFrame) -> DataFrame:
    """EXT7: per drug, which sources answered and the merged
    ``data_source`` label; PubMed alone does not lift 'synthetic'. Metrics
    come from the static efficacy table (default row for unknown drugs)."""
    t = parse_trials(raw).select(F.col("drug_name").alias("_d")).distinct().withColumn("_t", F.lit(True))
    f = parse_label(raw).select(F.col("drug_name").alias("_d")).distinct().withColumn("_f", F.lit(True))
    p = parse_pubmed(raw).select(F.col("drug_name").alias("_d")).distinct().withColumn("_pm", F.lit(True))
    d = drugs.select(F.col("drug_name")).distinct()
    for x in (t, f, p):
        d = d.join(x, d.drug_name == x._d, "left").drop("_d")
    ht, hf, hp = (F.coalesce(F.col(c), F.lit(False)) for c in ("_t", "_f", "_pm"))
    base = F.when(hf & ht, "fda+clinicaltrials").when(hf, "fda").when(ht, "clinicaltrials.gov").otherwise("synthetic")
    label = F.when((base != "synthetic") & hp, F.concat(base, F.lit("+pubmed"))).otherwise(base)
    d = d.select("drug_name", label.alias("data_source"), ht.alias("has_trials"), hf.alias("has_label"),
                 hp.alias("has_pubmed"))
    return with_efficacy(d, "drug_name")


def with_efficacy(df: DataFrame, drug_col: str) -> DataFrame:
    """SRC6: broadcast left join with the fixed efficacy table; unknown drugs
    get the default row."""
    spark = df.sparkSession
    eff = dims.efficacy(spark)
    dflt = dims.efficacy_default(spark).withColumnsRenamed(
        {"efficacy_metrics": "_def_eff", "adverse_events": "_def_ae"})
    j = df.join(F.broadcast(eff), df[drug_col] == eff.drug, "left").drop("drug")
    j = j.join(F.broadcast(dflt), how="inner", on=F.lit(True))
    return j.withColumn("efficacy_metrics", F.coalesce("efficacy_metrics", "_def_eff")) \
            .withColumn("adverse_events", F.coalesce("adverse_events", "_def_ae")).drop("_def_eff", "_def_ae")


def market_source(filings: DataFrame, companies=("Merck", "Bristol-Myers Squibb", "Regeneron"),
                  company_col: str = "company") -> DataFrame:
    """EXT8: 'sec_filings' when any listed company has filings, else 'synthetic'.
    ``company_col`` names the key that ``filings_summary`` grouped by."""
    has = filings.filter(F.col(company_col).isin(*companies) & (F.col("total_found") > 0))
    return has.agg(F.count(F.lit(1)).alias("_n")).select(
        F.when(F.col("_n") > 0, "sec_filings").otherwise("synthetic").alias("data_source"))


def market_sources(companies: DataFrame, filings: DataFrame, company_col: str = "company") -> DataFrame:
    """EXT8 for every company: its filings and the label of its data, and in a
    row with a null company the label of them all (any company with filings)."""
    n = F.coalesce(F.sum("total_found"), F.lit(0))
    label = F.when(n > 0, "sec_filings").otherwise("synthetic")
    known = companies.select(company_col).where(F.col(company_col).isNotNull()).distinct()
    each = known.join(filings, company_col, "left").groupBy(company_col).agg(n.alias("total_found"), label.alias("data_source"))
    total = each.agg(F.lit(None).cast(each.schema[company_col].dataType).alias(company_col), n.alias("total_found"), label.alias("data_source"))
    return each.unionByName(total)


def hcp_profiles(hcps: DataFrame, raw: DataFrame) -> DataFrame:
    """EXT9: registry record over defaults; the registry's specialty is
    preferred (the reference tested a different key and always overwrote)."""
    reg = parse_registry(raw)
    reg = latest_snapshot(reg.withColumnRenamed("npi", "key"), "key").withColumnRenamed("key", "npi")
    j = hcps.select(F.col("hcp_id").alias("npi")).join(reg, "npi", "left")
    return j.select("npi", F.when(F.col("name").isNotNull(), "npi_registry").otherwise("synthetic").alias("data_source"),
                    "name", "credential", F.col("specialty").alias("specialization"), "state", "enumeration_date")


def latest_snapshot(raw: DataFrame, key_col: str = "key", ts_col: str = "fetched_at",
                    now: Column | None = None, ttl_hours: float | None = None) -> DataFrame:
    """EXT10: the freshest row per key, optionally only rows younger than the
    TTL. The winning timestamp per key is found first (a hash aggregate on two
    narrow columns), then its rows are read; equal timestamps are decided by
    the remaining columns, the largest text first, so the result is the same
    in every run."""
    df = raw
    if ttl_hours is not None:
        now = now if now is not None else F.current_timestamp()
        df = df.filter(F.col(ts_col) > now - F.make_interval(secs=F.lit(float(ttl_hours * 3600))))
    others = [c for c in df.columns if c not in (key_col, ts_col)]
    newest = df.groupBy(F.col(key_col).alias("_k")).agg(F.max(ts_col).alias("_t"))
    ties = df.join(newest, df[key_col].eqNullSafe(F.col("_k")) & df[ts_col].eqNullSafe(F.col("_t")), "left_semi")
    latest = ties.groupBy(key_col, ts_col).agg(F.max(F.struct(*others)).alias("_r"))
    return latest.select(key_col, ts_col, "_r.*").select(*df.columns)


def snapshot_asof(requests: DataFrame, snapshots: DataFrame, key_col: str = "key", at_col: str = "requested_at",
                  ts_col: str = "fetched_at", ttl_hours: float = 24) -> DataFrame:
    """EXT10 at the time of each request: the rows of ``requests`` with the
    newest snapshot of their key that isn't later than the request and is
    younger than the TTL then (null columns if there is none). Equal
    timestamps are decided by the remaining columns, the largest first.

    A key's time is cut into hours: inside an hour a window looks back from the
    request, and what came before is the newest snapshot of the hours before,
    a table of one row per key and hour. So a hot key is spread over its hours,
    and no request meets all snapshots of its key. A null key finds nothing."""
    own = [c for c in snapshots.columns if c not in (key_col, ts_col)]
    hour = lambda c: F.date_trunc("hour", c)
    snap = F.struct(F.col(ts_col).alias("t"), *[F.col(c) for c in own])
    asked = requests.select(F.col(key_col).alias("_k"), F.col(at_col).alias("_at"), F.struct(*requests.columns).alias("_req"),
                            F.lit(None).cast(snapshots.select(snap).schema[0].dataType).alias("_snap"))
    seen = snapshots.where(F.col(key_col).isNotNull() & F.col(ts_col).isNotNull()).select(
        F.col(key_col).alias("_k"), F.col(ts_col).alias("_at"), F.lit(None).cast(asked.schema["_req"].dataType).alias("_req"), snap.alias("_snap"))
    both = asked.unionByName(seen).withColumn("_hour", hour(F.col("_at")))
    hours = both.groupBy("_k", "_hour").agg(F.max("_snap").alias("_last"))
    earlier = Window.partitionBy("_k").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    before = hours.select(F.col("_k").alias("_k2"), F.col("_hour").alias("_hour2"), F.max("_last").over(earlier).alias("_before"))
    # rows of one time are peers, so a snapshot at the very time of the request counts
    inside = both.withColumn("_now", F.max("_snap").over(Window.partitionBy("_k", "_hour").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    found = inside.where(F.col("_req").isNotNull()).join(before, F.col("_k").eqNullSafe(F.col("_k2")) & F.col("_hour").eqNullSafe(F.col("_hour2")), "left") \
        .withColumn("_hit", F.coalesce("_now", "_before"))
    fresh = F.col("_hit.t") > F.col("_at") - F.make_interval(secs=F.lit(float(ttl_hours * 3600)))
    hit = F.when(fresh & F.col("_k").isNotNull(), F.col("_hit"))
    return found.select("_req.*", hit.alias("_s")).select(*requests.columns, F.col("_s.t").alias(ts_col), *[F.col(f"_s.{c}").alias(c) for c in own])


def valid_answer() -> Column:
    """A 200 answer that parses and carries its source's root key; a label or
    registry answer needs a result as well."""
    ok = None
    for source, schema, root, some in (("trials", TRIALS_T, "StudyFieldsResponse", False), ("label", LABEL_T, "results", True),
                                       ("registry", REGISTRY_T, "results", True), ("pubmed", PUBMED_T, "esearchresult", False)):
        payload = F.from_json("body", schema)[root]
        hit = payload.isNotNull() & (F.size(payload) > 0 if some else F.lit(True))
        ok = F.when(F.col("source") == source, hit) if ok is None else ok.when(F.col("source") == source, hit)
    return (F.col("status") == 200) & F.coalesce(ok.otherwise(F.lit(False)), F.lit(False))


def fetch_statistics(raw: DataFrame) -> DataFrame:
    """EXT11: attempts (one per key), successes (valid answers, several per
    attempt possible), fallbacks (keys without an answer that lifts them:
    PubMed alone doesn't), success %."""
    per = raw.withColumn("_ok", valid_answer()).groupBy("key").agg(
        F.count_if("_ok").alias("_s"), F.count_if(F.col("_ok") & (F.col("source") != "pubmed")).alias("_lift"))
    return per.agg(F.count(F.lit(1)).alias("real_data_attempts"), F.coalesce(F.sum("_s"), F.lit(0)).alias("real_data_successes"),
                   F.count_if(F.col("_lift") == 0).alias("synthetic_fallbacks")).withColumn(
        "success_rate_percent", F.round(F.coalesce(F.try_divide(F.col("real_data_successes"),
                                                                F.col("real_data_attempts")) * 100, F.lit(0.0)), 2))


# ---------------------------------------------------------------- EXT12, JN8, JN9
def brand_bucket(drug: Column) -> Column:
    return F.when(drug.isin(*dims.KNOWN_BRANDS), drug).otherwise(F.lit("Others"))


def _lookup(key: Column, rows, default) -> Column:
    e = None
    for k, v in rows:
        e = F.when(key == k, F.lit(v)) if e is None else e.when(key == k, F.lit(v))
    return e.otherwise(F.lit(default))


def market_position(drugs: DataFrame, drug_col: str = "drug_name") -> DataFrame:
    """EXT12: market share, growth, rank (1-4, else 5) and advantage text."""
    b = brand_bucket(F.col(drug_col))
    shares = {r[0]: r for r in dims.DRUG_SHARE}
    return drugs.select(
        F.col(drug_col).alias("drug_name"),
        _lookup(b, [(k, float(v[1])) for k, v in shares.items()], 0.0).alias("market_share"),
        _lookup(b, [(k, float(v[4])) for k, v in shares.items()], 0.0).alias("growth_rate"),
        _lookup(b, dims.MARKET_RANK, dims.MARKET_RANK_DEFAULT).alias("market_rank"),
        _lookup(F.col(drug_col), dims.COMPETITIVE_ADVANTAGE, dims.COMPETITIVE_ADVANTAGE_DEFAULT)
        .alias("competitive_advantage"))


def price_class(list_price: Column) -> Column:
    """PRJ18."""
    return (F.when(list_price < 10000, "Highly competitive").when(list_price < 11000, "Competitive")
             .otherwise("Premium pricing"))


def reimbursement_class(medicare: Column, commercial: Column, list_price: Column) -> Column:
    """PRJ19."""
    ratio = ((medicare + commercial) / 2) / list_price
    return F.when(ratio > 0.8, "Favorable").when(ratio > 0.7, "Moderate").otherwise("Challenging")


def drug_profile(drugs: DataFrame, drug_col: str = "drug_name") -> DataFrame:
    """JN8: efficacy ⟕ market position ⟕ competition (JN9) ⟕ pricing, one row
    per drug, flattened. All right-hand sides are fixed-size tables."""
    spark = drugs.sparkSession
    d = drugs.select(F.col(drug_col).alias("drug_name")).filter(F.col("drug_name").isNotNull()).distinct()
    pos = market_position(d)
    eff = with_efficacy(d, "drug_name")
    pr = dims.pricing(spark).withColumnRenamed("drug_name", "_pd")
    out = (pos.join(eff, "drug_name")
           .join(F.broadcast(pr), F.col("drug_name") == F.col("_pd"), "left").drop("_pd"))
    known = F.array(*[F.lit(x) for x in dims.KNOWN_BRANDS])
    return out.select(
        "drug_name", "market_share", "growth_rate", "market_rank", "competitive_advantage",
        F.array_except(known, F.array(F.col("drug_name"))).alias("main_competitors"),
        *[F.col("efficacy_metrics")[f].alias(f) for f in dims.EFF_FIELDS],
        *[F.col("adverse_events")[f].alias(f) for f in dims.AE_FIELDS],
        F.col("list_price_per_dose").alias("list_price"), "avg_selling_price",
        F.when(F.col("list_price_per_dose").isNotNull(), price_class(F.col("list_price_per_dose")))
        .alias("price_competitiveness"),
        F.when(F.col("list_price_per_dose").isNotNull(),
               reimbursement_class(F.col("medicare_reimbursement"), F.col("commercial_reimbursement"),
                                   F.col("list_price_per_dose"))).alias("reimbursement_favorability"))


# ---------------------------------------------------------------- PRJ17, JN10
def payer_landscape(payers: DataFrame, payer_col: str = "payer") -> DataFrame:
    """JN10 via PRJ17: each payer gets the first policy whose pattern is a
    substring of its name (Medicare before Commercial); none -> empty policy.
    A non-equi join against the fixed 2-row policy table, then the
    first match by priority per payer."""
    spark = payers.sparkSession
    pol = dims.payer_policy(spark)
    p = payers.select(F.col(payer_col).alias("payer")).filter(F.col("payer").isNotNull()).distinct()
    j = p.join(F.broadcast(pol), F.col("payer").contains(F.col("pattern")), "left")
    best = j.groupBy("payer").agg(F.min_by(F.struct("pattern", "coverage_policies", "reimbursement_rates",
                                                    "formulary_tier"), F.col("priority")).alias("_m"))
    return best.select(
        "payer", F.col("_m.pattern").alias("matched_policy"),
        F.col("_m.coverage_policies.immunotherapy_covered").alias("immunotherapy_covered"),
        F.col("_m.coverage_policies.step_therapy_required").alias("step_therapy_required"),
        F.coalesce(F.col("_m.coverage_policies.coverage_restrictions"), F.array().cast("array<string>"))
        .alias("coverage_restrictions"),
        *[F.col("_m.reimbursement_rates")[b].alias(f"reimbursement_{b.lower()}") for b in dims.KNOWN_BRANDS],
        *[F.col("_m.formulary_tier")[b].alias(f"tier_{b.lower()}") for b in dims.KNOWN_BRANDS],
        F.lit("synthetic").alias("data_source"))


# ---------------------------------------------------------------- PRJ24
def cache_key(url: Column, params: Column | None = None) -> Column:
    """PRJ24: md5(url + text of the sorted (key, value) parameter list),
    the text written as Python prints a sorted list of 2-tuples. ``params`` is
    an array of (key, value); a key may repeat."""
    if params is None:
        return F.md5(url)
    entries = F.array_sort(params)
    items = F.transform(entries, lambda e: F.concat(F.lit("('"), e["key"], F.lit("', '"), e["value"], F.lit("')")))
    text = F.when(F.size(entries) > 0, F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))).otherwise(F.lit(""))
    return F.md5(F.concat(url, text))


def query_pairs(query: Column) -> Column:
    """Array of (key, value) of a URL's query part, in order, repeats kept."""
    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.split(p, "=", 2)[0].alias("key"),
                                                 F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit("")).alias("value")))


def page_cache_keys(pages: DataFrame) -> DataFrame:
    """Cache keys of landed pages: base URL plus the parsed query parameters."""
    base = F.regexp_extract("url", r"^([^?#]*)", 1)
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    return pages.select("page_id", base.alias("base_url"), cache_key(base, query_pairs(query)).alias("cache_key"))


# ---------------------------------------------------------------- SRC4, SRC5, SNK3
def indication_breakdown(spark: SparkSession) -> DataFrame:
    """SRC5: the indication map exploded to rows."""
    m = F.create_map(*[x for name, share in dims.INDICATION for x in (F.lit(name), F.lit(share))])
    return spark.range(1).select(F.explode(m).alias("indication", "share"))


def market_intelligence(spark: SparkSession, drugs: DataFrame, payers: DataFrame,
                        raw: DataFrame | None = None) -> DataFrame:
    """SNK3 payload: one nested row (market data, efficacy per drug, payer
    landscape). Its size is bounded by the number of drugs and payers."""
    total, growth = dims.MARKET_TOTALS
    shares = dims.drug_share(spark).agg(F.collect_list(F.struct(*dims.drug_share(spark).columns)).alias("drug_shares"))
    ind = indication_breakdown(spark).agg(F.map_from_entries(F.collect_list(F.struct("indication", "share")))
                                          .alias("indication_breakdown"))
    eff_rows = with_efficacy(drugs.select("drug_name").distinct(), "drug_name")
    eff = eff_rows.agg(F.collect_list(F.struct("drug_name", "efficacy_metrics", "adverse_events")).alias("drug_efficacy"))
    land = payer_landscape(payers).agg(F.collect_list(F.struct("*")).alias("payer_landscape"))
    one = shares.join(ind, how="inner", on=F.lit(True)).join(eff, how="inner", on=F.lit(True)) \
                .join(land, how="inner", on=F.lit(True))
    return one.select(F.struct(F.lit(total).alias("total_market_size_billion"), F.lit(growth).alias("growth_rate_yoy"),
                               "drug_shares", "indication_breakdown",
                               F.lit("synthetic").alias("data_source")).alias("market_data"),
                      "drug_efficacy", "payer_landscape")
