"""Landed payloads derived from the given tables, for the queries of the
external-intelligence operators: the JSON answers of four sources, one per
part or supplier, with missing root keys, empty results, failed requests and
repeated snapshots among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcast.sources.claims import claims_from_star


def _stamp(key: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + F.pmod(key, F.lit(5)) * 3600)


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, key, fetched_at, status, body) over all parts and suppliers."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    key, stamp = F.concat(F.lit("drug-"), F.pmod(k, F.lit(997)).cast("string")), _stamp(k)
    status = F.when(F.pmod(k, F.lit(11)) == 0, 500).otherwise(200)
    study = F.struct(F.when(F.pmod(k, F.lit(2)) == 0, "Active, not recruiting").otherwise("Completed").alias("OverallStatus"),
                     F.when(F.pmod(k, F.lit(3)) == 0, "Phase 3").otherwise("Phase 2").alias("Phase"), F.col("p_name").alias("BriefTitle"))
    trials = F.to_json(F.struct(F.struct(F.array_repeat(study, F.pmod(F.col("p_size"), F.lit(7))).alias("StudyFields")).alias("StudyFieldsResponse")))
    label = F.to_json(F.struct(F.array(F.struct(
        F.struct(F.array(F.concat(F.lit("BLA"), k.cast("string"))).alias("application_number"),
                 F.when(F.pmod(k, F.lit(4)) != 0, F.array(F.col("p_brand"))).alias("manufacturer_name")).alias("openfda"),
        F.array(F.col("p_type")).alias("indications_and_usage"))).alias("results")))
    pubmed = F.to_json(F.struct(F.struct(
        F.col("p_size").cast("string").alias("count"),
        F.transform(F.sequence(F.lit(1), F.col("p_size") + 1), lambda i: i.cast("string")).alias("idlist")).alias("esearchresult")))

    def rows(source: str, body: Column, broken: int) -> DataFrame:
        text = F.when(F.pmod(k, F.lit(7)) == broken, '{"error": "none"}').when((F.pmod(k, F.lit(13)) == 5) & F.lit(source == "label"), '{"results": []}') \
            .when(F.pmod(k, F.lit(17)) == 3, "not json").otherwise(body)
        return part.select(F.lit(source).alias("source"), key.alias("key"), stamp.alias("fetched_at"), status.cast("int").alias("status"), text.alias("body"))

    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    s = F.col("s_suppkey")
    person = F.to_json(F.struct(F.array(F.struct(
        F.struct(F.lit("Dr").alias("first_name"), F.col("s_name").alias("last_name"), F.lit("MD").alias("credential")).alias("basic"),
        F.when(F.pmod(s, F.lit(3)) != 0, F.array(F.struct(F.concat(F.lit("class "), F.col("s_nationkey").cast("string")).alias("desc")))).alias("taxonomies"),
        F.array(F.struct(F.concat(F.lit("S"), F.pmod(s, F.lit(9)).cast("string")).alias("state"))).alias("addresses"))).alias("results")))
    registry = supplier.select(
        F.lit("registry").alias("source"), (s + 1000000000).cast("string").alias("key"), _stamp(s).alias("fetched_at"),
        F.when(F.pmod(s, F.lit(8)) == 1, 404).otherwise(200).cast("int").alias("status"),
        F.when(F.pmod(s, F.lit(6)) == 2, '{"results": []}').otherwise(person).alias("body"))
    return rows("trials", trials, 0).union(rows("label", label, 1)).union(rows("pubmed", pubmed, 2)).union(registry)


#: DuckDB: the facts that the operators must find, straight from the tables.
SQL_PRELUDE = """
WITH p AS (SELECT *, 'drug-' || (p_partkey % 997) AS key, p_partkey % 11 <> 0 AS ok, p_partkey % 17 = 3 AS bad,
             TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (p_partkey % 5)::INT AS at FROM part),
trials AS (SELECT * FROM p WHERE ok AND p_partkey % 7 <> 0 AND NOT bad),
label AS (SELECT * FROM p WHERE ok AND p_partkey % 7 <> 1 AND p_partkey % 13 <> 5 AND NOT bad),
pubmed AS (SELECT * FROM p WHERE ok AND p_partkey % 7 <> 2 AND NOT bad),
registry AS (SELECT *, (s_suppkey + 1000000000)::VARCHAR AS npi, 'Dr ' || s_name AS name,
               CASE WHEN s_suppkey % 3 <> 0 THEN 'class ' || s_nationkey ELSE 'Unknown' END AS specialty, 'S' || (s_suppkey % 9) AS state
             FROM supplier WHERE s_suppkey % 8 <> 1 AND s_suppkey % 6 <> 2)
"""


def landed_claims_csv(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The claims view as three sets of CSV files under ``folder``, as three
    suppliers would land them: whole numbers as decimals; columns in another
    order with dates of another form; fewer columns, missing values written
    out. The text is gzipped."""
    claims = claims_from_star(spark, sf_dir)
    part = F.pmod(F.crc32(F.col("claim_number").cast("binary")), F.lit(3))
    whole = [c for c, t in claims.dtypes if t in ("int", "bigint")]
    first = claims.where(part == 0).withColumns({c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in whole})
    second = claims.where(part == 1).withColumns({c: F.date_format(c, f) for c, f in (("service_date_dd", "MM/dd/yyyy"), ("transaction_dt", "d-MMM-yyyy"))}) \
        .select(*reversed(claims.columns))
    third = claims.where(part == 2).drop("reject_reason_1_desc").withColumns({
        "service_date_dd": F.date_format("service_date_dd", "MMMM d, yyyy"), "type_1_npi": F.coalesce(F.col("type_1_npi").cast("string"), F.lit("NaN"))})
    for name, df in (("decimals", first), ("reordered", second), ("fewer", third)):
        df.write.option("header", True).option("compression", "gzip").mode("overwrite").csv(f"{folder}/{name}")
