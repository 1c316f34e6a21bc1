"""Claims sources.

* ``CLAIMS_SCHEMA`` / ``read_claims_csv``: the claims CSV contract (SRC1): fixed
  types (no inference pass over the data), columns matched by name per file,
  every value cast leniently.
* ``claims_from_star``: the claims view over the TPC-H-style test tables
  (SRC2). Five equi-joins; Catalyst prunes every column not used downstream
  and pushes filters into the parquet scans.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcast.functions.exprs import nan_to_null

CLAIMS_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("patient_id", T.StringType()),
    T.StructField("patient_gender", T.StringType()),
    T.StructField("patient_age", T.DoubleType()),
    T.StructField("drug_generic_name", T.StringType()),
    T.StructField("drug_brand_name", T.StringType()),
    T.StructField("type_1_npi", T.DoubleType()),
    T.StructField("type_2_npi", T.DoubleType()),
    T.StructField("prescriber_npi_nbr", T.StringType()),
    T.StructField("prescriber_npi_nm", T.StringType()),
    T.StructField("prescriber_npi_state_cd", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("claim_number", T.StringType()),
    T.StructField("transaction_status", T.StringType()),
    T.StructField("ndc", T.StringType()),
    T.StructField("payer_name", T.StringType()),
    T.StructField("payer_channel_name", T.StringType()),
    T.StructField("payer_subchannel_name", T.StringType()),
    T.StructField("final_status_code", T.StringType()),
    T.StructField("service_date_dd", T.StringType()),
    T.StructField("date_prescription_written_dd", T.IntegerType()),
    T.StructField("transaction_dt", T.StringType()),
    T.StructField("dispense_nbr", T.StringType()),
    T.StructField("admin_service_line", T.StringType()),
    T.StructField("clinical_service_line", T.StringType()),
    T.StructField("reject_reason_1_cd", T.StringType()),
    T.StructField("reject_reason_1_desc", T.StringType()),
    T.StructField("open_source_fl", T.IntegerType()),
    T.StructField("closed_source_fl", T.IntegerType()),
    T.StructField("ndc_desc", T.StringType()),
    T.StructField("ndc_drug_nm", T.StringType()),
    T.StructField("ndc_isbranded_ind", T.StringType()),
    T.StructField("roa", T.StringType()),
    T.StructField("pharmacy_npi_nbr", T.LongType()),
    T.StructField("pcp_npi_nbr", T.LongType()),
    T.StructField("payer_id", T.IntegerType()),
    T.StructField("payer_company_nm", T.StringType()),
    T.StructField("payer_bin_nbr", T.StringType()),
    T.StructField("days_supply_val", T.DoubleType()),
    T.StructField("awp_unit_price_amt", T.DoubleType()),
    T.StructField("total_paid_amt", T.DoubleType()),
    T.StructField("patient_to_pay_amt", T.DoubleType()),
    T.StructField("update_ts", T.StringType()),
    T.StructField("source_file_key", T.StringType()),
])

# Columns the cleaning step parses leniently from text (bad value -> null).
DATE_COLUMNS = ("service_date_dd", "transaction_dt", "date")
# Columns whose absence means something else than nulls (PRJ3, AGG6, FA11).
OPTIONAL_COLUMNS = ("type_1_npi", "prescriber_npi_nbr", "clinical_service_line", "reject_reason_1_desc")
MONEY_COLUMNS = ("awp_unit_price_amt", "total_paid_amt", "patient_to_pay_amt")
# The texts that pandas reads as a missing value.
MISSING = ("", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
           "NaN", "None", "n/a", "nan", "null")
# Date forms beyond ISO, by the shape of the text; the first form that reads it wins (PRJ1).
DATE_FORMS = ((r"^\d{8}$", ("yyyyMMdd",)),
              (r"^\d{1,2}/\d{1,2}/\d{4}", ("M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy h:mm a", "M/d/yyyy h:mm:ss a", "d/M/yyyy")),
              (r"^\d{1,2}/\d{1,2}/\d{2}$", ("M/d/yy",)),
              (r"^\d{4}/\d{1,2}/\d{1,2}", ("yyyy/M/d", "yyyy/M/d H:mm", "yyyy/M/d H:mm:ss")),
              (r"^\d{1,2}-\d{1,2}-\d{4}", ("M-d-yyyy", "d-M-yyyy")),
              (r"^\d{1,2}\.\d{1,2}\.\d{4}", ("M.d.yyyy", "d.M.yyyy")),
              (r"^\d{1,2}[- ]?[A-Za-z]{3}[- ]?\d{4}$", ("d-MMM-yyyy", "d MMM yyyy", "dMMMyyyy")),
              (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", ("d MMMM yyyy",)),
              (r"^[A-Za-z]{3} \d{1,2},? \d{4}$", ("MMM d, yyyy", "MMM d yyyy")),
              (r"^[A-Za-z]{4,9} \d{1,2},? \d{4}$", ("MMMM d, yyyy", "MMMM d yyyy")))
#: Bytes in which a file's header line must end.
HEADER_BYTES = 1 << 20


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header): the column names of every CSV file under ``path``, read
    by tasks from the beginning of each file (names are trimmed, a byte order
    mark goes, a repeated name gets .1, .2 as in pandas). An empty file has no
    columns. A missing path is Spark's PATH_NOT_FOUND."""
    files = sorted(spark.read.text(path).inputFiles())
    slices = max(1, min(len(files) // 16, 4 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("file").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array([_header(f) for f in names], pa.list_(pa.string()))], ["file", "header"])

    listed = spark.createDataFrame([(f,) for f in files], "file string")
    return listed.repartition(slices).mapInArrow(run, "file string, header array<string>")


def _header(uri: str) -> list[str]:
    """First CSV record of a file on any file system that Arrow knows."""
    store, name = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(name) as f:
        head = f.read(HEADER_BYTES).decode("utf-8-sig", "replace")
    row = next(csv.reader(io.StringIO(head)), []) if head.strip() else []
    seen: dict[str, int] = {}
    out = []
    for c in (x.strip() for x in row):
        out.append(f"{c}.{seen[c]}" if c in seen else c)
        seen[c] = seen.get(c, 0) + 1
    return out


def read_claims_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The CSV files of ``path`` (a file, a folder, a glob or a list) as text
    columns by name, whatever each file's columns and their order. Files with
    one and the same header are read together; a column that no file has is
    not in the result, one that some files lack is null in their rows."""
    groups = file_headers(spark, path).where(F.size("header") > 0) \
        .groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()  # the driver lists the files anyway
    rows = None
    for header, files in sorted((tuple(r.header), r.files) for r in groups):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        part = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
                .option("enforceSchema", True).csv(files))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows if rows is not None else spark.createDataFrame([], T.StructType())


def present(c: Column) -> Column:
    """The trimmed text, null where pandas reads a missing value."""
    t = F.trim(c)
    return F.when(~t.isin(*MISSING), t)


def tolerant(c: Column, kind: T.DataType) -> Column:
    """A text as a value of ``kind``; null if it isn't one. Whole numbers may be
    written as decimals or with an exponent ("30.0", "1.0E9"), as software
    writes them once a column has a missing value."""
    t = present(c)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        d = t.try_cast("double")
        whole = F.when((F.floor(d) == d) & (F.abs(d) < F.lit(2.0 ** 53)), d.cast("bigint"))
        out = F.coalesce(t.try_cast("bigint"), whole)
        return out if isinstance(kind, T.LongType) else out.try_cast("int")
    if isinstance(kind, T.DoubleType):
        return nan_to_null(t.try_cast("double"))
    return t


def parse_date(c: Column) -> Column:
    """PRJ1: wall-clock time of a date text, null if no form reads it. Two
    numbers that could be month or day are taken as month first, as pandas
    does; the day comes first where only that is a date."""
    t = present(c)
    # wall-clock (no time zone), independent of the session zone
    out = t.try_cast("timestamp_ntz")
    for shape, forms in DATE_FORMS:
        read = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in forms]).cast("timestamp_ntz")
        out = F.when(t.rlike(shape), read).otherwise(out)
    return out


def typed_claims(raw: DataFrame, schema: T.StructType = CLAIMS_SCHEMA) -> DataFrame:
    """Text columns cast to the contract's types, value by value: what can't be
    read is null (``claims_rejects`` counts it). Columns of the contract that
    are absent are null, but those of ``OPTIONAL_COLUMNS`` stay absent, since
    operators ask for their presence; others stay text."""
    known = {f.name: f.dataType for f in schema.fields}
    cols = [tolerant(F.col(f"`{c}`"), known.get(c, T.StringType())).alias(c) for c in raw.columns]
    lost = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in raw.columns and f.name not in OPTIONAL_COLUMNS]
    return normalise_claims(raw.select(*cols, *lost))


def claims_rejects(raw: DataFrame, schema: T.StructType = CLAIMS_SCHEMA) -> DataFrame:
    """(column, filled, rejected) for each number and date column of ``raw``:
    texts that are there, and those of them that can't be read."""
    counts = []
    for f in schema.fields:
        if f.name not in raw.columns or (f.dataType == T.StringType() and f.name not in DATE_COLUMNS):
            continue
        c = F.col(f"`{f.name}`")
        value = parse_date(c) if f.name in DATE_COLUMNS else tolerant(c, f.dataType)
        counts.append(F.struct(F.lit(f.name).alias("column"), F.count(present(c)).alias("filled"),
                               F.count_if(present(c).isNotNull() & value.isNull()).alias("rejected")))
    return raw.agg(F.array(*counts).alias("a")).select(F.inline("a"))


def read_claims_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = CLAIMS_SCHEMA) -> DataFrame:
    """SRC1: header CSV on any file system, columns by name and values cast one
    by one; see ``read_claims_text`` and ``typed_claims``."""
    return typed_claims(read_claims_text(spark, path), schema)


def normalise_claims(df: DataFrame) -> DataFrame:
    """Lenient date parse (PRJ1) and NaN -> null for money columns."""
    out = {}
    for c in DATE_COLUMNS:
        if c in df.columns:
            dt = dict(df.dtypes)[c]
            if dt == "string":
                out[c] = parse_date(F.col(c))
            elif dt in ("date", "timestamp"):
                out[c] = F.col(c).cast("timestamp_ntz")
    for c in MONEY_COLUMNS + ("type_1_npi", "type_2_npi"):
        if c in df.columns:
            out[c] = nan_to_null(F.col(c).cast("double"))
    return df.withColumns(out) if out else df


# ---------------------------------------------------------------------------
# SRC2: claims view over the star-schema test tables (mapping in FIXTURES.md)
# ---------------------------------------------------------------------------

# Fixed values of the claims view mapping (FIXTURES.md section 2).
GENERIC_BY_PARTKEY_MOD4 = {0: "Cemiplimab-Rwlc", 1: "Nivolumab", 2: "Pembrolizumab"}
BRAND_BY_PARTKEY_MOD4 = {0: "Libtayo", 1: "Opdivo", 2: "Keytruda"}
CHANNEL_BY_SEGMENT = {
    "AUTOMOBILE": "Medicare",
    "BUILDING": "Commercial",
    "FURNITURE": "Medicaid",
    "HOUSEHOLD": "Other",
}
CHANNEL_DEFAULT = "Dual (Medicaid/Medicare)"


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or ["lineitem", "orders", "customer", "supplier", "part", "nation"]
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _case_map(key: F.Column, mapping: dict, default: F.Column) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr.otherwise(default)


def claims_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2. lineitem ⋈ orders ⋈ customer ⋈ supplier ⋈ part ⋈ nation.

    Join strategy is left to Catalyst/AQE: the fact-to-fact join
    (lineitem-orders) is a sort-merge join on orderkey; customer/supplier/part
    become broadcast joins only when their measured size is under the
    broadcast threshold. ``nation`` (25 rows by definition) is broadcast.
    """
    t = load_tables(spark, sf_dir)
    l, o, c, s, p, n = (t[k] for k in ("lineitem", "orders", "customer", "supplier", "part", "nation"))
    j = (l.join(o, l.l_orderkey == o.o_orderkey)
          .join(c, o.o_custkey == c.c_custkey)
          .join(s, l.l_suppkey == s.s_suppkey)
          .join(p, l.l_partkey == p.p_partkey)
          .join(F.broadcast(n), s.s_nationkey == n.n_nationkey))
    pk4 = F.pmod(F.col("l_partkey"), F.lit(4))
    status = (F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("Reject"))
               .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit("Reversed"))
               .when((F.col("l_returnflag") == "N") & (F.col("l_tax") == 0), F.lit(None).cast("string"))
               .otherwise(F.lit("Dispensed")))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("claim_number"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        (F.lit(18) + F.pmod(F.col("c_custkey"), F.lit(67))).cast("int").alias("patient_age"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(2)) == 0, F.lit("F")).otherwise(F.lit("M")).alias("patient_gender"),
        F.when(F.col("l_quantity") == 50, F.lit(None).cast("double"))
         .otherwise((F.lit(1000000000) + F.col("l_suppkey")).cast("double")).alias("type_1_npi"),
        F.col("s_name").alias("prescriber_npi_nm"),
        F.col("n_name").alias("prescriber_npi_state_cd"),
        _case_map(pk4, GENERIC_BY_PARTKEY_MOD4, F.col("p_type")).alias("drug_generic_name"),
        _case_map(pk4, BRAND_BY_PARTKEY_MOD4, F.col("p_type")).alias("drug_brand_name"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("service_date_dd"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("transaction_dt"),
        status.alias("transaction_status"),
        F.col("l_quantity").cast("int").alias("days_supply_val"),
        F.col("p_retailprice").alias("awp_unit_price_amt"),
        F.when(F.col("l_discount") == 0, F.lit(0.0))
         .otherwise(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("total_paid_amt"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("patient_to_pay_amt"),
        _case_map(F.col("c_mktsegment"), CHANNEL_BY_SEGMENT, F.lit(CHANNEL_DEFAULT)).alias("payer_channel_name"),
        F.substring(F.col("o_orderpriority"), 3, 1 << 20).alias("payer_name"),
        F.col("p_type").alias("clinical_service_line"),
        F.when(F.col("l_linenumber") >= 6, F.lit("MR")).alias("reject_reason_1_cd"),
        F.when(F.col("l_linenumber") >= 6, F.when(F.pmod("l_partkey", F.lit(3)) == 0, F.lit("Prior authorization")).otherwise(F.lit("Not covered")))
         .alias("reject_reason_1_desc"),
        (F.lit(2000000000) + F.pmod(F.col("l_partkey"), F.lit(15))).cast("bigint").alias("pharmacy_npi_nbr"),
    )
