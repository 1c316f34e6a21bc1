import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rxcast.session import build_session
    s = build_session("local[4]", 4, app_name="rxcast-tests")
    yield s
    s.stop()


def claims_rows(spark, rows, extra_schema=None):
    """Build a claims frame from dicts; missing columns are null."""
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("claim_number", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("patient_age", T.IntegerType()),
        T.StructField("patient_gender", T.StringType()),
        T.StructField("type_1_npi", T.DoubleType()),
        T.StructField("prescriber_npi_nm", T.StringType()),
        T.StructField("prescriber_npi_state_cd", T.StringType()),
        T.StructField("drug_generic_name", T.StringType()),
        T.StructField("drug_brand_name", T.StringType()),
        T.StructField("service_date_dd", T.TimestampType()),
        T.StructField("transaction_status", T.StringType()),
        T.StructField("days_supply_val", T.IntegerType()),
        T.StructField("awp_unit_price_amt", T.DoubleType()),
        T.StructField("total_paid_amt", T.DoubleType()),
        T.StructField("patient_to_pay_amt", T.DoubleType()),
        T.StructField("payer_channel_name", T.StringType()),
        T.StructField("payer_name", T.StringType()),
        T.StructField("clinical_service_line", T.StringType()),
        T.StructField("reject_reason_1_cd", T.StringType()),
        T.StructField("pharmacy_npi_nbr", T.LongType()),
    ] + (extra_schema or []))
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)
