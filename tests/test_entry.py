"""Driver contract: entry smoke check, registry/oracle consistency, and the
oracle comparison on the smallest scale factor for a few headline queries."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

ROWS_ONLY = {"paired_t_pvalue", "signed_rank_pvalue", "mult_temporal", "cv_temporal", "predictions", "predictions_learned",
             "component_regressors"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "Predicted_sales" in df.columns and "hcp_id" in df.columns


def test_every_query_has_oracle_unless_rows_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in q if n in entry.QUERIES} - set(o) == ROWS_ONLY


def _duck(sf):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "pages", "events", "documents", "embeddings", "labels"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["predictions_five_factor", "hcp_rolling", "metrics_sales", "basic_stats", "drug_profile",
                                  "html_rows", "importance"])
def test_oracle_matches_at_smallest_scale(spark, name):
    sf = "/root/testdata/sf0.001"
    sdf = entry.queries()[name](spark, sf)
    con = _duck(sf)
    rel = con.sql(entry.oracle_sql()[name])
    s_cols, d_cols = sorted(c.lower() for c in sdf.columns), sorted(c.lower() for c in rel.columns)
    assert s_cols == d_cols

    def norm(rows, cols):
        idx = sorted(range(len(cols)), key=lambda i: cols[i].lower())
        return sorted(repr(tuple(None if (isinstance(r[i], float) and r[i] != r[i]) else r[i] for i in idx))
                      for r in rows)

    assert norm([tuple(r) for r in sdf.collect()], sdf.columns) == norm(rel.fetchall(), rel.columns)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def test_oracle_column_types_match(spark):
    """The driver compares schemas too: every oracle column has Spark's type."""
    sf = "/root/testdata/sf0.001"
    con = _duck(sf)
    bad = []
    for name, sql in entry.oracle_sql().items():
        s = {c.lower(): t for c, t in entry.queries()[name](spark, sf).dtypes}
        rel = con.sql(sql)
        d = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
        bad += [(name, c, t, d.get(c)) for c, t in s.items() if SPARK_TO_DUCK.get(t, t) != d.get(c)]
    assert bad == []
