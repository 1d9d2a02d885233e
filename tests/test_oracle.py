"""A fast subset of the oracle gate on sf0.001 (the full gate runs on sf0.01
with ``scripts/check_oracle.py``)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
SUBSET = ["traffic_vc_ch_ar_is_new", "user_login_window", "province_order_window",
          "sku_order_enriched", "keyword_window", "fact_order_detail", "fact_refund_pay_suc",
          "dim_route", "dim_merge", "log_page", "dirty_records", "cdc_select_order_cancel",
          "fact_order_refund", "dwd_route", "province_order_from_fact", "metric_json_read", "cdc_gate_json",
          "log_parsed", "stream_traffic_home_detail_uv", "stream_province_order_window", "dim_job",
          "stream_log_split", "stream_dwd_route"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "uv_ct" in df.columns


def test_every_query_has_an_oracle_or_is_rows_only():
    from rtdw.plans.oracle import ORACLE
    from rtdw.plans.queries import QUERIES
    assert set(QUERIES) - set(ORACLE) == {"metric_json"}


@pytest.mark.parametrize("name", SUBSET)
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]
