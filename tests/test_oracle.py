"""Registered queries vs their DuckDB oracle on sf0.001 (a fast subset)."""
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KEYS = ["silver", "win_skew_split", "scored", "dedup", "dim_customer", "dim_channel", "fact_transaction",
        "fact_alert", "fire_rates", "decile_lift", "threshold_tradeoff", "m_approval_rate",
        "m_firings_per_txn_by_rule", "m_high_risk_by_band", "cube_overview", "mess_rates", "fingerprint_diff",
        "cdc_apply", "cdc_decode", "csv_roundtrip", "cdc_compact_buckets", "cdc_batch_gap", "cdc_mirror_as_of",
        "cdc_validity", "cdc_feed_columns", "orphans_planted", "run_ledger", "star_published", "cubes_one_scan",
        "rollup_month_band", "kpi_headline_sen", "band_replaced", "parse_rates", "stream_velocity_append",
        "stream_new_merchant", "stream_dedup_watermark", "load_log"]


def _norm(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    def n(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    out = [tuple(n(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ("events", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    res = con.execute(E.oracle_sql()[key])
    onames = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(onames)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), onames)


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"yr", "mth", "channel", "risk_band", "txn_type", "transactions", "total_amount"} == set(df.columns)


def test_oracle_sql_needs_no_spark_session():
    """The driver may read oracle_sql() in a process without Spark."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as E; o = E.oracle_sql(); q = E.queries(); print(len(o), len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    n_oracle, n_queries = map(int, out.stdout.split())
    assert 0 < n_oracle <= n_queries
