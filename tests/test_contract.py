"""Driver contract and a representative set of queries against the DuckDB oracle."""

import datetime as dt
import decimal
import importlib.util
import math
import os

import duckdb
import pytest

from wardline.sources.tables import TABLES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in recs), key=repr)


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert len(df.collect()) > 0
    assert "median_lead_days" in df.columns


def test_every_oracle_has_a_query():
    m = _entry()
    assert set(m.oracle_sql()) <= set(m.queries())
    assert len(m.queries()) >= 100


SAMPLE = [
    "mrt2_lead_time_by_priority", "dq8e_load_report", "jn4_asof_with_fallback", "scd3_change_log",
    "dim2_date", "fct5_invoices", "mrt7_completeness", "in42_cumulative_lead_curves", "lk2_candidate_pairs",
    "smp1_systematic_sample", "dq46_blocking_completeness", "snk1_batch_load_report",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    m = _entry()
    df = m.queries()[name](spark, SF)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(m.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows(df.columns, df.collect()) == rows(dcols, cur.fetchall())


def test_every_injected_defect_is_caught(spark):
    """Truth confrontation: each defect the landing rules inject is flagged with the
    expected reason, and nothing else carries those reasons."""
    out = _entry().queries()["dq14_truth_vs_quarantine"](spark, SF).collect()
    injected = [r for r in out if r["n_truth"] > 0]
    assert injected, "the fixture should contain injected defects"
    for r in injected:
        assert r["n_missing"] == 0 and r["n_extra"] == 0, r
