"""Driver contract: entry runs; a sample of queries match their DuckDB oracles at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL

TABLES = "customer orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return "inf" if math.isinf(v) else round(v, 6)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=str)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"grp", "time", "survival"} <= set(df.columns)


def test_every_oracle_names_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["cohort_reorder", "km_reorder_by_priority", "cif_gap",
                                  "logrank_pairwise_reorder", "cox_score_reorder",
                                  "cindex_custlife_tied", "brier_cox_reorder"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, res.fetchall())
