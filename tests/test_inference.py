"""SQL of tails, Newton's steps and admission against independent Python; queries that equal their SQL at sf0.001."""

import math
from collections import deque

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from hazardflow.operators.cox import fit_cox, hazard_ratios
from hazardflow.plans.inference import _admission_sql, newton_ctes, tail_sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("half", [0.0, 1e-9, 0.01, 0.5, 1.92, 7.0, 29.0, 31.0, 900.0])
def test_tail_is_erfc(half):
    got = duckdb.sql(f"SELECT {tail_sql('x')} FROM (SELECT {half}::DOUBLE AS x)").fetchall()[0][0]
    assert got == pytest.approx(math.erfc(math.sqrt(half)), abs=1e-10)


def test_newton_statements_equal_the_fit(spark):
    rows = [(float(1 + (i * 37) % 23), int(i % 3 > 0), float((i * 17) % 11), float((i * i) % 7)) for i in range(120)]
    rows += [(5.0, 1, None, 1.0), (None, 1, 1.0, 1.0)]
    con = duckdb.connect()
    con.register("t", pd.DataFrame(rows, columns=["duration", "event", "x1", "x2"]))
    sql = "WITH c AS (SELECT CASE WHEN isnan(duration) THEN NULL ELSE duration END AS duration, event, " \
          "CASE WHEN isnan(x1) THEN NULL ELSE x1 END AS x1, x2 FROM t), " + ", ".join(newton_ctes("c", "event > 0", 2))
    c1, c2, v1, v2 = con.execute(f"{sql} SELECT c1, c2, v11, v22 FROM f").fetchall()[0]
    model = fit_cox(spark.createDataFrame(rows, "duration double, event int, x1 double, x2 double"), ["x1", "x2"])
    got = {r["feature"]: r for r in hazard_ratios(model)}
    assert (got["x1"]["coef"], got["x2"]["coef"]) == pytest.approx((c1, c2), abs=1e-7)
    assert (got["x1"]["se"], got["x2"]["se"]) == pytest.approx((math.sqrt(v1), math.sqrt(v2)), rel=1e-6)


@pytest.mark.parametrize("window,limit", [(10.0, 1), (10.0, 3), (0.0, 2)])
def test_admission_statement_equals_a_queue(window, limit):
    rows = [(i, i % 4, (i * i) % 97) for i in range(150)]
    con = duckdb.connect()
    con.register("raw", pd.DataFrame(rows, columns=["event_id", "user_id", "s"]))
    con.execute("CREATE VIEW events AS SELECT event_id, user_id, make_timestamp((s * 1000000)::BIGINT) AS ts FROM raw")
    got = dict(con.execute(f"SELECT event_id, admitted FROM ({_admission_sql(window, limit)})").fetchall())
    want, state = {}, {}
    for i, user, s in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        kept = state.setdefault(user, deque())
        while kept and s - kept[0] > window:
            kept.popleft()
        want[i] = len(kept) < limit
        if want[i]:
            kept.append(s)
    assert got == want


@pytest.mark.parametrize("name", ["status_cohort_customer", "coded_cohort_customer", "cohort_sizes", "registry_lineitem"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, df.select(*rel.columns).collect())) == sorted(map(key, rel.fetchall()))
