"""DuckDB SQL oracles for the registered queries (tables are pre-registered views).

Written independently of the Spark plans: plain windows over whole partitions, self-joins where
that is the simplest statement of the definition. Doubles are rounded to 6 places.
"""

from __future__ import annotations

# ---------------------------------------------------------------- cohort CTEs

REORDER = """reorder AS (
  SELECT o.o_orderkey AS subject_id, o.o_orderpriority AS grp,
         CAST(greatest(1, date_diff('day', CAST(o.o_orderdate AS DATE),
              CAST(coalesce(o.nxt, TIMESTAMP '2001-08-02 00:00:00') AS DATE))) AS DOUBLE) AS duration,
         CAST(o.nxt IS NOT NULL AS INTEGER) AS event,
         CAST(o.o_totalprice AS DOUBLE) AS x1, CAST(c.c_acctbal AS DOUBLE) AS x2
  FROM (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt
        FROM orders) o
  JOIN customer c ON c.c_custkey = o.o_custkey)"""

GAP = """gap AS (
  SELECT e.event_id AS subject_id, e.event_type AS grp,
         CAST(epoch_us(coalesce(e.nxt_ts, TIMESTAMP '2024-01-31 00:00:00')) - epoch_us(e.ts) AS DOUBLE)
           / 3600000000.0 AS duration,
         CAST(CASE WHEN e.nxt_ts IS NULL THEN 0 WHEN e.nxt_type = 'purchase' THEN 1
                   WHEN e.nxt_type = 'error' THEN 2 ELSE 0 END AS INTEGER) AS cause,
         CAST(e.value AS DOUBLE) AS x1
  FROM (SELECT *, lead(ts) OVER w AS nxt_ts, lead(event_type) OVER w AS nxt_type
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) e)"""

CUSTLIFE = """custlife AS (
  SELECT c.c_custkey AS subject_id, c.c_mktsegment AS grp,
         CAST(greatest(1, date_diff('day', CAST(p.first_at AS DATE),
              CAST(coalesce(p.f_at, p.last_at) AS DATE))) AS DOUBLE) AS duration,
         CAST(p.f_at IS NOT NULL AS INTEGER) AS event, CAST(c.c_acctbal AS DOUBLE) AS x1
  FROM (SELECT o_custkey, min(o_orderdate) AS first_at,
               min(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS f_at,
               max(o_orderdate) AS last_at
        FROM orders GROUP BY o_custkey) p
  JOIN customer c ON c.c_custkey = p.o_custkey)"""

LINEQTY = """lineqty AS (
  SELECT CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS subject_id, l_linestatus AS grp,
         CAST(l_quantity AS DOUBLE) AS duration, CAST(l_returnflag = 'R' AS INTEGER) AS event,
         CAST(l_extendedprice AS DOUBLE) AS x1, CAST(l_discount AS DOUBLE) AS x2
  FROM lineitem)"""

COHORT_CTE = {"reorder": REORDER, "gap": GAP, "custlife": CUSTLIFE, "lineqty": LINEQTY}


def with_cohort(name: str, body: str, *extra: str) -> str:
    ctes = ",\n".join([COHORT_CTE[name], *extra])
    return f"WITH {ctes}\n{body}"


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def risk_cte(src: str, group: str | None, event_expr: str = "event > 0") -> list[str]:
    """Risk table CTEs ``rt`` and ``rs`` over a cohort CTE (optionally grouped)."""
    gsel = f"{group}, " if group else ""
    gpart = f"PARTITION BY {group} " if group else ""
    gwhere = f"WHERE {group} IS NOT NULL" if group else ""
    return [
        f"""rt AS (SELECT {gsel}duration AS time, CAST(count(*) AS BIGINT) AS n_total,
                   CAST(sum(CASE WHEN {event_expr} THEN 1 ELSE 0 END) AS BIGINT) AS d
            FROM {src} {gwhere} GROUP BY ALL)""",
        f"""rs AS (SELECT *, CAST(sum(n_total) OVER ({gpart}ORDER BY time DESC) AS BIGINT) AS n_at_risk
            FROM rt)""",
    ]


def km_cte(group: str | None) -> str:
    gpart = f"PARTITION BY {group} " if group else ""
    return f"""km AS (
      SELECT *,
        CASE WHEN zeros > 0 THEN 0.0 ELSE exp(logs) END AS survival
      FROM (SELECT *,
          sum(CASE WHEN d < n_at_risk THEN ln(1 - CAST(d AS DOUBLE) / n_at_risk) ELSE 0 END) OVER w AS logs,
          sum(CASE WHEN d < n_at_risk THEN 0 ELSE 1 END) OVER w AS zeros,
          sum(CASE WHEN d < n_at_risk THEN CAST(d AS DOUBLE) / (n_at_risk * (n_at_risk - d)) ELSE 0 END)
            OVER w AS var_greenwood,
          sum(CASE WHEN d > 0 THEN list_sum(list_transform(range(0, d), lambda i: 1.0 / (n_at_risk - i)))
                   ELSE 0 END) OVER w AS cum_hazard
        FROM rs WINDOW w AS ({gpart}ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"""


Z = "1.959963984540054"
BAND_LOWER = (f"CASE WHEN survival >= 1 THEN 1.0 WHEN survival <= 0 THEN 0.0 ELSE "
              f"pow(survival, exp(-({Z} * sqrt(var_greenwood) / ln(survival)))) END")
BAND_UPPER = (f"CASE WHEN survival >= 1 THEN 1.0 WHEN survival <= 0 THEN 0.0 ELSE "
              f"pow(survival, exp({Z} * sqrt(var_greenwood) / ln(survival))) END")


def km_select(group: str | None) -> str:
    g = f"{group}, " if group else ""
    return (f"SELECT {g}{r6('time', 'time')}, n_at_risk, d, n_total - d AS c, "
            f"{r6('survival', 'survival')}, {r6('var_greenwood', 'var_greenwood')}, "
            f"{r6(BAND_LOWER, 'lower')}, {r6(BAND_UPPER, 'upper')}, {r6('cum_hazard', 'cum_hazard')} "
            f"FROM km")


SQL: dict[str, str] = {}

SQL["cohort_reorder"] = with_cohort(
    "reorder", f"SELECT subject_id, grp, {r6('duration', 'duration')}, event, "
               f"{r6('x1', 'x1')}, {r6('x2', 'x2')} FROM reorder")
SQL["cohort_gap"] = with_cohort(
    "gap", f"SELECT subject_id, grp, {r6('duration', 'duration')}, cause, {r6('x1', 'x1')} FROM gap")
SQL["cohort_custlife"] = with_cohort(
    "custlife", f"SELECT subject_id, grp, {r6('duration', 'duration')}, event, {r6('x1', 'x1')} "
                f"FROM custlife")
SQL["cohort_lineqty"] = with_cohort(
    "lineqty", f"SELECT subject_id, grp, {r6('duration', 'duration')}, event, "
               f"{r6('x1', 'x1')}, {r6('x2', 'x2')} FROM lineqty")

SQL["risk_table_lineqty"] = with_cohort(
    "lineqty", f"SELECT grp, {r6('time', 'time')}, n_at_risk, d, n_total - d AS c FROM rs",
    *risk_cte("lineqty", "grp"))

SQL["km_reorder_by_priority"] = with_cohort(
    "reorder", km_select("grp"), *risk_cte("reorder", "grp"), km_cte("grp"))
SQL["km_custlife"] = with_cohort(
    "custlife", km_select(None), *risk_cte("custlife", None), km_cte(None))
SQL["km_lineqty_by_status"] = with_cohort(
    "lineqty", km_select("grp"), *risk_cte("lineqty", "grp"), km_cte("grp"))


def band_cte() -> str:
    return f"kb AS (SELECT *, {BAND_LOWER} AS lower, {BAND_UPPER} AS upper FROM km)"


INF = "CAST('inf' AS DOUBLE)"

SQL["km_lookup_reorder"] = with_cohort(
    "reorder",
    f"""SELECT km.grp, {r6('q.q', 'time')},
         {r6('CASE WHEN q.q < min(km.time) THEN 1.0 ELSE arg_max(survival, time) FILTER (WHERE time <= q.q) END', 'survival')},
         {r6('CASE WHEN q.q < min(km.time) THEN 0.0 ELSE arg_max(cum_hazard, time) FILTER (WHERE time <= q.q) END', 'cum_hazard')}
       FROM km CROSS JOIN (VALUES (30.0), (90.0), (180.0), (365.0)) q(q) GROUP BY km.grp, q.q""",
    *risk_cte("reorder", "grp"), km_cte("grp"))

SQL["km_median_reorder"] = with_cohort(
    "reorder",
    f"""SELECT grp,
         {r6(f'coalesce(min(time) FILTER (WHERE survival <= 0.5 + 1e-12), {INF})', 'median')},
         {r6(f'coalesce(min(time) FILTER (WHERE lower <= 0.5 + 1e-12), {INF})', 'ci_lower')},
         {r6(f'coalesce(min(time) FILTER (WHERE upper <= 0.5 + 1e-12), {INF})', 'ci_upper')}
       FROM kb GROUP BY grp""",
    *risk_cte("reorder", "grp"), km_cte("grp"), band_cte())

SQL["subgroup_medians_custlife"] = with_cohort(
    "custlife",
    f"""SELECT m.grp AS "group", {r6('m.med', 'median_survival')}, c.n_subjects, c.n_events
       FROM (SELECT grp, coalesce(min(time) FILTER (WHERE survival <= 0.5 + 1e-12), {INF}) AS med
             FROM km GROUP BY grp) m
       JOIN (SELECT grp, CAST(count(*) AS BIGINT) AS n_subjects,
                    CAST(sum(CASE WHEN event > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_events
             FROM custlife WHERE grp IS NOT NULL GROUP BY grp) c ON c.grp = m.grp""",
    *risk_cte("custlife", "grp"), km_cte("grp"))

SQL["logrank_pairwise_reorder"] = with_cohort(
    "reorder",
    f"""SELECT group_a, group_b, {r6('o_minus_e', 'o_minus_e')}, {r6('variance', 'variance')},
         {r6('CASE WHEN variance > 0 THEN o_minus_e * o_minus_e / variance ELSE 0 END', 'test_statistic')}
       FROM agg""",
    "times AS (SELECT DISTINCT duration AS t FROM reorder WHERE grp IS NOT NULL)",
    "grps AS (SELECT DISTINCT grp FROM reorder WHERE grp IS NOT NULL)",
    """cnt AS (SELECT grp, duration AS t, count(*) AS n_total, sum(event) AS d
              FROM reorder WHERE grp IS NOT NULL GROUP BY 1, 2)""",
    """grid AS (SELECT g.grp, t.t, coalesce(c.n_total, 0) AS n_total, coalesce(c.d, 0) AS d
               FROM grps g CROSS JOIN times t LEFT JOIN cnt c ON c.grp = g.grp AND c.t = t.t)""",
    """risk AS (SELECT grp, t, d, sum(n_total) OVER (PARTITION BY grp ORDER BY t DESC) AS n FROM grid)""",
    """pr AS (SELECT a.grp AS group_a, b.grp AS group_b, CAST(a.n AS DOUBLE) AS na, CAST(a.d AS DOUBLE) AS da,
                    CAST(a.n + b.n AS DOUBLE) AS n, CAST(a.d + b.d AS DOUBLE) AS dd
             FROM risk a JOIN risk b ON a.t = b.t AND a.grp < b.grp)""",
    """agg AS (SELECT group_a, group_b,
                     sum(da - CASE WHEN n > 0 THEN dd * na / n ELSE 0 END) AS o_minus_e,
                     sum(CASE WHEN n > 1 THEN dd * (n - dd) / (n - 1) * (na / n) * (1 - na / n) ELSE 0 END)
                       AS variance
              FROM pr GROUP BY 1, 2)""")


def cif_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gp = f"PARTITION BY {group} " if group else ""
    gw = f"WHERE {group} IS NOT NULL" if group else ""
    own_log = "CASE WHEN d < n_at_risk THEN ln(1 - CAST(d AS DOUBLE) / n_at_risk) ELSE 0 END"
    own_zero = "CASE WHEN d < n_at_risk THEN 0 ELSE 1 END"
    prev = f"({gp}ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return with_cohort(
        "gap",
        f"""SELECT {g}c.cause, {r6('time', 'time')},
             {r6('least(1.0, greatest(0.0, CASE c.cause WHEN 1 THEN cif_1 ELSE cif_2 END))', 'cif')},
             {r6('survival', 'survival')}
           FROM ci CROSS JOIN (VALUES (1), (2)) c(cause) WHERE d > 0""",
        f"""rt AS (SELECT {g}duration AS time, count(*) AS n_total,
                   sum(CASE WHEN cause > 0 THEN 1 ELSE 0 END) AS d,
                   sum(CASE WHEN cause = 1 THEN 1 ELSE 0 END) AS d_1,
                   sum(CASE WHEN cause = 2 THEN 1 ELSE 0 END) AS d_2
            FROM gap {gw} GROUP BY ALL)""",
        f"rs AS (SELECT *, sum(n_total) OVER ({gp}ORDER BY time DESC) AS n_at_risk FROM rt)",
        f"""sv AS (SELECT *, coalesce(sum({own_log}) OVER {prev}, 0) AS logs_prev,
                          coalesce(sum({own_zero}) OVER {prev}, 0) AS zeros_prev FROM rs)""",
        f"""sp AS (SELECT *, CASE WHEN zeros_prev > 0 THEN 0.0 ELSE exp(logs_prev) END AS s_prev,
                   CASE WHEN zeros_prev + {own_zero} > 0 THEN 0.0 ELSE exp(logs_prev + {own_log}) END
                     AS survival FROM sv)""",
        f"""ci AS (SELECT *,
                   sum(s_prev * d_1 / n_at_risk) OVER ({gp}ORDER BY time ROWS UNBOUNDED PRECEDING) AS cif_1,
                   sum(s_prev * d_2 / n_at_risk) OVER ({gp}ORDER BY time ROWS UNBOUNDED PRECEDING) AS cif_2
            FROM sp)""")


SQL["cif_gap"] = cif_sql(None)
SQL["cif_gap_by_type"] = cif_sql("grp")

SQL["overview_reorder"] = with_cohort(
    "reorder",
    f"""SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN event > 0 THEN 1 ELSE 0 END) AS BIGINT) AS events,
         {r6('sum(CASE WHEN event > 0 THEN 1 ELSE 0 END) / count(*)', 'event_rate')},
         {r6('quantile_cont(duration, 0.5)', 'median_followup')}
       FROM reorder""")

SQL["histogram_gap"] = with_cohort(
    "gap",
    f"""SELECT CAST(r.range AS INTEGER) AS bin, {r6('mm.lo + r.range * ((mm.hi - mm.lo) / 40)', 'bin_lo')},
         {r6('mm.lo + (r.range + 1) * ((mm.hi - mm.lo) / 40)', 'bin_hi')},
         CAST(coalesce(c.n, 0) AS BIGINT) AS n
       FROM range(40) r CROSS JOIN mm LEFT JOIN c ON c.bin = r.range""",
    "mm AS (SELECT min(duration) AS lo, max(duration) AS hi FROM gap)",
    """c AS (SELECT least(39, CAST(floor((duration - lo) * 40.0 / (hi - lo)) AS INTEGER)) AS bin,
                   count(*) AS n
            FROM gap CROSS JOIN mm GROUP BY 1)""")

_DESCRIBE_COLS = ["duration", "x1", "x2"]
SQL["describe_reorder"] = with_cohort(
    "reorder",
    f"""SELECT "column", CAST(count(value) AS BIGINT) AS count, {r6('avg(value)', 'mean')},
         {r6('stddev_samp(value)', 'std')}, {r6('min(value)', 'min')},
         {r6('quantile_cont(value, 0.25)', 'q25')}, {r6('quantile_cont(value, 0.5)', 'q50')},
         {r6('quantile_cont(value, 0.75)', 'q75')}, {r6('max(value)', 'max')}
       FROM long WHERE value IS NOT NULL GROUP BY "column\"""",
    "long AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM reorder" for c in _DESCRIBE_COLS) + ")")

SQL["quartiles_gap_by_type"] = with_cohort(
    "gap",
    " UNION ALL ".join(
        f"SELECT grp, {r6(str(p), 'p')}, {r6(f'quantile_cont(duration, {p})', 'value')} FROM gap "
        f"WHERE duration IS NOT NULL GROUP BY grp" for p in (0.25, 0.5, 0.75)))


# ---------------------------------------------------------------- Cox at fixed coefficients

COX_B = (0.05, -0.02)


def cox_ctes(src: str = "reorder") -> list[str]:
    b1, b2 = COX_B
    return [
        f"st AS (SELECT avg(x1) AS m1, stddev_samp(x1) AS s1, avg(x2) AS m2, stddev_samp(x2) AS s2 "
        f"FROM {src} WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND duration IS NOT NULL AND event IS NOT NULL)",
        f"""z AS (SELECT subject_id, duration AS time, CAST(event AS DOUBLE) AS ev,
                    (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2
             FROM {src} CROSS JOIN st
             WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND duration IS NOT NULL AND event IS NOT NULL)""",
        f"e AS (SELECT *, {b1} * z1 + ({b2}) * z2 AS eta, exp({b1} * z1 + ({b2}) * z2) AS w FROM z)",
    ]


SQL["cox_score_reorder"] = with_cohort(
    "reorder",
    f"""SELECT term, {r6('value', 'value')} FROM (
          SELECT 'loglik' AS term, sum(ee - lsum) / (SELECT count(*) FROM z) AS value FROM ef
          UNION ALL SELECT 'grad_0', sum(e1 - (r1 * p0 - b1 * p1)) / (SELECT count(*) FROM z) FROM ef
          UNION ALL SELECT 'grad_1', sum(e2 - (r2 * p0 - b2 * p1)) / (SELECT count(*) FROM z) FROM ef
          UNION ALL SELECT 'hess_0_0', -sum((r11 * p0 - b11 * p1) - (r1 * r1 * q0 - 2 * r1 * b1 * q1 + b1 * b1 * q2))
                                        / (SELECT count(*) FROM z) FROM ef
          UNION ALL SELECT 'hess_0_1', -sum((r12 * p0 - b12 * p1)
                                            - (r1 * r2 * q0 - (r1 * b2 + b1 * r2) * q1 + b1 * b2 * q2))
                                        / (SELECT count(*) FROM z) FROM ef
          UNION ALL SELECT 'hess_1_1', -sum((r22 * p0 - b22 * p1) - (r2 * r2 * q0 - 2 * r2 * b2 * q1 + b2 * b2 * q2))
                                        / (SELECT count(*) FROM z) FROM ef)""",
    *cox_ctes(),
    """pt AS (SELECT time, sum(w) AS a0, sum(z1 * w) AS a1, sum(z2 * w) AS a2, sum(z1 * z1 * w) AS a11,
                    sum(z1 * z2 * w) AS a12, sum(z2 * z2 * w) AS a22, CAST(sum(ev) AS BIGINT) AS d,
                    sum(ev * w) AS b0, sum(ev * z1 * w) AS b1, sum(ev * z2 * w) AS b2,
                    sum(ev * z1 * z1 * w) AS b11, sum(ev * z1 * z2 * w) AS b12, sum(ev * z2 * z2 * w) AS b22,
                    sum(ev * z1) AS e1, sum(ev * z2) AS e2, sum(ev * eta) AS ee
             FROM e GROUP BY time)""",
    """rs AS (SELECT *, sum(a0) OVER w AS r0, sum(a1) OVER w AS r1, sum(a2) OVER w AS r2,
                    sum(a11) OVER w AS r11, sum(a12) OVER w AS r12, sum(a22) OVER w AS r22
             FROM pt WINDOW w AS (ORDER BY time DESC))""",
    """ef AS (SELECT *,
               list_sum(list_transform(range(0, d), lambda l: ln(r0 - l / d * b0))) AS lsum,
               list_sum(list_transform(range(0, d), lambda l: 1 / (r0 - l / d * b0))) AS p0,
               list_sum(list_transform(range(0, d), lambda l: (l / d) / (r0 - l / d * b0))) AS p1,
               list_sum(list_transform(range(0, d), lambda l: 1 / pow(r0 - l / d * b0, 2))) AS q0,
               list_sum(list_transform(range(0, d), lambda l: (l / d) / pow(r0 - l / d * b0, 2))) AS q1,
               list_sum(list_transform(range(0, d), lambda l: pow(l / d, 2) / pow(r0 - l / d * b0, 2))) AS q2
             FROM rs WHERE d > 0)""")

_BASELINE = [
    "bp AS (SELECT time, sum(w) AS ph, sum(CASE WHEN ev > 0 THEN 1 ELSE 0 END) AS d FROM e GROUP BY time)",
    "br AS (SELECT *, sum(ph) OVER (ORDER BY time DESC) AS risk FROM bp)",
    """bl AS (SELECT time, d / risk AS baseline_hazard,
                    sum(d / risk) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS cum_hazard FROM br)""",
]

SQL["cox_baseline_reorder"] = with_cohort(
    "reorder",
    f"SELECT {r6('time', 'time')}, {r6('baseline_hazard', 'baseline_hazard')}, "
    f"{r6('cum_hazard', 'cum_hazard')} FROM bl",
    *cox_ctes(), *_BASELINE)

SQL["cox_risk_reorder"] = with_cohort(
    "reorder", f"SELECT subject_id, {r6('eta', 'log_partial_hazard')} FROM e", *cox_ctes())

SQL["cox_survival_reorder"] = with_cohort(
    "reorder",
    f"""SELECT e.subject_id, {r6('h.q', 'time')}, {r6('exp(-h.h0 * e.w)', 'survival')}
        FROM e CROSS JOIN h""",
    *cox_ctes(), *_BASELINE,
    """h AS (SELECT q.q, coalesce(arg_max(cum_hazard, time) FILTER (WHERE time <= q.q), 0.0) AS h0
            FROM bl CROSS JOIN (VALUES (30.0), (90.0), (180.0), (365.0)) q(q) GROUP BY q.q)""")

SQL["cox_median_reorder"] = with_cohort(
    "reorder",
    f"""SELECT e.subject_id, {r6(f'coalesce(min(bl.time), {INF})', 'median')}
        FROM e LEFT JOIN bl ON bl.cum_hazard >= ln(2) * exp(-e.eta) GROUP BY e.subject_id""",
    *cox_ctes(), *_BASELINE)


# ---------------------------------------------------------------- evaluation

def cindex_sql(risk_expr: str) -> str:
    return with_cohort(
        "custlife",
        f"""SELECT CAST(count(*) AS DOUBLE) AS comparable,
              CAST(sum(CASE WHEN j.r < i.r THEN 1 ELSE 0 END) AS DOUBLE) AS concordant,
              CAST(sum(CASE WHEN j.r = i.r THEN 1 ELSE 0 END) AS DOUBLE) AS tied_risk,
              {r6('(sum(CASE WHEN j.r < i.r THEN 1 ELSE 0 END) + 0.5 * sum(CASE WHEN j.r = i.r THEN 1 ELSE 0 END)) / count(*)', 'c_index')}
            FROM s i JOIN s j ON i.e > 0 AND (j.t > i.t OR (j.t = i.t AND j.e = 0))""",
        f"""s AS (SELECT duration AS t, event AS e, {risk_expr} AS r FROM custlife
                 WHERE duration IS NOT NULL AND event IS NOT NULL AND {risk_expr} IS NOT NULL)""")


SQL["cindex_custlife"] = cindex_sql("CAST(x1 AS DOUBLE)")
SQL["cindex_custlife_tied"] = cindex_sql("round(x1 / 1000.0)")

SQL["cindex_cox_reorder"] = with_cohort(
    "reorder",
    f"""SELECT CAST(sum(n) AS DOUBLE) AS comparable, CAST(sum(lo) AS DOUBLE) AS concordant, CAST(sum(eq) AS DOUBLE) AS tied_risk,
          {r6('(sum(lo) + 0.5 * sum(eq)) / sum(n)', 'c_index')}
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE j.eta < i.eta) AS lo, count(*) FILTER (WHERE j.eta = i.eta) AS eq
              FROM e i JOIN e j ON i.ev > 0 AND (j.time > i.time OR (j.time = i.time AND j.ev = 0)))""",
    *cox_ctes())

_GC = """gc AS (SELECT time, CASE WHEN zeros > 0 THEN 0.0 ELSE exp(logs) END AS g
  FROM (SELECT time,
          sum(CASE WHEN c < n_at_risk - d THEN ln(1 - CAST(c AS DOUBLE) / (n_at_risk - d)) ELSE 0 END) OVER w AS logs,
          sum(CASE WHEN c < n_at_risk - d OR c = 0 THEN 0 ELSE 1 END) OVER w AS zeros
        FROM (SELECT *, n_total - d AS c FROM rs)
        WINDOW w AS (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"""

SQL["censoring_curve_reorder"] = with_cohort(
    "reorder", f"SELECT {r6('time', 'time')}, {r6('g', 'censoring_survival')} FROM gc",
    *risk_cte("reorder", None), _GC)

_TIMES = "(VALUES (30.0), (90.0), (180.0), (365.0)) v(q)"
_PRED = [
    *cox_ctes(), *_BASELINE,
    f"""h AS (SELECT v.q, coalesce(arg_max(cum_hazard, time) FILTER (WHERE time <= v.q), 0.0) AS h0
             FROM bl CROSS JOIN {_TIMES} GROUP BY v.q)""",
    "pred AS (SELECT e.subject_id, h.q AS time, exp(-h.h0 * e.w) AS survival FROM e CROSS JOIN h)",
    *risk_cte("reorder", None), _GC,
    """subj AS (SELECT r.subject_id, r.duration AS tt, r.event > 0 AS ev, g.g AS gt
               FROM reorder r ASOF LEFT JOIN gc g ON r.duration >= g.time)""",
]

SQL["brier_cox_reorder"] = with_cohort(
    "reorder",
    f"""SELECT metric, {r6('time', 'time')}, {r6('value', 'value')} FROM (
          SELECT 'brier' AS metric, time, value FROM bs
          UNION ALL
          SELECT 'ibs', NULL, sum(area) / (max(time) - min(time)) FROM (
            SELECT time, (lead(time) OVER (ORDER BY time) - time)
                         * (value + lead(value) OVER (ORDER BY time)) / 2 AS area FROM bs))""",
    *_PRED,
    f"""gq AS (SELECT v.q, arg_max(g, time) FILTER (WHERE time <= v.q) AS g_at FROM gc CROSS JOIN {_TIMES}
              GROUP BY v.q)""",
    """bs AS (SELECT p.time,
                    avg(CASE WHEN s.ev AND s.tt <= p.time AND s.gt > 0 THEN p.survival * p.survival / s.gt ELSE 0 END
                        + CASE WHEN s.tt > p.time THEN (1 - p.survival) * (1 - p.survival) / gq.g_at ELSE 0 END)
                      AS value
             FROM pred p JOIN subj s ON s.subject_id = p.subject_id JOIN gq ON gq.q = p.time
             WHERE p.time < (SELECT max(duration) FROM reorder) GROUP BY p.time)""")

SQL["auc_cox_reorder"] = with_cohort(
    "reorder",
    f"""SELECT {r6('t', 'time')}, {r6('CASE WHEN sum(w) > 0 AND sum(k) > 0 THEN sum(w * (k_lt + 0.5 * k)) / (sum(w) * sum(k)) END', 'auc')}
        FROM (SELECT *, coalesce(sum(k) OVER (PARTITION BY t ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k_lt
              FROM (SELECT v.q AS t, e.eta AS r,
                           sum(CASE WHEN s.ev AND s.tt <= v.q AND s.gt > 0 THEN 1 / s.gt ELSE 0 END) AS w,
                           sum(CASE WHEN s.tt > v.q THEN 1.0 ELSE 0 END) AS k
                    FROM subj s JOIN e ON e.subject_id = s.subject_id CROSS JOIN {_TIMES}
                    WHERE v.q < 0.99 * (SELECT max(duration) FROM reorder)
                    GROUP BY v.q, e.eta))
        GROUP BY t""",
    *_PRED)

SQL["crude_brier_cox_reorder"] = with_cohort(
    "reorder",
    f"""SELECT {r6('p.time', 'time')}, {r6('avg(pow(p.survival - CASE WHEN r.duration > p.time THEN 1.0 ELSE 0.0 END, 2))', 'brier')}
        FROM pred p JOIN reorder r ON r.subject_id = p.subject_id GROUP BY p.time""",
    *_PRED)


# ---------------------------------------------------------------- neural kernels, preparation

SQL["nn_cox_loss_reorder"] = with_cohort(
    "reorder",
    f"""SELECT {r6('sum(d * ln(risk) - s_ev) / sum(d)', 'loss')} FROM (
          SELECT *, sum(w) OVER (ORDER BY time DESC) AS risk FROM (
            SELECT time, sum(w) AS w, sum(ev) AS d, sum(CASE WHEN ev > 0 THEN eta ELSE 0 END) AS s_ev
            FROM e GROUP BY time))""",
    *cox_ctes())

SQL["discretise_gap"] = with_cohort(
    "gap",
    """SELECT CAST(least(floor((duration - lo) / (((hi + 1e-6) - lo) / 10)), 9) AS INTEGER) AS bin,
              CAST(count(*) AS BIGINT) AS n
       FROM gap CROSS JOIN (SELECT min(duration) AS lo, max(duration) AS hi FROM gap) GROUP BY 1""")

SQL["exp_curve_reorder"] = with_cohort(
    "reorder",
    f"""SELECT e.subject_id, {r6('v.q', 'time')},
           {r6('exp(-exp(e.eta - m.mr) * v.q / m.mt)', 'survival')}
        FROM e CROSS JOIN (SELECT avg(eta) AS mr, avg(time) AS mt FROM e) m CROSS JOIN {_TIMES}""",
    *cox_ctes())

SQL["duration_buckets_reorder"] = with_cohort(
    "reorder",
    """SELECT CASE WHEN duration > 0 AND duration <= 30 THEN '<=30'
                   WHEN duration > 30 AND duration <= 90 THEN '31-90'
                   WHEN duration > 90 AND duration <= 180 THEN '91-180'
                   WHEN duration > 180 AND duration <= 365 THEN '181-365'
                   WHEN duration > 365 THEN '>365' END AS bucket,
              CAST(count(*) AS BIGINT) AS n, CAST(sum(event) AS BIGINT) AS events
       FROM reorder GROUP BY 1""")

SQL["split_quotas_reorder"] = with_cohort(
    "reorder",
    """SELECT s.split, q.event, CAST(CASE s.split WHEN 'test' THEN q.n_test WHEN 'val' THEN q.n_val
                                     ELSE q.n - q.n_test - q.n_val END AS BIGINT) AS n
       FROM (SELECT event, n, n_test, CAST(floor((n - n_test) * (0.15 / 0.85) + 0.5) AS BIGINT) AS n_val
             FROM (SELECT event, count(*) AS n, CAST(floor(count(*) * 0.15 + 0.5) AS BIGINT) AS n_test
                   FROM reorder GROUP BY event)) q
       CROSS JOIN (VALUES ('train'), ('val'), ('test')) s(split)""")

SQL["scaler_reorder"] = with_cohort(
    "reorder",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(median({c}), 4) AS median, round(avg(coalesce({c}, m)), 4) AS mean,
                   round(stddev_pop(coalesce({c}, m)), 4) AS std
            FROM reorder CROSS JOIN (SELECT median({c}) AS m FROM reorder)"""
        for c in ("x1", "x2", "duration")))

SQL["patient_curves_reorder"] = with_cohort(
    "reorder",
    f"""SELECT e.subject_id, {r6('h.q', 'time')}, {r6('exp(-h.h0 * e.w)', 'survival')} FROM e CROSS JOIN h""",
    *cox_ctes(), *_BASELINE,
    """h AS (SELECT v.q, coalesce(arg_max(cum_hazard, time) FILTER (WHERE time <= v.q), 0.0) AS h0
            FROM bl CROSS JOIN (SELECT CAST(range AS DOUBLE) AS q FROM range(0, 361, 10)) v GROUP BY v.q)""")

SQL["martingale_reorder"] = with_cohort(
    "reorder",
    f"SELECT e.subject_id, {r6('e.ev - e.w * bl.cum_hazard', 'residual')} FROM e JOIN bl ON bl.time = e.time",
    *cox_ctes(), *_BASELINE)
