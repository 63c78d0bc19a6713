"""Registered queries of cohort normalisers, prepared splits, registry and report tables, and SQL of fitted models and tests.

Newton's steps are a chain of DuckDB statements (``NEWTON_STEPS`` from zero, far beyond convergence on these cohorts),
normal and chi-square tails a series of the error function.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardflow.operators import cox, nonparam, prep
from hazardflow.operators.concordance import concordance_by, concordance_table
from hazardflow.plans import comparison
from hazardflow.plans.catalog import CURVE_TIMES, finish, once, register
from hazardflow.plans.extras import q_crude_table_custlife, q_permutation_importance
from hazardflow.plans.oracles import _PRED, _TIMES, COHORT_CTE, SQL, Z, km_cte, r6, with_cohort
from hazardflow.session import read_table
from hazardflow.sources.clinical import normalise_coded_cohort, normalise_status_cohort
from hazardflow.sources.cohorts import COHORTS, custlife, load_cohort, reorder
from hazardflow.sources.sinks import list_models

NEWTON_STEPS = 8


def tail_sql(half: str) -> str:
    """Upper tail of chi-square(1) at ``2 * half``, that is erfc(sqrt(half)); 0 from half = 30 on (below 1e-14)."""
    return (f"(CASE WHEN {half} <= 0 THEN 1.0 WHEN {half} > 30 THEN 0.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 200), "
            f"lambda n: exp((n + 0.5) * ln({half}) - {half} - lgamma(n + 1.5))))) END)")


# ---------------------------------------------------------------- cohorts and preparation (SRC-1, 2, 5, PREP-6, 8)

@register("status_cohort_customer")
def q_status_cohort(spark, sf):
    """SRC-1: codes 1/2 with dotted names and gaps, projected from every customer, normalised and filled with medians."""
    k = F.col("c_custkey")
    raw = read_table(spark, sf, "customer").select(
        k.alias("subject_id"), (k % 30).alias("inst"), (k % 900 + 1).alias("time"), (k % 2 + 1).alias("status"),
        F.when(k % 7 > 0, k % 4).alias("ph.ecog"), F.when(k % 11 > 0, F.col("c_acctbal").cast("double")).alias("wt.loss"))
    return finish(normalise_status_cohort(raw))


SQL["status_cohort_customer"] = f"""
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 4 END AS e,
             CASE WHEN c_custkey % 11 > 0 THEN c_acctbal END AS w FROM customer)
SELECT (k % 900 + 1)::DOUBLE AS duration, (k % 2 = 1)::INTEGER AS event, k::DOUBLE AS subject_id,
  {r6('coalesce(e, (SELECT median(e) FROM c))', 'ph_ecog')}, {r6('coalesce(w, (SELECT median(w) FROM c))', 'wt_loss')} FROM c
"""


@register("coded_cohort_customer")
def q_coded_cohort(spark, sf):
    """SRC-2: therapy, menopause and grade as words, projected from every customer, as codes."""
    k = F.col("c_custkey")
    word = lambda col, *ws: F.element_at(F.array(*[F.lit(w) for w in ws]), (col % len(ws) + 1).cast("int"))
    raw = read_table(spark, sf, "customer").select(
        k.alias("subject_id"), (k % 900 + 1).alias("time"), (k % 3 % 2).alias("cens"), word(k, "yes", "no").alias("horTh"),
        word(k, "Post", "Pre", "?").alias("menostat"), word(k, "I", "II", "III", "IV", "").alias("tgrade"))
    return normalise_coded_cohort(raw)


SQL["coded_cohort_customer"] = """
SELECT c_custkey AS subject_id, (c_custkey % 900 + 1)::DOUBLE AS duration, (c_custkey % 3 = 1)::INTEGER AS event,
  (c_custkey % 2 = 0)::INTEGER AS "horTh", (c_custkey % 3 = 0)::INTEGER AS menostat,
  CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 2 END AS tgrade FROM customer
"""


@register("cohort_sizes")
def q_cohort_sizes(spark, sf):
    """SRC-5: every named cohort by its name, with rows, events and the sum of durations."""
    out = None
    for name in COHORTS:
        data = load_cohort(spark, name, sf)
        event = F.col("cause" if "cause" in data.columns else "event") > 0
        one = data.agg(F.count(F.lit(1)).alias("n"), F.count_if(event).alias("events"), F.round(F.sum("duration"), 2).alias("total"))
        one = one.select(F.lit(name).alias("cohort"), "n", "events", "total")
        out = one if out is None else out.unionByName(one)
    return out


SQL["cohort_sizes"] = f"WITH {', '.join(COHORT_CTE.values())} " + " UNION ALL ".join(
    f"SELECT '{c}' AS cohort, count(*)::BIGINT AS n, count_if({'cause' if c == 'gap' else 'event'} > 0)::BIGINT AS events, "
    f"round(sum(duration), 2) AS total FROM {c}" for c in COHORT_CTE)


@register("prepared_reorder")
def q_prepared_reorder(spark, sf):
    """PREP-6/8: splits of the reorder cohort, gaps filled and scaled by the train rows' parameters."""
    data = once(reorder(spark, sf).withColumn("x2", F.when(F.col("subject_id") % 13 > 0, F.col("x2"))))
    done = prep.prepare_cohort(data, "reorder")
    parts = [p.select(F.lit(name).alias("split"), "subject_id", "event", *done.features)
             for name, p in (("train", done.train), ("val", done.val), ("test", done.test))]
    return finish(parts[0].unionByName(parts[1]).unionByName(parts[2]))


SQL["prepared_reorder"] = with_cohort(
    "reorder",
    f"""SELECT split, subject_id, event, {r6('(x1 - m1) / s1', 'x1')}, {r6('(coalesce(x2, d2) - m2) / s2', 'x2')} FROM sp CROSS JOIN pr""",
    f"sp AS (SELECT s.split, r.subject_id, r.event, r.x1, CASE WHEN r.subject_id % 13 > 0 THEN r.x2 END AS x2 "
    f"FROM reorder r JOIN ({SQL['split_reorder']}) s USING (subject_id))",
    "md AS (SELECT median(x2) AS d2 FROM sp WHERE split = 'train')",
    "pr AS (SELECT any_value(d2) AS d2, avg(x1) AS m1, stddev_pop(x1) AS s1, avg(coalesce(x2, d2)) AS m2, "
    "stddev_pop(coalesce(x2, d2)) AS s2 FROM sp CROSS JOIN md WHERE split = 'train')")


@register("registry_lineitem")
def q_registry_lineitem(spark, sf):
    """SINK-2: a registry with one registration a line item (equal ones count once), its active model derived."""
    rows = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("seq"), F.concat(F.lit("model_"), F.col("l_suppkey") % 3).alias("name"),
        (F.col("l_linenumber") / 10).alias("c_index"), F.col("l_linestatus").alias("dataset"),
        (F.col("l_returnflag") == "R").alias("make_active"))
    return finish(list_models(rows))


SQL["registry_lineitem"] = f"""
WITH r AS (SELECT DISTINCT l_orderkey AS seq, 'model_' || (l_suppkey % 3) AS name, l_linenumber / 10.0 AS c_index,
             l_linestatus AS dataset, l_returnflag = 'R' AS make_active FROM lineitem),
a AS (SELECT seq, name, dataset FROM r ORDER BY make_active DESC, CASE WHEN make_active THEN -seq ELSE seq END,
        CASE WHEN make_active THEN name END DESC, CASE WHEN make_active THEN dataset END DESC, name, dataset LIMIT 1)
SELECT r.name, {r6('r.c_index', 'c_index')}, r.dataset, a.seq IS NOT NULL AS is_active, r.seq
FROM r LEFT JOIN a ON a.seq = r.seq AND a.name = r.name AND a.dataset = r.dataset
"""


# ---------------------------------------------------------------- log-rank tests (NP-11, 12, 13)

@register("logrank_pairs_reorder")
def q_logrank_pairs(spark, sf):
    """NP-13: statistics, p-values and flags of all pairs of priorities."""
    return finish(nonparam.pairwise_logrank(once(reorder(spark, sf)), "grp"))


_LEVELS = "lv AS (SELECT grp, row_number() OVER (ORDER BY grp) AS i FROM (SELECT DISTINCT grp FROM reorder WHERE grp IS NOT NULL))"

SQL["logrank_pairs_reorder"] = with_cohort(
    "reorder",
    f"""SELECT group_a, group_b, {r6('z', 'o_minus_e')}, {r6('v', 'variance')}, {r6('x', 'test_statistic')}, {r6('p', 'p_value')}, p < 0.05 AS significant
        FROM (SELECT *, {tail_sql('(x / 2)')} AS p FROM (SELECT *, CASE WHEN v > 0 THEN z * z / v ELSE 0 END AS x FROM s))""",
    _LEVELS,
    "pr AS (SELECT a.grp AS group_a, b.grp AS group_b FROM lv a JOIN lv b ON a.i < b.i)",
    """t AS (SELECT group_a, group_b, duration AS time, count(*) AS n0, count_if(grp = group_a) AS a0, count_if(event > 0) AS d,
             count_if(event > 0 AND grp = group_a) AS da FROM reorder JOIN pr ON grp IN (group_a, group_b) GROUP BY ALL)""",
    """u AS (SELECT *, sum(n0) OVER w::DOUBLE AS n, sum(a0) OVER w::DOUBLE AS na FROM t
             WINDOW w AS (PARTITION BY group_a, group_b ORDER BY time DESC))""",
    """s AS (SELECT group_a, group_b, sum(da - d * na / n) AS z,
             sum(CASE WHEN n > 1 THEN d * (n - d) / (n - 1) * (na / n) * (1 - na / n) ELSE 0 END) AS v FROM u GROUP BY ALL)""")


def _logrank_sql(levels: int = 5) -> str:
    """Five groups: the leading 4 x 4 block of the covariance, its Cholesky factor row by row, chi2 = |L^-1 z|^2."""
    m = levels - 1
    cells = [(i, j) for i in range(1, m + 1) for j in range(i, m + 1)]
    sums = ", ".join(f"sum(d{i} - d * n{i} / n) AS z{i}" for i in range(1, m + 1)) + ", " + ", ".join(
        f"sum(CASE WHEN n > 1 THEN d * (n - d) / (n - 1) * n{i} / n * ({int(i == j)} - n{j} / n) ELSE 0 END) AS v{i}{j}" for i, j in cells)
    chain, source = [], "v"
    for i in range(1, m + 1):
        for j in range(1, i + 1):
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
            value = f"sqrt(v{i}{i}{less})" if i == j else f"(v{j}{i}{less}) / l{j}{j}"
            chain.append(f"c{i}{j} AS (SELECT *, {value} AS l{i}{j} FROM {source})")
            source = f"c{i}{j}"
        less = "".join(f" - l{i}{k} * y{k}" for k in range(1, i))
        chain.append(f"y{i}_ AS (SELECT *, (z{i}{less}) / l{i}{i} AS y{i} FROM {source})")
        source = f"y{i}_"
    chi2 = " + ".join(f"y{i} * y{i}" for i in range(1, m + 1))
    return with_cohort(
        "reorder",
        f"""SELECT 'grp' AS subgroup, {r6('x', 'test_statistic')}, {r6('exp(-x / 2) * (1 + x / 2)', 'p_value')},
              exp(-x / 2) * (1 + x / 2) < 0.05 AS significant FROM (SELECT {chi2} AS x FROM {source})""",
        _LEVELS,
        f"""t AS (SELECT duration AS time, count(*) AS n0, count_if(event > 0) AS d, {', '.join(
            f'count_if(i = {i}) AS a{i}, count_if(i = {i} AND event > 0) AS d{i}' for i in range(1, m + 1))}
            FROM reorder JOIN lv USING (grp) GROUP BY duration)""",
        f"""u AS (SELECT *, sum(n0) OVER w::DOUBLE AS n, {', '.join(f'sum(a{i}) OVER w::DOUBLE AS n{i}' for i in range(1, m + 1))}
            FROM t WINDOW w AS (ORDER BY time DESC))""",
        f"v AS (SELECT {sums} FROM u)", *chain)


SQL["logrank_reorder_by_priority"] = _logrank_sql()


# ---------------------------------------------------------------- fitted Cox models (COX-1, 3, 4, CR-3, RPT-5)

def newton_ctes(src: str, event: str, p: int, *, name: str = "", penalizer: float = 0.1, steps: int = NEWTON_STEPS) -> list[str]:
    """CTEs of a penalised Efron fit of ``x1`` (and ``x2``): ``{name}z`` rows, ``{name}b{steps}`` coefficients, ``{name}f`` result."""
    xs = range(1, p + 1)
    pairs = [(j, k) for j in xs for k in xs if j <= k]
    present = " AND ".join(["duration IS NOT NULL", f"({event}) IS NOT NULL", *[f"x{j} IS NOT NULL" for j in xs]])
    out = [
        f"{name}m AS (SELECT count(*) AS n, {', '.join(f'avg(x{j}) AS m{j}, stddev_samp(x{j}) AS s{j}' for j in xs)} FROM {src} WHERE {present})",
        f"{name}z AS MATERIALIZED (SELECT duration AS time, ({event})::INT AS ev, {', '.join(f'(x{j} - m{j}) / s{j} AS z{j}' for j in xs)} "
        f"FROM {src} CROSS JOIN {name}m WHERE {present})",
        f"{name}b0 AS (SELECT {', '.join(f'0.0::DOUBLE AS b{j}' for j in xs)})"]
    a = [("0", "1.0")] + [(f"{j}", f"z{j}") for j in xs] + [(f"{j}{k}", f"z{j} * z{k}") for j, k in pairs]
    term = lambda c, q: (f"list_sum(list_transform(range(0, d), lambda l: pow(l / d, {c}) / pow(r0 - l / d * d0, {q})))")
    for i in range(steps + 1):
        eta = " + ".join(f"b{j} * z{j}" for j in xs)
        out.append(f"{name}t{i} AS (SELECT time, sum(ev)::BIGINT AS d, {', '.join(f'sum({e} * w) AS a{c}, sum(ev * {e} * w) AS d{c}' for c, e in a)}, "
                   f"{', '.join(f'sum(ev * z{j}) AS e{j}' for j in xs)} FROM (SELECT *, exp({eta}) AS w FROM {name}z CROSS JOIN {name}b{i}) GROUP BY time)")
        out.append(f"{name}r{i} AS (SELECT *, {', '.join(f'sum(a{c}) OVER w AS r{c}' for c, _ in a)} FROM {name}t{i} WINDOW w AS (ORDER BY time DESC))")
        out.append(f"{name}e{i} AS (SELECT *, {term(0, 1)} AS p0, {term(1, 1)} AS p1, {term(0, 2)} AS q0, {term(1, 2)} AS q1, {term(2, 2)} AS q2 "
                   f"FROM {name}r{i} WHERE d > 0)")
        grad = ", ".join(f"sum(e{j} - (r{j} * p0 - d{j} * p1)) - any_value(n * {penalizer} * b{j}) AS g{j}" for j in xs)
        info = ", ".join(f"sum(r{j}{k} * p0 - d{j}{k} * p1 - (r{j} * r{k} * q0 - (r{j} * d{k} + d{j} * r{k}) * q1 + d{j} * d{k} * q2)) "
                         f"+ {'any_value(n * ' + str(penalizer) + ')' if j == k else '0'} AS h{j}{k}" for j, k in pairs)
        out.append(f"{name}g{i} AS MATERIALIZED (SELECT {', '.join(f'any_value(b{j}) AS b{j}' for j in xs)}, sum(d) AS deaths, {grad}, {info} "
                   f"FROM {name}e{i} CROSS JOIN {name}b{i} CROSS JOIN {name}m)")
        step = ({1: "b1 + g1 / h11 AS b1"} if p == 1 else
                {1: "b1 + (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12) AS b1", 2: "b2 + (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12) AS b2"})
        if i < steps:
            out.append(f"{name}b{i + 1} AS MATERIALIZED (SELECT {', '.join(step.values())} FROM {name}g{i})")
    det = "(h11 * h22 - h12 * h12)"
    var = "1 / h11 / (s1 * s1) AS v11" if p == 1 else (
        f"h22 / {det} / (s1 * s1) AS v11, -h12 / {det} / (s1 * s2) AS v12, h11 / {det} / (s2 * s2) AS v22")
    out.append(f"{name}f AS MATERIALIZED (SELECT deaths, {', '.join(f'b{j} / s{j} AS c{j}' for j in xs)}, {var} FROM {name}g{steps} CROSS JOIN {name}m)")
    return out


_HR = f"""SELECT *, exp(coef) AS hr, exp(coef - {Z} * se) AS lower_95, exp(coef + {Z} * se) AS upper_95,
    {tail_sql('(pow(coef / se, 2) / 2)')} AS p_value"""
_FIT = newton_ctes("reorder", "event > 0", 2)
_FIT_ROWS = "hz AS (" + _HR + " FROM (SELECT 'x1' AS feature, c1 AS coef, sqrt(v11) AS se FROM f UNION ALL SELECT 'x2', c2, sqrt(v22) FROM f))"

SQL["cox_fit_reorder"] = with_cohort(
    "reorder", f"SELECT feature, {', '.join(f'round({c}, 10) AS {c}' for c in ('coef', 'hr', 'se', 'lower_95', 'upper_95'))}, {r6('p_value', 'p_value')}, "
               "TRUE AS converged FROM hz",
    *_FIT, _FIT_ROWS)

SQL["cause_specific_cox_gap"] = with_cohort(
    "gap", f"SELECT cause, feature, {', '.join(r6(c, c) for c in ('coef', 'hr', 'se', 'p_value'))} FROM hz",
    *newton_ctes("gap", "cause = 1", 1, name="one_"), *newton_ctes("gap", "cause = 2", 1, name="two_"),
    f"hz AS ({_HR} FROM (SELECT 1 AS cause, 'x1' AS feature, c1 AS coef, sqrt(v11) AS se FROM one_f UNION ALL SELECT 2, 'x1', c1, sqrt(v11) FROM two_f))")

_LAST = NEWTON_STEPS
SQL["cox_ph_test_reorder"] = with_cohort(
    "reorder",
    f"""SELECT feature, {r6('x', 'test_statistic')}, {r6('p', 'p_value')}, p > 0.05 AS assumption_holds
        FROM (SELECT feature, x, {tail_sql('(x / 2)')} AS p FROM st)""",
    *_FIT,
    f"""rs AS (SELECT z.time, (z.z1 - r.r1 / r.r0) * m.s1 AS u1, (z.z2 - r.r2 / r.r0) * m.s2 AS u2,
              rank() OVER (ORDER BY z.time) + (count(*) OVER (PARTITION BY z.time) - 1) / 2.0 AS g
            FROM z JOIN r{_LAST} r ON r.time = z.time CROSS JOIN m WHERE z.ev > 0)""",
    """ce AS (SELECT *, g - avg(g) OVER () AS gc FROM rs)""",
    """sm AS (SELECT sum(gc * gc) AS gg, sum(gc * u1) AS w1, sum(gc * u2) AS w2 FROM ce)""",
    """st AS (SELECT 'x1' AS feature, pow(deaths * (v11 * w1 + v12 * w2), 2) / (deaths * v11 * gg) AS x FROM sm CROSS JOIN f
              UNION ALL SELECT 'x2', pow(deaths * (v12 * w1 + v22 * w2), 2) / (deaths * v22 * gg) FROM sm CROSS JOIN f)""")


@register("forest_table_reorder")
def q_forest_table(spark, sf):
    """RPT-5: hazard ratios of the fitted model with the lengths of their error bars."""
    m = cox.fit_cox(once(reorder(spark, sf)), ["x1", "x2"], penalizer=0.1)
    return finish(comparison.forest_table(cox.hazard_ratio_table(m, spark)), 10)


SQL["forest_table_reorder"] = with_cohort(
    "reorder",
    f"""SELECT feature, round(hr, 10) AS hr, round(lower_95, 10) AS lower_95, round(upper_95, 10) AS upper_95, round(hr - lower_95, 10) AS err_lo,
          round(upper_95 - hr, 10) AS err_hi, CASE WHEN hr > 1 THEN 'increased risk' ELSE 'decreased risk' END AS direction FROM hz""",
    *_FIT, _FIT_ROWS)


# ---------------------------------------------------------------- evaluation (EV-6, 7, 10, 11, RPT-6, 7)

SQL["calibration_cox_reorder"] = with_cohort(
    "reorder",
    f"""SELECT time, round((lo + hi) / 2, 3) AS bin_mid, {r6('predicted', 'predicted')}, {r6('coalesce(observed, 1.0)', 'observed')}, n
        FROM (SELECT time, bin, any_value(lo) AS lo, any_value(hi) AS hi, avg(survival) AS predicted, count(*) AS n FROM tg GROUP BY time, bin)
        LEFT JOIN ob USING (time, bin) WHERE n >= 5""",
    *_PRED,
    "ed AS (SELECT time, list_sort(list_distinct(quantile_cont(survival, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS es FROM pred GROUP BY time)",
    "bn AS (SELECT time, i AS bin, es[i] AS lo, es[i + 1] AS hi, i + 1 = len(es) AS last FROM (SELECT time, es, unnest(range(1, len(es))) AS i FROM ed))",
    """tg AS (SELECT p.time, b.bin, b.lo, b.hi, p.survival, r.duration, r.event FROM pred p JOIN reorder r USING (subject_id)
              JOIN bn b ON b.time = p.time AND p.survival >= b.lo AND (p.survival < b.hi OR (b.last AND p.survival <= b.hi)))""",
    """cn AS (SELECT *, sum(k) OVER (PARTITION BY time, bin ORDER BY duration DESC) AS n_at
              FROM (SELECT time, bin, duration, count(*) AS k, count_if(event > 0) AS d FROM tg GROUP BY ALL))""",
    """ob AS (SELECT time, bin, CASE WHEN bool_or(d = n_at) THEN 0.0 ELSE exp(sum(ln(1 - d / n_at))) END AS observed
              FROM cn WHERE duration <= time GROUP BY ALL)""")

_R4 = lambda e, alias: f"coalesce(round(({e})::DOUBLE, 4), 'nan'::DOUBLE) AS {alias}"
SQL["evaluation_cox_reorder"] = with_cohort(
    "reorder",
    f"""SELECT m.model, 'reorder' AS dataset, {_R4('ci.c', 'c_index')},
          {_R4("(SELECT sum(area) / (max(time) - min(time)) FROM ar WHERE ar.model = m.model)", 'ibs')},
          {', '.join(_R4(f'(SELECT auc FROM au WHERE au.model = m.model AND au.t = {t})', f'auc_{int(t)}d') for t in CURVE_TIMES)}
        FROM (VALUES ('cox_fixed'), ('kaplan_meier')) m(model) JOIN ci USING (model)""",
    *_PRED, km_cte(None),
    """ci AS (SELECT 'cox_fixed' AS model, (count(*) FILTER (WHERE j.eta < i.eta) + 0.5 * count(*) FILTER (WHERE j.eta = i.eta)) / count(*) AS c
              FROM e i JOIN e j ON i.ev > 0 AND (j.time > i.time OR (j.time = i.time AND j.ev = 0)) UNION ALL SELECT 'kaplan_meier', 0.5)""",
    f"kq AS (SELECT v.q, arg_max(survival, time) FILTER (WHERE time <= v.q) AS s FROM km CROSS JOIN {_TIMES} GROUP BY v.q)",
    """pm AS (SELECT 'cox_fixed' AS model, subject_id, time, survival FROM pred
              UNION ALL SELECT 'kaplan_meier', subject_id, q, s FROM reorder CROSS JOIN kq)""",
    f"gq AS (SELECT v.q, arg_max(g, time) FILTER (WHERE time <= v.q) AS g_at FROM gc CROSS JOIN {_TIMES} GROUP BY v.q)",
    """bs AS (SELECT p.model, p.time, avg(CASE WHEN s.ev AND s.tt <= p.time AND s.gt > 0 THEN p.survival * p.survival / s.gt ELSE 0 END
                + CASE WHEN s.tt > p.time THEN (1 - p.survival) * (1 - p.survival) / gq.g_at ELSE 0 END) AS value
              FROM pm p JOIN subj s USING (subject_id) JOIN gq ON gq.q = p.time WHERE p.time < (SELECT max(duration) FROM reorder) GROUP BY ALL)""",
    """ar AS (SELECT model, time, (lead(time) OVER w - time) * (value + lead(value) OVER w) / 2 AS area FROM bs
              WINDOW w AS (PARTITION BY model ORDER BY time))""",
    f"""ra AS (SELECT 'cox_fixed' AS model, v.q AS t, e.eta AS r, sum(CASE WHEN s.ev AND s.tt <= v.q AND s.gt > 0 THEN 1 / s.gt ELSE 0 END) AS w,
                sum(CASE WHEN s.tt > v.q THEN 1.0 ELSE 0 END) AS k
              FROM subj s JOIN e USING (subject_id) CROSS JOIN {_TIMES} WHERE v.q < 0.99 * (SELECT max(duration) FROM reorder) GROUP BY ALL)""",
    """rb AS (SELECT * FROM ra UNION ALL SELECT 'kaplan_meier', t, 0.0, sum(w), sum(k) FROM ra GROUP BY t)""",
    """au AS (SELECT model, t, CASE WHEN sum(w) > 0 AND sum(k) > 0 THEN sum(w * (below + 0.5 * k)) / (sum(w) * sum(k)) END AS auc
              FROM (SELECT *, coalesce(sum(k) OVER (PARTITION BY model, t ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                    FROM rb) GROUP BY ALL)""")


@register("full_comparison_custlife")
def q_full_comparison(spark, sf):
    """EV-11: the table of two fixed scorers stacked with a scorer whose table lacks data set and Brier columns."""
    deep = concordance_table(custlife(spark, sf).withColumn("risk", -F.col("x1"))).select(
        F.lit("balance_fine").alias("model"), F.round("c_index", 4).alias("c_index"), F.col("comparable").cast("long").alias("pairs"))
    return comparison.full_comparison(q_crude_table_custlife(spark, sf), deep, "custlife")


_C = lambda src, r="r": (f"SELECT sum(CASE WHEN j.{r} < i.{r} THEN 1.0 WHEN j.{r} = i.{r} THEN 0.5 ELSE 0 END) / count(*) AS c, count(*) AS n FROM {src} i "  # noqa: E731
                         f"JOIN {src} j ON i.event > 0 AND (j.duration > i.duration OR (j.duration = i.duration AND j.event = 0))")
SQL["full_comparison_custlife"] = with_cohort(
    "custlife",
    f"""SELECT model, c_index, dataset, brier_30d, brier_90d, brier_180d, brier_365d, NULL::BIGINT AS pairs FROM ({SQL['crude_table_custlife']})
        UNION ALL SELECT 'balance_fine', round(c, 4)::DOUBLE, 'custlife', NULL, NULL, NULL, NULL, n FROM ({_C('fine')})""",
    "fine AS (SELECT duration, event, -x1 AS r FROM custlife)")

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # fixed values: market segments


@register("cindex_pivot_segments")
def q_cindex_pivot(spark, sf):
    """RPT-7: C-index of three fixed scorers in every market segment, all in one keyed run, and the best of each."""
    data = custlife(spark, sf)
    scores = [("balance", F.col("x1")), ("reverse", -F.col("x1")), ("coarse", F.round(F.col("x1") / 1000))]
    rows = data.select("grp", "duration", "event", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), s.alias("risk")) for m, s in scores])))
    table = concordance_by(rows, ["grp", "model"]).select("model", F.col("grp").alias("dataset"), F.round("c_index", 4).alias("c_index"))
    return finish(comparison.cindex_pivot(table, _SEGMENTS))


SQL["cindex_pivot_segments"] = with_cohort(
    "custlife",
    "SELECT model, " + ", ".join(
        f"max(c) FILTER (WHERE grp = '{g}') AS \"{g}\", coalesce(bool_or(c = best) FILTER (WHERE grp = '{g}'), FALSE) AS \"best_{g}\""
        for g in _SEGMENTS) + " FROM (SELECT *, max(c) OVER (PARTITION BY grp) AS best FROM ci) GROUP BY model",
    "sc AS (SELECT 'balance' AS model, grp, duration, event, x1 AS r FROM custlife UNION ALL SELECT 'reverse', grp, duration, event, -x1 FROM custlife "
    "UNION ALL SELECT 'coarse', grp, duration, event, round(x1 / 1000) FROM custlife)",
    """ci AS (SELECT i.model, i.grp, round(sum(CASE WHEN j.r < i.r THEN 1.0 WHEN j.r = i.r THEN 0.5 ELSE 0 END)::DOUBLE / count(*), 4) AS c
              FROM sc i JOIN sc j ON i.model = j.model AND i.grp = j.grp AND i.event > 0
                AND (j.duration > i.duration OR (j.duration = i.duration AND j.event = 0)) GROUP BY ALL)""")


@register("top_features_custlife")
def q_top_features(spark, sf):
    """RPT-6: the most important feature of the permutation run (a top-k report)."""
    return comparison.top_features(q_permutation_importance(spark, sf), 1)


SQL["top_features_custlife"] = f"SELECT * FROM ({SQL['permutation_importance_custlife']}) ORDER BY importance DESC LIMIT 1"


# ---------------------------------------------------------------- admission (STRM-1)

def _admission_sql(window: float, limit: int) -> str:
    return f"""
WITH RECURSIVE o AS (SELECT event_id, user_id, ts, epoch_us(ts) / 1000000.0 AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
st AS (SELECT event_id, user_id, ts, k, [s] AS kept, TRUE AS admitted FROM o WHERE k = 1
  UNION ALL
  SELECT event_id, user_id, ts, k, CASE WHEN len(live) < {limit} THEN list_append(live, s) ELSE live END, len(live) < {limit}
  FROM (SELECT o.*, list_filter(st.kept, lambda x: o.s - x <= {window}) AS live
        FROM st JOIN o ON o.user_id IS NOT DISTINCT FROM st.user_id AND o.k = st.k + 1))
SELECT event_id, user_id, ts, admitted FROM st
"""


SQL["admission_events"] = _admission_sql(60.0, 60)
SQL["admission_events_tight"] = _admission_sql(3600.0, 2)
