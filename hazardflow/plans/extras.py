"""Registered queries of feature preparation, request checks, discrete-time losses and importance, with SQL.

The warehouse has no clinical columns, so clinical fields are projected from keys and values by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardflow.functions import columns as C
from hazardflow.operators import neural, prep
from hazardflow.operators.competing import cause_indicator
from hazardflow.operators.importance import permutation_importance
from hazardflow.plans.catalog import finish, register
from hazardflow.plans.comparison import crude_table
from hazardflow.plans.oracles import _BASELINE, SQL, cox_ctes, r6, with_cohort
from hazardflow.session import read_table
from hazardflow.sources.cohorts import custlife, gap, reorder


@register("features_customer")
def q_features_customer(spark, sf):
    """SRC-1/2/4, PREP-1/2/3, PREP-12: codes, comorbidity index and engineered groups of every customer."""
    k = F.col("c_custkey")
    base = read_table(spark, sf, "customer").select(
        k.alias("subject_id"), (k % 95).alias("age"), (k % 14).alias("los"), F.when(k % 6 < 5, k % 6).alias("ph_ecog"),
        (k % 2).alias("horTh"), (k % 3).alias("menostat"), (k % 3).alias("status"), F.substring("c_mktsegment", 1, 1).alias("segment"),
        F.element_at(F.array(*[F.lit(g) for g in ("I", "II", "III", "?")]), (k % 4 + 1).cast("int")).alias("tgrade"))
    base = base.withColumn("cci", C.comorbidity_index(F.col("age"), *[F.col("subject_id") % m == 0 for m in (5, 7, 11, 13)]))
    both = prep.engineer_features(prep.engineer_features(base, "lung"), "gbsg2")
    return both.select("subject_id", "cci", "age_group", "cci_level", "los_category", "ecog_group", "hormone_meno_interaction",
                       C.status_event(F.col("status")).alias("event"), C.grade_code(F.col("tgrade")).alias("grade"),
                       cause_indicator(F.col("status"), 1).alias("cause_1"))


def _bins(col, edges, labels):
    arms = " ".join(f"WHEN {col} > {lo} AND {col} <= {hi} THEN '{x}'" for lo, hi, x in zip(edges[:-1], edges[1:], labels))
    return f"CASE {arms} END"


SQL["features_customer"] = f"""
WITH b AS (SELECT c_custkey AS subject_id, c_custkey % 95 AS age, c_custkey % 14 AS los,
    CASE WHEN c_custkey % 6 < 5 THEN c_custkey % 6 END AS ecog, c_custkey % 3 AS status, c_custkey % 4 AS g,
    ((c_custkey % 2) * (c_custkey % 3))::DOUBLE AS hormone_meno_interaction FROM customer),
c AS (SELECT *, ((age >= 50)::INT + (age >= 60)::INT + (age >= 70)::INT + (subject_id % 5 = 0)::INT + (subject_id % 7 = 0)::INT
    + 2 * (subject_id % 11 = 0)::INT + (subject_id % 13 = 0)::INT)::INTEGER AS cci FROM b)
SELECT subject_id, cci, {_bins('age', C.AGE_BINS, C.AGE_LABELS)} AS age_group, {_bins('cci', C.CCI_BINS, C.CCI_LABELS)} AS cci_level,
  {_bins('los', C.LOS_BINS, C.LOS_LABELS)} AS los_category,
  CASE WHEN ecog IS NULL THEN NULL WHEN ecog <= 1 THEN 'good' WHEN ecog <= 2 THEN 'moderate' ELSE 'poor' END AS ecog_group,
  hormone_meno_interaction, (status = 2)::INTEGER AS event, CASE g WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 2 END AS grade,
  (status = 1)::INTEGER AS cause_1 FROM c
"""


@register("requests_orders")
def q_requests_orders(spark, sf):
    """PREP-11: scoring requests projected from every order, defaults filled, out-of-range fields listed."""
    k = F.col("o_orderkey")
    req = read_table(spark, sf, "orders").select(
        k.alias("request_id"), F.when(k % 9 > 0, k % 120).alias("age"), (k % 30 - 1).alias("los"), (k % 27).alias("sofa_score"),
        (F.col("o_totalprice") / 1000 - 20).alias("creatinine"), (k % 104).alias("spo2"), ((k % 3) / 2).alias("diabetes"))
    done = prep.validate_requests(req)
    return finish(done.select("request_id", "age", "los", "map", "creatinine", F.array_join("errors", ",").alias("errors")))


SQL["requests_orders"] = f"""
WITH r AS (SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey % 120 ELSE 65 END AS age,
    o_orderkey % 30 - 1 AS los, o_orderkey % 27 AS sofa, o_totalprice / 1000 - 20 AS creatinine, o_orderkey % 104 AS spo2,
    (o_orderkey % 3) / 2.0 AS diabetes FROM orders)
SELECT request_id, {r6('age', 'age')}, {r6('los', 'los')}, 75.0::DOUBLE AS map, {r6('creatinine', 'creatinine')},
  concat_ws(',', CASE WHEN age < 18 OR age > 110 THEN 'age' END, CASE WHEN los < 0 THEN 'los' END,
            CASE WHEN sofa > 24 THEN 'sofa_score' END, CASE WHEN creatinine < 0 THEN 'creatinine' END,
            CASE WHEN spo2 > 100 THEN 'spo2' END, CASE WHEN diabetes = 0.5 THEN 'diabetes' END) AS errors FROM r
"""


@register("aligned_lineitem")
def q_aligned_lineitem(spark, sf):
    """PREP-9/10: rows with a missing or NaN value go, absent features are 0, columns in model order."""
    q = F.col("l_quantity").cast("double")
    rows = read_table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("subject_id"), F.when(q > 3, q).alias("qty"),
        F.when(F.col("l_discount") < 0.09, F.col("l_discount").cast("double")).otherwise(F.lit(float("nan"))).alias("disc"))
    kept = prep.drop_missing(rows, ["qty", "disc"])
    return finish(prep.align_features(kept, ["disc", "absent", "qty"], keep=["subject_id"]))


SQL["aligned_lineitem"] = f"""
SELECT l_orderkey * 100 + l_linenumber AS subject_id, {r6('l_discount', 'disc')}, 0.0::DOUBLE AS absent, {r6('l_quantity', 'qty')}
FROM lineitem WHERE l_quantity > 3 AND l_discount < 0.09
"""

PMF_BINS = 8


@register("discrete_losses_gap")
def q_discrete_losses_gap(spark, sf):
    """NN-5/6/8: negative log-likelihood and ranking loss of a fixed mass function over every gap, mean survival."""
    weight = lambda c: F.transform(F.sequence(F.lit(0), F.lit(PMF_BINS - 1)),
                                   lambda b: (b + 1) * c + F.pmod(F.col("subject_id"), F.lit(7)) + 1.0)
    both = gap(spark, sf).select("subject_id", "cause", F.least(F.floor(F.col("duration") / 6), F.lit(PMF_BINS - 1)).cast("int").alias("bin"),
                                 F.array(weight(1), weight(2)).alias("w"))
    total = F.aggregate(F.flatten("w"), F.lit(0.0), lambda s, v: s + v)
    df = both.withColumn("_t", total).withColumn("pmf", F.transform("w", lambda row: F.transform(row, lambda v: v / F.col("_t"))))
    surv = df.agg(F.avg(neural.survival_from_pmf(F.element_at("pmf", 1), F.col("bin")))).first()[0]
    return finish(spark.createDataFrame([(neural.deephit_nll(df), neural.deephit_rank_loss(df, PMF_BINS), surv)],
                                        "nll double, rank_loss double, mean_survival double"))


SQL["discrete_losses_gap"] = with_cohort(
    "gap",
    f"""SELECT {r6('(SELECT avg(-ln(greatest(CASE cause WHEN 1 THEN p1[bin + 1] ELSE p2[bin + 1] END, 1e-8))) FROM p WHERE cause > 0)', 'nll')},
      {r6('(SELECT avg(exp(-(f1[i.bin + 1] - j.fj) / 0.1)) FROM i JOIN j ON j.b = i.bin AND j.bin > i.bin)', 'rank_loss')},
      {r6('(SELECT avg(least(1.0, greatest(0.0, 1.0 - CASE WHEN bin > 0 THEN list_sum(p1[1:bin]) ELSE 0 END))) FROM p)', 'mean_survival')}""",
    f"""w AS (SELECT subject_id, cause, least(floor(duration / 6), {PMF_BINS - 1})::INTEGER AS bin,
         list_transform(range(0, {PMF_BINS}), lambda b: (b + 1) * 1 + subject_id % 7 + 1.0) AS w1,
         list_transform(range(0, {PMF_BINS}), lambda b: (b + 1) * 2 + subject_id % 7 + 1.0) AS w2 FROM gap)""",
    """p AS (SELECT subject_id, cause, bin, list_transform(w1, lambda v: v::DOUBLE / (list_sum(w1) + list_sum(w2))::DOUBLE) AS p1,
         list_transform(w2, lambda v: v::DOUBLE / (list_sum(w1) + list_sum(w2))::DOUBLE) AS p2 FROM w)""",
    f"f AS (SELECT *, list_transform(range(0, {PMF_BINS}), lambda b: list_sum(p1[1:b + 1])) AS f1 FROM p)",
    "i AS (SELECT * FROM f WHERE cause = 1)",
    f"j AS (SELECT bin, b::INTEGER AS b, f1[b + 1] AS fj FROM f, range(0, {PMF_BINS}) t(b))")


@register("permutation_importance_custlife")
def q_permutation_importance(spark, sf):
    """EV-9: account balance and a key-derived feature under a fixed linear risk, two permutations each."""
    data = custlife(spark, sf).withColumn("x2", (F.col("subject_id") % 100).cast("double")).select(
        "subject_id", "duration", "event", "x1", "x2")
    risk = lambda d: F.round(d["x1"] / 1000) * 2 + d["x2"]
    return finish(permutation_importance(data, ["x1", "x2"], risk, repeats=2))


def _importance_sql() -> str:
    c = lambda src: (f"(SELECT sum(CASE WHEN j.r < i.r THEN 1.0 WHEN j.r = i.r THEN 0.5 ELSE 0 END) / count(*) FROM {src} i "  # noqa: E731
                     f"JOIN {src} j ON i.event > 0 AND (j.duration > i.duration OR (j.duration = i.duration AND j.event = 0)))")
    ctes = ["d AS (SELECT subject_id, duration, event, x1, (subject_id % 100)::DOUBLE AS x2, "
            "row_number() OVER (ORDER BY subject_id) AS k FROM custlife)",
            "base AS (SELECT duration, event, round(x1 / 1000) * 2 + x2 AS r FROM d)"]
    for f, expr in (("x1", "round(v.val / 1000) * 2 + d.x2"), ("x2", "round(d.x1 / 1000) * 2 + v.val")):
        for r in (0, 1):
            ctes.append(f"""{f}_{r} AS (SELECT d.duration, d.event, {expr} AS r FROM d JOIN (SELECT {f} AS val,
              row_number() OVER (ORDER BY md5('42:{r}:' || subject_id::VARCHAR)[1:12], subject_id) AS k FROM d) v ON d.k = v.k)""")
    rows = [f"SELECT '{f}' AS feature, {r6(c('base'), 'baseline')}, "
            f"{r6(f'(2 * {c('base')} - {c(f'{f}_0')} - {c(f'{f}_1')}) / 2', 'importance')}, "
            f"{r6(f'abs({c(f'{f}_0')} - {c(f'{f}_1')}) / 2', 'importance_std')}, 2 AS repeats" for f in ("x1", "x2")]
    return with_cohort("custlife", " UNION ALL ".join(rows), *ctes)


SQL["permutation_importance_custlife"] = _importance_sql()


@register("split_reorder")
def q_split_reorder(spark, sf):
    """PREP-7: who goes where in the stratified 70/15/15 split of the reorder cohort."""
    return prep.stratified_split(reorder(spark, sf), seed=42).select("subject_id", "event", "split")


SQL["split_reorder"] = with_cohort(
    "reorder",
    """SELECT subject_id, event, CASE WHEN k <= n_test THEN 'test' WHEN k <= n_test + floor((n - n_test) * (0.15 / 0.85) + 0.5) THEN 'val'
         ELSE 'train' END AS split
       FROM (SELECT *, floor(n * 0.15 + 0.5) AS n_test FROM (
         SELECT subject_id, event, count(*) OVER (PARTITION BY event) AS n,
                row_number() OVER (PARTITION BY event ORDER BY md5('split:42:' || subject_id::VARCHAR)[1:12]) AS k FROM reorder))""")


@register("crude_table_custlife")
def q_crude_table_custlife(spark, sf):
    """EV-8: table of two fixed scorers on custlife, one with predicted survival."""
    data = custlife(spark, sf)
    risk = data.select("subject_id", F.round(F.col("x1") / 1000).alias("risk"))
    at = F.array(*[F.struct(F.lit(t).alias("time"), F.exp(-F.lit(t) / 1000).alias("survival")) for t in (30.0, 90.0, 180.0, 365.0)])
    flat = data.select("subject_id", F.inline(at))
    return crude_table([("balance", "custlife", risk, flat), ("reverse", "custlife", risk.withColumn("risk", -F.col("risk")), None)], data)


def _crude_sql() -> str:
    c = lambda sign: (f"(SELECT round(sum(CASE WHEN {sign}j.r < {sign}i.r THEN 1.0 WHEN j.r = i.r THEN 0.5 ELSE 0 END) / count(*), 4) FROM s i "  # noqa: E731
                      "JOIN s j ON i.event > 0 AND (j.duration > i.duration OR (j.duration = i.duration AND j.event = 0)))")
    brier = lambda t: f"(SELECT round(avg(pow(exp(-{t} / 1000.0) - (duration > {t})::INT, 2)), 4) FROM s)"
    times = (30, 90, 180, 365)
    return with_cohort(
        "custlife",
        f"SELECT 'balance' AS model, {c('')}::DOUBLE AS c_index, {', '.join(f'{brier(t)}::DOUBLE AS brier_{t}d' for t in times)}, 'custlife' AS dataset "
        f"UNION ALL SELECT 'reverse', {c('-')}::DOUBLE, {', '.join('NULL' for _ in times)}, 'custlife'",
        "s AS (SELECT duration, event, round(x1 / 1000) AS r FROM custlife)")


SQL["crude_table_custlife"] = _crude_sql()


_CHECKS = """concat_ws(',', CASE WHEN subject_id % 120 < 18 OR subject_id % 120 > 110 THEN 'age' END, CASE WHEN subject_id % 30 = 0 THEN 'los' END,
    CASE WHEN subject_id % 9 > 0 AND subject_id % 103 > 100 THEN 'spo2' END, CASE WHEN subject_id % 5 IN (1, 2, 3) THEN 'diabetes' END)"""
SQL["score_batch_reorder"] = with_cohort(
    "reorder",
    f"""SELECT subject_id, CASE WHEN errors = '' THEN 'cox_fixed' END AS model,
      {', '.join(f"CASE WHEN errors = '' THEN round(exp(-(SELECT max(cum_hazard) FROM bl WHERE time <= {t}) * w), 4) END AS survival_{t}d" for t in (30, 90, 180, 365))},
      CASE WHEN errors <> '' THEN NULL WHEN round(eta, 4) = 0 THEN 0.0 ELSE round(eta, 4) END AS risk_score, errors FROM (SELECT *, {_CHECKS} AS errors FROM e)""",
    *cox_ctes(), *_BASELINE)
