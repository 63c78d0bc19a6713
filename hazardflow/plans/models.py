"""Registered queries of the forest, the boosted trees and their importances, with SQL (RSF-*, GB-*).

Growth is checked one level at a time on given bins, everything that follows on given trees; the full fits
(100 trees, 100 rounds) are registered beside them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators import boosting, forest
from hazardflow.operators.importance import normalised, permutation_importance
from hazardflow.plans import scorers
from hazardflow.plans.catalog import CURVE_TIMES, finish, once, register
from hazardflow.plans.oracles import SQL, r6, with_cohort
from hazardflow.sources.cohorts import custlife

FEATURES = ["x1", "x2", "x3"]
#: Given bins: upper edges of each feature and of time.
EDGES = [[-500.0, 500.0, 1500.0, 2500.0, 3500.0, 4500.0, 5500.0, 6500.0, 7500.0, 8500.0], [9.0, 19.0, 39.0, 59.0, 79.0, 89.0],
         [65.0, 66.0, 70.0, 72.0]]
TIME_EDGES = [50.0, 100.0, 200.0, 300.0, 450.0, 600.0, 900.0, 1200.0]
GIVEN = forest.GrowthSettings(n_trees=4)


def subjects(spark, sf) -> DataFrame:
    """custlife with three features: account balance, a key-derived one and the segment's first letter."""
    return custlife(spark, sf).select("subject_id", "duration", "event", "x1", (F.col("subject_id") % 100).cast("double").alias("x2"),
                                      F.ascii("grp").cast("double").alias("x3"))


SUBJECTS = ("d AS (SELECT subject_id, duration, event, x1, (subject_id % 100)::DOUBLE AS x2, ascii(grp)::DOUBLE AS x3 FROM custlife)")


def _draw(label: str, *parts: str) -> str:
    return f"('0x' || md5(concat_ws(':', '{label}', {', '.join(parts)}))[1:12])::BIGINT"


def _weight(tree: str = "tree", row: str = "subject_id") -> str:
    steps = ", ".join(map(str, forest.poisson_steps()))
    return f"(SELECT len(list_filter([{steps}], lambda s: {_draw('bag:42', tree, row)} >= s)))"


def _bin(x: str, edges) -> str:
    return f"({' + '.join(f'({x} > {e})::INT' for e in edges)})"


def _bag(trees: int) -> str:
    return f"bag AS (SELECT * FROM (SELECT d.*, tree, {_weight()} AS w FROM d, range(0, {trees}) t(tree)))"


# ---------------------------------------------------------------- RSF-1: one level on given bins, and the whole fit

def binned(df: DataFrame) -> DataFrame:
    return df.select(F.col("subject_id").alias("id"), "event", forest.bin_of(F.col("duration"), TIME_EDGES).alias("tbin"),
                     F.array(*[forest.bin_of(F.col(f), e) for f, e in zip(FEATURES, EDGES)]).alias("bins"))


@register("forest_root_splits_custlife")
def q_forest_root_splits(spark, sf):
    """RSF-1: the root cut of each of 100 trees on given bins: bags, tried features and log-rank statistics."""
    s = forest.GrowthSettings()
    state = forest.first_level(binned(subjects(spark, sf)), len(FEATURES), s)
    splits = forest.with_threshold(forest.best_logrank_splits(state, len(TIME_EDGES) + 1, s), EDGES)
    return finish(splits.select("tree", "feature", "bin", "threshold", "statistic", "n_left", "n_right"))


_ROOT = with_cohort(
    "custlife",
    f"""SELECT tree::INTEGER AS tree, f::INTEGER AS feature, bin::INTEGER AS bin, {r6('(' + str(EDGES) + ')[f + 1][bin + 1]', 'threshold')},
      {r6('stat', 'statistic')}, cl::BIGINT AS n_left, (c - cl)::BIGINT AS n_right
      FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY stat DESC, f, bin) AS k FROM stats) WHERE k = 1""",
    SUBJECTS, _bag(100),
    f"""tried AS (SELECT tree, f FROM (SELECT tree, f, row_number() OVER (PARTITION BY tree ORDER BY {_draw('feature:42', 'tree', '1', 'f')}, f) AS k
         FROM range(0, 100) t(tree), range(0, 3) u(f)) WHERE k = 1)""",
    f"""b AS (SELECT tree, f, w, event, {_bin('duration', TIME_EDGES)} AS tb,
         CASE f WHEN 0 THEN {_bin('x1', EDGES[0])} WHEN 1 THEN {_bin('x2', EDGES[1])} ELSE {_bin('x3', EDGES[2])} END AS bin
         FROM bag JOIN tried USING (tree) WHERE w > 0)""",
    "cuts AS (SELECT DISTINCT tree, f, bin FROM b)",
    """sides AS (SELECT cuts.tree, cuts.f, cuts.bin, sum(w * event) FILTER (b.bin <= cuts.bin) AS el, count(*) AS c,
         count(*) FILTER (b.bin <= cuts.bin) AS cl FROM cuts JOIN b USING (tree) GROUP BY ALL)""",
    f"""times AS (SELECT cuts.tree, cuts.f, cuts.bin, t, sum(w) FILTER (tb >= t)::DOUBLE AS r, coalesce(sum(w * event) FILTER (tb = t), 0)::DOUBLE AS dd,
         coalesce(sum(w) FILTER (tb >= t AND b.bin <= cuts.bin), 0)::DOUBLE AS l
         FROM cuts JOIN b USING (tree), range(0, {len(TIME_EDGES) + 1}) u(t) GROUP BY ALL)""",
    """uv AS (SELECT tree, f, bin, sum(CASE WHEN r > 0 THEN dd * l / r ELSE 0 END) AS e,
         sum(CASE WHEN r > 1 THEN dd * (r - dd) / (r - 1) * (l / r) * (1 - l / r) ELSE 0 END) AS v FROM times GROUP BY ALL)""",
    """stats AS (SELECT s.*, round((el - e) * (el - e) / v, 9) AS stat FROM sides s JOIN uv USING (tree, f, bin)
         WHERE v > 1e-12 AND c >= 10 AND cl >= 5 AND c - cl >= 5 AND round((el - e) * (el - e) / v, 9) > 0)""")
SQL["forest_root_splits_custlife"] = _ROOT


@register("forest_custlife")
def q_forest(spark, sf):
    """RSF-1, 4, 5: 100 trees with the defaults; splits by level, train and out-of-bag C-index (rows only)."""
    data = once(subjects(spark, sf))
    model = forest.fit_forest(data, FEATURES)
    spread = [level.agg(F.lit(f"splits_level_{i}").alias("metric"), F.count(F.lit(1)).cast("double").alias("value"))
              for i, level in enumerate(model.levels)]
    index = [model.c_index(data, risk).select(F.lit(name).alias("metric"), F.col("c_index").alias("value"))
             for name, risk in (("c_index_train", None), ("c_index_out_of_bag", model.out_of_bag_risk(data)))]
    out = index[0]
    for part in [*index[1:], *spread]:
        out = out.unionByName(part)
    return finish(out)


# ---------------------------------------------------------------- RSF-2..8 on given trees

def given_levels(spark) -> list[DataFrame]:
    roots = [(t, 1, 0, 3000.0 + 500.0 * t) for t in range(GIVEN.n_trees)]
    below = [r for t in range(GIVEN.n_trees) for r in ((t, 2, 1, 40.0 + 5.0 * t), (t, 3, 2, 70.0))]
    return [spark.createDataFrame(rows, "tree int, node long, feature int, threshold double") for rows in (roots, below)]


def given_forest(spark, data: DataFrame) -> forest.SurvivalForest:
    return forest.forest_from_splits(data, given_levels(spark), FEATURES, GIVEN)


_NODE = "CASE WHEN {0}x1 > 3000 + 500 * tree THEN 6 + ({0}x3 > 70)::INT ELSE 4 + ({0}x2 > 40 + 5 * tree)::INT END AS node"
_LEAVES = [
    SUBJECTS, _bag(4),
    f"""at_times AS (SELECT tree, node, duration AS time, sum(w) AS n, sum(w * event) AS d FROM
         (SELECT *, {_NODE.format('')} FROM bag WHERE w > 0) GROUP BY ALL)""",
    """hazards AS (SELECT *, d::DOUBLE / risk AS h, d = risk AS ends FROM
         (SELECT *, sum(n) OVER (PARTITION BY tree, node ORDER BY time DESC) AS risk FROM at_times))""",
    "event_times AS (SELECT DISTINCT duration AS time FROM d WHERE event > 0)",
    """leaf AS (SELECT tree, node, round(sum(h * (SELECT count(*) FROM event_times e WHERE e.time >= hazards.time)) * 1e9)::BIGINT AS mortality
         FROM hazards GROUP BY tree, node)"""]
_RISK = "sum(mortality)::DOUBLE / 1e9 / count(mortality)"


@register("forest_survival_custlife")
def q_forest_survival(spark, sf):
    """RSF-2: survival of every subject at four times under four given trees."""
    data = subjects(spark, sf)
    return finish(given_forest(spark, data).survival(data, CURVE_TIMES))


SQL["forest_survival_custlife"] = with_cohort(
    "custlife",
    f"""SELECT subject_id, q AS time, {r6('avg(s)', 'survival')} FROM (SELECT subject_id, tree, {_NODE.format('')} FROM d, range(0, 4) t(tree))
      JOIN curve USING (tree, node) GROUP BY subject_id, q""",
    *_LEAVES[:4],
    f"asked AS (SELECT q, least(greatest(q, (SELECT min(duration) FROM d)), (SELECT max(duration) FROM d)) AS clip FROM (VALUES {', '.join(f'({t}::DOUBLE)' for t in CURVE_TIMES)}) v(q))",
    """curve AS (SELECT tree, node, q, CASE WHEN bool_or(time <= clip AND ends) THEN 0 ELSE
         exp(coalesce(sum(CASE WHEN time <= clip AND NOT ends THEN ln(1 - h) END), 0)) END AS s FROM hazards, asked GROUP BY tree, node, q)""")


@register("forest_risk_custlife")
def q_forest_risk(spark, sf):
    """RSF-3, RSF-5: mortality of every subject over all given trees and over those whose bag it is not in."""
    data = subjects(spark, sf)
    model = given_forest(spark, data)
    out = model.out_of_bag_risk(data).withColumnRenamed("risk", "out_of_bag")
    return finish(model.risk(data).join(out, "subject_id", "left"))


SQL["forest_risk_custlife"] = with_cohort(
    "custlife",
    f"""SELECT subject_id, {r6(_RISK, 'risk')}, {r6('sum(mortality) FILTER (w = 0)::DOUBLE / 1e9 / count(mortality) FILTER (w = 0)', 'out_of_bag')}
      FROM (SELECT *, {_NODE.format('')} FROM bag) JOIN leaf USING (tree, node) GROUP BY subject_id""", *_LEAVES)


@register("forest_cindex_custlife")
def q_forest_cindex(spark, sf):
    """RSF-4, RSF-5: pair counts and C-index of the given trees, all and out of bag."""
    data = subjects(spark, sf)
    model = given_forest(spark, data)
    rows = [model.c_index(data, risk).select(F.lit(kind).alias("kind"), *[F.col(c).cast("double").alias(c) for c in (
        "comparable", "concordant", "tied_risk", "c_index")]) for kind, risk in (("all", None), ("out_of_bag", model.out_of_bag_risk(data)))]
    return finish(rows[0].unionByName(rows[1]))


SQL["forest_cindex_custlife"] = with_cohort(
    "custlife",
    f"""SELECT kind, count(*)::DOUBLE AS comparable, sum((j.risk < i.risk)::INT)::DOUBLE AS concordant, sum((j.risk = i.risk)::INT)::DOUBLE AS tied_risk,
      {r6('(sum((j.risk < i.risk)::INT) + 0.5 * sum((j.risk = i.risk)::INT)) / count(*)', 'c_index')}
      FROM scored i JOIN scored j USING (kind) WHERE i.event > 0 AND (j.duration > i.duration OR (j.duration = i.duration AND j.event = 0)) GROUP BY kind""",
    *_LEAVES,
    f"""scored AS (SELECT 'all' AS kind, subject_id, duration, event, {_RISK} AS risk FROM (SELECT *, {_NODE.format('')} FROM bag) JOIN leaf USING (tree, node) GROUP BY ALL
         UNION ALL SELECT 'out_of_bag', subject_id, duration, event, {_RISK} FROM (SELECT *, {_NODE.format('')} FROM bag WHERE w = 0) JOIN leaf USING (tree, node) GROUP BY ALL)""")


@register("forest_importance_custlife")
def q_forest_importance(spark, sf):
    """RSF-6, 7, 8: permutation importance of the given trees, mean, deviation and share, descending; all in one keyed run."""
    data = subjects(spark, sf)
    lost = permutation_importance(data, FEATURES, scorer=given_forest(spark, data), repeats=3)
    share = normalised(lost).withColumnRenamed("importance", "share")
    return finish(lost.join(share, "feature").orderBy(F.desc("importance"), "feature"))


_DEALT = "CASE WHEN f = {0} THEN v.x{1} ELSE d.x{1} END AS x{1}"
SQL["forest_importance_custlife"] = with_cohort(
    "custlife",
    f"""SELECT 'x' || (f + 1) AS feature, {r6('b.c', 'baseline')}, {r6('avg(b.c - p.c)', 'importance')}, {r6('stddev_pop(b.c - p.c)', 'importance_std')},
      3 AS repeats, {r6('greatest(avg(b.c - p.c), 0) / sum(greatest(avg(b.c - p.c), 0)) OVER ()', 'share')}
      FROM index p, (SELECT c FROM index WHERE f = -1) b WHERE p.f >= 0 GROUP BY f, b.c""",
    *_LEAVES,
    "k AS (SELECT *, row_number() OVER (ORDER BY subject_id) AS k FROM d)",
    """v AS (SELECT d.*, rep, row_number() OVER (PARTITION BY rep ORDER BY md5('42:' || rep || ':' || subject_id::VARCHAR)[1:12], subject_id) AS k
         FROM d, range(0, 3) t(rep))""",
    f"""dealt AS (SELECT f, rep, d.subject_id, d.duration, d.event, {_DEALT.format(0, 1)}, {_DEALT.format(1, 2)}, {_DEALT.format(2, 3)}
         FROM k d JOIN v ON d.k = v.k, range(0, 3) u(f) UNION ALL SELECT -1, 0, subject_id, duration, event, x1, x2, x3 FROM d)""",
    f"""scored AS (SELECT f, rep, subject_id, duration, event, {_RISK} AS risk
         FROM (SELECT *, {_NODE.format('')} FROM dealt, range(0, 4) t(tree)) JOIN leaf USING (tree, node) GROUP BY ALL)""",
    """index AS (SELECT f, rep, sum(CASE WHEN j.risk < i.risk THEN 1.0 WHEN j.risk = i.risk THEN 0.5 ELSE 0 END) / count(*) AS c
         FROM scored i JOIN scored j USING (f, rep) WHERE i.event > 0 AND (j.duration > i.duration OR (j.duration = i.duration AND j.event = 0)) GROUP BY f, rep)""")


# ---------------------------------------------------------------- boosting

@register("boosting_level_custlife")
def q_boosting_level(spark, sf):
    """GB-1: the best cuts of two given nodes for the martingale residuals at score 0, on given bins."""
    rows = boosting.martingale_residuals(subjects(spark, sf).withColumn("score", F.lit(0.0)))
    at = rows.select((2 + (F.col("x1") > 4000).cast("long")).alias("node"), "residual",
                     F.array(*[forest.bin_of(F.col(f), e) for f, e in zip(FEATURES, EDGES)]).alias("bins"))
    return finish(boosting.best_mean_splits(at).select("node", "feature", "bin", "gain", "n", "n_left", "s_left"))


_RESIDUAL = """hazard AS (SELECT duration, sum(h) OVER (ORDER BY duration) AS cum FROM (SELECT duration, sum(event) / sum(sum({0})) OVER (ORDER BY duration DESC) AS h
         FROM {1} GROUP BY duration))"""
SQL["boosting_level_custlife"] = with_cohort(
    "custlife",
    f"""SELECT node::BIGINT AS node, f::INTEGER AS feature, bin::INTEGER AS bin, {r6('gain', 'gain')}, n::BIGINT AS n, n_left::BIGINT AS n_left, {r6('s_left', 's_left')}
      FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) AS k FROM scored) WHERE k = 1""",
    SUBJECTS, _RESIDUAL.format("1.0", "d"),
    "res AS (SELECT d.*, event - cum AS y, 2 + (x1 > 4000)::INT AS node FROM d JOIN hazard USING (duration))",
    f"""cells AS (SELECT node, f, CASE f WHEN 0 THEN {_bin('x1', EDGES[0])} WHEN 1 THEN {_bin('x2', EDGES[1])} ELSE {_bin('x3', EDGES[2])} END AS bin,
         count(*) AS c, sum(y) AS y FROM res, range(0, 3) u(f) GROUP BY ALL)""",
    """cuts AS (SELECT node, f, bin, sum(c) OVER g AS n, sum(y) OVER g AS s, sum(c) OVER o AS n_left, sum(y) OVER o AS s_left FROM cells
         WINDOW g AS (PARTITION BY node, f), o AS (PARTITION BY node, f ORDER BY bin))""",
    """scored AS (SELECT *, round(n_left * (n - n_left) / n::DOUBLE * pow(s_left / n_left - (s - s_left) / (n - n_left), 2), 12) AS gain
         FROM cuts WHERE n >= 10 AND n_left >= 5 AND n - n_left >= 5)""")


def given_boosted() -> boosting.BoostedCox:
    """Two trees of given numbers: root and left child of the first are split, the root of the second."""
    node = boosting.Node
    first = {1: node(0.01, 100, 0, 0, 4000.0), 2: node(-0.1, 60, 1, 0, 50.0), 3: node(0.175, 40), 4: node(-0.3, 20), 5: node(0.0, 40)}
    second = {1: node(-0.02, 100, 2, 0, 70.0), 2: node(0.05, 50), 3: node(-0.09, 50)}
    return boosting.BoostedCox(FEATURES, 0.1, [first, second])


@register("boosting_attributions_custlife")
def q_boosting_attributions(spark, sf):
    """GB-5: base, contribution of each feature and score of every subject under two given trees."""
    return finish(given_boosted().attributions(subjects(spark, sf)))


_SCORE = "0.1 * (CASE WHEN x1 > 4000 THEN 0.175 WHEN x2 > 50 THEN 0.0 ELSE -0.3 END + CASE WHEN x3 > 70 THEN -0.09 ELSE 0.05 END)"
SQL["boosting_attributions_custlife"] = with_cohort(
    "custlife",
    f"""SELECT subject_id, {r6('0.1 * (0.01 - 0.02)', 'base')}, {r6('0.1 * CASE WHEN x1 > 4000 THEN 0.165 ELSE -0.11 END', 'phi_x1')},
      {r6('0.1 * CASE WHEN x1 > 4000 THEN 0 WHEN x2 > 50 THEN 0.1 ELSE -0.2 END', 'phi_x2')},
      {r6('0.1 * CASE WHEN x3 > 70 THEN -0.07 ELSE 0.07 END', 'phi_x3')}, {r6(_SCORE, 'score')} FROM d""", SUBJECTS)


@register("boosting_survival_custlife")
def q_boosting_survival(spark, sf):
    """GB-6: survival of every subject at four times under two given trees and the Breslow hazard of their scores."""
    data = subjects(spark, sf)
    return finish(scorers.BoostedScorer(given_boosted(), data).survival(data, CURVE_TIMES))


SQL["boosting_survival_custlife"] = with_cohort(
    "custlife",
    f"""SELECT subject_id, q AS time, {r6('exp(-h * exp(score))', 'survival')} FROM s,
      (SELECT q, coalesce((SELECT max(cum) FROM hazard WHERE duration <= q), 0) AS h
       FROM (VALUES {', '.join(f'({t}::DOUBLE)' for t in CURVE_TIMES)}) v(q))""",
    SUBJECTS, f"s AS (SELECT *, ({_SCORE})::DOUBLE AS score FROM d)", _RESIDUAL.format("exp(score)", "s"))
