"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

Double columns are rounded to 6 places so that a value hash agrees with the SQL oracle; the
library functions themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from hazardflow.operators import boosting, cox, metrics, neural, prep
from hazardflow.operators.concordance import concordance_table
from hazardflow.operators import nonparam as np_ops
from hazardflow.operators.competing import cause_specific_cox, cumulative_incidence
from hazardflow.operators.quantiles import exact_percentiles
from hazardflow.plans import comparison, reports, scoring
from hazardflow.session import cut_lineage, read_table
from hazardflow.streaming import admission
from hazardflow.sources.cohorts import custlife, gap, lineqty, reorder

DIGITS = 6
CURVE_TIMES = [30.0, 90.0, 180.0, 365.0]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def once(cohort: DataFrame) -> DataFrame:
    """A narrow cohort that its query reads more than once, written once."""
    return cut_lineage(cohort)


# ---------------------------------------------------------------- cohorts (SRC-3/5)

@register("cohort_reorder")
def q_cohort_reorder(spark, sf):
    return finish(reorder(spark, sf))


@register("cohort_gap")
def q_cohort_gap(spark, sf):
    return finish(gap(spark, sf))


@register("cohort_custlife")
def q_cohort_custlife(spark, sf):
    return finish(custlife(spark, sf))


@register("cohort_lineqty")
def q_cohort_lineqty(spark, sf):
    return finish(lineqty(spark, sf))


# ---------------------------------------------------------------- risk table / KM (NP-1..4, 9)

@register("risk_table_lineqty")
def q_risk_table_lineqty(spark, sf):
    rt = np_ops.risk_table(once(lineqty(spark, sf)), ["grp"], small_groups=True)
    return finish(rt.select("grp", "time", "n_at_risk", "d", "c"))


def _km_cols(curve: DataFrame, g: list[str]) -> DataFrame:
    return curve.select(*g, "time", "n_at_risk", "d", "c", "survival", "var_greenwood",
                        "lower", "upper", "cum_hazard")


@register("km_reorder_by_priority")
def q_km_reorder_by_priority(spark, sf):
    curve = np_ops.km_curve(once(reorder(spark, sf)), ["grp"], small_groups=True)
    return finish(_km_cols(curve, ["grp"]))


@register("km_custlife")
def q_km_custlife(spark, sf):
    return finish(_km_cols(np_ops.km_curve(once(custlife(spark, sf))), []))


@register("km_lineqty_by_status")
def q_km_lineqty_by_status(spark, sf):
    curve = np_ops.km_curve(once(lineqty(spark, sf)), ["grp"], small_groups=True)
    return finish(_km_cols(curve, ["grp"]))


# ---------------------------------------------------------------- lookups, medians, log-rank

@register("km_lookup_reorder")
def q_km_lookup_reorder(spark, sf):
    curve = np_ops.km_curve(once(reorder(spark, sf)), ["grp"], small_groups=True)
    got = np_ops.value_at(curve, CURVE_TIMES, {"survival": "survival", "cum_hazard": "cum_hazard"},
                          ["grp"])
    return finish(got)


@register("km_median_reorder")
def q_km_median_reorder(spark, sf):
    curve = np_ops.km_curve(once(reorder(spark, sf)), ["grp"], small_groups=True)
    return finish(np_ops.median_survival(curve, ["grp"]))


@register("subgroup_medians_custlife")
def q_subgroup_medians_custlife(spark, sf):
    return finish(np_ops.subgroup_medians(once(custlife(spark, sf)), "grp"))


@register("logrank_pairwise_reorder")
def q_logrank_pairwise_reorder(spark, sf):
    return finish(np_ops.pairwise_logrank_stats(once(reorder(spark, sf)), "grp"))


@register("logrank_reorder_by_priority")
def q_logrank_reorder(spark, sf):
    """NP-11/12: k-sample statistic solved on the driver from a k x k matrix."""
    return finish(np_ops.logrank_summary(once(reorder(spark, sf)), ["grp"]))


# ---------------------------------------------------------------- competing risks (CR-1/2)

@register("cif_gap")
def q_cif_gap(spark, sf):
    return finish(cumulative_incidence(once(gap(spark, sf)), causes=[1, 2]))


@register("cif_gap_by_type")
def q_cif_gap_by_type(spark, sf):
    return finish(cumulative_incidence(once(gap(spark, sf)), causes=[1, 2], group_cols=["grp"],
                                       small_groups=True))


# ---------------------------------------------------------------- reports (RPT-1..3), quantiles

@register("overview_reorder")
def q_overview_reorder(spark, sf):
    return finish(reports.cohort_overview(reorder(spark, sf)))


@register("histogram_gap")
def q_histogram_gap(spark, sf):
    return finish(reports.duration_histogram(gap(spark, sf)))


@register("describe_reorder")
def q_describe_reorder(spark, sf):
    return finish(reports.describe_numeric(once(reorder(spark, sf)), ["duration", "x1", "x2"]))


@register("quartiles_gap_by_type")
def q_quartiles_gap_by_type(spark, sf):
    return finish(exact_percentiles(once(gap(spark, sf)), "duration", [0.25, 0.5, 0.75], ["grp"],
                                    small_groups=True))


# ---------------------------------------------------------------- Cox regression (COX-*, CR-3)

COX_FEATURES = ["x1", "x2"]
COX_BETA = [0.05, -0.02]          # fixed standardised coefficients for the kernel checks


@register("cox_score_reorder")
def q_cox_score_reorder(spark, sf):
    """COX-2 at a fixed beta, per subject: loglik/n, score/n, Hessian/n (unpenalised, Efron)."""
    res = cox.score_at(once(reorder(spark, sf)), COX_FEATURES, COX_BETA)
    n = float(res["n"])
    rows = [("loglik", res["ll"] / n)]
    rows += [(f"grad_{j}", float(res["grad"][j]) / n) for j in range(2)]
    rows += [(f"hess_{j}_{k}", float(res["hess"][j, k]) / n) for j in range(2) for k in range(j, 2)]
    return finish(spark.createDataFrame(rows, "term string, value double"))


def _fixed_cox(spark, sf):
    data = once(reorder(spark, sf))
    return data, cox.model_from_coefficients(data, COX_FEATURES, COX_BETA)


@register("cox_baseline_reorder")
def q_cox_baseline_reorder(spark, sf):
    _, m = _fixed_cox(spark, sf)
    return finish(m.baseline)


@register("cox_risk_reorder")
def q_cox_risk_reorder(spark, sf):
    data, m = _fixed_cox(spark, sf)
    return finish(cox.predict_risk(m, data))


@register("cox_survival_reorder")
def q_cox_survival_reorder(spark, sf):
    data, m = _fixed_cox(spark, sf)
    return finish(cox.predict_survival(m, data, CURVE_TIMES))


@register("cox_median_reorder")
def q_cox_median_reorder(spark, sf):
    data, m = _fixed_cox(spark, sf)
    return finish(cox.predict_median(m, data))


@register("cox_fit_reorder")
def q_cox_fit_reorder(spark, sf):
    """COX-1/3: penalised fit (0.1) and its hazard-ratio table (Newton on the driver)."""
    m = cox.fit_cox(once(reorder(spark, sf)), COX_FEATURES, penalizer=0.1)
    table = finish(cox.hazard_ratio_table(m, spark), 10)  # a unit of x1 changes the hazard in the 7th place
    return table.withColumn("p_value", F.round("p_value", DIGITS))


@register("cox_ph_test_reorder")
def q_cox_ph_test_reorder(spark, sf):
    data = once(reorder(spark, sf))
    m = cox.fit_cox(data, COX_FEATURES, penalizer=0.1)
    return finish(cox.schoenfeld_test(m, data))


@register("cause_specific_cox_gap")
def q_cause_specific_cox_gap(spark, sf):
    models = cause_specific_cox(once(gap(spark, sf)), ["x1"], penalizer=0.1)
    rows = [(k, r["feature"], r["coef"], r["hr"], r["se"], r["p_value"])
            for k, m in sorted(models.items()) for r in cox.hazard_ratios(m)]
    return finish(spark.createDataFrame(
        rows, "cause int, feature string, coef double, hr double, se double, p_value double"))


# ---------------------------------------------------------------- evaluation (EV-*)

@register("cindex_custlife")
def q_cindex_custlife(spark, sf):
    data = custlife(spark, sf).withColumnRenamed("x1", "risk")
    return finish(concordance_table(data))


@register("cindex_custlife_tied")
def q_cindex_custlife_tied(spark, sf):
    data = custlife(spark, sf).withColumn("risk", F.round(F.col("x1") / 1000.0))
    return finish(concordance_table(data))


@register("cindex_cox_reorder")
def q_cindex_cox_reorder(spark, sf):
    """EV-1 / COX-9 on the whole reorder cohort."""
    data, m = _fixed_cox(spark, sf)
    return finish(concordance_table(data.withColumn("risk", m.log_partial_hazard())))


@register("censoring_curve_reorder")
def q_censoring_curve_reorder(spark, sf):
    return finish(metrics.censoring_curve(once(reorder(spark, sf))))


def _cox_predictions(spark, sf):
    data, m = _fixed_cox(spark, sf)
    return data, m, cox.predict_survival(m, data, CURVE_TIMES)


@register("brier_cox_reorder")
def q_brier_cox_reorder(spark, sf):
    data, _, pred = _cox_predictions(spark, sf)
    return finish(metrics.brier_scores(data, data, pred, CURVE_TIMES))


@register("auc_cox_reorder")
def q_auc_cox_reorder(spark, sf):
    data, m, _ = _cox_predictions(spark, sf)
    risk = cox.predict_risk(m, data).withColumnRenamed("log_partial_hazard", "risk")
    return finish(metrics.time_auc(data, data, risk, CURVE_TIMES))


@register("crude_brier_cox_reorder")
def q_crude_brier_cox_reorder(spark, sf):
    data, _, pred = _cox_predictions(spark, sf)
    return finish(metrics.crude_brier(data, pred, CURVE_TIMES))


@register("calibration_cox_reorder")
def q_calibration_cox_reorder(spark, sf):
    data, _, pred = _cox_predictions(spark, sf)
    return finish(metrics.calibration(data, pred, CURVE_TIMES))


# ---------------------------------------------------------------- neural-model kernels (NN-*)

@register("nn_cox_loss_reorder")
def q_nn_cox_loss_reorder(spark, sf):
    data, m = _fixed_cox(spark, sf)
    loss = neural.cox_loss(data.withColumn("score", m.log_partial_hazard()))
    return finish(spark.createDataFrame([(loss,)], "loss double"))


@register("discretise_gap")
def q_discretise_gap(spark, sf):
    binned = neural.discretise(once(gap(spark, sf)), 10)
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@register("exp_curve_reorder")
def q_exp_curve_reorder(spark, sf):
    data, m = _fixed_cox(spark, sf)
    return finish(neural.exponential_curve(data.withColumn("risk", m.log_partial_hazard()),
                                           CURVE_TIMES))


# ---------------------------------------------------------------- preparation (PREP-*)

DURATION_BINS = [0, 30, 90, 180, 365, float("inf")]
DURATION_LABELS = ["<=30", "31-90", "91-180", "181-365", ">365"]


@register("duration_buckets_reorder")
def q_duration_buckets_reorder(spark, sf):
    """PREP-1/2: right-closed labelled buckets (generic ``cut``) with counts."""
    from hazardflow.functions.columns import cut
    data = reorder(spark, sf).withColumn("bucket", cut(F.col("duration"), DURATION_BINS, DURATION_LABELS))
    return data.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum("event").cast("long").alias("events"))


@register("split_quotas_reorder")
def q_split_quotas_reorder(spark, sf):
    """PREP-7: stratified 70/15/15 split; exact per-stratum quotas."""
    out = prep.stratified_split(once(reorder(spark, sf)), seed=42)
    return out.groupBy("split", "event").agg(F.count(F.lit(1)).alias("n"))


@register("scaler_reorder")
def q_scaler_reorder(spark, sf):
    """PREP-4/5: fitted parameter table (median, mean, population std after imputation)."""
    sc = prep.fit_scaler(once(reorder(spark, sf)), ["x1", "x2", "duration"])
    return finish(sc.table(spark), 4)


# ---------------------------------------------------------------- scoring, streams, reports (P6)

@register("patient_curves_reorder")
def q_patient_curves_reorder(spark, sf):
    """RPT-8: Cox survival for every subject on the grid 0..360 step 10."""
    data, m = _fixed_cox(spark, sf)
    return finish(comparison.patient_curves(m, data))


@register("score_batch_reorder")
def q_score_batch_reorder(spark, sf):
    """SCORE-1 on a request for every reorder subject: range checks, defaults, alignment, scaling, survival and risk.

    The model is fitted to scaled features; clinical fields are projected from the key by fixed rules, so that some
    requests fail their checks. Rejected ones come back with their errors and no scores.
    """
    data = once(reorder(spark, sf))
    scaler = prep.fit_scaler(data, COX_FEATURES)
    scaled = data.select("subject_id", "duration", "event", *[scaler.scaled(f).alias(f) for f in COX_FEATURES])
    model = cox.model_from_coefficients(scaled, COX_FEATURES, COX_BETA)
    k = F.col("subject_id")
    requests = data.select("subject_id", *COX_FEATURES, (k % 120).alias("age"), (k % 30 - 1).alias("los"),
                           F.when(k % 9 > 0, (k % 103).cast("double")).alias("spo2"), ((k % 5) / 4).alias("diabetes"))
    scored, rejected = scoring.score_batch(requests, model, model_name="cox_fixed", scaler=scaler)
    at = scored.select("subject_id", "model", *[F.col("survival_probabilities")[f"{int(t)}d"].alias(f"survival_{int(t)}d")
                                                for t in scoring.PREDICT_TIMES],
                       F.when(F.col("risk_score") == 0, 0.0).otherwise(F.col("risk_score")).alias("risk_score"),  # no negative zero
                       F.lit("").alias("errors"))
    return at.unionByName(rejected.select("subject_id", F.array_join("errors", ",").alias("errors")), allowMissingColumns=True)


@register("admission_events")
def q_admission_events(spark, sf):
    """STRM-1 batch twin over the whole events table (per user, 60 per 60 s)."""
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    return admission.admit_batch(ev, window=60.0, limit=60)


@register("admission_events_tight")
def q_admission_events_tight(spark, sf):
    """STRM-1 with a limit that binds on this data: 2 per user per hour."""
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    return admission.admit_batch(ev, window=3600.0, limit=2)


@register("evaluation_cox_reorder")
def q_evaluation_cox_reorder(spark, sf):
    """EV-7/EV-10: evaluation row of the fixed Cox model plus the KM reference row."""
    data, m, pred = _cox_predictions(spark, sf)
    risk = data.select("subject_id", m.log_partial_hazard().alias("risk"))
    cox_row = comparison.evaluate_model("cox_fixed", "reorder", data, data, risk, pred)
    km_risk = data.select("subject_id", F.lit(0.0).alias("risk"))
    km_curve = np_ops.km_curve(data)
    at = {r["time"]: r["survival"] for r in
          np_ops.value_at(km_curve, CURVE_TIMES, {"survival": "survival"}).collect()}
    km_pred = data.select("subject_id", F.inline(F.array(*[
        F.struct(F.lit(t).alias("time"), F.lit(float(at[t])).alias("survival")) for t in CURVE_TIMES])))
    km_row = comparison.evaluate_model("kaplan_meier", "reorder", data, data, km_risk, km_pred)
    return comparison.comparison_table(cox_row.unionByName(km_row))


# ---------------------------------------------------------------- boosting (GB-*)

@register("martingale_reorder")
def q_martingale_reorder(spark, sf):
    """GB-2: martingale residuals at the fixed Cox score (uncentred exp(eta) weights)."""
    data, m = _fixed_cox(spark, sf)
    scored = data.withColumn("score", m.log_partial_hazard())
    return finish(boosting.martingale_residuals(scored).select("subject_id", "residual"))


@register("boosting_custlife")
def q_boosting_custlife(spark, sf):
    """GB-1/GB-6: the default 100 boosting rounds on custlife, train C-index of the boosted score."""
    data = custlife(spark, sf)
    model = boosting.fit_boosted_cox(data, ["x1"])
    scored = model.score(data, "risk")
    res = concordance_table(scored)
    return finish(res)
