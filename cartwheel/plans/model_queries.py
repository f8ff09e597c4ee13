"""Registered fitted-model queries (rows-checked): Cox PH (H13, H14, H16,
H18-H22), on the survival split with training-fitted standardisation (H10).

A fit is a handful of driver-side numbers; it is memoised per (session, data
folder, state of its files) so several reports of one model share one fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import cox
from cartwheel.operators import survival as sv
from cartwheel.plans import survival_queries as sq
from cartwheel.plans.frames import memo, sid
from cartwheel.plans.registry import register
from cartwheel.session import stage, staged_parquet
from cartwheel.sources.files import fingerprint

FEATURES = sq.SURV_FEATURES
COX_PENALIZER = 0.1  # fixed value


def data(spark, d) -> tuple:
    """Memo key of a folder's tables: a changed file is another key."""
    return (*sid(spark), d, fingerprint(spark, [f"{d}/{t}.parquet" for t in ("events", "orders", "lineitem")]))


def scaled_split(spark, d):
    """(train, test) with features standardised on train; duration/event columns."""
    def build():
        s = sq._split(spark, d).withColumnRenamed("time_to_event", "duration").withColumnRenamed("churned", "event")
        train = s.where(F.col("split") == "train")
        test = s.where(F.col("split") == "test")
        tr = stage(sv.standardize(train, train, FEATURES))
        te = stage(sv.standardize(train, test, FEATURES))
        return tr, te
    return memo(("scaled_split", data(spark, d)), build)


def cox_fit(spark, d):
    tr, _ = scaled_split(spark, d)
    return memo(("cox", data(spark, d)), lambda: cox.fit_cox(tr, FEATURES, penalizer=COX_PENALIZER))


def cox_baseline(spark, d):
    tr, _ = scaled_split(spark, d)
    return cox.baseline_hazard(tr, cox_fit(spark, d))


@register("h13_cox_summary", ids="H13")
def q_h13(spark, d):
    return cox.summary_frame(spark, cox_fit(spark, d))


@register("h14_ph_assumption_test", ids="H14")
def q_h14(spark, d):
    tr, _ = scaled_split(spark, d)
    return cox.ph_test(tr, cox_fit(spark, d))


@register("h16_cox_partial_hazard", ids="H16")
def q_h16(spark, d):
    _, te = scaled_split(spark, d)
    return cox.partial_hazard(te, cox_fit(spark, d)).select("visitorid", "business_label", "partial_hazard")


@register("h16_cox_baseline", ids="H16,W4")
def q_h16b(spark, d):
    return cox_baseline(spark, d)


@register("h17_cox_mean_curve_by_segment", ids="H17,J11,P28")
def q_h17c(spark, d):
    _, te = scaled_split(spark, d)
    return cox.mean_survival_by_segment(te, cox_baseline(spark, d), cox_fit(spark, d), sv.survival_grid(spark))


@register("h18_hazard_ratio_table", ids="H18")
def q_h18(spark, d):
    return cox.hazard_ratio_table(cox.summary_frame(spark, cox_fit(spark, d)))


@register("h19_hazard_by_segment", ids="H19,P28")
def q_h19(spark, d):
    _, te = scaled_split(spark, d)
    return cox.hazard_by_segment(te, cox_baseline(spark, d), cox_fit(spark, d), sv.survival_grid(spark))


@register("h20_cox_interpretation", ids="H20")
def q_h20(spark, d):
    return cox.interpretation(cox.hazard_ratio_table(cox.summary_frame(spark, cox_fit(spark, d))))


@register("h21_driver_ranking", ids="H21,T2")
def q_h21(spark, d):
    return cox.driver_ranking(cox.hazard_ratio_table(cox.summary_frame(spark, cox_fit(spark, d))))


@register("h15_cox_concordance", ids="H15,H30")
def q_h15c(spark, d):
    _, te = scaled_split(spark, d)
    ph = cox.partial_hazard(te, cox_fit(spark, d)).withColumn("neg_ph", -F.col("partial_hazard"))
    return sv.concordance_index(ph, "duration", "neg_ph", "event").withColumn("model", F.lit("cox"))


@register("h22_h23_cox_risk_segments", ids="H22,H23,W10")
def q_h23c(spark, d):
    _, te = scaled_split(spark, d)
    ph = cox.partial_hazard(te, cox_fit(spark, d), "risk_score")
    return sv.risk_quartiles(ph).groupBy("risk_segment").agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------- clustering
from cartwheel.operators import boosting as bo  # noqa: E402
from cartwheel.operators import churn_ml as cm  # noqa: E402
from cartwheel.operators import cluster as cl  # noqa: E402
from cartwheel.operators import importance as im  # noqa: E402
from cartwheel.operators import rfm as rf  # noqa: E402
from cartwheel.operators import survival_forest as sf  # noqa: E402
from cartwheel.plans import frames as fr  # noqa: E402

FOREST_PERIOD_DAYS = 30.0


def _cluster_input(spark, d):
    return memo(("cf", data(spark, d)), lambda: stage(rf.cluster_features(fr.rfm_b(spark, d))))


def _segmentation(spark, d, model):
    return memo(("seg", model, data(spark, d)), lambda: cl.segment(_cluster_input(spark, d), model=model))


@register("g4_model_comparison", ids="G4,G8")
def q_g4(spark, d):
    return memo(("cmp", data(spark, d)), lambda: stage(cl.compare_models(_cluster_input(spark, d))))


@register("g4_comparison_pivot", ids="G4")
def q_g4p(spark, d):
    return cl.comparison_pivot(q_g4(spark, d))


@register("g5_gmm_segments", ids="G5,G7,G8")
def q_g5(spark, d):
    return _segmentation(spark, d, "gmm")[0]


@register("g6_kmeans_segments", ids="G6,G7,G8")
def q_g6(spark, d):
    return _segmentation(spark, d, "kmeans")[0]


@register("g7_segmentation_metrics", ids="G7,G8")
def q_g7m(spark, d):
    return _segmentation(spark, d, "gmm")[1].unionByName(_segmentation(spark, d, "kmeans")[1])


@register("g9_gmm_segment_profile", ids="G9,G10,G13")
def q_g9m(spark, d):
    seg = _segmentation(spark, d, "gmm")[0].select("visitorid", "segment")
    r = fr.rfm_b(spark, d).join(seg, "visitorid", "inner")
    return rf.build_segment_profile(r, "segment")


# ------------------------------------------------------- churn classifier
def _gbt(spark, d):
    tr, _ = scaled_split(spark, d)
    return memo(("gbt", data(spark, d)), lambda: bo.fit_boosting(tr, FEATURES, "event"))


def _gbt_pred(spark, d):
    _, te = scaled_split(spark, d)
    return bo.predict_proba(_gbt(spark, d), te, FEATURES)


@register("h6_gbt_test_probabilities", ids="H5,H6")
def q_h6(spark, d):
    return _gbt_pred(spark, d).select("visitorid", "event", "prob")


@register("h7_h8_gbt_metrics", ids="H7,H8")
def q_h7(spark, d):
    p = _gbt_pred(spark, d)
    return cm.auc(p, "event", "prob").crossJoin(cm.prob_errors(p, "event", "prob"))


@register("h9_gbt_importance", ids="H9")
def q_h9(spark, d):
    return bo.importance_table(_gbt(spark, d), 20, spark)


@register("h9_permutation_importance", ids="H9")
def q_h9p(spark, d):
    """Drop of the test AUC: with label-0 rows as events at time 0 and label-1
    rows censored at time 1, the concordance index is the AUC."""
    _, te = scaled_split(spark, d)
    te = te.select("visitorid", F.col("event").cast("double").alias("at"), (1 - F.col("event")).alias("zero"), *FEATURES)
    return im.permutation_importance(te, FEATURES, _gbt(spark, d), "margin", duration="at", event="zero")


# -------------------------------------------------------- survival forest
def _forest(spark, d, refit=False):
    tr, te = scaled_split(spark, d)
    if refit:
        def build():
            allu = stage(tr.unionByName(te))
            return sf.fit_forest(allu, FEATURES, period_days=FOREST_PERIOD_DAYS, min_leaf=sf.FOREST_MIN_LEAF_REFIT), allu
        return memo(("rsf_all", data(spark, d)), build)
    return memo(("rsf", data(spark, d)), lambda: sf.fit_forest(tr, FEATURES, period_days=FOREST_PERIOD_DAYS))


def _horizon(spark, d):
    tr, _ = scaled_split(spark, d)
    return memo(("horizon", data(spark, d)), lambda: int((tr.agg(F.max("duration")).first()[0] or 0.0) // FOREST_PERIOD_DAYS) + 1)


def _forest_curves(spark, d):
    _, te = scaled_split(spark, d)
    return memo(("curves", data(spark, d)), lambda: staged_parquet(
        sf.forest_curves(_forest(spark, d), te, FEATURES, _horizon(spark, d), FOREST_PERIOD_DAYS), "forest-curves"))


@register("h24_forest_survival_curves", ids="H24")
def q_h24(spark, d):
    return _forest_curves(spark, d)


@register("h25_forest_concordance", ids="H25,H15")
def q_h25(spark, d):
    _, te = scaled_split(spark, d)
    risk = sf.forest_risk(_forest_curves(spark, d)).withColumn("neg_risk", -F.col("risk"))
    j = te.select("visitorid", "duration", "event").join(risk, "visitorid")
    return sv.concordance_index(j, "duration", "neg_risk", "event").withColumn("model", F.lit("survival_forest"))


@register("h27_forest_expected_lifetime", ids="H27")
def q_h27f(spark, d):
    c = _forest_curves(spark, d)
    start = c.select("visitorid").distinct().withColumn("t", F.lit(0.0)).withColumn("s", F.lit(1.0))
    return sv.expected_lifetime(c.select("visitorid", "t", "s").unionByName(start))


@register("h28_forest_segment_curve", ids="H28,P27")
def q_h28f(spark, d):
    return cm.segment_mean_curve(_forest_curves(spark, d), sv.survival_grid(spark))


@register("h29_users_survival_30", ids="H29,J10")
def q_h29(spark, d):
    model, allu = _forest(spark, d, refit=True)
    # staged: the forest is asked once, not by every reader of its curves
    curves = staged_parquet(sf.forest_curves(model, allu, FEATURES, max(2, int(30 // FOREST_PERIOD_DAYS) + 1), FOREST_PERIOD_DAYS),
                            "refit-curves")
    s30 = cm.survival_at_day(curves, 30.0)
    return fr.users_pipeline(spark, d).join(s30, "visitorid", "left")


@register("h30_model_comparison", ids="H30")
def q_h30(spark, d):
    return q_h15c(spark, d).unionByName(q_h25(spark, d))


# ------------------------------------------------------- anomaly flags (F9+)
from cartwheel.operators import features as fe  # noqa: E402
from cartwheel.operators import iforest  # noqa: E402


def _model_flags(spark, d):
    return memo(("iso", data(spark, d)), lambda: stage(iforest.model_based_flags(fr.rules(spark, d))))


@register("f9_model_flags", ids="F9")
def q_f9(spark, d):
    return _model_flags(spark, d).select("visitorid", "iso_score", "iso_flag", "iso_score_norm", "model_flag")


@register("f10_combined_flags", ids="F10,F14")
def q_f10(spark, d):
    return fe.combined_flags(_model_flags(spark, d))


@register("f11_final_flag_distribution", ids="F11,A12")
def q_f11f(spark, d):
    return fe.flag_distribution(fe.combined_flags(_model_flags(spark, d)), "final_flag")


@register("f11_top_flagged_users", ids="F11,T3")
def q_f11t(spark, d):
    return fe.top_flagged(fe.combined_flags(_model_flags(spark, d)), 200)


@register("f11_top25_by_combined_score", ids="F11,T3")
def q_f11c(spark, d):
    return fe.top_by_score(fe.combined_flags(_model_flags(spark, d)), "combined_score", 25)


@register("f12_feature_distributions", ids="F12,A17,P18")
def q_f12(spark, d):
    return fe.feature_distributions(fe.combined_flags(_model_flags(spark, d)))


@register("f14_run_pipeline_staged", ids="F14,S5,S6,S3")
def q_f14(spark, d):
    from cartwheel.session import ensure_checkpoint_dir
    import hashlib
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tag = hashlib.md5(d.encode()).hexdigest()[:10]
    e = fr.ewp(spark, d)
    return fe.run_pipeline(e, fe.build_user_features(e), stage_dir=f"{root}/cartwheel_stages/{tag}",
                           sources=[f"{d}/events.parquet"])


@register("h26_permutation_importance", ids="H26")
def q_h26(spark, d):
    tr, _ = scaled_split(spark, d)
    return im.permutation_importance(tr, FEATURES, _forest(spark, d), "risk", (_horizon(spark, d),), sign=-1.0)


# ------------------------------------------- policy on the fitted models (X)
from cartwheel.operators import policy as po  # noqa: E402
from cartwheel.plans import clv_queries as cq  # noqa: E402


def _fitted_gains(spark, d):
    users = po.policy_inputs_fitted(fr.users_pipeline(spark, d), cq.q_c16(spark, d), q_h29(spark, d))
    return po.simulate_gains(stage(users), po.draws_frame(spark))


@register("x5_fitted_discount_optimization", ids="X1,X2,X3,X4,X5,X6")
def q_x5_fitted(spark, d):
    return po.optimization_table(_fitted_gains(spark, d))


@register("x8_fitted_recommendations", ids="X7,X8")
def q_x8_fitted(spark, d):
    return po.recommendations(po.optimization_table(_fitted_gains(spark, d)))
