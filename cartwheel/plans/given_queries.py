"""Registered queries of model reports on given scores and coefficients (F8, F10-F12,
H16-H21): everything behind a fit, over the whole tables, checked against SQL.

The coefficients, the anomaly score and the hazard summary are plain stand-ins; the
fitted forms of the same reports are in ``model_queries``. Also here: rule flags at the
published thresholds and approximate distinct counts against exact ones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cartwheel.operators import cox
from cartwheel.operators import features as fe
from cartwheel.operators import sketches as sk
from cartwheel.operators import survival as sv
from cartwheel.plans import frames as fr
from cartwheel.plans import pipeline_queries as pq
from cartwheel.plans import survival_queries as sq
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import hist_sql, register_cte, with_ctes
from cartwheel.session import stage

FEATURES = sq.SURV_FEATURES
GIVEN_COEF = [round((-1) ** k * 0.4 / (k + 2), 6) for k in range(len(FEATURES))]


# ------------------------------------------------- F8 at the published thresholds
def _rules_sql(th: dict) -> str:
    flags = {"flag_many_events": ("total_events", "events"), "flag_many_events_30d": ("events_30d", "events_30d"),
             "flag_events_per_day_high": ("events_per_active_day", "events_per_day"),
             "flag_high_epm": ("max_events_per_minute", "events_per_minute"),
             "flag_fast_burst": ("prop_very_fast", "prop_fast"),
             "flag_repeat_items": ("prop_same_item_repeat", "prop_repeat"),
             "flag_many_distinct_items": ("distinct_items", "distinct_items")}
    cols = ", ".join(f"CAST({c} >= {th[t]} AS INTEGER) AS {f}" for f, (c, t) in flags.items())
    return f"SELECT *, {' + '.join(flags)} AS rule_flag_score FROM (SELECT *, {cols} FROM extra)"


register_cte("rules_published", ["extra"], _rules_sql(fe.RULE_THRESHOLDS))


@register("f8_rule_flags_published_thresholds", with_ctes("rules_published") + "SELECT * FROM rules_published",
          doubles=pq.EXTRA_DOUBLES, ids="F8,P21,P23")
def q_f8_published(spark, d):
    return fe.rule_based_flags(fr.extra(spark, d))


# ---------------------------------------- F10-F12 with a given anomaly score
register_cte("combined", ["rules"], f"""
  SELECT *, CAST(combined_score >= {fe.FINAL_THRESHOLD} AS INTEGER) AS final_flag
  FROM (SELECT *, {fe.W_RULE}::DOUBLE * rule_score_norm + {fe.W_MODEL}::DOUBLE * iso_score_norm AS combined_score
        FROM (SELECT *, least(distinct_items, 50) / 50.0::DOUBLE AS iso_score_norm,
                     rule_flag_score / CAST(CASE WHEN mx > 0 THEN mx ELSE 1 END AS DOUBLE) AS rule_score_norm
              FROM (SELECT *, max(rule_flag_score) OVER () AS mx FROM rules)))""")


def _combined(spark, d):
    given = fr.rules(spark, d).withColumn("iso_score_norm", F.least(F.col("distinct_items"), F.lit(50)) / F.lit(50.0))
    return fe.combined_flags(stage(given))


@register("f10_combined_flags_of_given_score", with_ctes("combined") + """
SELECT visitorid, rule_flag_score, iso_score_norm, rule_score_norm, combined_score, final_flag FROM combined""",
          doubles=["iso_score_norm", "rule_score_norm", "combined_score"], ids="F10,P26")
def q_f10_given(spark, d):
    return _combined(spark, d).select("visitorid", "rule_flag_score", "iso_score_norm", "rule_score_norm",
                                      "combined_score", "final_flag")


@register("f11_final_flags_of_given_score", with_ctes("combined") + """
SELECT final_flag, count(*) AS count FROM combined GROUP BY final_flag""", ids="F11,A12")
def q_f11_given(spark, d):
    return fe.flag_distribution(_combined(spark, d), "final_flag")


@register("f11_top_flagged_of_given_score", with_ctes("combined") + """
SELECT visitorid, combined_score, rule_flag_score, total_events FROM combined WHERE final_flag = 1
ORDER BY combined_score DESC, rule_flag_score DESC, total_events DESC, visitorid LIMIT 200""",
          doubles=["combined_score"], ids="F11,T3")
def q_f11_top_given(spark, d):
    return fe.top_flagged(_combined(spark, d), 200).select("visitorid", "combined_score", "rule_flag_score", "total_events")


@register("f12_feature_distributions_of_given_score", with_ctes("combined") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, h.* FROM ({hist_sql('combined', c, 50, log=c in fe.LOG_FEATURES)}) h"
    for c in fe.FEATURES_TO_PLOT), doubles=["bin_lo", "bin_hi"], ids="F12,A17,P18")
def q_f12_given(spark, d):
    return fe.feature_distributions(stage(_combined(spark, d)))


# ------------------------------------------------ H16-H19 with given coefficients
_SCALED = ", ".join(f"CASE WHEN sd_{c} > 0 THEN (coalesce(CAST({c} AS DOUBLE), 0.0) - mu_{c}) / sd_{c} ELSE 0.0 END AS {c}"
                    for c in FEATURES)
_LINEAR = " + ".join(f"({b!r})::DOUBLE * {c}" for b, c in zip(GIVEN_COEF, FEATURES))
register_cte("scaled", ["splitted"], f"""
  SELECT visitorid, business_label, split, time_to_event AS duration, churned AS event, {_SCALED}
  FROM splitted, (SELECT {sq._STATS} FROM splitted WHERE split = 'train')""")
register_cte("given_hazard", ["scaled"], f"SELECT *, exp({_LINEAR}) AS partial_hazard FROM scaled")
register_cte("given_baseline", ["given_hazard"], """
  SELECT timeline, baseline_hazard, sum(baseline_hazard) OVER (ORDER BY timeline) AS cumulative_hazard
  FROM (SELECT timeline, dd / sum(r0) OVER (ORDER BY timeline DESC) AS baseline_hazard
        FROM (SELECT CAST(duration AS DOUBLE) AS timeline, sum(partial_hazard) AS r0, CAST(sum(event) AS DOUBLE) AS dd
              FROM given_hazard WHERE split = 'train' GROUP BY 1))""")
register_cte("given_grid", ["given_baseline", "grid"], """
  SELECT g.t, coalesce(b.baseline_hazard, 0.0) AS h0, coalesce(b.cumulative_hazard, 0.0) AS ch0
  FROM grid g ASOF LEFT JOIN given_baseline b ON g.t >= b.timeline""")


def given_fit() -> cox.CoxFit:
    n = len(FEATURES)
    return cox.CoxFit(list(FEATURES), np.array(GIVEN_COEF), np.ones(n), np.eye(n), 0.0, 0, np.zeros(n), 0, 0)


def _scaled(spark, d):
    s = sq._split(spark, d).withColumnRenamed("time_to_event", "duration").withColumnRenamed("churned", "event")
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    return stage(sv.standardize(train, train, FEATURES)), sv.standardize(train, test, FEATURES)


@register("h16_partial_hazard_of_given_coefficients", with_ctes("given_hazard") + """
SELECT visitorid, business_label, partial_hazard FROM given_hazard WHERE split = 'test'""",
          doubles=["partial_hazard"], ids="H16")
def q_h16_given(spark, d):
    _, test = _scaled(spark, d)
    return cox.partial_hazard(test, given_fit()).select("visitorid", "business_label", "partial_hazard")


@register("h16_baseline_of_given_coefficients", with_ctes("given_baseline") + """
SELECT *, exp(-cumulative_hazard) AS baseline_survival FROM given_baseline""",
          doubles=["timeline", "baseline_hazard", "cumulative_hazard", "baseline_survival"], ids="H16,W4")
def q_h16_baseline_given(spark, d):
    train, _ = _scaled(spark, d)
    return cox.baseline_hazard(train, given_fit())


@register("h16_survival_curves_of_given_coefficients", with_ctes("given_hazard", "given_grid") + """
SELECT visitorid, business_label, t, exp(-ch0 * partial_hazard) AS s
FROM given_hazard, given_grid WHERE split = 'test'""", doubles=["t", "s"], ids="H16,J11,P28")
def q_h16_curves_given(spark, d):
    train, test = _scaled(spark, d)
    return cox.survival_on_grid(test, cox.baseline_hazard(train, given_fit()), given_fit(), sv.survival_grid(spark))


@register("h17_mean_curve_of_given_coefficients", with_ctes("given_hazard", "given_grid") + """
SELECT business_label, t, avg(exp(-ch0 * partial_hazard)) AS mean_survival
FROM given_hazard, given_grid WHERE split = 'test' GROUP BY 1, 2""", doubles=["t", "mean_survival"], ids="H17,P28")
def q_h17_given(spark, d):
    train, test = _scaled(spark, d)
    return cox.mean_survival_by_segment(test, cox.baseline_hazard(train, given_fit()), given_fit(), sv.survival_grid(spark))


@register("h19_hazard_by_segment_of_given_coefficients", with_ctes("given_hazard", "given_grid") + """
SELECT business_label, t, h0 * mean_ph AS hazard
FROM (SELECT business_label, avg(partial_hazard) AS mean_ph FROM given_hazard WHERE split = 'test' GROUP BY 1), given_grid""",
          doubles=["t", "hazard"], ids="H19,P28")
def q_h19_given(spark, d):
    train, test = _scaled(spark, d)
    return cox.hazard_by_segment(test, cox.baseline_hazard(train, given_fit()), given_fit(), sv.survival_grid(spark))


# --------------------------------- H18, H20, H21 on a summary of mean differences
# Stand-in summary: coefficient = difference of the standardised means of churned and
# other training users, se = sqrt(1/n1 + 1/n0) / 2, p = exp(-z^2 / 2).
register_cte("mean_summary", ["scaled"], "\n  UNION ALL ".join(f"""
  SELECT '{c}' AS covariate, avg({c}) FILTER (WHERE event = 1) - avg({c}) FILTER (WHERE event = 0) AS coef,
         sqrt(1.0 / count(*) FILTER (WHERE event = 1) + 1.0 / count(*) FILTER (WHERE event = 0)) / 2 AS se
  FROM scaled WHERE split = 'train'""" for c in FEATURES))
register_cte("mean_ratios", ["mean_summary"], """
  SELECT covariate, exp(coef) AS "HR", exp(coef - 1.96 * se) AS "HR_lower", exp(coef + 1.96 * se) AS "HR_upper",
         exp(-0.5 * (coef / se) * (coef / se)) AS p FROM mean_summary""")


def _mean_ratios(spark, d):
    train, _ = _scaled(spark, d)
    n = {e: F.count_if(F.col("event") == e) for e in (0, 1)}
    mean = {(c, e): F.avg(F.when(F.col("event") == e, F.col(c))) for c in FEATURES for e in (0, 1)}
    row = train.agg((F.sqrt(F.try_divide(F.lit(1.0), n[1]) + F.try_divide(F.lit(1.0), n[0])) / 2).alias("_se"),
                    *[(mean[c, 1] - mean[c, 0]).alias(c) for c in FEATURES])
    summary = row.unpivot("_se", FEATURES, "covariate", "coef").select(
        "covariate", "coef", (F.col("coef") - 1.96 * F.col("_se")).alias("coef_lower"),
        (F.col("coef") + 1.96 * F.col("_se")).alias("coef_upper"),
        F.exp(F.lit(-0.5) * (F.col("coef") / F.col("_se")) * (F.col("coef") / F.col("_se"))).alias("p"))
    return cox.hazard_ratio_table(summary)


@register("h18_hazard_ratios_of_mean_differences", with_ctes("mean_ratios") + "SELECT * FROM mean_ratios",
          doubles=["HR", "HR_lower", "HR_upper", "p"], ids="H18")
def q_h18_given(spark, d):
    return _mean_ratios(spark, d)


@register("h20_interpretation_of_mean_differences", with_ctes("mean_ratios") + """
SELECT covariate, CASE WHEN "HR" > 1
    THEN printf('%s: +%.1f%% higher churn risk (HR=%.2f, p=%.3f)', covariate, ("HR" - 1) * 100, "HR", p)
    ELSE printf('%s: -%.1f%% lower churn risk (HR=%.2f, p=%.3f)', covariate, (1 - "HR") * 100, "HR", p) END AS text
FROM mean_ratios WHERE p <= 0.05""", ids="H20")
def q_h20_given(spark, d):
    return cox.interpretation(_mean_ratios(spark, d))


@register("h21_drivers_of_mean_differences", with_ctes("mean_ratios") + """
SELECT *, abs(ln("HR")) AS impact_strength FROM mean_ratios ORDER BY impact_strength DESC, covariate LIMIT 10""",
          doubles=["HR", "HR_lower", "HR_upper", "p", "impact_strength"], ids="H21,T2")
def q_h21_given(spark, d):
    return cox.driver_ranking(_mean_ratios(spark, d))


# --------------------------------------------- A3: sketches beside exact counts
_BOUND = sk.relative_error_bound()


def _beside_exact(exact, approx, on):
    return exact.join(approx, on).withColumn(
        "within_bound", (F.abs(F.col("approx_distinct") - F.col("visitors")) <= F.col("visitors") * _BOUND + 0.5).cast("int")) \
        .drop("approx_distinct")


@register("a3_monthly_visitors_by_sketch", with_ctes("ev") + """
SELECT event, CAST(date_trunc('month', "timestamp") AS DATE) AS month, count(DISTINCT visitorid) AS visitors, 1 AS within_bound
FROM ev GROUP BY 1, 2""", ids="A3")
def q_a3_month(spark, d):
    e = fr.ev(spark, d)
    month = F.trunc("day", "month").alias("month")
    approx = sk.merged_counts(sk.daily_sketches(e, "visitorid", "timestamp", ["event"]), ["event", month])
    exact = e.groupBy("event", F.trunc("timestamp", "month").alias("month")).agg(F.count_distinct("visitorid").alias("visitors"))
    return _beside_exact(exact, approx, ["event", "month"])


@register("a3_trailing_week_visitors_by_sketch", with_ctes("ev") + """
, v AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS day, visitorid FROM ev)
SELECT d.day, count(DISTINCT v.visitorid) AS visitors, 1 AS within_bound
FROM (SELECT DISTINCT day FROM v) d JOIN v ON v.day BETWEEN d.day - 6 AND d.day GROUP BY 1""", ids="A3")
def q_a3_week(spark, d):
    e = fr.ev(spark, d)
    approx = sk.trailing_counts(sk.daily_sketches(e, "visitorid", "timestamp"), 7)
    days = e.select(F.to_date("timestamp").alias("day"), "visitorid").distinct()
    exact = days.withColumn("day", F.explode(F.sequence("day", F.date_add("day", 6)))) \
        .groupBy("day").agg(F.count_distinct("visitorid").alias("visitors")) \
        .join(days.select("day").distinct(), "day", "left_semi")
    return _beside_exact(exact, approx, ["day"])
