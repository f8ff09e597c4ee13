"""Registered churn / survival queries (H1-H4, H10-H12, H15, H17, H22, H23,
H27, H28). Churn window 180 days on the order adapter (FIXTURES.md) so that
both classes are populated; scores and curves are deterministic stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import survival as sv
from cartwheel.plans import frames as fr
from cartwheel.plans import pipeline_queries as _pq  # noqa: F401  (registers users_pipeline CTE)
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import register_cte, with_ctes
from cartwheel.session import stage

WINDOW = 180
SURV_FEATURES = ["total_events", "tenure_days", "total_views", "total_addtocarts", "total_tx", "distinct_items",
                 "view_items", "addtocart_items", "tx_items", "prop_addtocart", "prop_tx", "events_7d",
                 "events_14d", "events_30d", "active_days", "events_per_active_day"]
KM_DOUBLES = ["timeline", "survival", "ci_lower", "ci_upper"]

register_cte("churn", ["btx"], f"""
  SELECT visitorid, min("timestamp") AS origin,
         CASE WHEN date_diff('microsecond', max("timestamp"), max(de)) >= {WINDOW} * 86400000000
              THEN date_diff('microsecond', min("timestamp"), max("timestamp")) / 86400000000.0
              ELSE date_diff('microsecond', min("timestamp"), max(de)) / 86400000000.0 END AS time_to_event,
         CAST(date_diff('microsecond', max("timestamp"), max(de)) >= {WINDOW} * 86400000000 AS INTEGER) AS churned
  FROM (SELECT b.*, (SELECT max("timestamp") FROM btx) AS de FROM btx b) GROUP BY visitorid""")
register_cte("user_data", ["users_pipeline", "churn"], """
  SELECT u.* EXCLUDE (view_price, addtocart_price, tx_price, avg_inter_event_days), c.origin, c.time_to_event, c.churned
  FROM users_pipeline u LEFT JOIN churn c ON u.visitorid = c.visitorid""")
register_cte("splitted", ["user_data"], """
  SELECT * EXCLUDE (h, n), CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY h, visitorid)
                                     <= n - ceil(n * 0.2) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, ('0x' || substr(md5(CAST(visitorid AS VARCHAR) || ':42'), 1, 8))::BIGINT AS h,
               count(*) OVER (PARTITION BY churned) AS n FROM user_data)""")
register_cte("test_scored", ["splitted"], """
  SELECT *, 0.1::DOUBLE * events_per_active_day + 0.01::DOUBLE * recency_days - 0.001::DOUBLE * tenure_days AS risk_score
  FROM splitted WHERE split = 'test'""")


def km_sql(src: str, by: str | None = None) -> str:
    p = f"PARTITION BY {by} " if by else ""
    k = f"{by}, " if by else ""
    zero = f"SELECT DISTINCT {k}0.0::DOUBLE AS timeline, 0 AS removed, 0 AS observed FROM {src}"
    return f"""
  SELECT {k}timeline, removed, observed, removed - observed AS censored, at_risk, survival,
         CASE WHEN survival >= 1 OR survival <= 0 THEN survival
              ELSE exp(-exp(ln(-ln(survival)) + 1.959963984540054 * sqrt(cgw) / ln(survival))) END AS ci_lower,
         CASE WHEN survival >= 1 OR survival <= 0 THEN survival
              ELSE exp(-exp(ln(-ln(survival)) - 1.959963984540054 * sqrt(cgw) / ln(survival))) END AS ci_upper
  FROM (SELECT *, CASE WHEN czf > 0 THEN 0.0 ELSE exp(clf) END AS survival
        FROM (SELECT *, sum(lf) OVER o AS clf, sum(zf) OVER o AS czf, sum(gw) OVER o AS cgw
              FROM (SELECT *, CASE WHEN observed < at_risk THEN ln(1.0 - observed / at_risk) ELSE 0.0 END AS lf,
                           CASE WHEN observed >= at_risk AND observed > 0 THEN 1 ELSE 0 END AS zf,
                           CASE WHEN observed < at_risk THEN observed / (at_risk * (at_risk - observed)) ELSE 0.0 END AS gw
                    FROM (SELECT *, CAST(sum(removed) OVER ({p}ORDER BY timeline DESC
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS at_risk
                          FROM (SELECT {k}timeline, CAST(sum(removed) AS BIGINT) AS removed,
                                       CAST(sum(observed) AS BIGINT) AS observed
                                FROM (SELECT {k}CAST(time_to_event AS DOUBLE) AS timeline, count(*) AS removed,
                                             sum(churned) AS observed FROM {src} GROUP BY ALL
                                      UNION ALL {zero}) GROUP BY ALL)))
              WINDOW o AS ({p}ORDER BY timeline ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"""


register_cte("km_train", ["splitted"], km_sql("(SELECT * FROM splitted WHERE split = 'train')"))
register_cte("km_by_label", ["splitted"], km_sql("(SELECT * FROM splitted WHERE split = 'train')", "business_label"))
register_cte("grid", [], "SELECT CAST(range AS DOUBLE) AS t FROM range(151)")
register_cte("curves", ["km_train", "grid", "test_scored"], """
  SELECT u.visitorid, u.business_label, g.t, pow(coalesce(k.survival, 0.0), exp(u.risk_score)) AS s
  FROM test_scored u CROSS JOIN (grid g ASOF LEFT JOIN km_train k ON g.t >= k.timeline)""")


def _users(spark, d):
    return sv.attach_churn(fr.users_pipeline(spark, d), sv.time_to_churn(fr.btx_once(spark, d), WINDOW))


def _split(spark, d):
    return fr.memo(("split", fr.orders_state(spark, d)), lambda: stage(sv.stratified_split(_users(spark, d))))


def _train(spark, d):
    return _split(spark, d).where(F.col("split") == "train")


def _test_scored(spark, d):
    return sv.standin_risk_score(_split(spark, d).where(F.col("split") == "test"))


def _km(spark, d, by=None):
    return sv.kaplan_meier(_train(spark, d), "time_to_event", "churned", by=by)


@register("h1_time_to_churn", with_ctes("churn") + "SELECT * FROM churn", doubles=["time_to_event"], ids="H1,P17")
def q_h1(spark, d):
    return sv.time_to_churn(fr.btx(spark, d), WINDOW)


@register("h2_user_data", with_ctes("user_data") + "SELECT * FROM user_data",
          doubles=["prop_addtocart", "prop_tx", "events_per_active_day", "time_to_event"], ids="H2,J10,P9")
def q_h2(spark, d):
    return _users(spark, d)


@register("h3_stratified_split", with_ctes("splitted") + "SELECT visitorid, churned, split FROM splitted",
          ids="H3")
def q_h3(spark, d):
    return _split(spark, d).select("visitorid", "churned", "split")


@register("h4_class_balance", with_ctes("splitted") + """
SELECT split, churned, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY split) AS share
FROM splitted GROUP BY split, churned""", doubles=["share"], ids="H4,A12")
def q_h4(spark, d):
    return sv.class_balance(_split(spark, d))


_STD = ",\n".join(
    f"CASE WHEN sd_{c} > 0 THEN (coalesce(CAST({c} AS DOUBLE), 0.0) - mu_{c}) / sd_{c} ELSE 0.0 END AS {c}"
    for c in SURV_FEATURES)
_STATS = ", ".join(f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS mu_{c}, stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) AS sd_{c}"
                   for c in SURV_FEATURES)


@register("h10_standardized_test_features", with_ctes("splitted") + f"""
SELECT visitorid, {_STD}
FROM (SELECT * FROM splitted WHERE split = 'test'), (SELECT {_STATS} FROM splitted WHERE split = 'train')""",
          doubles=SURV_FEATURES, ids="H10,H5")
def q_h10(spark, d):
    s = _split(spark, d)
    feats = sv.feature_columns(s.drop("time_to_event", "churned"))
    assert feats == SURV_FEATURES, feats
    out = sv.standardize(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"), feats)
    return out.select("visitorid", *feats)


@register("h11_km_overall", with_ctes("km_train") + "SELECT * FROM km_train", doubles=KM_DOUBLES, ids="H11")
def q_h11(spark, d):
    return _km(spark, d)


@register("h12_km_by_segment", with_ctes("km_by_label") + "SELECT * FROM km_by_label", doubles=KM_DOUBLES,
          ids="H12")
def q_h12(spark, d):
    return _km(spark, d, ["business_label"])


@register("h15_concordance_index", with_ctes("test_scored") + """
, x AS (SELECT time_to_event AS t, churned AS e, -risk_score AS s FROM test_scored)
SELECT concordant, tied, pairs, (concordant + 0.5 * tied) / pairs AS c_index FROM (
  SELECT CAST(count(*) FILTER (WHERE j.s > i.s) AS DOUBLE) AS concordant,
         CAST(count(*) FILTER (WHERE j.s = i.s) AS DOUBLE) AS tied, CAST(count(*) AS DOUBLE) AS pairs
  FROM x i JOIN x j ON i.e = 1 AND (i.t < j.t OR (i.t = j.t AND j.e = 0)))""",
          doubles=["concordant", "tied", "pairs", "c_index"], ids="H15,J12")
def q_h15(spark, d):
    t = _test_scored(spark, d).withColumn("neg_risk", -F.col("risk_score"))
    return sv.concordance_index(t, "time_to_event", "neg_risk", "churned")


@register("h7_auc_of_score", with_ctes("test_scored") + """
, r AS (SELECT churned AS y, rank() OVER (ORDER BY risk_score)
               + (count(*) OVER (PARTITION BY risk_score) - 1) / 2.0 AS rk FROM test_scored)
SELECT (sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
       / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS auc,
       count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg FROM r""",
          doubles=["auc"], ids="H7,W11")
def q_h7_score(spark, d):
    from cartwheel.operators.churn_ml import auc
    return auc(_test_scored(spark, d), "churned", "risk_score")


@register("h8_errors_of_logistic_score", with_ctes("test_scored") + """
, p AS (SELECT 1.0 / (1.0 + exp(-risk_score)) - churned AS e FROM test_scored)
SELECT avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM p""",
          doubles=["mse", "rmse", "mae"], ids="H8")
def q_h8_score(spark, d):
    from cartwheel.operators.churn_ml import prob_errors
    t = _test_scored(spark, d).withColumn("prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("risk_score"))))
    return prob_errors(t, "churned", "prob")


@register("h17_mean_curve_by_segment", with_ctes("curves") + """
SELECT business_label, t, avg(s) AS mean_survival FROM curves GROUP BY 1, 2""",
          doubles=["t", "mean_survival"], ids="H17,J11,P28,P30")
def q_h17(spark, d):
    return sv.mean_curve_from_baseline(_test_scored(spark, d), _km(spark, d), "risk_score", sv.survival_grid(spark))


@register("h22_risk_summary", with_ctes("test_scored") + """
SELECT 'risk_score' AS "column", count(risk_score) AS count, avg(risk_score) AS mean, stddev_samp(risk_score) AS std,
       min(risk_score) AS "min", quantile_cont(risk_score, 0.25) AS p25, quantile_cont(risk_score, 0.5) AS p50,
       quantile_cont(risk_score, 0.75) AS p75, max(risk_score) AS "max" FROM test_scored""",
          doubles=["mean", "std", "min", "p25", "p50", "p75", "max"], ids="H22,A16")
def q_h22(spark, d):
    return sv.risk_summary(_test_scored(spark, d))


@register("h23_risk_quartiles", with_ctes("test_scored") + """
, q AS (SELECT quantile_cont(risk_score, 0.25) AS q1, quantile_cont(risk_score, 0.5) AS q2,
               quantile_cont(risk_score, 0.75) AS q3 FROM test_scored)
SELECT risk_segment, count(*) AS count FROM (
  SELECT CASE WHEN risk_score <= q1 THEN 'Low' WHEN risk_score <= q2 THEN 'Medium'
              WHEN risk_score <= q3 THEN 'High' ELSE 'Very High' END AS risk_segment FROM test_scored, q)
GROUP BY 1""", ids="H23,W10,A12")
def q_h23(spark, d):
    return sv.risk_quartiles(_test_scored(spark, d)).groupBy("risk_segment").agg(F.count(F.lit(1)).alias("count"))


@register("h27_expected_lifetime", with_ctes("curves") + """
SELECT visitorid, coalesce(sum((t2 - t) * (s + s2) / 2.0), 0.0) AS expected_lifetime FROM (
  SELECT visitorid, t, s, lead(t) OVER w AS t2, lead(s) OVER w AS s2 FROM curves
  WINDOW w AS (PARTITION BY visitorid ORDER BY t)) GROUP BY visitorid""",
          doubles=["expected_lifetime"], ids="H27")
def q_h27(spark, d):
    return sv.expected_lifetime_from_baseline(_test_scored(spark, d), _km(spark, d), "risk_score", sv.survival_grid(spark))


@register("h28_interpolated_segment_curves", with_ctes("km_by_label", "grid") + """
, pts AS (SELECT DISTINCT k.business_label, g.t FROM km_by_label k CROSS JOIN grid g)
, br AS (SELECT p.business_label, p.t,
                arg_max(k.survival, k.timeline) FILTER (WHERE k.timeline <= p.t) AS lo_s,
                max(k.timeline) FILTER (WHERE k.timeline <= p.t) AS lo_t,
                arg_min(k.survival, k.timeline) FILTER (WHERE k.timeline >= p.t) AS hi_s,
                min(k.timeline) FILTER (WHERE k.timeline >= p.t) AS hi_t,
                arg_min(k.survival, k.timeline) AS first_s, arg_max(k.survival, k.timeline) AS last_s
         FROM pts p JOIN km_by_label k ON p.business_label = k.business_label GROUP BY 1, 2)
SELECT business_label, t, CASE WHEN lo_t IS NULL THEN first_s WHEN hi_t IS NULL THEN last_s
                               WHEN hi_t = lo_t THEN lo_s
                               ELSE lo_s + (t - lo_t) * (hi_s - lo_s) / (hi_t - lo_t) END AS s
FROM br""", doubles=["t", "s"], ids="H28,P27")
def q_h28(spark, d):
    km = _km(spark, d, ["business_label"])
    pts = km.select("business_label").distinct().crossJoin(F.broadcast(sv.survival_grid(spark).select("t")))
    return sv.interpolate_curves(pts, km, ["business_label"], "t", "timeline", "survival")
