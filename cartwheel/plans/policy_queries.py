"""Registered policy-simulation queries (X1-X11). Model outputs are the
deterministic stand-ins of ``policy.policy_inputs_standin`` over the
eligible customers, so the whole chain is SQL-checkable; the draws are the
reference's seeded stream, embedded verbatim in the oracle."""

from __future__ import annotations


from cartwheel.operators import policy as po
from cartwheel.plans import frames as fr
from cartwheel.plans import pipeline_queries as _pq  # noqa: F401  (registers users_pipeline CTE)
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import register_cte, with_ctes


def _draws_sql() -> str:
    rows = ",\n".join(f"({i}, '{u1!r}'::DOUBLE, '{u2!r}'::DOUBLE)" for i, u1, u2 in po.uniform_draws())
    return f"SELECT * FROM (VALUES {rows}) AS t(sim_id, u1, u2)"


def _grid_sql() -> str:
    return "[" + ", ".join(f"'{x!r}'::DOUBLE" for x in po.discount_grid()) + "]"


register_cte("policy_users", ["users_pipeline"], """
  SELECT *, total_tx / greatest(tenure_days, 1) * 30.0 AS pred_no_purchase, tx_price AS pred_money_each_purchase,
         1.0 / (1.0 + recency_days / 180.0::DOUBLE) AS survival_prob,
         total_tx / greatest(tenure_days, 1) * 30.0 * tx_price * (1.0 / (1.0 + recency_days / 180.0::DOUBLE)) AS baseline_clv
  FROM users_pipeline""")
register_cte("seg_params", ["policy_users"], """
  SELECT business_label, churn_risk, purchase_freq, clv,
         churn_risk / max(churn_risk) OVER () * 1.3 AS k,
         (1.0 - purchase_freq / max(purchase_freq) OVER ()) * 0.6 AS c,
         churn_risk * 0.12 AS m
  FROM (SELECT business_label, 1.0 - avg(survival_prob) AS churn_risk, avg(pred_no_purchase) AS purchase_freq,
               avg(baseline_clv) AS clv FROM policy_users GROUP BY business_label)""")
register_cte("lifts", ["seg_params"], f"""
  SELECT business_label, k, c, m, discount,
         k * pow(discount, 0.85) AS purchase_min, k * pow(discount, 1.05) AS purchase_max,
         1.0 / (1.0 + exp(-c * (discount - m))) * 0.8 AS churn_min,
         1.0 / (1.0 + exp(-c * (discount - m))) * 1.2 AS churn_max
  FROM (SELECT *, unnest({_grid_sql()}) AS discount FROM seg_params)""")
register_cte("draws", [], _draws_sql())
register_cte("gains", ["lifts", "policy_users", "draws"], """
  SELECT l.business_label AS segment, l.discount, d.sim_id,
         (1.0 + (purchase_min + (purchase_max - purchase_min) * u1))
           * (coalesce(seg_a, 0.0) - (1.0 - (churn_min + (churn_max - churn_min) * u2)) * coalesce(seg_b, 0.0))
         - coalesce(seg_c, 0.0) - l.discount * (1.0 + (purchase_min + (purchase_max - purchase_min) * u1)) * coalesce(seg_a, 0.0) AS gain
  FROM lifts l
  LEFT JOIN (SELECT business_label, sum(pred_no_purchase * pred_money_each_purchase) AS seg_a,
                    sum(pred_no_purchase * pred_money_each_purchase * (1.0 - survival_prob)) AS seg_b,
                    sum(baseline_clv) AS seg_c
             FROM policy_users WHERE pred_no_purchase IS NOT NULL AND pred_money_each_purchase IS NOT NULL
               AND survival_prob IS NOT NULL GROUP BY business_label) s ON l.business_label = s.business_label
  CROSS JOIN draws d""")
register_cte("opt", ["gains"], """
  SELECT segment, discount, avg(gain) AS mean_gain, quantile_cont(gain, 0.5) AS median_gain,
         avg(CAST(gain > 0 AS DOUBLE)) AS prob_positive, quantile_cont(gain, 0.05) AS worst_5pct,
         quantile_cont(gain, 0.95) AS best_95pct
  FROM gains GROUP BY segment, discount""")

_PUBLISHED = ", ".join(f"('{s}', '{p['k']!r}'::DOUBLE, '{p['c']!r}'::DOUBLE, '{p['m']!r}'::DOUBLE)"
                       for s, p in po.PUBLISHED_SEGMENT_PARAMS.items())
register_cte("published_gains", ["policy_users", "draws"], f"""
  SELECT l.business_label AS segment, l.discount, d.sim_id,
         (1.0 + pmin + (pmax - pmin) * u1) * (coalesce(seg_a, 0.0)
             - (1.0 - center * (0.8 + 0.4 * u2)) * coalesce(seg_b, 0.0))
         - coalesce(seg_c, 0.0) - l.discount * (1.0 + pmin + (pmax - pmin) * u1) * coalesce(seg_a, 0.0) AS gain
  FROM (SELECT *, k * pow(discount, 0.85) AS pmin, k * pow(discount, 1.05) AS pmax,
               1.0 / (1.0 + exp(-c * (discount - m))) AS center
        FROM (SELECT *, unnest({_grid_sql()}) AS discount
              FROM (VALUES {_PUBLISHED}) AS t(business_label, k, c, m))) l
  LEFT JOIN (SELECT business_label, sum(pred_no_purchase * pred_money_each_purchase) AS seg_a,
                    sum(pred_no_purchase * pred_money_each_purchase * (1.0 - survival_prob)) AS seg_b,
                    sum(baseline_clv) AS seg_c
             FROM policy_users WHERE pred_no_purchase IS NOT NULL AND pred_money_each_purchase IS NOT NULL
               AND survival_prob IS NOT NULL GROUP BY business_label) s ON l.business_label = s.business_label
  CROSS JOIN draws d""")

OPT = ["discount", "mean_gain", "median_gain", "prob_positive", "worst_5pct", "best_95pct"]


def _users(spark, d):
    return po.policy_inputs_standin(fr.users_pipeline(spark, d))


def _opt(spark, d):
    u = _users(spark, d)
    return po.optimization_table(po.simulate_gains(u, po.draws_frame(spark)))


@register("x1_baseline_clv", with_ctes("policy_users") + """
SELECT visitorid, business_label, pred_no_purchase, pred_money_each_purchase, survival_prob, baseline_clv
FROM policy_users""", doubles=["pred_no_purchase", "pred_money_each_purchase", "survival_prob", "baseline_clv"],
          ids="X1,P20")
def q_x1(spark, d):
    return po.baseline_clv(_users(spark, d)).select(
        "visitorid", "business_label", "pred_no_purchase", "pred_money_each_purchase", "survival_prob", "baseline_clv")


@register("x1_baseline_describe", with_ctes("policy_users") + """
SELECT 'baseline_clv' AS "column", count(baseline_clv) AS count, avg(baseline_clv) AS mean,
       stddev_samp(baseline_clv) AS std, min(baseline_clv) AS "min", quantile_cont(baseline_clv, 0.25) AS p25,
       quantile_cont(baseline_clv, 0.5) AS p50, quantile_cont(baseline_clv, 0.75) AS p75, max(baseline_clv) AS "max"
FROM policy_users""", doubles=["mean", "std", "min", "p25", "p50", "p75", "max"], ids="X1,A16")
def q_x1d(spark, d):
    return po.baseline_describe(_users(spark, d))


@register("x2_segment_parameters", with_ctes("seg_params") + "SELECT * FROM seg_params",
          doubles=["churn_risk", "purchase_freq", "clv", "k", "c", "m"], ids="X2")
def q_x2(spark, d):
    return po.segment_parameters(_users(spark, d))


@register("x3_lift_ranges", with_ctes("lifts") + """
SELECT business_label, discount, purchase_min, purchase_max, churn_min, churn_max FROM lifts""",
          doubles=["discount", "purchase_min", "purchase_max", "churn_min", "churn_max"], ids="X3,P20,P30,J11")
def q_x3(spark, d):
    return po.lift_ranges(po.segment_parameters(_users(spark, d))).select(
        "business_label", "discount", "purchase_min", "purchase_max", "churn_min", "churn_max")


@register("x4_simulated_gains", with_ctes("gains") + "SELECT * FROM gains", doubles=["discount", "gain"],
          ids="X4,J11")
def q_x4(spark, d):
    return po.simulate_gains(_users(spark, d), po.draws_frame(spark))


@register("x5_discount_optimization", with_ctes("opt") + "SELECT * FROM opt", doubles=OPT, ids="X5,X6,A8,A14")
def q_x5(spark, d):
    return _opt(spark, d)


@register("x7_best_discount_by_mean", with_ctes("opt") + """
SELECT segment, discount, mean_gain, median_gain, prob_positive, worst_5pct, best_95pct FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY mean_gain DESC, discount) AS rn FROM opt) WHERE rn = 1""",
          doubles=OPT, ids="X7,T4")
def q_x7(spark, d):
    return po.best_discount(_opt(spark, d), "mean_gain")


@register("x7_best_discount_by_prob", with_ctes("opt") + """
SELECT segment, discount, mean_gain, median_gain, prob_positive, worst_5pct, best_95pct FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY prob_positive DESC, discount) AS rn FROM opt) WHERE rn = 1""",
          doubles=OPT, ids="X7,T4")
def q_x7p(spark, d):
    return po.best_discount(_opt(spark, d), "prob_positive")


@register("x8_recommendations", with_ctes("opt") + """
SELECT segment, discount AS best_discount, mean_gain, prob_positive, worst_5pct, best_95pct FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY prob_positive DESC, mean_gain DESC, discount) AS rn
  FROM opt) WHERE rn = 1""", doubles=["best_discount", "mean_gain", "prob_positive", "worst_5pct", "best_95pct"],
          ids="X8,T5")
def q_x8(spark, d):
    return po.recommendations(_opt(spark, d))


@register("x9_gain_histogram", with_ctes("opt", "gains") + """
, best AS (SELECT segment, discount AS bd FROM (
    SELECT *, row_number() OVER (PARTITION BY segment ORDER BY mean_gain DESC, discount) AS rn FROM opt) WHERE rn = 1)
, g AS (SELECT g.segment, g.gain FROM gains g JOIN best b ON g.segment = b.segment AND g.discount = b.bd)
, b AS (SELECT segment, CASE WHEN min(gain) = max(gain) THEN min(gain) - 0.5 ELSE min(gain) END AS lo,
               CASE WHEN min(gain) = max(gain) THEN max(gain) + 0.5 ELSE max(gain) END AS hi FROM g GROUP BY segment)
SELECT b.segment, CAST(r.bin AS BIGINT) AS bin, lo + r.bin * ((hi - lo) / 40) AS bin_lo,
       lo + (r.bin + 1) * ((hi - lo) / 40) AS bin_hi, coalesce(c.cnt, 0) AS count
FROM b CROSS JOIN (SELECT range AS bin FROM range(40)) r
LEFT JOIN (SELECT g.segment, least(CAST(floor((gain - lo) / (hi - lo) * 40) AS BIGINT), 39) AS bin, count(*) AS cnt
           FROM g JOIN b ON g.segment = b.segment GROUP BY 1, 2) c ON c.segment = b.segment AND c.bin = r.bin""",
          doubles=["bin_lo", "bin_hi"], ids="X9,A17")
def q_x9(spark, d):
    u = _users(spark, d)
    gains = po.simulate_gains(u, po.draws_frame(spark))
    return po.gain_histogram(gains, po.optimization_table(gains))


@register("x10_baseline_by_segment", with_ctes("policy_users") + """
SELECT business_label, avg(baseline_clv) AS mean_baseline_clv FROM policy_users GROUP BY business_label""",
          doubles=["mean_baseline_clv"], ids="X10,A5")
def q_x10(spark, d):
    return po.baseline_by_segment(_users(spark, d))


@register("x11_sensitivity", with_ctes("opt") + "SELECT segment, discount, mean_gain FROM opt",
          doubles=["discount", "mean_gain"], ids="X11")
def q_x11(spark, d):
    return po.sensitivity(_opt(spark, d))



@register("x5_published_parameters", with_ctes("published_gains") + """
SELECT segment, discount, avg(gain) AS mean_gain, quantile_cont(gain, 0.5) AS median_gain,
       avg(CAST(gain > 0 AS DOUBLE)) AS prob_positive, quantile_cont(gain, 0.05) AS worst_5pct,
       quantile_cont(gain, 0.95) AS best_95pct
FROM published_gains GROUP BY segment, discount""", doubles=OPT, ids="X5,X6")
def q_x5_published(spark, d):
    params = po.published_parameters(spark)
    return po.optimization_table(po.simulate_gains(_users(spark, d), po.draws_frame(spark), params))
