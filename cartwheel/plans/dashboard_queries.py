"""Registered dashboard queries (D1-D10). The oracle uses the row-level
formulation (exclusive running counts per event row), which independently
checks the visitor-day algebra of the Spark plan."""

from __future__ import annotations

from cartwheel.operators import dashboard as db
from cartwheel.plans import frames as fr
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import register_cte, with_ctes

register_cte("dash_v1", ["ewp"], """
  SELECT a.visitorid, a."day", a."month", a.number_of_view, a.number_of_addtocart,
         coalesce(t.number_of_purchase, 0) AS number_of_purchase, a.number_of_activity,
         CAST(ft IS NULL OR a."day" < ft AS INTEGER) AS new_user_transaction,
         CAST((fa IS NULL OR a."day" < fa) AND (ft IS NULL OR a."day" < ft) AS INTEGER) AS new_user_addtocart,
         CAST((fv IS NULL OR a."day" < fv) AND (fa IS NULL OR a."day" < fa) AND (ft IS NULL OR a."day" < ft) AS INTEGER) AS new_user_view,
         coalesce(t.revenue, 0.0) AS revenue
  FROM (SELECT visitorid, CAST("timestamp" AS DATE) AS "day", strftime("timestamp", '%Y-%m') AS "month",
               count(event) AS number_of_activity, count(*) FILTER (WHERE event = 'view') AS number_of_view,
               count(*) FILTER (WHERE event = 'addtocart') AS number_of_addtocart
        FROM ewp GROUP BY 1, 2, 3) a
  LEFT JOIN (SELECT visitorid, CAST("timestamp" AS DATE) AS "day", count(DISTINCT transactionid) AS number_of_purchase,
                    coalesce(sum(price), 0.0) AS revenue
             FROM ewp WHERE event = 'transaction' GROUP BY 1, 2) t ON a.visitorid = t.visitorid AND a."day" = t."day"
  LEFT JOIN (SELECT visitorid, min(CAST("timestamp" AS DATE)) FILTER (WHERE event = 'transaction') AS ft,
                    min(CAST("timestamp" AS DATE)) FILTER (WHERE event = 'addtocart') AS fa,
                    min(CAST("timestamp" AS DATE)) FILTER (WHERE event = 'view') AS fv
             FROM ewp GROUP BY visitorid) f ON a.visitorid = f.visitorid""")

register_cte("dash_rows", ["ewp"], """
  SELECT *, CAST("timestamp" AS DATE) AS "day", strftime("timestamp", '%Y-%m') AS "month",
         coalesce(sum(CAST(event = 'view' AS INTEGER)) OVER w, 0) AS had_view_before,
         coalesce(sum(CAST(event = 'addtocart' AS INTEGER)) OVER w, 0) AS had_add_before,
         coalesce(sum(CAST(event = 'transaction' AS INTEGER)) OVER w, 0) AS had_tx_before
  FROM ewp
  WINDOW w AS (PARTITION BY visitorid ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")

register_cte("dash_v2", ["dash_rows"], """
  SELECT visitorid, "day", "month",
         count(*) FILTER (WHERE event = 'view') AS number_of_view,
         count(*) FILTER (WHERE event = 'addtocart') AS number_of_addtocart,
         count(*) FILTER (WHERE event = 'transaction') AS number_of_purchase,
         count(event) AS number_of_activity, coalesce(sum(price), 0.0) AS revenue,
         coalesce(sum(price) FILTER (WHERE event = 'transaction'), 0.0) AS tx_revenue,
         CAST(max(had_view_before) AS BIGINT) AS had_view_before, CAST(max(had_add_before) AS BIGINT) AS had_add_before,
         CAST(max(had_tx_before) AS BIGINT) AS had_tx_before,
         CAST(max(had_tx_before) = 0 AS INTEGER) AS new_user_transaction_day,
         CAST(max(had_add_before) = 0 AND max(had_tx_before) = 0 AS INTEGER) AS new_user_addtocart_day,
         CAST(max(had_view_before) = 0 AND max(had_add_before) = 0 AND max(had_tx_before) = 0 AS INTEGER) AS new_user_view_day
  FROM dash_rows GROUP BY 1, 2, 3""")

register_cte("dash", ["dash_v2"], """
  SELECT *, CASE WHEN revenue_tier = 'High' AND cum_purchases >= 2 THEN 'Loyal'
                 WHEN cum_purchases >= 2 OR cum_addtocart >= 3 OR cum_activity >= 5 THEN 'Potential Loyal'
                 ELSE 'At Risk' END AS business_label
  FROM (SELECT *, CASE WHEN rn <= 1.0 + (n - 1) * 0.5 THEN 'Low' WHEN rn <= 1.0 + (n - 1) * 0.7 THEN 'Mid' ELSE 'High' END AS revenue_tier
        FROM (SELECT *, row_number() OVER (PARTITION BY "day" ORDER BY cum_revenue, visitorid) AS rn,
                     count(*) OVER (PARTITION BY "day") AS n
              FROM (SELECT *, CAST(row_number() OVER (PARTITION BY visitorid, "month" ORDER BY "day") = 1 AS INTEGER) AS new_user_view_month,
                           CAST(row_number() OVER (PARTITION BY visitorid, "month" ORDER BY "day") = 1
                                AND (number_of_addtocart > 0 OR number_of_purchase > 0) AS INTEGER) AS new_user_addtocart_month,
                           CAST(row_number() OVER (PARTITION BY visitorid, "month" ORDER BY "day") = 1
                                AND number_of_purchase > 0 AS INTEGER) AS new_user_transaction_month,
                           sum(revenue) OVER c AS cum_revenue, CAST(sum(number_of_purchase) OVER c AS BIGINT) AS cum_purchases,
                           CAST(sum(number_of_addtocart) OVER c AS BIGINT) AS cum_addtocart,
                           CAST(sum(number_of_activity) OVER c AS BIGINT) AS cum_activity
                    FROM dash_v2
                    WINDOW c AS (PARTITION BY visitorid ORDER BY "day" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))""")

FINAL = ", ".join(f'"{c}"' for c in db.FINAL_COLUMNS)


@register("d1_visitor_day_v1", with_ctes("dash_v1") + "SELECT * FROM dash_v1", doubles=["revenue"],
          ids="D1,D2,A2,J9,P11,J8")
def q_d1(spark, d):
    return db.visitor_day_v1(fr.ewp(spark, d))


@register("d4_visitor_day_v2", with_ctes("dash_v2") + "SELECT * FROM dash_v2",
          doubles=["revenue", "tx_revenue"], ids="D3,D4,D5,W5")
def q_d4(spark, d):
    return db.visitor_day_v2(fr.ewp(spark, d))


@register("d7_dashboard", with_ctes("dash") + f"SELECT {FINAL} FROM dash", doubles=["revenue", "cum_revenue"],
          ids="D6,D7,D8,D9,W4,W6,W7,P22")
def q_d7(spark, d):
    return db.dashboard_table(fr.ewp(spark, d))


@register("d8_revenue_tiers", with_ctes("dash") + """
SELECT "day", revenue_tier, count(*) AS count FROM dash GROUP BY 1, 2""", ids="D8,W7")
def q_d8(spark, d):
    from pyspark.sql import functions as F
    t = db.dashboard_table(fr.ewp(spark, d), keep_tier=True)
    return t.groupBy("day", "revenue_tier").agg(F.count(F.lit(1)).alias("count"))


@register("d10_dashboard_checks", with_ctes("dash") + """
SELECT 'business_label' AS "check", business_label AS value, count(*) AS count FROM dash GROUP BY 2
UNION ALL SELECT 'new_user_transaction_day', CAST(new_user_transaction_day AS VARCHAR), count(*) FROM dash GROUP BY 2
UNION ALL SELECT 'number_of_purchase_sum', 'total', CAST(coalesce(sum(number_of_purchase), 0) AS BIGINT) FROM dash
UNION ALL SELECT 'number_of_addtocart', CAST(number_of_addtocart AS VARCHAR), count(*) FROM dash GROUP BY 2""",
          ids="D10,A12")
def q_d10(spark, d):
    return db.dashboard_checks(db.dashboard_table(fr.ewp(spark, d)))
