"""Registered EDA queries (E1-E29) over the enriched clickstream."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import eda
from cartwheel.plans import frames as fr
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import hist_sql, money_sql, register_cte, with_ctes

register_cte("bask", ["ewp"], """
  SELECT transactionid, arg_min(visitorid, "timestamp") AS visitorid, min("timestamp") AS "timestamp",
         count(DISTINCT itemid) AS total_items, count(itemid) AS total_rows,
         coalesce(sum(price), 0.0) AS total_price, avg(price) AS avg_price, min(price) AS min_price,
         max(price) AS max_price, CAST(min("timestamp") AS DATE) AS "date",
         CAST(hour(min("timestamp")) AS INTEGER) AS "hour", dayname(min("timestamp")) AS dayofweek
  FROM ewp WHERE event = 'transaction' GROUP BY transactionid""")
register_cte("etx", ["ewp"], "SELECT * FROM ewp WHERE event = 'transaction'")
register_cte("buyers", ["bask"], """
  SELECT visitorid, count(total_price) AS num_tx, coalesce(sum(total_price), 0.0) AS total_spend,
         avg(total_price) AS avg_tx_value FROM bask GROUP BY visitorid""")
register_cte("daily", ["bask"], """
  SELECT "date", count(transactionid) AS tx_count, avg(total_price) AS avg_tx_value,
         median(total_price) AS median_tx_value FROM bask GROUP BY "date\"""")

HIST = ["bin_lo", "bin_hi"]
BASKET_DOUBLES = ["total_price", "avg_price", "min_price", "max_price"]


def _b(spark, d):
    return eda.baskets(fr.ewp(spark, d))


def _tx(spark, d):
    return fr.ewp(spark, d).where(F.col("event") == "transaction")


@register("e1_event_counts", with_ctes("ewp") + """
SELECT event, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM ewp GROUP BY event""",
          doubles=["share"], ids="E1,A12,A13")
def q_e1(spark, d):
    return eda.event_counts(fr.ev(spark, d))


@register("e2_daily_events", with_ctes("ewp") + """
SELECT CAST("timestamp" AS DATE) AS "date", count(*) AS count FROM ewp GROUP BY 1""", ids="E2,A1,P15")
def q_e2(spark, d):
    return eda.counts_by(fr.ev(spark, d), F.to_date("timestamp"), "date")


@register("e3_hourly_events", with_ctes("ewp") + """
SELECT CAST(hour("timestamp") AS INTEGER) AS "hour", count(*) AS count FROM ewp GROUP BY 1""", ids="E3,A1,P15")
def q_e3(spark, d):
    return eda.counts_by(fr.ev(spark, d), F.hour("timestamp"), "hour")


@register("e4_events_per_visitor", with_ctes("ewp") + """
SELECT visitorid, count(*) AS count FROM ewp WHERE visitorid IS NOT NULL GROUP BY visitorid""", ids="E4,A1")
def q_e4(spark, d):
    return eda.size_per(fr.ev(spark, d), "visitorid")


@register("e4_events_per_visitor_hist", with_ctes("ewp") + ", s AS (SELECT visitorid, count(*) AS n FROM ewp GROUP BY 1)"
          + hist_sql("s", "n", 50), doubles=HIST, ids="E4,A17")
def q_e4h(spark, d):
    return eda.hist(eda.size_per(fr.ev(spark, d), "visitorid"), "count", 50)


@register("e5_top_visitors", with_ctes("ewp") + """
SELECT visitorid, count(*) AS count FROM ewp GROUP BY visitorid ORDER BY count DESC, visitorid LIMIT 20""",
          ids="E5,T2")
def q_e5(spark, d):
    return eda.top_by_count(eda.size_per(fr.ev(spark, d), "visitorid"), "visitorid", 20)


@register("e6_events_per_item_hist", with_ctes("ewp") + ", s AS (SELECT itemid, count(*) AS n FROM ewp WHERE itemid IS NOT NULL GROUP BY 1)"
          + hist_sql("s", "n", 50), doubles=HIST, ids="E6,A1,A17")
def q_e6h(spark, d):
    return eda.hist(eda.size_per(fr.ev(spark, d), "itemid"), "count", 50)


@register("e6_top_items", with_ctes("ewp") + """
SELECT itemid, count(*) AS count FROM ewp WHERE itemid IS NOT NULL GROUP BY itemid ORDER BY count DESC, itemid LIMIT 20""",
          ids="E6,T2")
def q_e6(spark, d):
    return eda.top_by_count(eda.size_per(fr.ev(spark, d), "itemid"), "itemid", 20)


@register("e7_funnel", with_ctes("ewp") + """
SELECT "view", addtocart, "transaction",
       CASE WHEN "view" = 0 THEN NULL ELSE addtocart / "view" END AS addtocart_rate,
       CASE WHEN "view" = 0 THEN NULL ELSE "transaction" / "view" END AS purchase_rate,
       CASE WHEN "view" > 0 THEN addtocart / "view" * 100 ELSE 0.0 END AS addtocart_pct_of_views,
       CASE WHEN "view" > 0 THEN "transaction" / "view" * 100 ELSE 0.0 END AS transaction_pct_of_views
FROM (SELECT count(*) FILTER (WHERE event = 'view') AS "view", count(*) FILTER (WHERE event = 'addtocart') AS addtocart,
             count(*) FILTER (WHERE event = 'transaction') AS "transaction" FROM ewp)""",
          doubles=["addtocart_rate", "purchase_rate", "addtocart_pct_of_views", "transaction_pct_of_views"],
          ids="E7,E22,P29")
def q_e7(spark, d):
    return eda.funnel(fr.ev(spark, d))


@register("e8_baskets", with_ctes("bask") + "SELECT * FROM bask", doubles=BASKET_DOUBLES, ids="E8,A3,A5,A7,P15")
def q_e8(spark, d):
    return _b(spark, d)


@register("e9_basket_size_hist", with_ctes("bask") + hist_sql("bask", "total_items", 20), doubles=HIST,
          ids="E9,A17")
def q_e9(spark, d):
    return eda.hist(_b(spark, d), "total_items", 20)


@register("e10_basket_value_hist", with_ctes("bask") + hist_sql("bask", "total_price", 40), doubles=HIST,
          ids="E10,A17")
def q_e10(spark, d):
    return eda.hist(_b(spark, d), "total_price", 40)


@register("e11_basket_value_box", with_ctes("bask") + """
, t AS (SELECT total_price AS x FROM bask WHERE total_price <= 2e5)
, q AS (SELECT count(x) AS n, min(x) AS "min", max(x) AS "max", quantile_cont(x, 0.25) AS q1,
               quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM t)
SELECT n, "min", "max", q1, median, q3, q3 - q1 AS iqr,
       (SELECT min(x) FROM t WHERE x >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
       (SELECT max(x) FROM t WHERE x <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
       (SELECT count(*) FROM t WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM q""", doubles=["min", "max", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"], ids="E11,A19")
def q_e11(spark, d):
    return eda.value_box(_b(spark, d))


@register("e12_daily_baskets", with_ctes("bask") + """
SELECT "date", count(*) AS count FROM bask GROUP BY "date\"""", ids="E12,A1")
def q_e12(spark, d):
    return eda.counts_by(_b(spark, d), "date", "date")


@register("e13_hourly_baskets", with_ctes("bask") + """
SELECT "hour", count(*) AS count FROM bask GROUP BY "hour\"""", ids="E13,A12")
def q_e13(spark, d):
    return eda.counts_by(_b(spark, d), "hour", "hour")


@register("e14_baskets_per_buyer", with_ctes("bask") + """
SELECT visitorid, count(*) AS count FROM bask WHERE visitorid IS NOT NULL GROUP BY visitorid""", ids="E14,A12")
def q_e14(spark, d):
    return eda.size_per(_b(spark, d), "visitorid")


@register("e14_baskets_per_buyer_hist", with_ctes("bask") + ", s AS (SELECT visitorid, count(*) AS n FROM bask GROUP BY 1)"
          + hist_sql("s", "n", 50), doubles=HIST, ids="E14,A17")
def q_e14h(spark, d):
    return eda.hist(eda.size_per(_b(spark, d), "visitorid"), "count", 50)


@register("e15_mean_value_per_buyer", with_ctes("buyers") + "SELECT visitorid, avg_tx_value FROM buyers",
          doubles=["avg_tx_value"], ids="E15,A5")
def q_e15(spark, d):
    return eda.buyer_stats(_b(spark, d)).select("visitorid", "avg_tx_value")


@register("e15_mean_value_per_buyer_hist", with_ctes("buyers") + hist_sql("buyers", "avg_tx_value", 40),
          doubles=HIST, ids="E15,A17")
def q_e15h(spark, d):
    return eda.hist(eda.buyer_stats(_b(spark, d)), "avg_tx_value", 40)


@register("e16_top_purchased_items", with_ctes("etx") + """
SELECT itemid, count(*) AS count FROM etx WHERE itemid IS NOT NULL GROUP BY itemid ORDER BY count DESC, itemid LIMIT 20""",
          ids="E16,T2")
def q_e16(spark, d):
    return eda.top_by_count(eda.size_per(_tx(spark, d), "itemid"), "itemid", 20)


@register("e17_top_purchased_categories", with_ctes("etx") + """
SELECT categoryid, count(*) AS count FROM etx WHERE categoryid IS NOT NULL GROUP BY categoryid
ORDER BY count DESC, categoryid LIMIT 20""", ids="E17,T2")
def q_e17(spark, d):
    return eda.top_by_count(eda.size_per(_tx(spark, d), "categoryid"), "categoryid", 20)


@register("e18_size_value_points", with_ctes("bask") + "SELECT transactionid, total_items, total_price FROM bask",
          doubles=["total_price"], ids="E18,P9")
def q_e18(spark, d):
    return _b(spark, d).select("transactionid", "total_items", "total_price")


@register("e19_daily_tx", with_ctes("daily") + "SELECT * FROM daily",
          doubles=["avg_tx_value", "median_tx_value"], ids="E19,A5,A8")
def q_e19(spark, d):
    return eda.daily_tx(_b(spark, d))


@register("e20_rolling_daily_tx", with_ctes("daily") + """
SELECT *, avg(tx_count) OVER (ORDER BY "date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7,
       CAST("date" = (SELECT "date" FROM daily ORDER BY tx_count DESC, "date" LIMIT 1) AS INTEGER) AS is_peak
FROM daily""", doubles=["avg_tx_value", "median_tx_value", "rolling_7"], ids="E20,W8,A20")
def q_e20(spark, d):
    return eda.rolling_daily(eda.daily_tx(_b(spark, d)))


@register("e21_daily_event_pivot", with_ctes("bask", "ewp") + """
SELECT d."date", coalesce(p."view", 0) AS "view", coalesce(p.addtocart, 0) AS addtocart,
       coalesce(p."transaction", 0) AS "transaction"
FROM (SELECT DISTINCT "date" FROM bask) d
LEFT JOIN (SELECT CAST("timestamp" AS DATE) AS "date", count(*) FILTER (WHERE event = 'view') AS "view",
                  count(*) FILTER (WHERE event = 'addtocart') AS addtocart,
                  count(*) FILTER (WHERE event = 'transaction') AS "transaction" FROM ewp GROUP BY 1) p
  ON d."date" = p."date\"""", ids="E21,A11,P29")
def q_e21(spark, d):
    e = fr.ev(spark, d)
    return eda.daily_event_pivot(e, eda.baskets(e.withColumn("price", F.lit(None).cast("double"))))


@register("e23_basket_size_buckets", with_ctes("bask") + """
SELECT CASE WHEN total_items <= 5 THEN CAST(total_items AS VARCHAR) WHEN total_items <= 10 THEN '6-10'
            WHEN total_items <= 15 THEN '11-15' WHEN total_items <= 20 THEN '16-20' ELSE '20+' END AS bucket,
       count(*) AS count FROM bask WHERE total_items >= 0 GROUP BY 1""", ids="E23,A18")
def q_e23(spark, d):
    return eda.basket_size_buckets(_b(spark, d))


@register("e23_small_basket_hist", with_ctes("bask") + """
SELECT g.bin, CAST(g.bin AS DOUBLE) AS bin_lo, CAST(g.bin + 1 AS DOUBLE) AS bin_hi, coalesce(c.cnt, 0) AS count
FROM (SELECT range AS bin FROM range(6)) g
LEFT JOIN (SELECT least(CAST(floor((total_items - 0.0) / (6.0 - 0.0) * 6) AS BIGINT), 5) AS bin, count(*) AS cnt
           FROM bask WHERE total_items <= 5 AND total_items >= 0 GROUP BY 1) c ON g.bin = c.bin""",
          doubles=HIST, ids="E23,A17")
def q_e23h(spark, d):
    from cartwheel.operators.relational import histogram
    b = _b(spark, d).where(F.col("total_items") <= 5)
    return histogram(b, "total_items", 6, lo=0.0, hi=6.0)


@register("e24_trimmed_value_percentiles", with_ctes("bask") + """
, p AS (SELECT quantile_cont(total_price, 0.99) AS p99 FROM bask)
, t AS (SELECT total_price FROM bask, p WHERE total_price <= p99)
, q AS (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE]) AS pct,
               unnest(quantile_cont(total_price, [0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE])) AS value
        FROM t)
SELECT pct, value, """ + money_sql("value") + " AS label FROM q", doubles=["pct", "value"], ids="E24,A8,A19,P25")
def q_e24(spark, d):
    return eda.trimmed_value_percentiles(_b(spark, d))


@register("e25_median_value_by_size", with_ctes("bask") + """
SELECT total_items, median(total_price) AS median_value FROM bask GROUP BY total_items""",
          doubles=["median_value"], ids="E25,A8")
def q_e25(spark, d):
    return eda.median_by_size(_b(spark, d))


@register("e26_item_coverage", with_ctes("etx") + """
, c AS (SELECT itemid, count(*) AS count FROM etx WHERE itemid IS NOT NULL GROUP BY itemid)
SELECT CAST(n AS BIGINT) AS n, cum / total AS coverage FROM (
  SELECT row_number() OVER (ORDER BY count DESC, itemid) AS n,
         sum(count) OVER (ORDER BY count DESC, itemid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM c),
  (SELECT sum(count) AS total FROM c)""", doubles=["coverage"], ids="E26,W9")
def q_e26(spark, d):
    return eda.item_coverage(_tx(spark, d))


@register("e27_buyer_stats", with_ctes("buyers") + "SELECT * FROM buyers",
          doubles=["total_spend", "avg_tx_value"], ids="E27,A5")
def q_e27(spark, d):
    return eda.buyer_stats(_b(spark, d))


@register("e27_top_buyers", with_ctes("buyers") + """
SELECT * FROM buyers ORDER BY total_spend DESC, visitorid LIMIT 10""",
          doubles=["total_spend", "avg_tx_value"], ids="E27,T2")
def q_e27t(spark, d):
    from cartwheel.operators.relational import top_n
    return top_n(eda.buyer_stats(_b(spark, d)), [F.desc("total_spend"), F.asc("visitorid")], 10)


@register("e27_buyer_medians", with_ctes("buyers") + """
SELECT median(num_tx) AS median_num_tx, median(total_spend) AS median_total_spend FROM buyers""",
          doubles=["median_num_tx", "median_total_spend"], ids="E27,A8")
def q_e27m(spark, d):
    return eda.buyer_medians(eda.buyer_stats(_b(spark, d)))


@register("e28_log_spend_hist", with_ctes("buyers") + hist_sql("buyers", "total_spend", 50, log=True),
          doubles=HIST, ids="E28,P18,A17")
def q_e28(spark, d):
    return eda.hist(eda.buyer_stats(_b(spark, d)), "total_spend", 50, log=True)


@register("e29_top15_items", with_ctes("etx") + """
SELECT itemid, count(*) AS count FROM etx WHERE itemid IS NOT NULL GROUP BY itemid ORDER BY count DESC, itemid LIMIT 15""",
          ids="E29,T2")
def q_e29i(spark, d):
    return eda.top_by_count(eda.size_per(_tx(spark, d), "itemid"), "itemid", 15)


@register("e29_top12_categories", with_ctes("etx") + """
SELECT categoryid, count(*) AS count FROM etx WHERE categoryid IS NOT NULL GROUP BY categoryid
ORDER BY count DESC, categoryid LIMIT 12""", ids="E29,T2")
def q_e29c(spark, d):
    return eda.top_by_count(eda.size_per(_tx(spark, d), "categoryid"), "categoryid", 12)
