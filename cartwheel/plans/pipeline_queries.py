"""Registered queries for sources, preprocessing/feature operators and RFM
segmentation (S, F, G, E30), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import features as fe
from cartwheel.operators import rfm as rf
from cartwheel.plans import frames as fr
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import register_cte, with_ctes


def feats_sql(src: str) -> str:
    """F5 in SQL over CTE ``src`` (cutoff = latest event)."""
    return f"""
  SELECT e.visitorid,
    count(*) FILTER (WHERE transactionid IS NULL) + count(DISTINCT transactionid) AS total_events,
    min("timestamp") AS first_event, max("timestamp") AS last_event,
    CAST(floor(date_diff('microsecond', max("timestamp"), max(c)) / 86400000000.0) AS BIGINT) AS recency_days,
    CAST(floor(date_diff('microsecond', min("timestamp"), max("timestamp")) / 86400000000.0) AS BIGINT) + 1 AS tenure_days,
    count(*) FILTER (WHERE event = 'view') AS total_views,
    count(*) FILTER (WHERE event = 'addtocart') AS total_addtocarts,
    count(*) FILTER (WHERE event = 'transaction') AS total_tx,
    count(DISTINCT itemid) AS distinct_items,
    count(DISTINCT itemid) FILTER (WHERE event = 'view') AS view_items,
    count(DISTINCT itemid) FILTER (WHERE event = 'addtocart') AS addtocart_items,
    count(DISTINCT itemid) FILTER (WHERE transactionid IS NOT NULL) AS tx_items,
    count(*) FILTER (WHERE event = 'addtocart') / (count(*) FILTER (WHERE transactionid IS NULL) + count(DISTINCT transactionid) + 1e-9) AS prop_addtocart,
    count(*) FILTER (WHERE event = 'transaction') / (count(*) FILTER (WHERE transactionid IS NULL) + count(DISTINCT transactionid) + 1e-9) AS prop_tx,
    count(*) FILTER (WHERE transactionid IS NULL AND "timestamp" >= c - INTERVAL 7 DAY)
      + count(DISTINCT transactionid) FILTER (WHERE "timestamp" >= c - INTERVAL 7 DAY) AS events_7d,
    count(*) FILTER (WHERE transactionid IS NULL AND "timestamp" >= c - INTERVAL 14 DAY)
      + count(DISTINCT transactionid) FILTER (WHERE "timestamp" >= c - INTERVAL 14 DAY) AS events_14d,
    count(*) FILTER (WHERE transactionid IS NULL AND "timestamp" >= c - INTERVAL 30 DAY)
      + count(DISTINCT transactionid) FILTER (WHERE "timestamp" >= c - INTERVAL 30 DAY) AS events_30d,
    count(DISTINCT CAST("timestamp" AS DATE)) AS active_days,
    (count(*) FILTER (WHERE transactionid IS NULL) + count(DISTINCT transactionid)) / count(DISTINCT CAST("timestamp" AS DATE)) AS events_per_active_day,
    avg(price) FILTER (WHERE event = 'view') AS view_price,
    avg(price) FILTER (WHERE event = 'addtocart') AS addtocart_price,
    avg(price) FILTER (WHERE event = 'transaction') AS tx_price,
    any_value(g.avg_inter_event_days) AS avg_inter_event_days
  FROM (SELECT s.*, (SELECT max("timestamp") FROM {src}) AS c FROM {src} s) e
  LEFT JOIN (
    SELECT visitorid, avg(CASE WHEN us >= 0 THEN floor(us / 1000000.0) ELSE ceil(us / 1000000.0) END) / 86400.0 AS avg_inter_event_days
    FROM (SELECT visitorid, date_diff('microsecond', lag("timestamp") OVER (PARTITION BY visitorid ORDER BY "timestamp", itemid), "timestamp") AS us FROM {src})
    GROUP BY visitorid) g ON e.visitorid = g.visitorid
  WHERE e."timestamp" <= e.c
  GROUP BY e.visitorid"""


RATE_SQL = """
  SELECT *, count(*) OVER (PARTITION BY visitorid, minute) AS events_per_minute FROM (
    SELECT *, date_diff('microsecond', prev_ts, "timestamp") / 1000000.0 AS delta_s,
           coalesce(CAST(date_diff('microsecond', prev_ts, "timestamp") / 1000000.0 <= 1 AS INTEGER), 0) AS very_fast,
           coalesce(CAST(itemid = prev_item AS INTEGER), 0) AS same_item_repeat,
           date_trunc('minute', "timestamp") AS minute
    FROM (SELECT *, lag("timestamp") OVER w AS prev_ts, lag(itemid) OVER w AS prev_item
          FROM ewp WINDOW w AS (PARTITION BY visitorid ORDER BY "timestamp", itemid)))"""

EXTRA_SQL = """
  SELECT f.visitorid, f.total_events, f.first_event, f.last_event, f.recency_days, f.tenure_days,
    f.total_views, f.total_addtocarts, f.total_tx, f.distinct_items, f.view_items, f.addtocart_items, f.tx_items,
    f.prop_addtocart, f.prop_tx, f.events_7d, f.events_14d, f.events_30d, f.active_days, f.events_per_active_day,
    coalesce(f.view_price, 0) AS view_price, coalesce(f.addtocart_price, 0) AS addtocart_price,
    coalesce(f.tx_price, 0) AS tx_price, coalesce(f.avg_inter_event_days, 0) AS avg_inter_event_days,
    coalesce(s.prop_very_fast, 0) AS prop_very_fast, coalesce(s.prop_same_item_repeat, 0) AS prop_same_item_repeat,
    coalesce(m.max_events_per_minute, 0) AS max_events_per_minute,
    coalesce(s.min_ie_s, 0) AS min_ie_s, coalesce(s.median_ie_s, 0) AS median_ie_s, coalesce(s.std_ie_s, 0) AS std_ie_s,
    coalesce(s.prop_price_available, 0) AS prop_price_available
  FROM feats f
  LEFT JOIN (SELECT visitorid, avg(very_fast) AS prop_very_fast, avg(same_item_repeat) AS prop_same_item_repeat,
                    min(delta_s) AS min_ie_s, median(delta_s) AS median_ie_s, stddev_pop(delta_s) AS std_ie_s,
                    avg(CAST(price IS NOT NULL AS DOUBLE)) AS prop_price_available
             FROM rate GROUP BY visitorid) s ON f.visitorid = s.visitorid
  LEFT JOIN (SELECT visitorid, max(n) AS max_events_per_minute
             FROM (SELECT visitorid, minute, count(*) AS n FROM rate GROUP BY ALL) GROUP BY visitorid) m
    ON f.visitorid = m.visitorid"""

RULES_SQL = """
  SELECT *, flag_many_events + flag_many_events_30d + flag_events_per_day_high + flag_high_epm
            + flag_fast_burst + flag_repeat_items + flag_many_distinct_items AS rule_flag_score
  FROM (SELECT *, CAST(total_events >= 48 AS INTEGER) AS flag_many_events,
          CAST(events_30d >= 48 AS INTEGER) AS flag_many_events_30d,
          CAST(events_per_active_day >= 2.0 AS INTEGER) AS flag_events_per_day_high,
          CAST(max_events_per_minute >= 2 AS INTEGER) AS flag_high_epm,
          CAST(prop_very_fast >= 0.5 AS INTEGER) AS flag_fast_burst,
          CAST(prop_same_item_repeat >= 0.5 AS INTEGER) AS flag_repeat_items,
          CAST(distinct_items >= 38 AS INTEGER) AS flag_many_distinct_items
        FROM extra)"""

ROLLUP_SQL = """
  SELECT visitorid, transactionid, coalesce(sum(price), 0.0) AS monetary, max("timestamp") AS "time"
  FROM btx GROUP BY visitorid, transactionid"""

RFM_SQL = """
  SELECT *, frequency / greatest(tenure_days, 1) AS purchase_rate, monetary_sum / greatest(tenure_days, 1) AS monetary_rate
  FROM (SELECT visitorid, count(*) AS frequency, avg(monetary) AS monetary_avg, coalesce(sum(monetary), 0.0) AS monetary_sum,
               max("time") AS last_purchase, min("time") AS first_purchase,
               CAST(floor(date_diff('microsecond', max("time"), max(obs)) / 86400000000.0) AS BIGINT) AS recency_days,
               CAST(floor(date_diff('microsecond', min("time"), max(obs)) / 86400000000.0) AS BIGINT) AS tenure_days
        FROM (SELECT r.*, (SELECT max("time") FROM rollup) - INTERVAL 1 DAY AS obs FROM rollup r)
        GROUP BY visitorid)"""

PROFILE_SQL = """
  SELECT *, CASE WHEN avg_frequency = 1 THEN 'One-time Buyers'
                 WHEN avg_recency < 30 AND avg_frequency > 5 AND avg_monetary > q70 THEN 'Champions'
                 WHEN avg_recency < 60 AND avg_frequency > 4 THEN 'Loyal Customers'
                 WHEN avg_recency > 65 AND avg_frequency <= 2 THEN 'At Risk'
                 ELSE 'Potential Loyalists' END AS business_label
  FROM (SELECT *, total_revenue / sum(total_revenue) OVER () AS revenue_share,
               quantile_cont(avg_monetary, 0.7) OVER () AS q70
        FROM (SELECT segment, count(visitorid) AS customers, avg(recency_days) AS avg_recency,
                     avg(frequency) AS avg_frequency, avg(monetary_avg) AS avg_monetary,
                     avg(purchase_rate) AS avg_purchase_rate, avg(tenure_days) AS avg_tenure,
                     coalesce(sum(monetary_sum), 0.0) AS total_revenue
              FROM rfm_seg GROUP BY segment))"""

register_cte("feats", ["ewp"], feats_sql("ewp"))
register_cte("rate", ["ewp"], RATE_SQL)
register_cte("extra", ["feats", "rate"], EXTRA_SQL)
register_cte("rules", ["extra"], RULES_SQL)
register_cte("rollup", ["btx"], ROLLUP_SQL)
register_cte("rfm", ["rollup"], RFM_SQL)
register_cte("rfm_seg", ["rfm"], "SELECT *, CAST(least(frequency, 4) - 1 AS INTEGER) AS segment FROM rfm")
register_cte("profile", ["rfm_seg"], PROFILE_SQL)
register_cte("rfm_labeled", ["rfm_seg", "profile"],
             "SELECT r.*, p.business_label FROM rfm_seg r LEFT JOIN profile p ON r.segment = p.segment")
register_cte("users_b", ["btx"], feats_sql("btx"))
register_cte("users_pipeline", ["users_b", "rfm_labeled"], """
  SELECT u.*, l.business_label FROM users_b u
  JOIN (SELECT visitorid, business_label FROM rfm_labeled
        WHERE business_label <> 'One-time Buyers' AND frequency > 1) l ON u.visitorid = l.visitorid""")

FEAT_DOUBLES = ["prop_addtocart", "prop_tx", "events_per_active_day", "view_price", "addtocart_price",
                "tx_price", "avg_inter_event_days"]
EXTRA_DOUBLES = FEAT_DOUBLES + ["prop_very_fast", "prop_same_item_repeat", "min_ie_s", "median_ie_s",
                                "std_ie_s", "prop_price_available"]
RFM_DOUBLES = ["monetary_avg", "monetary_sum", "purchase_rate", "monetary_rate"]
PROFILE_DOUBLES = ["avg_recency", "avg_frequency", "avg_monetary", "avg_purchase_rate", "avg_tenure",
                   "total_revenue", "revenue_share"]


# ------------------------------------------------------------------ sources
@register("s1_clickstream_events", with_ctes("ev") + "SELECT * FROM ev", ids="S1")
def q_s1(spark, d):
    return fr.ev(spark, d)


@register("s2_item_property_log", with_ctes("props") + "SELECT * FROM props", ids="S2,S4,U1")
def q_s2(spark, d):
    return fr.props(spark, d)


@register("s_order_transactions", with_ctes("btx") + "SELECT * FROM btx", doubles=["price"], ids="S1(B)")
def q_sb(spark, d):
    return fr.btx(spark, d)


# ------------------------------------------------------------- F operators
@register("f1_numeric_properties", with_ctes("props") + """
SELECT property, count(*) AS n_rows, count(DISTINCT value) AS unique_vals,
       avg(CAST(regexp_full_match(value, 'n\\d+(\\.\\d+)?') AS DOUBLE)) AS share_positive_numeric,
       count(DISTINCT value) / count(*) AS unique_ratio
FROM props WHERE coalesce(starts_with(value, 'n'), false) GROUP BY property""",
          doubles=["share_positive_numeric", "unique_ratio"], ids="F1,P3,P4,A3,A14")
def q_f1(spark, d):
    return fe.detect_numeric_properties(fr.props(spark, d))


@register("f2_item_snapshots", with_ctes("snap") + "SELECT itemid, \"timestamp\", available, categoryid, price FROM snap",
          doubles=["price"], ids="F2,P2,P5,A7,A10")
def q_f2(spark, d):
    return fr.snap(spark, d)


@register("f3_events_with_properties", with_ctes("ewp") + "SELECT * FROM ewp",
          doubles=["price", "mean_price"], ids="F3,J1,J2,P12")
def q_f3(spark, d):
    return fr.ewp(spark, d)


@register("f4_transaction_prices", with_ctes("txp") + "SELECT * FROM txp", doubles=["price"], ids="F4,P1,P10,P13,A6")
def q_f4(spark, d):
    return fr.txp(spark, d)


@register("f5_user_features", with_ctes("feats") + "SELECT * FROM feats", doubles=FEAT_DOUBLES,
          ids="F5,A2,A3,A4,A15,P6,P17,W2")
def q_f5(spark, d):
    return fr.feats(spark, d)


@register("f6_rate_features", with_ctes("rate") + """
SELECT visitorid, "timestamp", itemid, event, prev_ts, delta_s, very_fast, prev_item, same_item_repeat,
       minute, events_per_minute FROM rate""", doubles=["delta_s"], ids="F6,W1,W3,P16,J3,T1")
def q_f6(spark, d):
    return fe.add_rate_features(fr.ev(spark, d)).select(
        "visitorid", "timestamp", "itemid", "event", "prev_ts", "delta_s", "very_fast", "prev_item",
        "same_item_repeat", "minute", "events_per_minute")


@register("f7_extra_user_features", with_ctes("extra") + "SELECT * FROM extra", doubles=EXTRA_DOUBLES,
          ids="F7,J4,P11,P24,A9")
def q_f7(spark, d):
    return fr.extra(spark, d)


@register("f8_rule_flags", with_ctes("rules") + "SELECT * FROM rules", doubles=EXTRA_DOUBLES, ids="F8,P21,P23")
def q_f8(spark, d):
    return fr.rules(spark, d)


@register("f11_rule_flag_distribution", with_ctes("rules") + """
SELECT rule_flag_score, count(*) AS count FROM rules GROUP BY rule_flag_score""", ids="F11,A12")
def q_f11(spark, d):
    return fe.flag_distribution(fr.rules(spark, d), "rule_flag_score")


@register("f11_top_rule_flagged", with_ctes("rules") + """
SELECT visitorid, rule_flag_score, total_events FROM rules
ORDER BY rule_flag_score DESC, total_events DESC, visitorid LIMIT 25""", ids="F11,T3")
def q_f11_top(spark, d):
    return fe.top_by_score(fr.rules(spark, d), "rule_flag_score", 25) \
        .select("visitorid", "rule_flag_score", "total_events")


@register("f13_remove_flagged_visitors", with_ctes("ewp", "rules") + """
SELECT e.* FROM ewp e WHERE e.visitorid NOT IN (SELECT visitorid FROM rules WHERE rule_flag_score >= 3)""",
          doubles=["price", "mean_price"], ids="F13,J7,P8")
def q_f13(spark, d):
    r = fr.rules(spark, d).where(F.col("rule_flag_score") >= 3)
    return fe.remove_visitors(fr.ewp(spark, d), r)


@register("e30_data_span_days", with_ctes("ev") + """
SELECT CAST(date_diff('day', min(CAST("timestamp" AS DATE)), max(CAST("timestamp" AS DATE))) AS BIGINT) AS span_days FROM ev""",
          ids="E30,A20")
def q_e30(spark, d):
    return fe.days_span(fr.ev(spark, d))


# ------------------------------------------------------------- G operators
@register("g1_purchase_rollup", with_ctes("rollup") + "SELECT * FROM rollup", doubles=["monetary"], ids="G1")
def q_g1(spark, d):
    return rf.purchase_rollup(fr.btx(spark, d))


@register("g2_rfm", with_ctes("rfm") + "SELECT * FROM rfm", doubles=RFM_DOUBLES, ids="G2,P17,P19")
def q_g2(spark, d):
    return fr.rfm_b(spark, d)


@register("g3_cluster_features", with_ctes("rfm") + """
SELECT visitorid,
  CASE WHEN coalesce(recency_days, 0) <= -1 THEN 0.0 ELSE ln(1 + coalesce(recency_days, 0)) END AS recency_days_log,
  CASE WHEN coalesce(frequency, 0) <= -1 THEN 0.0 ELSE ln(1 + coalesce(frequency, 0)) END AS frequency_log,
  CASE WHEN coalesce(monetary_avg, 0) <= -1 THEN 0.0 ELSE ln(1 + coalesce(monetary_avg, 0)) END AS monetary_avg_log
FROM rfm WHERE frequency > 1""", doubles=["recency_days_log", "frequency_log", "monetary_avg_log"], ids="G3,P18")
def q_g3(spark, d):
    return rf.cluster_features(fr.rfm_b(spark, d))


@register("g9_segment_profile", with_ctes("profile") + """
SELECT segment, customers, avg_recency, avg_frequency, avg_monetary, avg_purchase_rate, avg_tenure,
       total_revenue, revenue_share, business_label FROM profile""", doubles=PROFILE_DOUBLES, ids="G9,G10,A13,A8", digits={"total_revenue": 2})
def q_g9(spark, d):
    return rf.build_segment_profile(fr.rfm_seg(spark, d), "segment")


@register("g11_radar_table", with_ctes("profile") + """
SELECT segment,
  coalesce((avg_recency - min(avg_recency) OVER ()) / nullif(max(avg_recency) OVER () - min(avg_recency) OVER (), 0), 0.0) AS avg_recency,
  coalesce((avg_frequency - min(avg_frequency) OVER ()) / nullif(max(avg_frequency) OVER () - min(avg_frequency) OVER (), 0), 0.0) AS avg_frequency,
  coalesce((avg_monetary - min(avg_monetary) OVER ()) / nullif(max(avg_monetary) OVER () - min(avg_monetary) OVER (), 0), 0.0) AS avg_monetary,
  coalesce((avg_purchase_rate - min(avg_purchase_rate) OVER ()) / nullif(max(avg_purchase_rate) OVER () - min(avg_purchase_rate) OVER (), 0), 0.0) AS avg_purchase_rate,
  coalesce((avg_tenure - min(avg_tenure) OVER ()) / nullif(max(avg_tenure) OVER () - min(avg_tenure) OVER (), 0), 0.0) AS avg_tenure
FROM profile""", doubles=rf.RADAR_METRICS, ids="G11,P26")
def q_g11(spark, d):
    return rf.radar_table(rf.build_segment_profile(fr.rfm_seg(spark, d), "segment"), "segment")


@register("g12_segment_points", with_ctes("rfm_seg") + """
SELECT visitorid, segment, -recency_days AS neg_recency, frequency, monetary_avg FROM rfm_seg""",
          doubles=["monetary_avg"], ids="G12,P9")
def q_g12(spark, d):
    return rf.segment_points(fr.rfm_seg(spark, d), "segment")


@register("g13_users_pipeline", with_ctes("users_pipeline") + "SELECT * FROM users_pipeline",
          doubles=FEAT_DOUBLES, ids="G13,J5,J8")
def q_g13(spark, d):
    return fr.users_pipeline(spark, d)


@register("g14_label_counts", with_ctes("users_pipeline") + """
SELECT business_label, count(*) AS count FROM users_pipeline GROUP BY business_label""", ids="G14,A12")
def q_g14(spark, d):
    return rf.label_counts(fr.users_pipeline(spark, d))


@register("g7_ari_rule_vs_tenure_segments", with_ctes("rfm_seg") + """
, c AS (SELECT segment AS a, CAST(least(floor(tenure_days / 365), 5) AS INTEGER) AS b, count(*) AS nij FROM rfm_seg GROUP BY ALL)
SELECT CASE WHEN mx = expected THEN 1.0 ELSE (sij - expected) / (mx - expected) END AS ari, CAST(n AS BIGINT) AS n
FROM (SELECT sij, n, sa * sb / (n * (n - 1) / 2.0) AS expected, (sa + sb) / 2.0 AS mx
      FROM (SELECT sum(nij * (nij - 1) / 2.0) AS sij, sum(nij) AS n FROM c),
           (SELECT sum(ai * (ai - 1) / 2.0) AS sa FROM (SELECT a, sum(nij) AS ai FROM c GROUP BY a)),
           (SELECT sum(bj * (bj - 1) / 2.0) AS sb FROM (SELECT b, sum(nij) AS bj FROM c GROUP BY b)))""",
          doubles=["ari"], ids="G7")
def q_g7(spark, d):
    r = fr.rfm_seg(spark, d).withColumn(
        "tenure_bucket", F.least(F.floor(F.col("tenure_days") / 365), F.lit(5)).cast("int"))
    return rf.adjusted_rand_index(r, "segment", "tenure_bucket")
