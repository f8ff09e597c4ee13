"""RFM roll-up, cluster features, segment profile and business labels
(G1-G3, G7 ARI, G9-G14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.semantics import add_days, clip_lower, floor_days, log1p0
from cartwheel.operators.relational import minmax_scale, quantile

# Business-label names and their rule constants.
ONE_TIME, CHAMPIONS, LOYAL, AT_RISK, POTENTIAL = (
    "One-time Buyers", "Champions", "Loyal Customers", "At Risk", "Potential Loyalists")
RADAR_METRICS = ["avg_recency", "avg_frequency", "avg_monetary", "avg_purchase_rate", "avg_tenure"]


def purchase_rollup(tx: DataFrame) -> DataFrame:
    """G1: (visitorid, transactionid) -> monetary = sum(price), time = max(ts).
    NULL transaction ids form their own group (``dropna=False``)."""
    return tx.groupBy("visitorid", "transactionid").agg(
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("monetary"), F.max("timestamp").alias("time"))


def observation_date(frame: DataFrame, ts: str = "timestamp", days_before: int = 1) -> DataFrame:
    """One-row frame: max(ts) - ``days_before`` days."""
    return frame.agg(F.max(ts).alias("_m")).select(add_days(F.col("_m"), -days_before).alias("obs_date"))


def build_rfm(tx_money: DataFrame, obs: DataFrame | None = None) -> DataFrame:
    """Per-visitor RFM. ``obs`` is a one-row frame with ``obs_date``
    (default: latest purchase time minus one day)."""
    obs = obs if obs is not None else observation_date(tx_money, "time")
    has_tx = "transactionid" in tx_money.columns
    freq = F.count(F.lit(1)) if has_tx else F.count_if(F.col("monetary") > 0)
    r = tx_money.groupBy("visitorid").agg(
        freq.alias("frequency"), F.avg("monetary").alias("monetary_avg"),
        F.coalesce(F.sum("monetary"), F.lit(0.0)).alias("monetary_sum"),
        F.max("time").alias("last_purchase"), F.min("time").alias("first_purchase"))
    r = r.crossJoin(F.broadcast(obs))
    r = r.withColumn("recency_days", floor_days("last_purchase", "obs_date")) \
        .withColumn("tenure_days", floor_days("first_purchase", "obs_date")) \
        .withColumn("purchase_rate", F.col("frequency") / clip_lower("tenure_days", 1)) \
        .withColumn("monetary_rate", F.col("monetary_sum") / clip_lower("tenure_days", 1))
    return r.drop("obs_date")


def cluster_features(rfm: DataFrame) -> DataFrame:
    """Repeat buyers with log1p(recency, frequency, monetary_avg); -inf/NaN -> 0."""
    return rfm.where(F.col("frequency") > 1).select(
        "visitorid",
        log1p0(F.coalesce(F.col("recency_days").cast("double"), F.lit(0.0))).alias("recency_days_log"),
        log1p0(F.coalesce(F.col("frequency").cast("double"), F.lit(0.0))).alias("frequency_log"),
        log1p0(F.coalesce(F.col("monetary_avg"), F.lit(0.0))).alias("monetary_avg_log"))


def rule_segment(rfm: DataFrame, name: str = "segment") -> DataFrame:
    """Deterministic stand-in for model labels: least(frequency, 4) - 1."""
    return rfm.withColumn(name, (F.least(F.col("frequency"), F.lit(4)) - 1).cast("int"))


def build_segment_profile(df: DataFrame, segment_col: str, customer_col: str = "visitorid",
                          recency_col: str = "recency_days", frequency_col: str = "frequency",
                          monetary_avg_col: str = "monetary_avg", monetary_sum_col: str = "monetary_sum",
                          purchase_rate_col: str = "purchase_rate", tenure_col: str = "tenure_days") -> DataFrame:
    """G9 + G10: segment profile with revenue share and business label.
    The profile has one row per segment, so its windows are tiny."""
    p = df.groupBy(segment_col).agg(
        F.count(customer_col).alias("customers"),
        F.avg(recency_col).alias("avg_recency"), F.avg(frequency_col).alias("avg_frequency"),
        F.avg(monetary_avg_col).alias("avg_monetary"), F.avg(purchase_rate_col).alias("avg_purchase_rate"),
        F.avg(tenure_col).alias("avg_tenure"),
        F.coalesce(F.sum(monetary_sum_col), F.lit(0.0)).alias("total_revenue"))
    whole = Window.partitionBy()
    p = p.withColumn("revenue_share", F.col("total_revenue") / F.sum("total_revenue").over(whole))
    q70 = p.agg(quantile("avg_monetary", 0.7).alias("_q70"))
    p = p.crossJoin(F.broadcast(q70))
    label = F.when(F.col("avg_frequency") == 1, ONE_TIME) \
        .when((F.col("avg_recency") < 30) & (F.col("avg_frequency") > 5) & (F.col("avg_monetary") > F.col("_q70")),
              CHAMPIONS) \
        .when((F.col("avg_recency") < 60) & (F.col("avg_frequency") > 4), LOYAL) \
        .when((F.col("avg_recency") > 65) & (F.col("avg_frequency") <= 2), AT_RISK) \
        .otherwise(POTENTIAL)
    return p.withColumn("business_label", label).drop("_q70")


def radar_table(profile: DataFrame, segment_col: str, metrics: list[str] | None = None) -> DataFrame:
    """Per-metric min-max normalisation across segments."""
    m = metrics or RADAR_METRICS
    out = minmax_scale(profile.select(segment_col, *m), m, suffix="_norm")
    return out.select(segment_col, *[F.col(c + "_norm").alias(c) for c in m])


def segment_points(df: DataFrame, segment_col: str) -> DataFrame:
    """Scatter point sets (recency inverted, frequency, monetary)."""
    return df.select("visitorid", segment_col, (-F.col("recency_days")).alias("neg_recency"),
                     "frequency", "monetary_avg")


def eligible_users(rfm_labeled: DataFrame, user_feats: DataFrame) -> DataFrame:
    """Users with a non one-time label and frequency > 1, inner-joined to features."""
    el = rfm_labeled.where((F.col("business_label") != ONE_TIME) & (F.col("frequency") > 1)) \
        .select("visitorid", "business_label")
    return user_feats.join(el, "visitorid", "inner")


def label_rfm(rfm_seg: DataFrame, profile: DataFrame, segment_col: str) -> DataFrame:
    """Segment -> business_label lookup (profile has one row per segment)."""
    return rfm_seg.join(F.broadcast(profile.select(segment_col, "business_label")), segment_col, "left")


def label_counts(df: DataFrame, c: str = "business_label") -> DataFrame:
    """G14."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("count"))


def adjusted_rand_index(labels: DataFrame, a: str, b: str) -> DataFrame:
    """G7 metric: ARI from the contingency table (groupBy(a, b)) with C(n, 2)
    sums; everything after the first aggregation is on small tables."""
    cont = labels.groupBy(a, b).agg(F.count(F.lit(1)).alias("nij"))

    def c2(x):
        return x * (x - 1) / 2.0
    s_ij = cont.agg(F.sum(c2(F.col("nij"))).alias("sij"), F.sum("nij").alias("n"))
    s_a = cont.groupBy(a).agg(F.sum("nij").alias("ai")).agg(F.sum(c2(F.col("ai"))).alias("sa"))
    s_b = cont.groupBy(b).agg(F.sum("nij").alias("bj")).agg(F.sum(c2(F.col("bj"))).alias("sb"))
    t = s_ij.crossJoin(s_a).crossJoin(s_b)
    expected = F.col("sa") * F.col("sb") / c2(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2.0
    ari = F.when(mx == expected, F.lit(1.0)).otherwise((F.col("sij") - expected) / (mx - expected))
    return t.select(ari.alias("ari"), F.col("n").cast("long").alias("n"))


def bootstrap_sample(df: DataFrame, seed: int = 42) -> DataFrame:
    """G7 resample with replacement, distributed: Poisson(1) copies per row
    (``sample(withReplacement=True, fraction=1.0)``), the standard bootstrap
    for partitioned data - no global row numbering, no driver-side index."""
    return df.sample(withReplacement=True, fraction=1.0, seed=seed)
