"""Exploratory queries over enriched events.

Global orderings only run on aggregated tables whose size is bounded by a
parameter (top-n) or by the calendar (days, hours)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.semantics import log1p0
from cartwheel.operators.relational import (
    boxplot_stats, exact_quantiles, exact_rank, histogram, running_sums, top_n,
)

FUNNEL = ["view", "addtocart", "transaction"]


def with_date_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Date, hour, day name, month, calendar period."""
    return df.withColumn("date", F.to_date(ts)).withColumn("hour", F.hour(ts)) \
        .withColumn("dayofweek", F.date_format(ts, "EEEE")).withColumn("month", F.month(ts)) \
        .withColumn("period", F.date_format(ts, "yyyy-MM"))


def event_counts(ev: DataFrame) -> DataFrame:
    """Counts and share per event type."""
    c = ev.groupBy("event").agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))


def counts_by(ev: DataFrame, key: Column | str, name: str) -> DataFrame:
    """Group size per derived key."""
    k = F.col(key) if isinstance(key, str) else key
    return ev.groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def size_per(ev: DataFrame, key: str) -> DataFrame:
    """Rows per key."""
    return ev.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def top_by_count(counts: DataFrame, key: str, n: int) -> DataFrame:
    """Top-n by count with the key as tie-break."""
    return top_n(counts, [F.desc("count"), F.asc(key)], n)


def funnel(ev: DataFrame) -> DataFrame:
    """View / addtocart / transaction counts, rates over views."""
    c = ev.agg(*[F.count_if(F.col("event") == e).alias(e) for e in FUNNEL])
    return c.select(*FUNNEL,
                    F.try_divide(F.col("addtocart"), F.col("view")).alias("addtocart_rate"),
                    F.try_divide(F.col("transaction"), F.col("view")).alias("purchase_rate"),
                    F.when(F.col("view") > 0, F.col("addtocart") / F.col("view") * 100).otherwise(0.0)
                    .alias("addtocart_pct_of_views"),
                    F.when(F.col("view") > 0, F.col("transaction") / F.col("view") * 100).otherwise(0.0)
                    .alias("transaction_pct_of_views"))


def baskets(ev: DataFrame) -> DataFrame:
    """One row per transaction id with size / value statistics."""
    tx = ev.where(F.col("event") == "transaction")
    b = tx.groupBy("transactionid").agg(
        F.min_by("visitorid", "timestamp").alias("visitorid"), F.min("timestamp").alias("timestamp"),
        F.count_distinct("itemid").alias("total_items"), F.count("itemid").alias("total_rows"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("total_price"), F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"))
    return b.withColumn("date", F.to_date("timestamp")).withColumn("hour", F.hour("timestamp")) \
        .withColumn("dayofweek", F.date_format("timestamp", "EEEE"))


def hist(df: DataFrame, c: str, bins: int, log: bool = False) -> DataFrame:
    """Histogram with an optional log1p after a > 0 filter."""
    s = df.select(F.col(c).cast("double").alias("v")).where(F.col("v").isNotNull())
    if log:
        s = s.where(F.col("v") > 0).select(log1p0("v").alias("v"))
    return histogram(s, "v", bins)


def value_box(b: DataFrame, cap: float = 2e5) -> DataFrame:
    """Boxplot statistics of basket values <= cap."""
    return boxplot_stats(b.where(F.col("total_price") <= cap), "total_price")


def daily_tx(b: DataFrame) -> DataFrame:
    """Per day count, mean and median basket value (exact median without
    a per-day buffer)."""
    g = b.groupBy("date").agg(F.count("transactionid").alias("tx_count"), F.avg("total_price").alias("avg_tx_value"))
    med = exact_quantiles(b, ["date"], "total_price", [0.5]).withColumnRenamed("q_0", "median_tx_value")
    return g.join(med, "date", "left")


def rolling_daily(d: DataFrame) -> DataFrame:
    """7-row rolling mean (min_periods 1) over the per-day table and
    the peak-day flag (first date among ties). The per-day table is bounded
    by the calendar, so one ordered window over it is cheap."""
    w = Window.orderBy("date").rowsBetween(-6, 0)
    out = d.withColumn("rolling_7", F.avg("tx_count").over(w))
    peak = d.agg(F.max_by("date", F.struct(F.col("tx_count"), F.datediff(F.lit("1970-01-01").cast("date"),
                                                                          F.col("date")))).alias("_peak"))
    return out.crossJoin(F.broadcast(peak)).withColumn("is_peak", (F.col("date") == F.col("_peak")).cast("int")) \
        .drop("_peak")


def daily_event_pivot(ev: DataFrame, b: DataFrame) -> DataFrame:
    """Date x event counts (0-filled) on the days that have baskets."""
    p = ev.withColumn("date", F.to_date("timestamp")).groupBy("date").pivot("event", FUNNEL) \
        .agg(F.count(F.lit(1))).na.fill(0, subset=FUNNEL)
    days = b.select("date").distinct()
    return days.join(p, "date", "left").na.fill(0, subset=FUNNEL)


def basket_size_buckets(b: DataFrame) -> DataFrame:
    """Counts of small baskets (1..5 per size) and ranges above."""
    s = F.col("total_items")
    label = F.when(s <= 5, s.cast("string")).when(s <= 10, "6-10").when(s <= 15, "11-15") \
        .when(s <= 20, "16-20").otherwise("20+")
    return b.where(s >= 0).groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


def money_label(x) -> Column:
    """P25: 1.23B / 4.5M / 12k / 7 axis labels."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x >= 1e9, F.concat(F.format_string("%.2f", x / 1e9), F.lit("B"))) \
        .when(x >= 1e6, F.concat(F.format_string("%.1f", x / 1e6), F.lit("M"))) \
        .when(x >= 1e3, F.concat(F.format_string("%.0f", x / 1e3), F.lit("k"))) \
        .otherwise(x.cast("long").cast("string"))


TRIM_PCTS = [0.25, 0.5, 0.75, 0.9, 0.99]


def trimmed_value_percentiles(b: DataFrame) -> DataFrame:
    """Percentiles of basket value after trimming above its p99."""
    p99 = exact_quantiles(b, [], "total_price", [0.99]).select(F.col("q_0").alias("_p99"))
    t = b.crossJoin(F.broadcast(p99)).where(F.col("total_price") <= F.col("_p99"))
    q = exact_quantiles(t, [], "total_price", TRIM_PCTS)
    out = q.select(F.posexplode(F.array(*[F.col(f"q_{i}") for i in range(len(TRIM_PCTS))])).alias("_i", "value"))
    pcts = F.array(*[F.lit(p) for p in TRIM_PCTS])
    return out.select(F.element_at(pcts, F.col("_i") + 1).alias("pct"), "value",
                      money_label("value").alias("label"))


def median_by_size(b: DataFrame) -> DataFrame:
    """E25."""
    return exact_quantiles(b, ["total_items"], "total_price", [0.5]).withColumnRenamed("q_0", "median_value")


def item_coverage(tx: DataFrame) -> DataFrame:
    """Share of all purchases covered by the top-N items, for every N.

    Items are ranked by (count desc, itemid) without a global sort in one task:
    the purchases of more frequent items come from running sums over the
    distinct counts, the place among equally frequent ones from ``exact_rank``."""
    counts = size_per(tx, "itemid").withColumn("_neg", -F.col("count"))
    ranked = exact_rank(counts, [], "_neg", "itemid", "_rk")
    sizes = counts.groupBy("count").agg(F.count(F.lit(1)).alias("_m")).withColumn("_s", F.col("count") * F.col("_m"))
    sizes = running_sums(sizes, [], "count", ["_m", "_s"], descending=True, prefix="_above")
    total = counts.agg(F.sum("count").alias("_total"))
    place = F.col("_rk") - (F.col("_above_m") - F.col("_m")) + 1
    cum = F.col("_above_s") - F.col("_s") + place * F.col("count")
    return ranked.join(sizes, "count").crossJoin(F.broadcast(total)) \
        .select((F.col("_rk") + 1).alias("n"), (cum / F.col("_total")).alias("coverage"))


def buyer_stats(b: DataFrame) -> DataFrame:
    """Per buyer count / sum / mean of basket values."""
    return b.groupBy("visitorid").agg(F.count("total_price").alias("num_tx"),
                                      F.coalesce(F.sum("total_price"), F.lit(0.0)).alias("total_spend"),
                                      F.avg("total_price").alias("avg_tx_value"))


def buyer_medians(bs: DataFrame) -> DataFrame:
    a = exact_quantiles(bs, [], "num_tx", [0.5]).withColumnRenamed("q_0", "median_num_tx")
    b = exact_quantiles(bs, [], "total_spend", [0.5]).withColumnRenamed("q_0", "median_total_spend")
    return a.crossJoin(b)
