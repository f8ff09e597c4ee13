"""Visitor-day dashboard table.

Everything after the first aggregation runs on the visitor-day table, whose
rows per visitor are bounded by the number of calendar days, so per-visitor
windows never hold raw events of a hot visitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.relational import exact_rank

# Daily label names and revenue-tier quantile edges.
TIER_EDGES = (0.5, 0.7)
TIER_LABELS = ("Low", "Mid", "High")
LOYAL, POTENTIAL_LOYAL, AT_RISK = "Loyal", "Potential Loyal", "At Risk"

FINAL_COLUMNS = [
    "visitorid", "day", "month", "number_of_view", "number_of_addtocart", "number_of_purchase",
    "number_of_activity", "revenue", "new_user_view_day", "new_user_addtocart_day",
    "new_user_transaction_day", "new_user_view_month", "new_user_addtocart_month",
    "new_user_transaction_month", "cum_revenue", "cum_purchases", "cum_addtocart", "cum_activity",
    "business_label",
]


def _day_month(ev: DataFrame) -> DataFrame:
    return ev.withColumn("day", F.to_date("timestamp")).withColumn("month", F.date_format("timestamp", "yyyy-MM"))


def visitor_day_v1(ev: DataFrame) -> DataFrame:
    """D1 + D2: activity / views / carts per visitor-day, distinct purchases
    and transaction revenue (0 when none), lifecycle flags from the first
    day of each event type (strictly before, or never)."""
    d = _day_month(ev)
    is_tx = F.col("event") == "transaction"
    vd = d.groupBy("visitorid", "day", "month").agg(
        F.count("event").alias("number_of_activity"),
        F.count_if(F.col("event") == "view").alias("number_of_view"),
        F.count_if(F.col("event") == "addtocart").alias("number_of_addtocart"),
        F.count_distinct(F.when(is_tx, F.col("transactionid"))).alias("number_of_purchase"),
        F.coalesce(F.sum(F.when(is_tx, F.col("price"))), F.lit(0.0)).alias("revenue"),
        F.count_if(is_tx).alias("_n_tx"))
    w = Window.partitionBy("visitorid")
    first_tx = F.min(F.when(F.col("_n_tx") > 0, F.col("day"))).over(w)
    first_add = F.min(F.when(F.col("number_of_addtocart") > 0, F.col("day"))).over(w)
    first_view = F.min(F.when(F.col("number_of_view") > 0, F.col("day"))).over(w)
    vd = vd.withColumn("_ft", first_tx).withColumn("_fa", first_add).withColumn("_fv", first_view)

    def before(c):
        return F.col(c).isNull() | (F.col("day") < F.col(c))
    vd = vd.withColumn("new_user_transaction", before("_ft").cast("int")) \
        .withColumn("new_user_addtocart", (before("_fa") & before("_ft")).cast("int")) \
        .withColumn("new_user_view", (before("_fv") & before("_fa") & before("_ft")).cast("int"))
    return vd.select("visitorid", "day", "month", "number_of_view", "number_of_addtocart",
                     "number_of_purchase", "number_of_activity", "new_user_transaction",
                     "new_user_addtocart", "new_user_view", "revenue")


def visitor_day_v2(ev: DataFrame, tiebreak: str = "event_id") -> DataFrame:
    """D3 + D4 + D5: per visitor-day counts (purchases = transaction rows),
    revenue = price summed over all events (``tx_revenue`` over transactions),
    and the history maxima had_*_before.

    had_X_before at the day's last event = X events on earlier days + X
    events of the day - [the day's last event is X]; the earlier-day sums are
    a running sum over the visitor-day table."""
    d = _day_month(ev)
    tb = tiebreak if tiebreak in ev.columns else "itemid"
    order = F.struct(F.col("timestamp"), F.col(tb))
    kinds = {"view": "view", "add": "addtocart", "tx": "transaction"}
    vd = d.groupBy("visitorid", "day", "month").agg(
        F.count_if(F.col("event") == "view").alias("number_of_view"),
        F.count_if(F.col("event") == "addtocart").alias("number_of_addtocart"),
        F.count_if(F.col("event") == "transaction").alias("number_of_purchase"),
        F.count("event").alias("number_of_activity"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.sum(F.when(F.col("event") == "transaction", F.col("price"))), F.lit(0.0)).alias("tx_revenue"),
        F.max_by("event", order).alias("_last_event"))
    w = Window.partitionBy("visitorid").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    counts = {"view": "number_of_view", "add": "number_of_addtocart", "tx": "number_of_purchase"}
    for k, ev_name in kinds.items():
        prev = F.coalesce(F.sum(counts[k]).over(w), F.lit(0))
        vd = vd.withColumn(f"had_{k}_before",
                           (prev + F.col(counts[k]) - (F.col("_last_event") == ev_name).cast("long")).cast("long"))
    z = {k: F.col(f"had_{k}_before") == 0 for k in kinds}
    vd = vd.withColumn("new_user_transaction_day", z["tx"].cast("int")) \
        .withColumn("new_user_addtocart_day", (z["add"] & z["tx"]).cast("int")) \
        .withColumn("new_user_view_day", (z["view"] & z["add"] & z["tx"]).cast("int"))
    return vd.drop("_last_event")


def add_month_flags(vd: DataFrame) -> DataFrame:
    """First visitor-day row of each (visitor, month) and month flags."""
    w = Window.partitionBy("visitorid", "month").orderBy("day")
    first = F.row_number().over(w) == 1
    return vd.withColumn("_first", first) \
        .withColumn("new_user_view_month", F.col("_first").cast("int")) \
        .withColumn("new_user_addtocart_month",
                    (F.col("_first") & ((F.col("number_of_addtocart") > 0) | (F.col("number_of_purchase") > 0)))
                    .cast("int")) \
        .withColumn("new_user_transaction_month", (F.col("_first") & (F.col("number_of_purchase") > 0)).cast("int")) \
        .drop("_first")


def add_cumulative(vd: DataFrame) -> DataFrame:
    """D7 (W4): running sums per visitor in day order."""
    w = Window.partitionBy("visitorid").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return vd.withColumn("cum_revenue", F.sum("revenue").over(w)) \
        .withColumn("cum_purchases", F.sum("number_of_purchase").over(w)) \
        .withColumn("cum_addtocart", F.sum("number_of_addtocart").over(w)) \
        .withColumn("cum_activity", F.sum("number_of_activity").over(w))


def add_revenue_tier(vd: DataFrame) -> DataFrame:
    """D8 (W7): per day, rank (ties by visitor id) of cum_revenue cut at the
    0.5 / 0.7 quantiles of the ranks; a single-visitor day is Low. The rank
    is ``exact_rank`` - no window over a whole (possibly huge) day."""
    d = exact_rank(vd, ["day"], "cum_revenue", "visitorid", "_rk") \
        .withColumn("_rn", F.col("_rk") + 1).withColumnRenamed("_rk_n", "_n").drop("_rk")
    lo = F.lit(1.0) + (F.col("_n") - 1) * TIER_EDGES[0]
    mid = F.lit(1.0) + (F.col("_n") - 1) * TIER_EDGES[1]
    tier = F.when(F.col("_rn") <= lo, TIER_LABELS[0]).when(F.col("_rn") <= mid, TIER_LABELS[1]) \
        .otherwise(TIER_LABELS[2])
    return d.withColumn("revenue_tier", tier).drop("_rn", "_n")


def add_daily_label(vd: DataFrame) -> DataFrame:
    """D9."""
    label = F.when((F.col("revenue_tier") == "High") & (F.col("cum_purchases") >= 2), LOYAL) \
        .when((F.col("cum_purchases") >= 2) | (F.col("cum_addtocart") >= 3) | (F.col("cum_activity") >= 5),
              POTENTIAL_LOYAL).otherwise(AT_RISK)
    return vd.withColumn("business_label", label)


def dashboard_table(ev: DataFrame, keep_tier: bool = False) -> DataFrame:
    """The 19-column visitor-day table."""
    d = add_daily_label(add_revenue_tier(add_cumulative(add_month_flags(visitor_day_v2(ev)))))
    return d.select(*FINAL_COLUMNS, *(["revenue_tier"] if keep_tier else []))


def dashboard_checks(dash: DataFrame) -> DataFrame:
    """Label counts, day-flag counts, purchase total, cart-count counts
    as one long table (check, value, count)."""
    a = dash.groupBy(F.lit("business_label").alias("check"), F.col("business_label").alias("value")) \
        .agg(F.count(F.lit(1)).alias("count"))
    b = dash.groupBy(F.lit("new_user_transaction_day").alias("check"),
                     F.col("new_user_transaction_day").cast("string").alias("value")) \
        .agg(F.count(F.lit(1)).alias("count"))
    c = dash.agg(F.lit("number_of_purchase_sum").alias("check"), F.lit("total").alias("value"),
                 F.coalesce(F.sum("number_of_purchase"), F.lit(0)).cast("long").alias("count"))
    e = dash.groupBy(F.lit("number_of_addtocart").alias("check"),
                     F.col("number_of_addtocart").cast("string").alias("value")) \
        .agg(F.count(F.lit(1)).alias("count"))
    return a.unionByName(b).unionByName(c).unionByName(e)
