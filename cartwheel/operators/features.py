"""Preprocessing and behavioural-feature operators.

Inputs follow the reference shape: events (timestamp, visitorid, event,
itemid, transactionid[, price]) and the property changelog (timestamp,
itemid, property, value, ingest_seq).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.semantics import (
    add_days, flag, floor_days, log1p0, row_sum, total_seconds, whole_seconds,
)
from cartwheel.operators.relational import asof_join, exact_quantiles, histogram, join_spread, top_n
from cartwheel.operators.scan import ordered_scan

# The property codes kept for item snapshots (790 is the price).
SNAPSHOT_PROPERTIES = ["790", "categoryid", "available"]
NUMERIC_VALUE_PATTERN = r"^n\d+(\.\d+)?$"

# Rule thresholds of the bot/anomaly rules.
RULE_THRESHOLDS = {
    "events": 6000,
    "events_30d": 1000,
    "events_per_day": 500,
    "events_per_minute": 50,
    "prop_fast": 0.5,
    "prop_repeat": 0.5,
    "distinct_items": 3000,
}
W_RULE, W_MODEL, FINAL_THRESHOLD, MODEL_FLAG_THRESHOLD = 0.6, 0.4, 0.5, 0.6


# ----------------------------------------------------------------------- F1
def detect_numeric_properties(props: DataFrame) -> DataFrame:
    """Properties whose values look like 'n<number>': rows, distinct values,
    share of strictly numeric values, distinct ratio; most distinct first."""
    num = props.where(F.coalesce(F.col("value").startswith("n"), F.lit(False)))
    out = num.groupBy("property").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("value").alias("unique_vals"),
        F.avg(F.col("value").rlike(NUMERIC_VALUE_PATTERN).cast("double")).alias("share_positive_numeric"),
    )
    return out.withColumn("unique_ratio", F.col("unique_vals") / F.col("n_rows")) \
        .orderBy(F.desc("unique_vals"), "property")


# ----------------------------------------------------------------------- F2
def get_small_props(props: DataFrame) -> DataFrame:
    """Item snapshots: one row per (itemid, timestamp) with the last value (in
    ingest order, NULLs skipped) of price / categoryid / available."""
    p = props.where(F.col("property").isin(SNAPSHOT_PROPERTIES))

    def last_of(prop):
        return F.max_by(F.col("value"), F.when((F.col("property") == prop) & F.col("value").isNotNull(),
                                               F.col("ingest_seq")))
    snap = p.groupBy("itemid", "timestamp").agg(
        last_of("790").alias("_price"), last_of("categoryid").alias("categoryid"),
        last_of("available").alias("available"))
    snap = snap.where(F.col("_price").isNotNull() | F.col("categoryid").isNotNull()
                      | F.col("available").isNotNull())
    price = F.regexp_replace("_price", "^n", "").try_cast("double")
    return snap.select("itemid", "timestamp", "available", "categoryid", price.alias("price"))


# ----------------------------------------------------------------------- F3
def attach_item_properties(events: DataFrame, snapshots: DataFrame) -> DataFrame:
    """As-of (backward) snapshot per event + all-time item mean price imputation.

    Only ``price`` is numeric on the snapshot side, so only it is imputed and
    only ``mean_price`` is added (the reference's fresh path)."""
    means = snapshots.groupBy("itemid").agg(F.avg("price").alias("mean_price"))
    enriched = asof_join(events, snapshots, by="itemid", left_on="timestamp", right_on="timestamp",
                         right_cols=["available", "categoryid", "price"], per_key=means)
    return enriched.withColumn("price", F.coalesce("price", "mean_price"))


# ----------------------------------------------------------------------- F4
def get_transaction_price(events_with_props: DataFrame) -> DataFrame:
    """Transaction lines; price 0 -> mean positive tx price of the item; rows
    whose price stays NULL are dropped."""
    tx = events_with_props.where(F.col("event") == "transaction") \
        .select("timestamp", "visitorid", "event", "itemid", "transactionid", "price")
    cols = tx.columns
    # only rows of price 0 are joined; an item with many of them is joined apart
    item_mean = tx.groupBy("itemid").agg(F.avg(F.when(F.col("price") > 0, F.col("price"))).alias("_imp"),
                                         F.count_if(F.col("price") == 0).alias("_n")).where(F.col("_n") > 0)
    free = tx.where(F.col("price") == 0)
    repaired = join_spread(free, item_mean, ["itemid"], "_n", free.count()).withColumn("price", F.col("_imp"))
    priced = tx.where(F.col("price") != 0)
    return priced.unionByName(repaired.where(F.col("price").isNotNull()).select(*cols))


# ----------------------------------------------------------------------- F5
def _cutoff_frame(events: DataFrame, cutoff_time):
    if cutoff_time is None:
        return events.agg(F.max("timestamp").alias("_cutoff"))
    return events.sparkSession.range(1).select(F.lit(cutoff_time).cast("timestamp_ntz").alias("_cutoff"))


def build_user_features(events: DataFrame, cutoff_time=None, rated: DataFrame | None = None) -> DataFrame:
    """24 per-visitor features (see FIXTURES.md).

    Plan: the events are sorted by visitor once (``rated``, which is
    ``rate_rows(events)`` where the caller has it, or a scan of their own), so a
    visitor's rows lie together and the partial aggregation of each task leaves
    about one row per visitor. The distinct items, transactions and dates of a
    visitor come from GROUPING SETS that carry two narrow columns only."""
    kind = F.when(F.col("event") == "view", 1).when(F.col("event") == "addtocart", 2) \
        .when(F.col("event") == "transaction", 3).otherwise(0).cast("byte")
    if rated is None:
        rated = ordered_scan(events.select("visitorid", "timestamp", "itemid", "transactionid", "price", kind.alias("_kind")),
                             "visitorid", ["timestamp", "itemid"], lags={"timestamp": "prev_ts"})
    else:
        rated = rated.withColumn("_kind", kind)
    cut = _cutoff_frame(rated, cutoff_time)
    # events beyond the cut-off precede none before it
    ev = rated.crossJoin(F.broadcast(cut)).where(F.col("timestamp") <= F.col("_cutoff"))
    ts, c = F.col("timestamp"), F.col("_cutoff")
    nulltx = F.col("transactionid").isNull()
    in7, in14, in30 = (ts >= add_days(c, -7)), (ts >= add_days(c, -14)), (ts >= add_days(c, -30))
    is_view, is_cart, is_tx = (F.col("_kind") == i for i in (1, 2, 3))
    visitors = ev.groupBy("visitorid").agg(
        F.max("_cutoff").alias("_cutoff"), F.max("timestamp").alias("last_event"), F.min("timestamp").alias("first_event"),
        F.count_if(nulltx).alias("_n_null"),
        F.count_if(nulltx & in7).alias("_n_null7"), F.count_if(nulltx & in14).alias("_n_null14"),
        F.count_if(nulltx & in30).alias("_n_null30"),
        F.count_if(is_view).alias("total_views"), F.count_if(is_cart).alias("total_addtocarts"),
        F.count_if(is_tx).alias("total_tx"),
        F.avg(F.when(is_view, F.col("price"))).alias("view_price"),
        F.avg(F.when(is_cart, F.col("price"))).alias("addtocart_price"),
        F.avg(F.when(is_tx, F.col("price"))).alias("tx_price"),
        (F.avg(whole_seconds("prev_ts", "timestamp")) / 86400.0).alias("avg_inter_event_days"),
    )
    # a null visitor has no gaps
    visitors = visitors.withColumn("avg_inter_event_days", F.when(F.col("visitorid").isNotNull(), F.col("avg_inter_event_days")))

    seen = F.when(is_view, 1).when(is_cart, 2).otherwise(0).bitwiseOR(F.when(nulltx, 0).otherwise(4)).cast("byte")
    pre = ev.select("visitorid", "itemid", "transactionid", F.to_date("timestamp").alias("_date"), "timestamp", seen.alias("_seen")) \
        .groupingSets(
            [["visitorid", "itemid"], ["visitorid", "transactionid"], ["visitorid", "_date"]],
            "visitorid", "itemid", "transactionid", "_date",
        ).agg(F.grouping_id().alias("_gid"), F.bit_or("_seen").alias("_seen"), F.max("timestamp").alias("_max_ts"))
    g = F.col("_gid")
    item_set, tx_set, date_set = g == 3, g == 5, g == 6
    item, txk = item_set & F.col("itemid").isNotNull(), tx_set & F.col("transactionid").isNotNull()

    def with_bit(bit):
        return F.col("_seen").bitwiseAND(F.lit(bit).cast("byte")) > 0
    sets = pre.crossJoin(F.broadcast(cut)).groupBy(F.col("visitorid").alias("_visitor")).agg(
        F.count_if(item).alias("distinct_items"), F.count_if(item & with_bit(1)).alias("view_items"),
        F.count_if(item & with_bit(2)).alias("addtocart_items"), F.count_if(item & with_bit(4)).alias("tx_items"),
        F.count_if(txk).alias("_n_txd"),
        F.count_if(txk & (F.col("_max_ts") >= add_days(c, -7))).alias("_n_txd7"),
        F.count_if(txk & (F.col("_max_ts") >= add_days(c, -14))).alias("_n_txd14"),
        F.count_if(txk & (F.col("_max_ts") >= add_days(c, -30))).alias("_n_txd30"),
        F.count_if(date_set & F.col("_date").isNotNull()).alias("active_days"),
    )
    agg = visitors.join(sets, F.col("visitorid").eqNullSafe(F.col("_visitor")))
    total = F.col("_n_null") + F.col("_n_txd")
    return agg.select(
        "visitorid", total.alias("total_events"), "first_event", "last_event",
        floor_days("last_event", "_cutoff").alias("recency_days"),
        (floor_days("first_event", "last_event") + 1).alias("tenure_days"),
        "total_views", "total_addtocarts", "total_tx", "distinct_items", "view_items",
        "addtocart_items", "tx_items",
        (F.col("total_addtocarts") / (total + F.lit(1e-9))).alias("prop_addtocart"),
        (F.col("total_tx") / (total + F.lit(1e-9))).alias("prop_tx"),
        (F.col("_n_null7") + F.col("_n_txd7")).alias("events_7d"),
        (F.col("_n_null14") + F.col("_n_txd14")).alias("events_14d"),
        (F.col("_n_null30") + F.col("_n_txd30")).alias("events_30d"),
        "active_days",
        (total / F.when(F.col("active_days") == 0, 1).otherwise(F.col("active_days"))).alias("events_per_active_day"),
        "view_price", "addtocart_price", "tx_price", "avg_inter_event_days",
    )


# ----------------------------------------------------------------------- F6
def rate_rows(events: DataFrame) -> DataFrame:
    """The previous event of the visitor and what follows from it, per event in
    (visitorid, timestamp, itemid) order. Rows come from one staged scan over
    range partitions, however many of them one visitor or one hour holds."""
    d = ordered_scan(events, "visitorid", ["timestamp", "itemid"], lags={"timestamp": "prev_ts", "itemid": "prev_item"})
    return d.withColumn("delta_s", total_seconds("prev_ts", "timestamp")) \
        .withColumn("very_fast", F.coalesce((F.col("delta_s") <= 1).cast("int"), F.lit(0))) \
        .withColumn("same_item_repeat", F.coalesce((F.col("itemid") == F.col("prev_item")).cast("int"), F.lit(0))) \
        .withColumn("minute", F.date_trunc("minute", "timestamp"))


def add_rate_features(events: DataFrame) -> DataFrame:
    """Per-event rate features: ``rate_rows`` and the visitor's events per minute,
    counted with partial sums and handed back, full minutes apart."""
    d = rate_rows(events)
    n = d.groupBy("visitorid", "minute").agg(F.count(F.lit(1)).alias("events_per_minute"))
    n = n.withColumn("_size", F.col("events_per_minute")).withColumnsRenamed({"visitorid": "_v", "minute": "_m"})
    d = d.withColumn("_v", F.col("visitorid")).withColumn("_m", F.col("minute"))
    return join_spread(d, n, ["_v", "_m"], "_size", d.count(), "left").drop("_v", "_m")


# ----------------------------------------------------------------------- F7
def compute_extra_user_features(events: DataFrame, user_feats: DataFrame, rated: DataFrame | None = None) -> DataFrame:
    """Extra behaviour features joined to the user table; missing -> 0 and all
    numeric NULLs of the result -> 0 (one row per user: the three gap
    statistics are columns). ``rated``: ``rate_rows(events)`` where the caller has it."""
    r = rate_rows(events) if rated is None else rated
    per_min = r.groupBy("visitorid", "minute").agg(F.count(F.lit(1)).alias("_epm")) \
        .groupBy("visitorid").agg(F.max("_epm").alias("max_events_per_minute"))
    stats = r.groupBy("visitorid").agg(
        F.avg("very_fast").alias("prop_very_fast"),
        F.avg("same_item_repeat").alias("prop_same_item_repeat"),
        F.min("delta_s").alias("min_ie_s"), F.stddev_pop("delta_s").alias("std_ie_s"),
        F.avg(F.col("price").isNotNull().cast("double")).alias("prop_price_available"),
    )
    med = exact_quantiles(r, ["visitorid"], "delta_s", [0.5], name="median").withColumnRenamed("median_0", "median_ie_s")
    stats = stats.join(med, "visitorid", "left")
    merged = user_feats.join(stats, "visitorid", "left").join(per_min, "visitorid", "left")
    numeric = [f.name for f in merged.schema.fields if isinstance(f.dataType, T.NumericType)]
    return merged.na.fill(0, subset=numeric)


# ----------------------------------------------------------------------- F8
def rule_based_flags(df: DataFrame, thresholds: dict | None = None) -> DataFrame:
    th = dict(RULE_THRESHOLDS, **(thresholds or {}))
    out = df.withColumn("flag_many_events", flag(F.col("total_events") >= th["events"])) \
        .withColumn("flag_many_events_30d", flag(F.col("events_30d") >= th["events_30d"])) \
        .withColumn("flag_events_per_day_high", flag(F.col("events_per_active_day") >= th["events_per_day"])) \
        .withColumn("flag_high_epm", flag(F.col("max_events_per_minute") >= th["events_per_minute"])) \
        .withColumn("flag_fast_burst", flag(F.col("prop_very_fast") >= th["prop_fast"])) \
        .withColumn("flag_repeat_items", flag(F.col("prop_same_item_repeat") >= th["prop_repeat"])) \
        .withColumn("flag_many_distinct_items", flag(F.col("distinct_items") >= th["distinct_items"]))
    flag_cols = [c for c in out.columns if c.startswith("flag_")]
    return out.withColumn("rule_flag_score", row_sum(flag_cols))


# ---------------------------------------------------------------------- F10
def combined_flags(df: DataFrame) -> DataFrame:
    """0.6 * rule_flag_score / max + 0.4 * iso_score_norm; final flag >= 0.5."""
    mx = df.agg(F.max("rule_flag_score").alias("_mx"))
    mx = mx.select(F.when(F.col("_mx") > 0, F.col("_mx")).otherwise(F.lit(1)).alias("_mx"))
    out = df.crossJoin(F.broadcast(mx)) \
        .withColumn("rule_score_norm", F.col("rule_flag_score") / F.col("_mx")) \
        .withColumn("combined_score", F.lit(W_RULE) * F.col("rule_score_norm")
                    + F.lit(W_MODEL) * F.col("iso_score_norm")) \
        .withColumn("final_flag", flag(F.col("combined_score") >= FINAL_THRESHOLD))
    return out.drop("_mx")


# ---------------------------------------------------------------------- F11
def flag_distribution(df: DataFrame, c: str = "final_flag") -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("count"))


def top_flagged(df: DataFrame, n: int = 200) -> DataFrame:
    """Top-n flagged users by (combined_score, rule_flag_score, total_events) desc."""
    return top_n(df.where(F.col("final_flag") == 1),
                 [F.desc("combined_score"), F.desc("rule_flag_score"), F.desc("total_events"),
                  F.asc("visitorid")], n)


def top_by_score(df: DataFrame, sort_by: str = "combined_score", n: int = 25) -> DataFrame:
    return top_n(df, [F.desc(sort_by), F.desc("total_events"), F.asc("visitorid")], n)


# ---------------------------------------------------------------------- F12
# The features of the report and those shown as log1p.
FEATURES_TO_PLOT = ["total_events", "events_per_active_day", "max_events_per_minute",
                    "prop_very_fast", "prop_same_item_repeat", "distinct_items",
                    "rule_flag_score", "combined_score"]
LOG_FEATURES = ["total_events", "distinct_items"]


def feature_distributions(df: DataFrame, features: list[str] | None = None, bins: int = 50) -> DataFrame:
    """Histogram data (50 bins) for each feature; log1p after a > 0 filter for
    the log features. Long format: feature, bin, bin_lo, bin_hi, count."""
    out = None
    for f in (features or [c for c in FEATURES_TO_PLOT if c in df.columns]):
        s = df.select(F.col(f).cast("double").alias("v")).where(F.col("v").isNotNull())
        if f in LOG_FEATURES:
            s = s.where(F.col("v") > 0).select(log1p0("v").alias("v"))
        h = histogram(s, "v", bins).withColumn("feature", F.lit(f))
        out = h if out is None else out.unionByName(h)
    return out


# ---------------------------------------------------------------------- F13
def remove_visitors(df: DataFrame, flagged: DataFrame, key: str = "visitorid") -> DataFrame:
    """Anti-join removal of flagged visitors (general form of ``!= id``)."""
    return df.join(flagged.select(key).distinct(), key, "left_anti")


def remove_visitor_id(df: DataFrame, visitor_id: int, key: str = "visitorid") -> DataFrame:
    return df.where(F.col(key) != F.lit(visitor_id))


# ---------------------------------------------------------------------- F14
def run_pipeline(events: DataFrame, user_feats: DataFrame, stage_dir: str | None = None,
                 iso_model=None, seed: int = 42, n_estimators: int = 100,
                 sources: list[str] | None = None) -> DataFrame:
    """F7 -> F8 -> F9 -> F10, each stage written once under ``stage_dir`` (a
    shared folder) and re-read on later runs, until the files of ``sources``
    (where ``events`` and ``user_feats`` come from) or a parameter change."""
    from cartwheel.operators.iforest import model_based_flags
    from cartwheel.sources.files import materialize
    spark = events.sparkSession

    def stage(name, fn, **params):
        return materialize(spark, f"{stage_dir}/{name}", fn, sources=sources, params=params) if stage_dir else fn()
    ext = stage("user_features_extended", lambda: compute_extra_user_features(events, user_feats))
    rules = stage("user_with_rules", lambda: rule_based_flags(ext), thresholds=RULE_THRESHOLDS)
    models = stage("user_with_models", lambda: model_based_flags(rules, seed=seed, n_estimators=n_estimators),
                   thresholds=RULE_THRESHOLDS, seed=seed, n_estimators=n_estimators)
    return combined_flags(models)


def days_span(events: DataFrame) -> DataFrame:
    """Data span in days (max date - min date)."""
    d = events.agg(F.min(F.to_date("timestamp")).alias("mn"), F.max(F.to_date("timestamp")).alias("mx"))
    return d.select(F.datediff("mx", "mn").cast("long").alias("span_days"))

