"""Shared Spark frames of the standard pipeline over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators import features as fe
from cartwheel.operators import rfm as rf
from cartwheel.session import stage, staged_parquet
from cartwheel.sources import tables as tb
from cartwheel.sources.files import fingerprint

# Rule thresholds that fire on the TESTDATA scale (FIXTURES.md).
TEST_RULE_THRESHOLDS = {"events": 48, "events_30d": 48, "events_per_day": 2.0,
                        "events_per_minute": 2, "distinct_items": 38}

_MEMO: dict = {}


def sid(spark: SparkSession) -> tuple:
    """Session identity for memo keys (object id alone can be reused)."""
    return (id(spark), spark.sparkContext.applicationId)


def memo(key, build):
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def orders_state(spark: SparkSession, d: str) -> tuple:
    """Memo key of a folder's order tables: a changed file is another key."""
    return (*sid(spark), d, fingerprint(spark, [f"{d}/{t}.parquet" for t in ("orders", "lineitem")]))


def ev(spark: SparkSession, d: str) -> DataFrame:
    return tb.clickstream_events(spark, d)


def props(spark: SparkSession, d: str) -> DataFrame:
    return tb.item_property_log(spark, d)


def snap(spark: SparkSession, d: str) -> DataFrame:
    return fe.get_small_props(props(spark, d))


def ewp(spark: SparkSession, d: str) -> DataFrame:
    """Enriched events, written once per query (the reference's stage file)."""
    return stage(fe.attach_item_properties(ev(spark, d), snap(spark, d)))


def txp(spark: SparkSession, d: str) -> DataFrame:
    return fe.get_transaction_price(ewp(spark, d))


def btx(spark: SparkSession, d: str) -> DataFrame:
    return tb.order_transactions(spark, d)


def btx_once(spark: SparkSession, d: str) -> DataFrame:
    """The order lines, joined and written once per state of the order tables, for
    queries that read them in several steps."""
    return memo(("btx", orders_state(spark, d)), lambda: staged_parquet(btx(spark, d), "order-lines"))


def feats(spark: SparkSession, d: str) -> DataFrame:
    return fe.build_user_features(ewp(spark, d))


def extra(spark: SparkSession, d: str) -> DataFrame:
    e = ewp(spark, d)
    rated = fe.rate_rows(e)
    return fe.compute_extra_user_features(e, fe.build_user_features(e, rated=rated), rated)


def rules(spark: SparkSession, d: str) -> DataFrame:
    return fe.rule_based_flags(extra(spark, d), TEST_RULE_THRESHOLDS)


def rfm_b(spark: SparkSession, d: str) -> DataFrame:
    """RFM on the order adapter (customers, baskets)."""
    b = btx_once(spark, d)
    return rf.build_rfm(rf.purchase_rollup(b), rf.observation_date(b))


def rfm_seg(spark: SparkSession, d: str) -> DataFrame:
    return rf.rule_segment(rfm_b(spark, d))


def rfm_labeled(spark: SparkSession, d: str) -> DataFrame:
    r = staged_parquet(rfm_seg(spark, d), "rfm")  # profiled, then labelled
    prof = rf.build_segment_profile(r, "segment")
    return rf.label_rfm(r, prof, "segment")


def users_b(spark: SparkSession, d: str) -> DataFrame:
    """Per-customer behavioural features on the order adapter (F5 over order lines)."""
    return fe.build_user_features(btx_once(spark, d))


def users_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Eligible (repeat, non one-time) customers with features + label; staged
    once per state of the order tables, as several steps of one query read it."""
    return memo(("users", orders_state(spark, d)), lambda: stage(rf.eligible_users(rfm_labeled(spark, d), users_b(spark, d))))
