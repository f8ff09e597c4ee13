"""
cartesian product or a window without a partition key (all rows in one
task). Windows over small aggregated tables (segments, days) are allowed
elsewhere and are not part of this list."""

import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
ROW_LEVEL = ["f3_events_with_properties", "f4_transaction_prices", "f5_user_features", "f6_rate_features",
             "f7_extra_user_features", "d1_visitor_day_v1", "d4_visitor_day_v2", "d7_dashboard", "e8_baskets",
             "g1_purchase_rollup", "g2_rfm", "c2_clv_summary", "h1_time_to_churn", "h3_stratified_split"]


def _nodes(p):
    yield p
    ch = p.children()
    for i in range(ch.size()):
        yield from _nodes(ch.apply(i))


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_no_cartesian_or_unpartitioned_window(spark, name):
    df = ent.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().sparkPlan()
    for n in _nodes(plan):
        assert n.nodeName() != "CartesianProduct", name
        if n.nodeName() == "Window":
            assert not n.partitionSpec().isEmpty(), f"{name}: unpartitioned window {n.simpleStringWithNodeId()}"


def test_results_do_not_depend_on_session_time_zone(spark):
    from oracle_check import compare
    q = ent.queries()
    before = {n: q[n](spark, SF).toPandas() for n in ["e3_hourly_events", "d7_dashboard", "p14_coerce_timestamps"]}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        for n, b in before.items():
            assert compare(q[n](spark, SF).toPandas(), b) is None, n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
