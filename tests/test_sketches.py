"""Distinct counts by mergeable daily sketches."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.operators import sketches as sk

DAY = dt.datetime(2024, 3, 1)


def test_merged_days_count_each_id_once(spark):
    e = spark.range(60_000).select((F.col("id") % 20_000).alias("who"),
                                   F.timestamp_add("DAY", (F.col("id") % 30).cast("int"), F.lit(DAY)).alias("ts"))
    daily = sk.daily_sketches(e, "who", "ts")
    assert daily.count() == 30
    got = sk.merged_counts(daily, []).first()["approx_distinct"]
    assert abs(got - 20_000) <= 20_000 * sk.relative_error_bound()


def test_trailing_days_and_null_ids(spark):
    rows = [(1, DAY), (2, DAY), (None, DAY), (1, DAY + dt.timedelta(days=1)), (3, DAY + dt.timedelta(days=4))]
    daily = sk.daily_sketches(spark.createDataFrame(rows, "who long, ts timestamp"), "who", "ts")
    got = {r["day"].day: r["approx_distinct"] for r in sk.trailing_counts(daily, 3).collect()}
    assert got == {1: 2, 2: 2, 5: 1}


def test_empty_events(spark):
    daily = sk.daily_sketches(spark.createDataFrame([], "who long, ts timestamp"), "who", "ts")
    assert sk.trailing_counts(daily, 7).count() == 0
