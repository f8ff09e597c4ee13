"""Hot keys: a third of all events moved to one visitor and another third
to one item (derived from the given sf0.001 events). The skew-safe plans
(bucketed as-of join / lag, exact ranks, grouping sets) must still match the
oracle exactly."""

import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from oracle_check import TABLES, compare

SRC = "/root/testdata/sf0.001"
QUERIES = ["f3_events_with_properties", "f5_user_features", "f6_rate_features", "f7_extra_user_features",
           "d7_dashboard", "e8_baskets", "e19_daily_tx"]


@pytest.fixture(scope="module")
def skewed(spark):
    d = tempfile.mkdtemp(prefix="cartwheel-skew-", dir="/tmp")
    ev = spark.read.parquet(f"{SRC}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))) \
        .withColumn("props", F.when(F.col("event_id") % 3 == 1, F.lit('{"k": 7}')).otherwise(F.col("props")))
    hot.write.parquet(f"{d}/events.parquet")
    for t in TABLES:
        if t != "events":
            os.symlink(f"{SRC}/{t}.parquet", f"{d}/{t}.parquet")
    con = duckdb.connect()
    for t in TABLES:
        src = f"{d}/{t}.parquet/*.parquet" if t == "events" else f"{d}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{src}')")
    return d, con


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys_match_oracle(spark, skewed, name):
    d, con = skewed
    err = compare(ent.queries()[name](spark, d).toPandas(), con.execute(ent.oracle_sql()[name]).df())
    assert err is None, err


def test_asof_join_spreads_an_item_with_all_rows_of_a_day(spark):
    import datetime as dt
    from cartwheel.operators import relational
    t0 = dt.datetime(2024, 5, 1)
    ev = spark.range(20_000).selectExpr(
        "id", "7L as itemid", "timestamp_ntz '2024-05-01 00:00:00' + make_dt_interval(0, 0, 0, id * 4) as timestamp")
    snaps = spark.createDataFrame([(7, t0 + dt.timedelta(minutes=37 * i), float(i)) for i in range(40)],
                                  "itemid long, timestamp timestamp_ntz, price double")
    got = relational.asof_join(ev, snaps, "itemid", "timestamp", "timestamp", ["price"])
    bad = got.where(F.col("price") != F.least(F.floor(F.col("id") * 4 / (37 * 60)), F.lit(39))).count()
    assert got.count() == 20_000 and bad == 0
    ranges = relational.equi_depth(ev.withColumn("v", relational._micros(ev, "timestamp")), "v", "r") \
        .groupBy("itemid", "r").count().agg(F.max("count")).first()[0]
    assert ranges <= 3 * 20_000 / 256
