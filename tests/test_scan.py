"""Ordered scans against a plain version, with a key that spans partitions."""

import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.scan import ordered_scan
from cartwheel.session import drop_staged, staged_parquet

SCHEMA = "k long, t long, x int, s string"


def plain(rows):
    out, state = {}, {}
    for i, (k, t, x, s, *_) in sorted(enumerate(rows), key=lambda e: (e[1][0] is not None, e[1][0] or 0, e[1][1])):
        total, n, prev = state.get(k, (0, 0, None))
        out[k, t] = (total + (x or 0), n, prev)
        state[k] = (total + (x or 0), n + 1, s)
    return out


def scanned(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = ordered_scan(df, "k", ["t"], sums={"x": "total"}, lags={"s": "before"}, position="n")
    assert out.columns == ["k", "t", "x", "s", "total", "before", "n"]
    return {(r.k, r.t): (r.total, r.n, r.before) for r in out.collect()}


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_equal_to_a_plain_scan(spark, many_partitions):
    rng = random.Random(5)
    for hot in (0, 400, 3000):
        rows = [(7, t, rng.choice([None, 1, 5]), f"h{t}") for t in range(hot)]
        rows += [(rng.choice([None, *range(30)]) if i % 2 else 50 + i % 3, 10_000 + i, i % 4, None if i % 5 == 0 else f"s{i}")
                 for i in range(300)]
        rng.shuffle(rows)
        assert scanned(spark, rows) == plain(rows)


def test_one_key_only_and_empty(spark, many_partitions):
    rows = [(1, t, 1, str(t)) for t in range(200)]
    assert scanned(spark, rows) == plain(rows)
    assert scanned(spark, []) == {}
    assert scanned(spark, [(None, 1, 2, "a")]) == {(None, 1): (2, 0, None)}


def test_hot_key_is_spread(spark, many_partitions):
    """A third of all rows in one key: no task gets more than twice the median."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("t"),
                                    F.lit(1).alias("x"), F.lit("s").alias("s"))
    by = [F.col("k").asc_nulls_first(), F.col("t")]
    sizes = sorted(r["count"] for r in df.repartitionByRange(*by).groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    out = ordered_scan(df, "k", ["t"], position="n")
    assert out.where("k = -1").agg(F.max("n"), F.countDistinct("n")).first()[:] == (9999, 10000)


def test_dropped_tables_are_gone(spark):
    kept, gone = staged_parquet(spark.range(5), "kept"), staged_parquet(spark.range(5), "gone")
    drop_staged(gone)
    assert kept.count() == 5
    with pytest.raises(Exception):
        gone.count()


def test_join_spread_equals_a_join(spark):
    from cartwheel.operators.relational import join_spread
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k % 2 = 1").withColumn("v", F.col("k") * 10)
    for how in ("inner", "left"):
        got = join_spread(rows, table, ["k"], "n", 60, how)  # 60: every key counts as hot
        none = join_spread(rows, table, ["k"], "n", 10 ** 9, how)
        plain = rows.join(table.drop("n"), ["k"], how).select("k", "id", "v")
        want = sorted(map(str, plain.collect()))
        assert sorted(map(str, got.collect())) == want == sorted(map(str, none.collect()))
