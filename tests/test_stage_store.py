"""Stages are kept while their inputs and parameters stay, and rebuilt otherwise."""

import os

from pyspark.sql import functions as F

from cartwheel.plans import model_queries as mq
from cartwheel.sources.files import fingerprint, materialize


def test_stage_follows_inputs_and_params(spark, tmp_path):
    source, path = f"{tmp_path}/in.parquet", f"{tmp_path}/stages/sums"
    builds = []

    def stage(factor=1):
        def build():
            builds.append(factor)
            return spark.read.parquet(source).agg((F.sum("id") * factor).alias("s"))
        return materialize(spark, path, build, sources=[source], params={"factor": factor}).first()["s"]

    spark.range(10).write.parquet(source)
    assert stage() == 45 and stage() == 45 and builds == [1]
    spark.range(11).write.mode("overwrite").parquet(source)
    assert stage() == 55 and builds == [1, 1]
    spark.range(11, 12).write.mode("append").parquet(source)
    assert stage() == 66 and stage() == 66 and builds == [1, 1, 1]
    assert stage(2) == 132 and stage(2) == 132 and builds == [1, 1, 1, 2]


def test_interrupted_stage_is_rebuilt(spark, tmp_path):
    source, path = f"{tmp_path}/in.parquet", f"{tmp_path}/stage"
    spark.range(3).write.parquet(source)

    def fails():
        raise RuntimeError("lost")

    def stage(build):
        return materialize(spark, path, build, sources=[source]).count()
    assert stage(lambda: spark.read.parquet(source)) == 3
    spark.range(4).write.mode("overwrite").parquet(source)
    try:
        stage(fails)
    except RuntimeError:
        pass
    assert not os.path.exists(f"{path}.manifest")
    assert stage(lambda: spark.read.parquet(source)) == 4


def test_stage_without_sources_is_taken_as_it_is(spark, tmp_path):
    path = f"{tmp_path}/stage"
    assert materialize(spark, path, lambda: spark.range(2)).count() == 2
    assert materialize(spark, path, lambda: spark.range(5)).count() == 2


def test_fingerprint_and_memo_key(spark, tmp_path):
    for t in ("events", "orders", "lineitem"):
        spark.range(2).write.parquet(f"{tmp_path}/{t}.parquet")
    before = mq.data(spark, str(tmp_path))
    assert mq.data(spark, str(tmp_path)) == before
    spark.range(3).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert mq.data(spark, str(tmp_path)) != before
    assert fingerprint(spark, [f"{tmp_path}/events.parquet"]) == fingerprint(spark, [f"{tmp_path}/events.parquet"])


def test_user_table_is_staged_once_per_state_of_the_order_tables(spark, tmp_path, monkeypatch):
    import datetime as dt
    from cartwheel.plans import frames as fr
    from cartwheel.plans import survival_queries as sq

    def write(days):
        orders = [(10 * c + i, c, dt.datetime(2020, 1, 1) + dt.timedelta(days=days * i + c)) for c in range(1, 9) for i in range(1 + c % 4)]
        spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz") \
            .write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
        spark.createDataFrame([(o, 7, 10.0 * c) for o, c, _ in orders], "l_orderkey long, l_partkey long, l_extendedprice double") \
            .write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")

    built = []
    labelled = fr.rfm_labeled
    monkeypatch.setattr(fr, "rfm_labeled", lambda *a: built.append(1) or labelled(*a))
    write(20)
    first = fr.users_pipeline(spark, str(tmp_path))
    sq._test_scored(spark, str(tmp_path))
    sq._train(spark, str(tmp_path))
    assert len(built) == 1 and first.count() == fr.users_pipeline(spark, str(tmp_path)).count()
    write(30)
    again = fr.users_pipeline(spark, str(tmp_path))
    assert len(built) == 2 and again.agg({"tenure_days": "max"}).first()[0] > first.agg({"tenure_days": "max"}).first()[0]
