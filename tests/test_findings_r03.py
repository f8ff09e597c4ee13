"""Steps that read their input once, carry narrow rows or compute in blocks
(findings F6, F7, F8, F14, F15, F20-F22 of round 3)."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import churn_ml, clv, features, iforest
from cartwheel.operators.survival_forest import SurvivalForest, Tree, grow_tree, leaf_steps
from cartwheel.plans import clv_queries, frames


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def order_tables(spark, tmp_path):
    d = str(tmp_path)
    t = dt.datetime(2000, 1, 1)
    orders = [(k, k % 7, t + dt.timedelta(days=3 * k)) for k in range(42)]
    lines = [(k, 10 * k + j, 5.0 + j) for k in range(42) for j in range(3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_extendedprice double").write.parquet(f"{d}/lineitem.parquet")
    return d


def test_order_lines_are_joined_once(spark, order_tables):
    """the later steps read the written join."""
    r = frames.rfm_b(spark, order_tables)
    assert "LeftSemi" not in _plan(r) and "o_orderkey" not in _plan(r)
    assert {(x.visitorid, x.frequency) for x in r.collect()} == {(v, 6) for v in range(7)}
    assert frames.btx_once(spark, order_tables).count() == 126


def test_purchases_of_the_clv_stage_are_written_once(spark, order_tables):
    """F8."""
    tm = clv_queries._tx_money(spark, order_tables)
    assert "Join" not in _plan(tm)
    assert tm.count() == 42 and tm.agg(F.sum("monetary")).first()[0] == 42 * 18.0


def test_distinct_counts_carry_two_columns(spark):
    """The grouping sets shuffle no visitor totals."""
    t = dt.datetime(2020, 1, 1)
    rows = [(1, t, "view", 7, None, 2.0), (1, t, "transaction", 7, 70, 4.0), (1, t + dt.timedelta(days=2), "addtocart", None, None, None),
            (None, t, "view", 8, None, 1.0), (None, t + dt.timedelta(days=1), "view", 9, None, 3.0), (2, None, "view", 1, None, 1.0)]
    e = spark.createDataFrame(rows, "visitorid long, timestamp timestamp_ntz, event string, itemid long, transactionid long, price double")
    f = features.build_user_features(e)
    grouped = [line for line in _plan(f).splitlines() if "spark_grouping_id" in line and "Aggregate" in line]
    assert grouped and all("avg(" not in line and "count" not in line for line in grouped)
    got = {r.visitorid: r for r in f.collect()}
    assert set(got) == {1, None}
    one, none = got[1], got[None]
    assert (one.total_events, one.distinct_items, one.view_items, one.tx_items, one.addtocart_items, one.active_days) == (3, 1, 1, 1, 0, 2)
    assert (one.view_price, one.tx_price, one.addtocart_price, one.avg_inter_event_days) == (2.0, 4.0, None, 1.0)
    assert (none.total_events, none.distinct_items, none.view_price, none.avg_inter_event_days) == (2, 2, 2.0, None)


def test_replaced_features_walk_like_whole_rows():
    """one walk for all replaced features gives the scores of one walk each."""
    rng = np.random.default_rng(0)
    k, trees = 5, []
    for _ in range(4):
        x = rng.integers(0, 40, (800, k)).astype(np.uint8)
        t, e, w = np.sort(rng.integers(1, 300, 800)).astype(float), (rng.random(800) < 0.6).astype(float), np.ones(800)
        feature, cut, left, leaf = grow_tree(x, t, e, w, 10, 5, 3, rng)
        steps = leaf_steps(leaf, t, e, w, 30.0)
        trees.append(Tree(*[np.array(v, dtype=np.int64) for v in (feature, cut, left, steps[0], steps[1])], steps[2], steps[3]))
    trees.append(Tree(*[np.array([v]) for v in (-1, 0, 0, 0, 1)], np.array([0.5]), np.array([0.5])))  # a single leaf
    model = SurvivalForest(trees, [], [f"f{i}" for i in range(k)], 30.0)
    x = rng.integers(0, 40, (300, k)).astype(np.uint8)
    d = x[rng.permutation(300)]
    got = model.risk_permuted(x, d, 9)
    assert np.array_equal(got[0], model.risk(x, 9))
    for j in range(k):
        y = x.copy()
        y[:, j] = d[:, j]
        assert np.array_equal(got[j + 1], model.risk(y, 9))
    assert model.risk_permuted(x[:0], d[:0], 9).shape == (k + 1, 0)


def test_likelihoods_are_computed_in_blocks(spark, monkeypatch):
    """F8: no array of all rows of a batch times all points."""
    most = clv.EVALUATE_ROWS

    def ll(params, x, _tx, _t):
        assert len(x) <= most
        return x[:, None] * params[None, :, 0]
    monkeypatch.setitem(clv.MODELS, "probe", (ll, ["r"], ["frequency", "recency", "T"]))
    data = spark.range(3 * most + 5).coalesce(1).select(F.col("id").cast("double").alias("frequency"), F.lit(1.0).alias("recency"),
                                                        F.lit(2.0).alias("T"), F.lit(2.0).alias("w"))
    got = clv._evaluate(data, "probe", np.log(np.array([[1.0], [3.0]])), 0.0)
    mean = (3 * most + 4) / 2
    assert np.allclose(got, [-mean, -3 * mean])


def test_segment_curve_without_windows(spark):
    """users of different time points, nulls and two labels."""
    rows = [(1, "a", 30.0, 0.5), (1, "a", 60.0, 0.2), (2, "a", 10.0, 0.8), (2, "a", 20.0, None), (3, None, 40.0, 0.0),
            (4, "a", 40.0, 0.4), (4, "b", 40.0, 0.4), (None, "a", 30.0, 0.0)]
    curves = spark.createDataFrame(rows, "visitorid long, business_label string, t double, s double")
    grid = spark.createDataFrame([(0.0,), (10.0,), (15.0,), (100.0,)], "t double")
    out = churn_ml.segment_mean_curve(curves, grid)
    assert "Window" not in _plan(out)
    got = {(r.business_label, r.t): r.mean_survival for r in out.collect()}
    one, four = np.interp([0, 10, 15, 100], [0, 30, 60], [1, 0.5, 0.2]), np.interp([0, 10, 15, 100], [0, 40], [1, 0.4])
    want = [(1 + 1 + 1) / 3, (one[1] + 0.8 + four[1]) / 3, (one[2] + four[2]) / 2, (one[3] + four[3]) / 2]
    assert [got[("a", t)] for t in (0.0, 10.0, 15.0, 100.0)] == pytest.approx(want)
    assert got[("b", 100.0)] == pytest.approx(0.4) and got[(None, 10.0)] == pytest.approx(0.75) and len(got) == 12


def test_model_flags_compute_their_input_once(spark, tmp_path):
    """F20-F22."""
    marks = str(tmp_path)

    def mark(batches):
        open(os.path.join(marks, uuid.uuid4().hex), "w").close()
        yield from batches
    cols = "visitorid long, " + ", ".join(f"{c} double" for c in iforest.MODEL_FEATURES)
    users = spark.range(40).coalesce(1).select(F.col("id").alias("visitorid"), *[(F.col("id") * (i + 1) % 11).cast("double").alias(c)
                                                                              for i, c in enumerate(iforest.MODEL_FEATURES)])
    out = iforest.model_based_flags(users.mapInPandas(mark, cols), n_estimators=5)
    assert out.count() == 40 and out.agg(F.max("iso_score_norm")).first()[0] == 1.0
    assert len(os.listdir(marks)) == 1
