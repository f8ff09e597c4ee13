"""Curves summed up inside the tasks against numpy over the same rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import curves


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def test_density_matches_numpy(spark):
    values = np.random.default_rng(3).normal(2.0, 1.5, 9000)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "a double").repartition(7)
    got = _rows(curves.density_curve(df, "a", 50, 3.0), "grid_id", "x", "density")
    h = len(values) ** -0.2 * values.std(ddof=1)
    x = np.linspace(values.min() - 3 * h, values.max() + 3 * h, 50)
    want = np.exp(-0.5 * ((x[None, :] - values[:, None]) / h) ** 2).sum(axis=0) / (len(values) * h * math.sqrt(2 * math.pi))
    assert [r[0] for r in got] == list(range(50))
    assert np.allclose([r[1] for r in got], x)
    assert np.allclose([r[2] for r in got], want)


@pytest.mark.parametrize("rows,points", [([], 0), ([(None,)], 0), ([(1.0,)], 5), ([(1.0,), (1.0,)], 5)])
def test_density_without_bandwidth(spark, rows, points):
    got = curves.density_curve(spark.createDataFrame(rows, "a double"), "a", 5, 3.0).collect()
    assert len(got) == points
    assert all(r["density"] is None for r in got)


def test_mean_power_curve_with_a_hot_and_a_null_label(spark):
    rng = np.random.default_rng(4)
    data = [("hot" if i % 3 else None if i % 2 else f"k{i % 5}", float(p) if i % 11 else None)
            for i, p in enumerate(rng.uniform(0.1, 3.0, 6000))]
    users = spark.createDataFrame(data, "label string, p double").repartition(5)
    grid = spark.createDataFrame([(float(i), 1.0 - i / 20) for i in range(21)], "t double, s double")
    got = {(r["label"], r["t"]): r["mean_survival"]
           for r in curves.mean_power_curve(users, "label", F.col("p"), grid, "t", "s").collect()}
    labels = {k for k, p in data if p is not None}
    assert set(got) == {(k, float(i)) for k in labels for i in range(21)}
    for k in labels:
        power = np.array([p for q, p in data if q == k and p is not None])
        for i in range(21):
            assert math.isclose(got[(k, float(i))], float(np.mean((1.0 - i / 20) ** power)), rel_tol=1e-9, abs_tol=1e-12)


def test_more_keys_than_a_task_holds(spark):
    n = curves.MAX_KEYS * 2 + 5
    users = spark.range(n * 2).select((F.col("id") % n).alias("label"), F.lit(2.0).alias("p")).coalesce(1)
    grid = spark.createDataFrame([(0.0, 1.0), (1.0, 0.5)], "t double, s double")
    got = curves.mean_power_curve(users, "label", F.col("p"), grid, "t", "s").collect()
    assert len(got) == 2 * n
    assert {(r["t"], r["mean_survival"]) for r in got} == {(0.0, 1.0), (1.0, 0.25)}


def test_rows_are_not_exploded_by_the_grid(spark):
    df = spark.range(40_000).select(F.rand(1).alias("a"))
    plan = curves.density_curve(df, "a", 200, 3.0)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "CartesianProduct" not in plan
