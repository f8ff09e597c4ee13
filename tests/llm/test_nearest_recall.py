"""The calibration target of the nearest-neighbour search, on vectors without clusters."""

import numpy as np
from pyspark.sql import functions as F

from cartwheel.llm import kmeans_tree


def recall(spark, **kw):
    x = np.random.RandomState(4).randn(2000, 12)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(2000)], "vec_id long, embedding array<double>")
    got = kmeans_tree.search(df, F.col("id") % 20 == 0, k=20, leaf_rows=16, **kw).toPandas()
    found = {q: set(g["vec_id"]) for q, g in got.groupby("query_id")}
    shares = []
    for q in range(0, 2000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        shares.append(len(found[q] & set(np.argsort(-s)[:20].tolist())) / 20)
    return np.mean(shares)


def test_default_search_reaches_97_percent(spark):
    """All 100 queries are calibration queries, so their mean recall is the target or more."""
    assert recall(spark) >= 0.97
