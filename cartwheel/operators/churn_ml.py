"""Scores of the churn models (H7, H8, H29, H28): exact AUC, errors of
probabilities, and reports on per-user survival curves. The learners are in
``boosting`` (H6), ``survival_forest`` (H24) and ``importance`` (H9, H26)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.curves import grid_sums
from cartwheel.operators.relational import avg_rank, interp_at


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """H7: ROC AUC = (sum of positive average ranks - P(P+1)/2) / (P N)."""
    r = avg_rank(df.select(F.col(label).cast("int").alias("_y"), F.col(score).alias("_s")), "_s", "_r")
    a = r.agg(F.sum(F.when(F.col("_y") == 1, F.col("_r"))).alias("sr"),
              F.count_if(F.col("_y") == 1).alias("npos"), F.count_if(F.col("_y") == 0).alias("nneg"))
    return a.select(F.try_divide(F.col("sr") - F.col("npos") * (F.col("npos") + 1) / 2.0,
                                 F.col("npos") * F.col("nneg")).alias("auc"),
                    F.col("npos").cast("long").alias("n_pos"), F.col("nneg").cast("long").alias("n_neg"))


def prob_errors(df: DataFrame, label: str, score: str) -> DataFrame:
    """H8: MSE, RMSE, MAE of probabilities against the 0/1 label."""
    e = F.col(score) - F.col(label).cast("double")
    return df.agg(F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def survival_at_day(curves: DataFrame, day: float, key: str = "visitorid", name: str = "survival_30") -> DataFrame:
    """Np.interp(day, t, S) per user, with S(0) = 1."""
    start = curves.select(key).distinct().withColumn("t", F.lit(0.0)).withColumn("s", F.lit(1.0))
    pts = curves.select(key, "t", "s").unionByName(start)
    q = curves.select(key).distinct().withColumn("_day", F.lit(float(day)))
    return interp_at(q, pts, [key], "_day", "t", "s", name).drop("_day")


def segment_mean_curve(curves: DataFrame, grid: DataFrame, label: str = "business_label",
                       key: str = "visitorid") -> DataFrame:
    """H28 (forest): per-user curve interpolated on the grid, mean per label. A user's
    points meet in one row; the users are summed up inside the tasks and never
    multiplied by the grid. Rows without a user are left out."""
    points = curves.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(F.col("t").isNotNull(), F.struct(F.col("t").cast("double").alias("t"), F.col("s").cast("double").alias("s")))))
        .alias("_points"), F.collect_set(F.struct(F.col(label).alias("label"))).alias("_labels"))
    axis = grid.select(F.col("t").cast("double").alias("t")).distinct().agg(F.sort_array(F.collect_list("t")).alias("_axis"))
    users = points.select("_points", F.explode("_labels").alias("_of")).crossJoin(F.broadcast(axis)) \
        .select("_points", "_axis", F.col("_of.label").alias(label))

    def kernel(block: pd.DataFrame) -> np.ndarray:
        x = np.asarray(block["x"].iloc[0], dtype=float)
        s = np.array([np.interp(x, [0.0, *t], np.array([1.0, *v], dtype=float)) for t, v in zip(block["t"], block["s"])])
        known = ~np.isnan(s)
        return np.concatenate([np.where(known, s, 0.0), known], axis=1)
    sums = grid_sums(users, label, {"t": F.col("_points.t"), "s": F.col("_points.s"), "x": F.col("_axis")}, kernel) \
        .crossJoin(F.broadcast(axis.withColumn("_size", F.size("_axis"))))
    at = F.col("pos") % F.col("_size")  # sums come first, then the numbers of users
    return sums.groupBy(label, F.get("_axis", at.cast("int")).alias("t")).agg(
        F.try_divide(F.sum(F.when(F.col("pos") < F.col("_size"), F.col("total"))),
                     F.sum(F.when(F.col("pos") >= F.col("_size"), F.col("total")))).alias("mean_survival"))
