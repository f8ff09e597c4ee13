"""Curves that sum over all rows at every point of a fixed grid.

Rows never meet the grid in an exploded table: each task adds its rows up in one
vector per key and hands on that vector alone, so what is shuffled depends on the
number of tasks, keys and grid points and not on the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows evaluated at a time, and keys a task holds before it hands on what it has.
BLOCK_ROWS, MAX_KEYS = 4096, 1024


def grid_sums(rows: DataFrame, key: str | None, inputs: dict[str, Column],
              kernel: Callable[[pd.DataFrame], np.ndarray]) -> DataFrame:
    """(key, pos, total, n): the kernel's values summed over the rows of each key
    at each grid position, and the rows behind the sum. ``kernel`` takes a block
    of the ``inputs`` columns and returns rows x grid values. Rows with a null
    input are left out; null is a key of its own, ``key=None`` is one key for all."""
    label = F.lit(0) if key is None else F.col(key)
    d = rows.select(label.alias("_key"), *[c.alias(n) for n, c in inputs.items()])
    for n in inputs:
        d = d.where(F.col(n).isNotNull())
    schema = T.StructType([T.StructField("_key", d.schema["_key"].dataType), T.StructField("_sum", T.ArrayType(T.DoubleType())),
                           T.StructField("_n", T.LongType())])

    def frame(held: dict) -> pd.DataFrame:
        return pd.DataFrame({"_key": pd.Series(list(held), dtype=object), "_sum": [v[0] for v in held.values()],
                             "_n": [v[1] for v in held.values()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for k, part in batch.groupby("_key", dropna=False, sort=False):
                k = None if pd.isna(k) else k
                for at in range(0, len(part), BLOCK_ROWS):
                    values = kernel(part.iloc[at:at + BLOCK_ROWS])
                    before = held.get(k, (0.0, 0))
                    held[k] = (before[0] + values.sum(axis=0), before[1] + len(values))
                if len(held) >= MAX_KEYS:
                    yield frame(held)
                    held = {}
        if held:
            yield frame(held)
    parts = d.mapInPandas(add, schema)
    out = parts.select("_key", "_n", F.posexplode("_sum").alias("pos", "_v")) \
        .groupBy("_key", "pos").agg(F.sum("_v").alias("total"), F.sum("_n").alias("n"))
    return out.drop("_key") if key is None else out.withColumnRenamed("_key", key)


def mean_power_curve(users: DataFrame, label: str, power: Column, grid: DataFrame, t: str, s: str) -> DataFrame:
    """(label, t, mean_survival): the mean over each label's users of
    ``s(t) ** power``, the curve of a user whose hazard is ``power`` times the
    baseline's. ``grid`` is a curve of bounded size; it rides along as one
    broadcast row. Users without a power are left out."""
    row = grid.agg(F.sort_array(F.collect_list(F.struct(F.col(t).cast("double").alias("t"),
                                                        F.col(s).cast("double").alias("s")))).alias("_grid"))
    u = users.select(F.col(label), power.alias("_power")).crossJoin(F.broadcast(row))

    def kernel(block: pd.DataFrame) -> np.ndarray:
        base = np.asarray(block["s"].iloc[0], dtype=float)
        return base[None, :] ** block["power"].to_numpy(dtype=float)[:, None]
    sums = grid_sums(u, label, {"power": F.col("_power"), "s": F.col("_grid.s")}, kernel)
    return sums.crossJoin(F.broadcast(row)) \
        .select(label, F.get("_grid", F.col("pos"))["t"].alias("t"), (F.col("total") / F.col("n")).alias("mean_survival"))


def density_curve(values: DataFrame, v: str, gridsize: int, cut: float) -> DataFrame:
    """(grid_id, x, density): Gaussian kernel density of the non-null values, with
    the bandwidth n^-1/5 * std, on ``gridsize`` points from min - cut * bandwidth to
    max + cut * bandwidth. No values give no rows; one value, or equal values only,
    have no bandwidth and give null densities."""
    d = values.select(F.col(v).cast("double").alias("v")).where(F.col("v").isNotNull())
    st = d.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("mn"),
               F.max("v").alias("mx")).where(F.col("n") > 0)
    st = st.withColumn("h", F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("sd")) \
        .withColumn("lo", F.col("mn") - F.lit(cut) * F.col("h")) \
        .withColumn("step", (F.col("mx") - F.col("mn") + F.lit(2 * cut) * F.col("h")) / F.lit(gridsize - 1))

    def kernel(block: pd.DataFrame) -> np.ndarray:
        lo, step, h = (float(block[c].iloc[0]) for c in ("lo", "step", "h"))
        x = lo + np.arange(gridsize) * step
        return np.exp(-0.5 * ((x[None, :] - block["v"].to_numpy()[:, None]) / h) ** 2)
    spread = d.crossJoin(F.broadcast(st.where(F.col("h") > 0)))
    sums = grid_sums(spread, None, {c: F.col(c) for c in ("v", "lo", "step", "h")}, kernel)
    points = st.withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))))
    return points.join(F.broadcast(sums.select("pos", "total")), "pos", "left") \
        .select(F.col("pos").cast("long").alias("grid_id"), (F.col("lo") + F.col("pos") * F.col("step")).alias("x"),
                F.try_divide("total", F.col("n") * F.col("h") * F.lit(float(np.sqrt(2 * np.pi)))).alias("density"))
