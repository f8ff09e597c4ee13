"""Discount-policy simulation.

The Monte-Carlo net gain of a segment collapses algebraically: users outside
the segment contribute 0, so with A = sum(n*m), B = sum(n*m*(1-s)),
C = sum(baseline) over the segment's users,

    gain = (1 + pl) * (A - (1 - cr) * B) - C - X * (1 + pl) * A.

One aggregation per segment therefore replaces one pass over all users per
(draw, discount, segment). The grid segment x discount x draw is built by
exploding parameter-sized arrays (no data cross product)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.operators.relational import describe, quantile

# Discount grid, simulation size and seed, lift exponents.
DISCOUNT_START, DISCOUNT_STOP, DISCOUNT_NUM = 0.01, 0.20, 20
N_SIMULATIONS, SEED = 1000, 42
PURCHASE_EXP_MIN, PURCHASE_EXP_MAX = 0.85, 1.05
CHURN_LOW, CHURN_HIGH = 0.8, 1.2
K_SCALE, C_SCALE, M_SCALE = 1.3, 0.6, 0.12

# Segment parameters published with the reference's simulation.
PUBLISHED_SEGMENT_PARAMS = {
    "At Risk": {"k": 1.3, "c": 0.5960799026972933, "m": 0.07820241224389889},
    "Loyal Customers": {"k": 0.6131388114528963, "c": 0.0, "m": 0.03688379545844122},
    "Potential Loyalists": {"k": 1.1532779416581898, "c": 0.5821057378090623, "m": 0.06937624386565303},
}


def discount_grid() -> list[float]:
    return [float(x) for x in np.linspace(DISCOUNT_START, DISCOUNT_STOP, DISCOUNT_NUM)]


def uniform_draws(n: int = N_SIMULATIONS, seed: int = SEED) -> list[tuple[int, float, float]]:
    """The seeded stream the reference consumes: per simulation one uniform
    for the purchase lift, then one for the churn reduction (seed reset per
    call, so every discount and segment sees the same draws)."""
    r = np.random.RandomState(seed).random_sample(2 * n)
    return [(i, float(r[2 * i]), float(r[2 * i + 1])) for i in range(n)]


def draws_frame(spark: SparkSession, n: int = N_SIMULATIONS, seed: int = SEED) -> DataFrame:
    return spark.createDataFrame(uniform_draws(n, seed), "sim_id int, u1 double, u2 double")


def _with_draws(df: DataFrame, draws: DataFrame) -> DataFrame:
    """Attach every draw to every row: the draws are folded into one array row
    (size bounded by the number of simulations) and exploded."""
    arr = draws.agg(F.sort_array(F.collect_list(F.struct("sim_id", "u1", "u2"))).alias("_draws"))
    return df.crossJoin(F.broadcast(arr)).select("*", F.inline("_draws")).drop("_draws")


def baseline_clv(users: DataFrame) -> DataFrame:
    """baseline_clv = pred_no_purchase * pred_money_each_purchase * survival_prob."""
    return users.withColumn("baseline_clv", F.col("pred_no_purchase") * F.col("pred_money_each_purchase")
                            * F.col("survival_prob"))


def baseline_describe(users: DataFrame) -> DataFrame:
    return describe(baseline_clv(users), ["baseline_clv"])


def segment_parameters(users: DataFrame, label: str = "business_label") -> DataFrame:
    """Churn risk, purchase frequency, mean CLV and k, c, m per segment
    (maxima over the small per-segment table; a share of a maximum of 0 is 0, as
    when no user is at risk within the forecast)."""
    u = baseline_clv(users)
    s = u.groupBy(label).agg((F.lit(1.0) - F.avg("survival_prob")).alias("churn_risk"),
                             F.avg("pred_no_purchase").alias("purchase_freq"),
                             F.avg("baseline_clv").alias("clv"))
    whole = Window.partitionBy()
    share = {c: F.coalesce(F.try_divide(F.col(c), F.max(c).over(whole)), F.lit(0.0)) for c in ("churn_risk", "purchase_freq")}
    return s.withColumn("k", share["churn_risk"] * K_SCALE) \
        .withColumn("c", (F.lit(1.0) - share["purchase_freq"]) * C_SCALE) \
        .withColumn("m", F.col("churn_risk") * M_SCALE)


def published_parameters(spark: SparkSession, label: str = "business_label") -> DataFrame:
    """The published k, c, m (``PUBLISHED_SEGMENT_PARAMS``) as a frame."""
    rows = [(s, p["k"], p["c"], p["m"]) for s, p in PUBLISHED_SEGMENT_PARAMS.items()]
    return spark.createDataFrame(rows, f"{label} string, k double, c double, m double")


def policy_inputs_fitted(users: DataFrame, clv: DataFrame, survival: DataFrame) -> DataFrame:
    """The simulation's inputs from the fitted models: expected purchases and
    money per purchase (``clv``) and survival at day 30 (``survival``)."""
    c = clv.select("visitorid", F.col("predicted_purchases_bgf").alias("pred_no_purchase"),
                   F.col("predicted_avg_transaction").alias("pred_money_each_purchase"))
    s = survival.select("visitorid", F.col("survival_30").alias("survival_prob"))
    return users.join(c, "visitorid", "left").join(s, "visitorid", "left")


def lift_ranges(params: DataFrame, discounts: list[float] | None = None) -> DataFrame:
    """Purchase lift k*X^0.85 .. k*X^1.05 and churn reduction
    0.8 .. 1.2 x logistic(c (X - m)) per (segment, discount)."""
    xs = discounts or discount_grid()
    g = params.withColumn("discount", F.explode(F.array(*[F.lit(x) for x in xs])))
    x = F.col("discount")
    center = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("c") * (x - F.col("m"))))
    return g.withColumn("purchase_min", F.col("k") * F.pow(x, PURCHASE_EXP_MIN)) \
        .withColumn("purchase_max", F.col("k") * F.pow(x, PURCHASE_EXP_MAX)) \
        .withColumn("churn_min", center * CHURN_LOW).withColumn("churn_max", center * CHURN_HIGH)


def segment_sums(users: DataFrame, label: str = "business_label") -> DataFrame:
    """A, B, C of the collapsed gain over users with complete predictions."""
    u = baseline_clv(users).where(F.col("pred_no_purchase").isNotNull()
                                  & F.col("pred_money_each_purchase").isNotNull()
                                  & F.col("survival_prob").isNotNull())
    nm = F.col("pred_no_purchase") * F.col("pred_money_each_purchase")
    return u.groupBy(label).agg(F.sum(nm).alias("seg_a"),
                                F.sum(nm * (F.lit(1.0) - F.col("survival_prob"))).alias("seg_b"),
                                F.sum("baseline_clv").alias("seg_c"))


def simulate_gains(users: DataFrame, draws: DataFrame, params: DataFrame | None = None,
                   segments: list[str] | None = None, label: str = "business_label") -> DataFrame:
    """X4 + X6: net gain per (segment, discount, sim_id)."""
    p = params if params is not None else segment_parameters(users, label)
    if segments is not None:
        p = p.where(F.col(label).isin(segments))
    lr = lift_ranges(p.select(label, "k", "c", "m"))
    sums = segment_sums(users, label)
    g = lr.join(sums, label, "left").na.fill(0.0, subset=["seg_a", "seg_b", "seg_c"])
    g = _with_draws(g, draws)
    pl = F.col("purchase_min") + (F.col("purchase_max") - F.col("purchase_min")) * F.col("u1")
    cr = F.col("churn_min") + (F.col("churn_max") - F.col("churn_min")) * F.col("u2")
    one = F.lit(1.0)
    a, b, c = F.col("seg_a"), F.col("seg_b"), F.col("seg_c")
    gain = (one + pl) * (a - (one - cr) * b) - c - F.col("discount") * (one + pl) * a
    return g.select(F.col(label).alias("segment"), "discount", "sim_id", gain.alias("gain"))


def optimization_table(gains: DataFrame) -> DataFrame:
    """Per (segment, discount) mean, median, P(gain > 0), 5th and 95th
    percentiles (linear interpolation)."""
    q = quantile("gain", [0.5, 0.05, 0.95])
    return gains.groupBy("segment", "discount").agg(
        F.avg("gain").alias("mean_gain"), q.alias("_q"),
        F.avg((F.col("gain") > 0).cast("double")).alias("prob_positive")) \
        .select("segment", "discount", "mean_gain", F.col("_q")[0].alias("median_gain"), "prob_positive",
                F.col("_q")[1].alias("worst_5pct"), F.col("_q")[2].alias("best_95pct"))


def best_discount(table: DataFrame, metric: str = "mean_gain") -> DataFrame:
    """Argmax of ``metric`` per segment, first (smallest) discount on ties."""
    return table.groupBy("segment").agg(
        F.max_by(F.struct(*[F.col(c) for c in table.columns if c != "segment"]),
                 F.struct(F.col(metric), -F.col("discount"))).alias("_b")).select("segment", "_b.*")


def recommendations(table: DataFrame) -> DataFrame:
    """Best row per segment by (prob_positive desc, mean_gain desc)."""
    w = Window.partitionBy("segment").orderBy(F.desc("prob_positive"), F.desc("mean_gain"), F.asc("discount"))
    return table.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1) \
        .select("segment", F.col("discount").alias("best_discount"), "mean_gain", "prob_positive",
                "worst_5pct", "best_95pct")


def gain_histogram(gains: DataFrame, table: DataFrame, bins: int = 40) -> DataFrame:
    """40-bin histogram of the draws at each segment's best discount."""
    best = best_discount(table).select("segment", F.col("discount").alias("_bd"))
    g = gains.join(best, "segment").where(F.col("discount") == F.col("_bd"))
    b = g.groupBy("segment").agg(F.min("gain").alias("_lo"), F.max("gain").alias("_hi"))
    b = b.select("segment", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                 F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    idx = F.least(F.floor((F.col("gain") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(bins)).cast("long"),
                  F.lit(bins - 1))
    counts = g.join(b, "segment").groupBy("segment", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = b.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))) \
        .withColumn("bin", F.col("bin").cast("long"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return grid.join(counts, ["segment", "bin"], "left").select(
        "segment", "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def baseline_by_segment(users: DataFrame, label: str = "business_label") -> DataFrame:
    """X10."""
    return baseline_clv(users).groupBy(label).agg(F.avg("baseline_clv").alias("mean_baseline_clv"))


def sensitivity(table: DataFrame) -> DataFrame:
    """X11: discount -> mean gain per segment."""
    return table.select("segment", "discount", "mean_gain")


def policy_inputs_standin(users: DataFrame, horizon_days: int = 30, survival_scale: float = 180.0) -> DataFrame:
    """Deterministic stand-ins for model outputs (used when the CLV / survival
    models are not run): purchases over the horizon from the observed
    purchase rate, money per purchase = mean transaction price, survival =
    1 / (1 + recency / scale)."""
    return users.withColumn("pred_no_purchase",
                            F.col("total_tx") / F.greatest(F.col("tenure_days"), F.lit(1)) * F.lit(float(horizon_days))) \
        .withColumn("pred_money_each_purchase", F.col("tx_price")) \
        .withColumn("survival_prob", F.lit(1.0) / (F.lit(1.0) + F.col("recency_days") / F.lit(survival_scale)))
