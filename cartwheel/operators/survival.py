"""Churn labelling and SQL-expressible survival analysis (H1-H5, H10-H12,
H15, H17, H22, H23, H27, H28).

Global orderings (Kaplan-Meier products, concordance) use bucketed running
sums / dominance counts from ``relational`` so no single task receives all
users, and no pair of users is ever materialised."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.semantics import MICROS_PER_DAY, frac_days, micros_between
from cartwheel.session import stage
from cartwheel.operators.concordance import concordance_index  # noqa: F401  (H15, part of this operator set)
from cartwheel.operators.curves import mean_power_curve
from cartwheel.operators.relational import (
    describe, ffill_on_grid, interp_at, linspace, qcut_labels, running_sums, trapezoid_area,
)

# Default churn window, columns dropped before modelling,
# excluded identifiers, risk-quartile labels, normal quantile for 95 % CI.
CHURN_WINDOW_DAYS = 50
SPARSE_COLUMNS = ["view_price", "addtocart_price", "tx_price", "avg_inter_event_days"]
NON_FEATURES = ["visitorid", "origin", "last_event", "first_event", "time_to_event", "churned",
                "Unnamed: 0", "business_label", "last_purchase", "recency_days"]
RISK_LABELS = ["Low", "Medium", "High", "Very High"]
Z95 = 1.959963984540054


# ----------------------------------------------------------------------- H1
def time_to_churn(tx: DataFrame, churn_window_days: int = CHURN_WINDOW_DAYS,
                  data_end: DataFrame | None = None) -> DataFrame:
    """Per visitor: churned = 1 when inactive >= window at ``data_end`` (clock
    stops at the last purchase), else censored at data_end. ``data_end`` is a
    one-row frame (default: latest timestamp of ``tx``)."""
    de = data_end if data_end is not None else tx.agg(F.max("timestamp").alias("data_end"))
    g = tx.groupBy("visitorid").agg(F.min("timestamp").alias("origin"), F.max("timestamp").alias("_last"))
    g = g.crossJoin(F.broadcast(de))
    churned = micros_between("_last", "data_end") >= F.lit(churn_window_days * MICROS_PER_DAY)
    end = F.when(churned, F.col("_last")).otherwise(F.col("data_end"))
    return g.select("visitorid", "origin", frac_days(F.col("origin"), end).alias("time_to_event"),
                    churned.cast("int").alias("churned"))


# ----------------------------------------------------------------------- H2
def attach_churn(users: DataFrame, churn: DataFrame) -> DataFrame:
    return users.join(churn, "visitorid", "left").drop(*[c for c in SPARSE_COLUMNS if c in users.columns])


# ----------------------------------------------------------------------- H3
def split_hash(key: str, seed: int = 42):
    """Portable 32-bit hash: first 8 hex digits of md5('<key>:<seed>')."""
    return F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10) \
        .cast("long")


def stratified_split(df: DataFrame, key: str = "visitorid", strata: str = "churned", test_frac: float = 0.2,
                     seed: int = 42, hash_bits_hi: int = 16) -> DataFrame:
    """Exact stratified split: in every stratum the ``ceil(test_frac * n)``
    rows with the largest (hash, key) go to test. The cut is found without a
    per-stratum sort of all rows: counts per (stratum, top hash bits), a
    running count over those buckets, then an exact rank only inside each
    stratum's cut bucket. Adds ``split`` in {'train', 'test'}."""
    d = df.withColumn("_h", split_hash(key, seed)).withColumn("_hb", F.shiftright("_h", 32 - hash_bits_hi))
    n = d.groupBy(strata).agg(F.count(F.lit(1)).alias("_n"))
    n = n.withColumn("_ntrain", F.col("_n") - F.ceil(F.col("_n") * F.lit(test_frac)).cast("long"))
    hb = d.groupBy(strata, "_hb").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(strata).orderBy("_hb").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hb = hb.withColumn("_cum", F.sum("_c").over(w)).join(n, strata)
    cut = hb.where((F.col("_cum") - F.col("_c") < F.col("_ntrain")) & (F.col("_cum") >= F.col("_ntrain"))) \
        .select(strata, F.col("_hb").alias("_cut"), (F.col("_ntrain") - (F.col("_cum") - F.col("_c"))).alias("_need"))
    d = d.join(cut, strata, "left")
    in_cut = d.where(F.col("_hb") == F.col("_cut"))
    wr = Window.partitionBy(strata).orderBy("_h", key)
    in_cut = in_cut.withColumn("split", F.when(F.row_number().over(wr) <= F.col("_need"), "train").otherwise("test"))
    rest = d.where(F.col("_cut").isNull() | (F.col("_hb") != F.col("_cut"))) \
        .withColumn("split", F.when(F.col("_cut").isNull(), F.lit("test"))
                    .when(F.col("_hb") < F.col("_cut"), "train").otherwise("test"))
    return in_cut.unionByName(rest).drop("_h", "_hb", "_cut", "_need")


def class_balance(df: DataFrame, strata: str = "churned") -> DataFrame:
    """H4: class shares per split."""
    c = df.groupBy("split", strata).agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("split")))


def feature_columns(df: DataFrame) -> list[str]:
    """H5: model features = numeric columns not excluded."""
    num = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [c for c, t in df.dtypes if c not in NON_FEATURES and t in num and c not in ("split",)]


# ---------------------------------------------------------------------- H10
def standardize(train: DataFrame, apply_to: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Fit mean / population std on ``train`` (NULL -> 0 first), apply to
    ``apply_to``; a zero-variance column scales to 0. The statistics are one
    broadcast row."""
    st = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols]) \
        .agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    out = apply_to.crossJoin(F.broadcast(st))

    def scaled(c):
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        return F.when(F.col(f"_sd_{c}") > 0, (x - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}")).otherwise(F.lit(0.0))
    names = {c + suffix for c in cols}
    keep = [F.col(c) for c in apply_to.columns if c not in names]
    return out.select(*keep, *[scaled(c).alias(c + suffix) for c in cols])


# ---------------------------------------------------------------- H11 / H12
def kaplan_meier(df: DataFrame, duration: str = "duration", event: str = "event", by: list[str] | None = None,
                 z: float = Z95) -> DataFrame:
    """Kaplan-Meier table per group: timeline (0 and every distinct
    duration), removed, observed, censored, at_risk, survival and the
    exponential-Greenwood 95 % band."""
    keys = by or []
    base = df.select(*keys, F.col(duration).cast("double").alias("timeline"),
                     F.col(event).cast("long").alias("_e"))
    zero = base.select(*keys).distinct().select(*keys, F.lit(0.0).alias("timeline"),
                                                F.lit(0).cast("long").alias("removed"),
                                                F.lit(0).cast("long").alias("observed"))
    ev = base.groupBy(*keys, "timeline").agg(F.count(F.lit(1)).alias("removed"), F.sum("_e").alias("observed"))
    ev = ev.unionByName(zero).groupBy(*keys, "timeline") \
        .agg(F.sum("removed").alias("removed"), F.sum("observed").alias("observed"))
    ev = running_sums(ev, keys, "timeline", ["removed"], descending=True, prefix="_risk_")
    ev = stage(ev.withColumnRenamed("_risk_removed", "at_risk"))
    d, n = F.col("observed"), F.col("at_risk")
    ev = ev.withColumn("_lf", F.when(d < n, F.log(F.lit(1.0) - d / n)).otherwise(F.lit(0.0))) \
        .withColumn("_zf", (d >= n).cast("long") * (d > 0).cast("long")) \
        .withColumn("_gw", F.when(d < n, d / (n * (n - d))).otherwise(F.lit(0.0)))
    ev = running_sums(ev, keys, "timeline", ["_lf", "_zf", "_gw"], prefix="_c")
    s = F.when(F.col("_c_zf") > 0, F.lit(0.0)).otherwise(F.exp(F.col("_c_lf")))
    ev = ev.withColumn("survival", s)
    v = F.log(F.col("survival"))
    lo = F.exp(-F.exp(F.log(-v) + F.lit(z) * F.sqrt(F.col("_c_gw")) / v))
    hi = F.exp(-F.exp(F.log(-v) - F.lit(z) * F.sqrt(F.col("_c_gw")) / v))
    edge = (F.col("survival") >= 1.0) | (F.col("survival") <= 0.0)
    ev = ev.withColumn("ci_lower", F.when(edge, F.col("survival")).otherwise(lo)) \
        .withColumn("ci_upper", F.when(edge, F.col("survival")).otherwise(hi))
    return ev.select(*keys, "timeline", "removed", "observed", (F.col("removed") - F.col("observed")).alias("censored"),
                     "at_risk", "survival", "ci_lower", "ci_upper")


# ------------------------------------------------------------ H17 / H27 / H28
def survival_grid(spark, start: float = 0.0, stop: float = 150.0, num: int = 151) -> DataFrame:
    return linspace(spark, start, stop, num, "t")


def curves_from_baseline(users: DataFrame, baseline: DataFrame, risk: str, grid: DataFrame,
                         by: list[str] | None = None) -> DataFrame:
    """Per-user curve S_i(t) = S0(t) ** exp(risk_i) on a time grid, with S0 a
    step function (``timeline``, ``survival``) forward-filled onto the grid
    (P28). Users x grid points is the intended output size."""
    keys = by or []
    g = baseline.select(*keys).distinct().crossJoin(F.broadcast(grid.select("t"))) if keys else grid.select("t")
    s0 = ffill_on_grid(g, baseline.select(*keys, F.col("timeline").alias("t"), "survival"), keys, "t",
                       "survival", "s0")
    s0 = s0.withColumn("s0", F.when(F.col("t") < 0, F.lit(1.0)).otherwise(F.col("s0")))
    u = users.select("visitorid", *[c for c in ["business_label"] if c in users.columns], *keys, risk)
    j = u.join(s0, keys) if keys else u.crossJoin(F.broadcast(s0))
    return j.withColumn("s", F.pow(F.col("s0"), F.exp(F.col(risk)))).drop("s0")


def mean_curve_from_baseline(users: DataFrame, baseline: DataFrame, risk: str, grid: DataFrame,
                             label: str = "business_label") -> DataFrame:
    """Mean of the curves S0(t) ** exp(risk) per label on the grid, summed up
    inside the tasks; users are not multiplied by the grid."""
    s0 = ffill_on_grid(grid.select("t"), baseline.select(F.col("timeline").alias("t"), "survival"), [], "t", "survival", "s0")
    s0 = s0.withColumn("s0", F.when(F.col("t") < 0, F.lit(1.0)).otherwise(F.col("s0")))
    return mean_power_curve(users, label, F.exp(F.col(risk)), s0, "t", "s0")


def mean_curve_by(curves: DataFrame, label: str = "business_label", t: str = "t", s: str = "s") -> DataFrame:
    """Mean curve per label on the grid."""
    return curves.groupBy(label, t).agg(F.avg(s).alias("mean_survival"))


def expected_lifetime(curves: DataFrame, key: str = "visitorid", t: str = "t", s: str = "s") -> DataFrame:
    """Trapezoid area under each user's curve."""
    return trapezoid_area(curves, [key], t, s, "expected_lifetime")


def expected_lifetime_from_baseline(users: DataFrame, baseline: DataFrame, risk: str, grid: DataFrame) -> DataFrame:
    """H27 for curves S0(t) ** exp(risk): the trapezoid area under each user's
    curve as one expression over the baseline's grid values, which are a single
    broadcast row. Users are neither multiplied by the grid nor shuffled."""
    s0 = ffill_on_grid(grid.select("t"), baseline.select(F.col("timeline").alias("t"), "survival"), [], "t", "survival", "s0")
    s0 = s0.agg(F.sort_array(F.collect_list(F.struct("t", "s0"))).alias("_grid"))
    at = lambda i: F.get(F.col("_grid"), i)
    power = lambda i: F.pow(at(i)["s0"], F.exp(F.col(risk)))
    area = F.aggregate(F.sequence(F.lit(1), F.size("_grid") - 1), F.lit(0.0), lambda acc, i:
                       acc + (at(i)["t"] - at(i - 1)["t"]) * (power(i) + power(i - 1)) / 2.0)
    return users.crossJoin(F.broadcast(s0)).select("visitorid", area.alias("expected_lifetime"))


def interpolate_curves(points: DataFrame, curves: DataFrame, key: list[str], x: str, t: str, s: str) -> DataFrame:
    """P27 helper: ``np.interp`` of per-key curves at the points."""
    return interp_at(points, curves, key, x, t, s, "s")


def survival_at(curves: DataFrame, key: list[str], day: float, t: str = "timeline", s: str = "survival",
                name: str = "survival_at") -> DataFrame:
    """``np.interp(day, t, s)`` for every key (e.g. survival_30)."""
    pts = curves.select(*key).distinct().withColumn("_day", F.lit(float(day)))
    return interp_at(pts, curves, key, "_day", t, s, name).drop("_day")


# ---------------------------------------------------------------- H22 / H23
def risk_summary(df: DataFrame, score: str = "risk_score") -> DataFrame:
    return describe(df, [score])


def risk_quartiles(df: DataFrame, score: str = "risk_score") -> DataFrame:
    return qcut_labels(df, score, [0.25, 0.5, 0.75], RISK_LABELS, "risk_segment")


def standin_risk_score(df: DataFrame, name: str = "risk_score") -> DataFrame:
    """Deterministic stand-in for a fitted partial hazard (oracle queries):
    0.1 * events_per_active_day + 0.01 * recency_days - 0.001 * tenure_days."""
    return df.withColumn(name, F.lit(0.1) * F.col("events_per_active_day") + F.lit(0.01) * F.col("recency_days")
                         - F.lit(0.001) * F.col("tenure_days"))
