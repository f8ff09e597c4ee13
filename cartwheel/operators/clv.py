"""Customer lifetime value (C1-C16): BG/NBD, Pareto/NBD and Gamma-Gamma.

Fitting is distributed: the per-customer summary is compressed to distinct
(frequency, recency, T) [or (frequency, monetary)] with weights, and every
optimizer iteration is ONE Spark pass that evaluates the mean negative
log-likelihood at all finite-difference points around the current iterate
(partial sums per partition in ``mapInPandas``, then a sum). A damped Newton
step over the <= 4 log-parameters runs on the driver. Time is rescaled by
10 / max(T) while fitting (alpha, beta are scaled back), and the penalty is
``penalizer * sum(params ** 2)`` on the rescaled parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.semantics import add_days, frac_days, log1p0
from cartwheel.functions.special import gammaln, hyp2f1_series, log_hyp2f1_next, logsubexp
from cartwheel.operators.curves import density_curve
from cartwheel.operators.relational import avg_rank, describe

# Default horizons and penalizers of the CLV stage.
HOLDOUT_DAYS, FUTURE_DAYS = 15, 15
PEN_BGF, PEN_PARETO, PEN_GG = 0.5, 0.5, 0.0
KDE_GRID, KDE_CUT = 200, 3.0
TIME_SCALE_NUMERATOR = 10.0
# Rows whose likelihoods are computed at a time: their arrays stay in the cache.
EVALUATE_ROWS = 256


# ---------------------------------------------------------------- C1 / C2
def calibration_split(tx_money: DataFrame, holdout_days: int = HOLDOUT_DAYS, time_col: str = "time"):
    """(calibration rows, holdout rows, one-row frame with calibration_end)."""
    end = tx_money.agg(add_days(F.max(time_col), -holdout_days).alias("calibration_end"))
    t = tx_money.crossJoin(F.broadcast(end))
    calib = t.where(F.col(time_col) <= F.col("calibration_end")).drop("calibration_end")
    hold = t.where(F.col(time_col) > F.col("calibration_end")).drop("calibration_end")
    return calib, hold, end


def clv_summary(calib: DataFrame, end: DataFrame, visitor_col: str = "visitorid", time_col: str = "time",
                monetary_col: str = "monetary") -> DataFrame:
    """frequency = purchases - 1, recency and T in fractional days,
    monetary_value = mean of all calibration purchases; recency > 0 only."""
    g = calib.groupBy(visitor_col).agg(F.count(F.lit(1)).alias("_n"), F.min(time_col).alias("_first"),
                                      F.max(time_col).alias("_last"), F.avg(monetary_col).alias("monetary_value"))
    g = g.crossJoin(F.broadcast(end))
    s = g.select(F.col(visitor_col).alias("visitorid"),
                 F.greatest(F.col("_n") - 1, F.lit(0)).cast("long").alias("frequency"),
                 frac_days("_first", "_last").alias("recency"),
                 frac_days("_first", "calibration_end").alias("T"), "monetary_value")
    return s.where(F.col("recency") > 0)


# ------------------------------------------------------------ log-likelihoods
def _bgnbd_ll(P, x, tx, T):
    r, al, a, b = (P[:, i][None, :] for i in range(4))
    x, tx, T = x[:, None], tx[:, None], T[:, None]
    A1 = gammaln(r + x) - gammaln(r) + r * np.log(al)
    A2 = gammaln(a + b) + gammaln(b + x) - gammaln(b) - gammaln(a + b + x)
    A3 = -(r + x) * np.log(al + T)
    A4 = np.log(a) - np.log(b + np.clip(x, 1, None) - 1) - (r + x) * np.log(tx + al)
    A4 = np.where(x > 0, A4, -np.inf)
    return A1 + A2 + np.logaddexp(A3, A4)


def _pareto_log_a0(r, al, s, be, x, tx, T):
    """log of the integral in the Pareto/NBD likelihood, as a difference of two
    hypergeometric terms that are kept as logarithms."""
    lo = np.minimum(al, be)
    hi = np.maximum(al, be)
    d = np.where(al < be, r + x, s + 1.0)
    rsx = r + s + x
    dif = hi - lo
    return logsubexp(-rsx * np.log(hi + tx) + log_hyp2f1_next(rsx, d, dif / (hi + tx)),
                     -rsx * np.log(hi + T) + log_hyp2f1_next(rsx, d, dif / (hi + T)))


def _pareto_ll(P, x, tx, T):
    r, al, s, be = (P[:, i][None, :] for i in range(4))
    x, tx, T = x[:, None], tx[:, None], T[:, None]
    A1 = gammaln(r + x) - gammaln(r) + r * np.log(al) + s * np.log(be)
    la0 = _pareto_log_a0(r, al, s, be, x, tx, T)
    A2 = np.logaddexp(-(r + x) * np.log(al + T) - s * np.log(be + T), np.log(s) + la0 - np.log(r + s + x))
    return A1 + A2


def _gg_ll(P, x, m, _unused=None):
    p, q, v = (P[:, i][None, :] for i in range(3))
    x, m = x[:, None], m[:, None]
    return (gammaln(p * x + q) - gammaln(p * x) - gammaln(q) + q * np.log(v) + (p * x - 1) * np.log(m)
            + (p * x) * np.log(x) - (p * x + q) * np.log(x * m + v))


MODELS = {
    "bgnbd": (_bgnbd_ll, ["r", "alpha", "a", "b"], ["frequency", "recency", "T"]),
    "pareto": (_pareto_ll, ["r", "alpha", "s", "beta"], ["frequency", "recency", "T"]),
    "gamma_gamma": (_gg_ll, ["p", "q", "v"], ["frequency", "monetary_value"]),
}


@dataclass
class FitResult:
    model: str
    params: dict
    nll: float
    iterations: int
    scale: float = 1.0
    history: list = field(default_factory=list)
    converged: bool = True


def _points(center: np.ndarray, h: float) -> np.ndarray:
    """center, center +- h e_i, center + h(+-e_i +- e_j) for i < j."""
    d = len(center)
    pts = [center]
    for i in range(d):
        for sgn in (1, -1):
            p = center.copy()
            p[i] += sgn * h
            pts.append(p)
    for i in range(d):
        for j in range(i + 1, d):
            for si, sj in ((1, 1), (1, -1), (-1, 1), (-1, -1)):
                p = center.copy()
                p[i] += si * h
                p[j] += sj * h
                pts.append(p)
    return np.array(pts)


def _derivatives(f: np.ndarray, d: int, h: float):
    f0 = f[0]
    g = np.zeros(d)
    H = np.zeros((d, d))
    k = 1
    fp, fm = np.zeros(d), np.zeros(d)
    for i in range(d):
        fp[i], fm[i] = f[k], f[k + 1]
        k += 2
    g = (fp - fm) / (2 * h)
    for i in range(d):
        H[i, i] = (fp[i] - 2 * f0 + fm[i]) / (h * h)
    for i in range(d):
        for j in range(i + 1, d):
            fpp, fpm, fmp, fmm = f[k:k + 4]
            k += 4
            H[i, j] = H[j, i] = (fpp - fpm - fmp + fmm) / (4 * h * h)
    return f0, g, H


def _evaluate(data: DataFrame, model: str, logP: np.ndarray, penalizer: float) -> np.ndarray:
    """One Spark pass: mean NLL + penalty at every row of ``logP``."""
    ll_fn, _, cols = MODELS[model]
    params = np.exp(logP)
    k = len(params)

    def part(it):
        acc = np.zeros(k)
        wsum = 0.0
        for pdf in it:
            if len(pdf) == 0:
                continue
            w = pdf["w"].to_numpy(dtype=float)
            args = [pdf[c].to_numpy(dtype=float) for c in cols]
            with np.errstate(all="ignore"):
                ll = np.concatenate([ll_fn(params, *[v[at:at + EVALUATE_ROWS] for v in args]) for at in range(0, len(w), EVALUATE_ROWS)])
            acc += w @ ll
            wsum += w.sum()
        yield pd.DataFrame({"point": np.arange(k), "ll": acc, "w": np.full(k, wsum)})

    sums = data.mapInPandas(part, "point long, ll double, w double") \
        .groupBy("point").agg(F.sum("ll").alias("ll"), F.sum("w").alias("w")).collect()
    out = np.zeros(k)
    for r in sums:
        out[r["point"]] = -r["ll"] / r["w"] if r["w"] > 0 else np.inf
    return out + penalizer * (params ** 2).sum(axis=1)


def compress(summary: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct covariate tuples with their multiplicity as weight."""
    return summary.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("w"))


def fit(summary: DataFrame, model: str, penalizer: float, max_iter: int = 200, h: float = 1e-4,
        tol: float = 1e-7, init: float = 0.1) -> FitResult:
    """Penalised maximum likelihood (C3 / C4 / C5); a point whose likelihood is
    not finite is rejected, and a fit that doesn't converge raises."""
    _, names, cols = MODELS[model]
    data = summary
    scale = 1.0
    if model in ("bgnbd", "pareto"):
        max_t = summary.agg(F.max("T")).first()[0]
        scale = TIME_SCALE_NUMERATOR / max_t
        data = summary.select(F.col("frequency").cast("double").alias("frequency"),
                              (F.col("recency") * scale).alias("recency"), (F.col("T") * scale).alias("T"))
    else:
        data = summary.select(F.col("frequency").cast("double").alias("frequency"), "monetary_value")
    data = compress(data, cols).repartition(max(1, summary.sparkSession.sparkContext.defaultParallelism)).persist()
    d = len(names)
    x = np.full(d, init)
    lam = 1e-6
    f0, g, H = _derivatives(_evaluate(data, model, _points(x, h), penalizer), d, h)
    hist = [f0]
    if not np.isfinite(f0):
        data.unpersist()
        raise ArithmeticError(f"{model}: the likelihood is not finite at the start values")
    it, done = 0, False
    for it in range(1, max_iter + 1):
        A = H + lam * np.eye(d)
        try:
            w, V = np.linalg.eigh(A)
            w = np.maximum(w, 1e-8 + lam)
            step = -(V @ ((V.T @ g) / w))
        except np.linalg.LinAlgError:
            step = -g
        step = np.clip(step, -2.0, 2.0)
        x_new = x + step
        f1, g1, H1 = _derivatives(_evaluate(data, model, _points(x_new, h), penalizer), d, h)
        if np.isfinite(f1) and f1 <= f0:
            converged = abs(f0 - f1) < tol * max(1.0, abs(f0))
            x, f0, g, H = x_new, f1, g1, H1
            hist.append(f0)
            lam = max(lam / 10, 1e-9)
            if converged or np.max(np.abs(g)) < tol:
                done = True
                break
        else:
            lam *= 10
            if lam > 1e8:  # no descent left: a minimum if the slope says so
                done = np.max(np.abs(g)) < 1e-4 * max(1.0, abs(f0))
                break
    data.unpersist()
    if not done:
        raise RuntimeError(f"{model}: the fit has not converged after {it} iterations")
    p = dict(zip(names, np.exp(x)))
    for k in ("alpha", "beta"):
        if k in p:
            p[k] = p[k] / scale
    return FitResult(model, {k: float(v) for k, v in p.items()}, float(f0), it, scale, hist)


# ------------------------------------------------------------ predictions
def bgnbd_expected_purchases(params: dict, t: float, x, tx, T):
    """Conditional expectation of Fader, Hardie and Lee (2005). Euler's
    transformation takes the large powers out of the hypergeometric function:
    what is left has small first parameters, and the ratio of powers in the
    denominator stays a logarithm, so no number of purchases overflows."""
    r, al, a, b = params["r"], params["alpha"], params["a"], params["b"]
    x, tx, T = (np.asarray(v, dtype=float) for v in (x, tx, T))
    z = t / (al + t + T)
    c = a + b + x - 1
    left = np.exp((a - 1) * np.log1p(-z)) * hyp2f1_series(a + b - 1 - r, a - 1, c, z)
    ratio = np.log(a) - np.log(b + np.maximum(x, 1) - 1) + (r + x) * (np.log(al + T) - np.log(al + tx))
    log_den = np.where(x > 0, np.logaddexp(0, ratio), 0.0)
    return (1 - left) * (a + b + x - 1) / (a - 1) * np.exp(-log_den)


def pareto_alive(params: dict, x, tx, T):
    r, al, s, be = params["r"], params["alpha"], params["s"], params["beta"]
    la0 = _pareto_log_a0(r, al, s, be, x, tx, T)
    return np.exp(-np.logaddexp(0, np.log(s / (r + s + x)) + (r + x) * np.log(al + T) + s * np.log(be + T) + la0))


def pareto_expected_purchases(params: dict, t: float, x, tx, T):
    r, al, s, be = params["r"], params["alpha"], params["s"], params["beta"]
    p1 = (r + x) * (be + T) / ((al + T) * (s - 1))
    p2 = 1 - ((be + T) / (be + T + t)) ** (s - 1)
    return p1 * p2 * pareto_alive(params, x, tx, T)


def _purchases_udf(kind: str, params: dict, t: float):
    fn = bgnbd_expected_purchases if kind == "bgnbd" else pareto_expected_purchases

    @F.pandas_udf(T.DoubleType())
    def udf(x: pd.Series, tx: pd.Series, TT: pd.Series) -> pd.Series:
        with np.errstate(all="ignore"):
            return pd.Series(fn(params, t, x.to_numpy(float), tx.to_numpy(float), TT.to_numpy(float)))
    return udf


def predict_purchases(summary: DataFrame, kind: str, params: dict, t: float, name: str) -> DataFrame:
    """Expected purchases in ``t`` days (Arrow-batched UDF; the
    parameters are a handful of driver-side numbers)."""
    return summary.withColumn(name, _purchases_udf(kind, params, t)(
        F.col("frequency").cast("double"), F.col("recency"), F.col("T")))


def expected_average_profit(summary: DataFrame, gg: dict, overall_avg: F.Column,
                            name: str = "predicted_avg_transaction") -> DataFrame:
    """Gamma-Gamma conditional expected average profit (pure SQL
    expression); frequency 0 -> overall average calibration transaction."""
    p, q, v = F.lit(gg["p"]), F.lit(gg["q"]), F.lit(gg["v"])
    x, m = F.col("frequency"), F.col("monetary_value")
    e = p * (v + x * m) / (p * x + q - F.lit(1.0))
    return summary.withColumn(name, F.when(x > 0, e).otherwise(overall_avg))


def holdout_target(hold: DataFrame, monetary_col: str = "monetary") -> DataFrame:
    """Future monetary per visitor."""
    return hold.groupBy("visitorid").agg(F.coalesce(F.sum(monetary_col), F.lit(0.0)).alias("future_monetary"))


def eval_table(summary: DataFrame, target: DataFrame) -> DataFrame:
    """C12."""
    return summary.join(target, "visitorid", "left")


def clv_metrics(ev: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """C11: MAE, RMSE, Spearman, MAE_log1p, MAPE (true > 0 only), n_eval on
    rows where both are non-null and non-negative; no row when empty."""
    d = ev.where(F.col(true_col).isNotNull() & F.col(pred_col).isNotNull()
                 & (F.col(true_col) >= 0) & (F.col(pred_col) >= 0)) \
        .select(F.col(true_col).alias("y"), F.col(pred_col).alias("p"))
    d = avg_rank(avg_rank(d, "y", "ry"), "p", "rp")
    out = d.agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("MAE"),
                F.sqrt(F.avg((F.col("y") - F.col("p")) ** 2)).alias("RMSE"),
                F.corr("ry", "rp").alias("Spearman"),
                F.avg(F.abs(F.log1p("y") - F.log1p("p"))).alias("MAE_log1p"),
                F.avg(F.when(F.col("y") > 0, F.abs((F.col("y") - F.col("p")) / F.col("y")))).alias("MAPE"),
                F.count(F.lit(1)).alias("n_eval"))
    return out.where(F.col("n_eval") > 0)


def prediction_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Describe of the prediction columns."""
    return describe(df, cols)


def residual_band(ev: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """C14: population std of log1p(pred) - log1p(true) and the log range."""
    d = ev.where(F.col(true_col).isNotNull() & F.col(pred_col).isNotNull()
                 & (F.col(true_col) >= 0) & (F.col(pred_col) >= 0)) \
        .select(F.log1p(true_col).alias("lt"), F.log1p(pred_col).alias("lp"))
    return d.agg(F.stddev_pop(F.col("lp") - F.col("lt")).alias("residual_std"),
                 F.least(F.min("lt"), F.min("lp")).alias("log_min"),
                 F.greatest(F.max("lt"), F.max("lp")).alias("log_max"),
                 F.count(F.lit(1)).alias("n"))


def kde_curve(df: DataFrame, c: str, gridsize: int = KDE_GRID, cut: float = KDE_CUT) -> DataFrame:
    """Kernel density (``density_curve``) of log1p(clip(c, 0))."""
    v = df.where(F.col(c).isNotNull()).select(log1p0(F.greatest(F.col(c), F.lit(0.0))).alias("v"))
    return density_curve(v, "v", gridsize, cut)


# ----------------------------------------------------------------- pipeline
def fit_and_predict(tx_money: DataFrame, holdout_days: int = HOLDOUT_DAYS, future_days: int = FUTURE_DAYS,
                    pen_bgf: float = PEN_BGF, pen_pareto: float = PEN_PARETO, pen_gg: float = PEN_GG,
                    visitor_col: str = "visitorid", time_col: str = "time", monetary_col: str = "monetary",
                    max_iter: int = 200):
    """C1-C12 (C16 with holdout_days=0, future_days=30): returns
    (eval table, {model: FitResult}, metrics frame or None)."""
    tm = tx_money.select(F.col(visitor_col).alias("visitorid"), F.col(time_col).alias("time"),
                         F.col(monetary_col).alias("monetary"))
    calib, hold, end = calibration_split(tm, holdout_days)
    summary = clv_summary(calib, end).persist()
    bgf = fit(summary, "bgnbd", pen_bgf, max_iter=max_iter)
    par = fit(summary, "pareto", pen_pareto, max_iter=max_iter)
    ggf = fit(summary.where(F.col("monetary_value") > 0), "gamma_gamma", pen_gg, max_iter=max_iter)
    overall = calib.agg(F.avg("monetary").alias("_overall"))
    s = predict_purchases(summary, "bgnbd", bgf.params, future_days, "predicted_purchases_bgf")
    s = s.crossJoin(F.broadcast(overall))
    s = expected_average_profit(s, ggf.params, F.col("_overall")).drop("_overall")
    s = s.withColumn("predicted_clv_bg_gamma", F.col("predicted_purchases_bgf") * F.col("predicted_avg_transaction"))
    s = predict_purchases(s, "pareto", par.params, future_days, "predicted_purchases_pareto")
    s = s.withColumn("predicted_clv_pareto", F.col("predicted_purchases_pareto") * F.col("predicted_avg_transaction"))
    ev = eval_table(s, holdout_target(hold))
    metrics = clv_metrics(ev, "future_monetary", "predicted_clv_bg_gamma").withColumn("model", F.lit("bgf_gg")) \
        .unionByName(clv_metrics(ev, "future_monetary", "predicted_clv_pareto").withColumn("model", F.lit("pareto_gg")))
    return ev, {"bgf": bgf, "pareto": par, "ggf": ggf}, metrics


def params_frame(spark, fits: dict) -> DataFrame:
    rows = [(k, f.model, p, float(v), float(f.nll), int(f.iterations)) for k, f in fits.items()
            for p, v in f.params.items()]
    return spark.createDataFrame(rows, "fit string, model string, param string, value double, nll double, "
                                       "iterations int")

