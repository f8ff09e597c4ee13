"""Cox proportional hazards.

Distributed Newton-Raphson with Efron ties. The rows are range-partitioned by
duration (descending) once and kept; no iteration shuffles. Every iteration: (A)
each partition sums w, w x, w x x' (w = exp(x beta)) -> P x (1+d+d^2) numbers on
the driver, turned into risk-set offsets, with the events of the durations that
neighbouring partitions share; (B) per partition, suffix sums plus offset (=
risk-set sums) and the Efron tie terms -> partial log-likelihood, gradient and
Hessian (d + d^2 numbers).
The Newton step (d x d solve) runs on the driver.
L2 penalty 0.5 * penalizer * n * |beta|^2."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.curves import mean_power_curve
from cartwheel.operators.relational import avg_rank, ffill_on_grid, running_sums, top_n

Z95 = 1.959963984540054


@dataclass
class CoxFit:
    features: list
    coef: np.ndarray
    se: np.ndarray
    cov: np.ndarray
    loglik: float
    iterations: int
    means: np.ndarray
    n: int
    n_events: int


def _pairs(d):
    return [(k, l) for k in range(d) for l in range(k, d)]


# Rows of one range partition; a task holds a handful of row x feature arrays of them.
RANGE_ROWS = 100_000


def _rows(it, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Durations (longest first), events and features of a range partition."""
    parts = [np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ["t", "e", *[f"x{k}" for k in range(d)]]], axis=1)
             for b in it if b.num_rows]
    r = np.concatenate(parts) if parts else np.zeros((0, 2 + d))
    return r[:, 0], r[:, 1], r[:, 2:]


def _events(t: np.ndarray, e: np.ndarray, X: np.ndarray, w: np.ndarray, xb: np.ndarray) -> dict:
    """Per distinct duration of the rows: sums over its events, and its last row."""
    starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    ew = e * w

    def red(a):
        return np.add.reduceat(a, starts, axis=0)
    return {"dd": red(e), "e0": red(ew), "exb": red(e * xb), "e1": red(ew[:, None] * X), "xs": red(e[:, None] * X),
            "last": np.r_[starts[1:], len(t)] - 1, "group": np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(t)]))}


def _totals_kernel(beta: np.ndarray, d: int):
    """Pass A: per range partition the sums of w, w x, w x x' and the events of its
    last duration, which may go on in the next one."""
    def kernel(it):
        from pyspark import TaskContext
        t, e, X = _rows(it, d)
        if len(t):
            xb = X @ beta
            w = np.exp(xb)
            st = _events(t, e, X, w, xb)
            tot = np.concatenate([[w.sum()], w @ X, ((X * w[:, None]).T @ X).ravel()])
            open_rows = slice(np.searchsorted(st["group"], st["group"][-1]), None)
            e2 = (X[open_rows] * (e * w)[open_rows, None]).T @ X[open_rows]
            of_tail = np.concatenate([[st[c][-1] for c in ("dd", "e0", "exb")], st["e1"][-1], st["xs"][-1], e2.ravel()])
            yield pa.RecordBatch.from_pydict({"pid": pa.array([TaskContext.get().partitionId()], pa.int32()), "tot": [tot],
                                              "head": [t[0]], "tail": [t[-1]], "of_tail": [of_tail]})
    return kernel


def _handed_on(rows: list, d: int) -> dict:
    """Per range partition, in order: sums over all rows before it, the events of its
    first duration in earlier partitions, and whether its last duration goes on."""
    rows = sorted(rows, key=lambda r: r["pid"])  # partition 0 holds the longest durations
    out, run = {}, np.zeros(1 + d + d * d)
    before, open_t = np.zeros(3 + 2 * d + d * d), None
    for i, r in enumerate(rows):
        carry = before if open_t == r["head"] else np.zeros(3 + 2 * d + d * d)
        goes_on = i + 1 < len(rows) and rows[i + 1]["head"] == r["tail"]
        out[r["pid"]] = (run, carry, goes_on)
        run = run + np.array(r["tot"])
        before = np.array(r["of_tail"]) + (carry if r["head"] == r["tail"] else 0.0)
        open_t = r["tail"]
    return out


TIE_BLOCK = 1 << 18


def tie_sums(s0: np.ndarray, e0: np.ndarray, deaths: np.ndarray) -> dict:
    """Efron's sums over the tied deaths of each event time. With phi = l / D and
    q = s0 - phi e0 for l = 0 .. D - 1: log = sum log q, a = sum 1/q,
    b = sum phi/q, aa = sum 1/q^2, ab = sum phi/q^2, bb = sum phi^2/q^2. Ties are
    worked off in blocks of ``TIE_BLOCK`` numbers, so a duration that a third of
    the rows share costs time but no memory."""
    out = {n: np.zeros(len(s0)) for n in ("log", "a", "b", "aa", "ab", "bb")}
    ends = np.cumsum(deaths)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, TIE_BLOCK):
        flat = np.arange(lo, min(lo + TIE_BLOCK, int(ends[-1])))
        i = np.searchsorted(ends, flat, side="right")
        phi = (flat - (ends[i] - deaths[i])) / deaths[i]
        q = 1 / (s0[i] - phi * e0[i])
        for name, v in (("log", -np.log(q)), ("a", q), ("b", phi * q), ("aa", q * q), ("ab", phi * q * q),
                        ("bb", phi * phi * q * q)):
            out[name] += np.bincount(i, v, len(s0))
    return out


def _efron_kernel(beta: np.ndarray, d: int, handed_on: dict):
    """Pass B: log-likelihood, gradient and Hessian of the durations that end in a range
    partition. A term of the Hessian that adds up sums of w x x' over the event
    times is one product over the rows, each weighted by the event times that follow it."""
    def kernel(it):
        from pyspark import TaskContext
        t, e, X = _rows(it, d)
        if not len(t):
            return
        off, carry, goes_on = handed_on[TaskContext.get().partitionId()]
        xb = X @ beta
        w = np.exp(xb)
        st = _events(t, e, X, w, xb)
        for name, v in (("dd", carry[0]), ("e0", carry[1]), ("exb", carry[2]), ("e1", carry[3:3 + d]), ("xs", carry[3 + d:3 + 2 * d])):
            st[name][0] += v
        S0 = off[0] + np.cumsum(w)[st["last"]]
        S1 = off[1:1 + d] + np.cumsum(w[:, None] * X, axis=0)[st["last"]]
        D = np.rint(st["dd"]).astype(int)
        if goes_on:
            D[-1] = 0  # the last partition of a duration counts it
        ev = np.flatnonzero(D > 0)
        ll, g, H = 0.0, np.zeros(d), np.zeros((d, d))
        if len(ev):
            S0, S1, E0, E1 = S0[ev], S1[ev], st["e0"][ev], st["e1"][ev]
            k = tie_sums(S0, E0, D[ev])
            a, b = np.zeros(len(D)), np.zeros(len(D))
            a[ev], b[ev] = k["a"], k["b"]
            ll = st["exb"][ev].sum() - k["log"].sum()
            g = st["xs"][ev].sum(0) - (k["a"] @ S1 - k["b"] @ E1)
            later = np.cumsum(a[::-1])[::-1]  # event times at or after a duration's place in the order
            all_rows = (X * (w * later[st["group"]])[:, None]).T @ X + later[0] * off[1 + d:].reshape(d, d)
            tied = (X * (e * w * b[st["group"]])[:, None]).T @ X + b[0] * carry[3 + 2 * d:].reshape(d, d)
            cross = (k["ab"][:, None] * S1).T @ E1
            outer = (k["aa"][:, None] * S1).T @ S1 - cross - cross.T + (k["bb"][:, None] * E1).T @ E1
            H = -(all_rows - tied - outer)
        yield pa.RecordBatch.from_pydict({"ll": [float(ll)], "g": [g], "H": [H.ravel()]})
    return kernel


def _ordered(data: DataFrame, n: int) -> DataFrame:
    """The rows range-partitioned and sorted by duration, longest first, once for all
    iterations. A row number joins the order, so rows of one duration may fill many
    partitions."""
    parts = max(1, data.sparkSession.sparkContext.defaultParallelism, -(-n // RANGE_ROWS))
    return data.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, F.desc("t"), "_row") \
        .drop("_row").sortWithinPartitions(F.desc("t")).persist()


def _evaluate(data: DataFrame, beta: np.ndarray, d: int):
    """Two passes over the ordered rows without a shuffle: partition totals, turned into
    risk-set offsets on the driver, then the Efron terms of each partition."""
    tots = data.mapInArrow(_totals_kernel(beta, d), "pid int, tot array<double>, head double, tail double, "
                                                    "of_tail array<double>").collect()
    rows = data.mapInArrow(_efron_kernel(beta, d, _handed_on(tots, d)), "ll double, g array<double>, H array<double>").collect()
    ll = sum(r["ll"] for r in rows)
    g = np.sum([np.array(r["g"]) for r in rows], axis=0)
    H = np.sum([np.array(r["H"]).reshape(d, d) for r in rows], axis=0)
    return ll, g, H


def fit_cox(df: DataFrame, features: list[str], duration: str = "duration", event: str = "event",
            penalizer: float = 0.1, max_iter: int = 50, tol: float = 1e-9) -> CoxFit:
    """Penalised Efron partial likelihood, Newton-Raphson with step halving.
    A step that lowers the likelihood is never taken; raises if it hasn't
    converged after ``max_iter`` steps."""
    d = len(features)
    data = df.select(F.col(duration).cast("double").alias("t"), F.col(event).cast("double").alias("e"),
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{k}") for k, c in enumerate(features)])
    stats = data.agg(F.count(F.lit(1)).alias("n"), F.sum("e").alias("ne"),
                     *[F.avg(f"x{k}").alias(f"m{k}") for k in range(d)]).first()
    n, ne = int(stats["n"]), int(stats["ne"] or 0)
    means = np.array([stats[f"m{k}"] for k in range(d)], dtype=float)
    pen = 0.5 * penalizer * n
    data = _ordered(data, n)

    def penalised(beta):
        ll, g, H = _evaluate(data, beta, d)
        return ll - pen * beta @ beta, g - 2 * pen * beta, H - 2 * pen * np.eye(d)
    beta = np.zeros(d)
    ll, g, H = penalised(beta)
    it, done = 0, False
    for it in range(1, max_iter + 1):
        try:
            step = np.linalg.solve(-H, g)
        except np.linalg.LinAlgError:
            step = np.linalg.lstsq(-H, g, rcond=None)[0]
        t = 1.0
        while True:
            nb = beta + t * step
            nll, ng, nH = penalised(nb)
            better = np.isfinite(nll) and nll >= ll - 1e-12 * max(1.0, abs(ll))
            if better or t < 1e-6:
                break
            t *= 0.5
        if not better:  # no ascent left along the Newton direction
            done = np.max(np.abs(g)) < 1e-6 * max(1.0, abs(ll))
            break
        done = abs(nll - ll) < tol * max(1.0, abs(ll)) or np.max(np.abs(t * step)) < 1e-8
        beta, ll, g, H = nb, nll, ng, nH
        if done:
            break
    if not done:
        data.unpersist()
        raise RuntimeError(f"the Cox fit did not converge in {it} steps")
    cov = np.linalg.inv(-H)
    se = np.sqrt(np.clip(np.diag(cov), 0, None))
    data.unpersist()
    return CoxFit(features, beta, se, cov, float(ll), it, means, n, ne)


def summary_frame(spark, fit: CoxFit) -> DataFrame:
    """H13 summary: coef, exp(coef), se, z, p, 95 % CI."""
    rows = []
    for k, c in enumerate(fit.features):
        b, s = float(fit.coef[k]), float(fit.se[k])
        z = b / s if s > 0 else float("nan")
        p = math.erfc(abs(z) / math.sqrt(2)) if s > 0 else float("nan")
        rows.append((c, b, math.exp(b), s, z, p, b - Z95 * s, b + Z95 * s))
    return spark.createDataFrame(rows, "covariate string, coef double, exp_coef double, se double, z double, "
                                       "p double, coef_lower double, coef_upper double")


def hazard_ratio_table(summary: DataFrame) -> DataFrame:
    """HR, HR bounds, p; sorted by HR descending."""
    return summary.select("covariate", F.exp("coef").alias("HR"), F.exp("coef_lower").alias("HR_lower"),
                          F.exp("coef_upper").alias("HR_upper"), "p").orderBy(F.desc("HR"), "covariate")


def interpretation(hr: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One sentence per significant covariate."""
    up = F.format_string("%s: +%.1f%% higher churn risk (HR=%.2f, p=%.3f)", F.col("covariate"),
                         (F.col("HR") - 1) * 100, F.col("HR"), F.col("p"))
    down = F.format_string("%s: -%.1f%% lower churn risk (HR=%.2f, p=%.3f)", F.col("covariate"),
                           (1 - F.col("HR")) * 100, F.col("HR"), F.col("p"))
    return hr.where(F.col("p") <= alpha).select("covariate", F.when(F.col("HR") > 1, up).otherwise(down).alias("text"))


def driver_ranking(hr: DataFrame, n: int = 10) -> DataFrame:
    """Top drivers by |ln HR|."""
    return top_n(hr.withColumn("impact_strength", F.abs(F.log("HR"))),
                 [F.desc("impact_strength"), F.asc("covariate")], n)


def partial_hazard(df: DataFrame, fit: CoxFit, name: str = "partial_hazard") -> DataFrame:
    """exp((x - mean_train) . beta), one SQL expression (no UDF)."""
    lin = sum((F.lit(float(fit.coef[k])) * (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(float(fit.means[k])))
               for k, c in enumerate(fit.features)), F.lit(0.0))
    return df.withColumn(name, F.exp(lin))


def baseline_hazard(df: DataFrame, fit: CoxFit, duration: str = "duration", event: str = "event") -> DataFrame:
    """Breslow baseline: h0(t) = d_t / sum_{risk set} partial hazard; H0, S0."""
    ph = partial_hazard(df, fit)
    per_t = ph.groupBy(F.col(duration).cast("double").alias("t")).agg(
        F.sum("partial_hazard").alias("r0"), F.sum(F.col(event).cast("double")).alias("dd"))
    per_t = running_sums(per_t, [], "t", ["r0"], descending=True, prefix="s_")
    per_t = per_t.withColumn("baseline_hazard", F.col("dd") / F.col("s_r0"))
    per_t = running_sums(per_t, [], "t", ["baseline_hazard"], prefix="cum_")
    return per_t.select(F.col("t").alias("timeline"), "baseline_hazard",
                        F.col("cum_baseline_hazard").alias("cumulative_hazard"),
                        F.exp(-F.col("cum_baseline_hazard")).alias("baseline_survival"))


def survival_on_grid(users: DataFrame, base: DataFrame, fit: CoxFit, grid: DataFrame) -> DataFrame:
    """S_i(t) = exp(-H0(t) * ph_i) on a fixed grid (users x grid)."""
    h0 = ffill_on_grid(grid.select("t"), base.select(F.col("timeline").alias("t"), "cumulative_hazard"), [], "t",
                       "cumulative_hazard", "H0")
    ph = partial_hazard(users, fit).select("visitorid", "business_label", "partial_hazard")
    return ph.crossJoin(F.broadcast(h0)).select("visitorid", "business_label", "t",
                                               F.exp(-F.col("H0") * F.col("partial_hazard")).alias("s"))


def mean_survival_by_segment(users: DataFrame, base: DataFrame, fit: CoxFit, grid: DataFrame,
                             label: str = "business_label") -> DataFrame:
    """Mean of exp(-H0(t) * ph_i) per label on the grid, summed up inside the tasks."""
    h0 = ffill_on_grid(grid.select("t"), base.select(F.col("timeline").alias("t"), "cumulative_hazard"), [], "t",
                       "cumulative_hazard", "H0")
    return mean_power_curve(partial_hazard(users, fit), label, F.col("partial_hazard"),
                            h0.withColumn("s0", F.exp(-F.col("H0"))), "t", "s0")


def hazard_by_segment(users: DataFrame, base: DataFrame, fit: CoxFit, grid: DataFrame) -> DataFrame:
    """Baseline hazard forward-filled on the grid x mean partial hazard of
    each segment (partial hazard used once)."""
    h0 = ffill_on_grid(grid.select("t"), base.select(F.col("timeline").alias("t"), "baseline_hazard"), [], "t",
                       "baseline_hazard", "h0")
    seg = partial_hazard(users, fit).groupBy("business_label").agg(F.avg("partial_hazard").alias("mean_ph"))
    return seg.crossJoin(F.broadcast(h0)).select("business_label", "t", (F.col("h0") * F.col("mean_ph")).alias("hazard"))


def ph_test(df: DataFrame, fit: CoxFit, duration: str = "duration", event: str = "event") -> DataFrame:
    """Grambsch-Therneau test with rank-transformed event times on scaled
    Schoenfeld residuals (Breslow risk-set means); chi-square(1) p-values."""
    d = len(fit.features)
    ph = partial_hazard(df, fit).select(F.col(duration).cast("double").alias("t"), F.col(event).cast("double").alias("e"),
                                        "partial_hazard", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{k}")
                                                            for k, c in enumerate(fit.features)])
    per_t = ph.groupBy("t").agg(F.sum("partial_hazard").alias("r0"),
                                *[F.sum(F.col("partial_hazard") * F.col(f"x{k}")).alias(f"r1_{k}") for k in range(d)])
    per_t = running_sums(per_t, [], "t", ["r0"] + [f"r1_{k}" for k in range(d)], descending=True,
                         prefix="s_")
    ev = ph.where(F.col("e") > 0).join(per_t.select("t", "s_r0", *[f"s_r1_{k}" for k in range(d)]), "t")
    for k in range(d):
        ev = ev.withColumn(f"r{k}", F.col(f"x{k}") - F.col(f"s_r1_{k}") / F.col("s_r0"))
    V = fit.cov * fit.n_events
    for j in range(d):
        ev = ev.withColumn(f"s{j}", sum((F.lit(float(V[k, j])) * F.col(f"r{k}") for k in range(d)), F.lit(0.0)))
    ev = avg_rank(ev, "t", "g")
    agg = ev.agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("sg"), F.sum(F.col("g") ** 2).alias("sgg"),
                 *[F.sum(f"s{j}").alias(f"ss{j}") for j in range(d)],
                 *[F.sum(F.col("g") * F.col(f"s{j}")).alias(f"sgs{j}") for j in range(d)]).first()
    n = agg["n"]
    out = []
    for j, c in enumerate(fit.features):
        num = (agg[f"sgs{j}"] - agg["sg"] * agg[f"ss{j}"] / n) ** 2
        den = fit.n_events * fit.se[j] ** 2 * (agg["sgg"] - agg["sg"] ** 2 / n)
        stat = num / den if den > 0 else float("nan")
        p = math.erfc(math.sqrt(stat / 2)) if stat == stat else float("nan")
        out.append((c, float(stat), float(p), int(p < 0.05) if p == p else 0))
    return df.sparkSession.createDataFrame(out, "covariate string, test_statistic double, p double, violates int")
