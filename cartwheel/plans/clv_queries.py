"""Registered CLV queries (C1-C16) on the order adapter, restricted to the
eligible customers (semi-join, J6). Holdout 180 days (FIXTURES.md). The
likelihood fits are rows-checked; everything relational is oracle-checked
with fixed Gamma-Gamma parameters and an observed-rate purchase forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import clv
from cartwheel.operators import rfm as rf
from cartwheel.plans import frames as fr
from cartwheel.plans import pipeline_queries as _pq  # noqa: F401
from cartwheel.plans.registry import register
from cartwheel.plans.sql_adapters import register_cte, with_ctes
from cartwheel.session import stage, staged_parquet
from cartwheel.sources.files import fingerprint

HOLDOUT = 180
FUTURE = 15
# Gamma-Gamma parameters used by the oracle-checked stages.
FIXED_GG = {"p": 6.0, "q": 4.0, "v": 15.0}
SQRT_2PI = 2.5066282746310002

register_cte("tx_money", ["rollup", "users_pipeline"], """
  SELECT r.* FROM rollup r WHERE r.visitorid IN (SELECT visitorid FROM users_pipeline)""")
register_cte("cal_end", ["tx_money"], f"""
  SELECT max("time") - INTERVAL {HOLDOUT} DAY AS calibration_end FROM tx_money""")
register_cte("clv_summary", ["tx_money", "cal_end"], """
  SELECT * FROM (
    SELECT visitorid, CAST(greatest(count(*) - 1, 0) AS BIGINT) AS frequency,
           date_diff('microsecond', min("time"), max("time")) / 86400000000.0 AS recency,
           date_diff('microsecond', min("time"), max(calibration_end)) / 86400000000.0 AS "T",
           avg(monetary) AS monetary_value
    FROM tx_money, cal_end WHERE "time" <= calibration_end GROUP BY visitorid) WHERE recency > 0""")
register_cte("clv_fixed", ["clv_summary", "tx_money", "cal_end"], f"""
  SELECT *, predicted_purchases * predicted_avg_transaction AS predicted_clv FROM (
    SELECT s.*, s.frequency / s."T" * {FUTURE}.0 AS predicted_purchases,
           CASE WHEN s.frequency > 0
                THEN {FIXED_GG['p']}::DOUBLE * ({FIXED_GG['v']}::DOUBLE + s.frequency * s.monetary_value)
                     / ({FIXED_GG['p']}::DOUBLE * s.frequency + {FIXED_GG['q']}::DOUBLE - 1.0::DOUBLE)
                ELSE o.overall END AS predicted_avg_transaction
    FROM clv_summary s, (SELECT avg(monetary) AS overall FROM tx_money, cal_end WHERE "time" <= calibration_end) o)""")
register_cte("holdout", ["tx_money", "cal_end"], """
  SELECT visitorid, coalesce(sum(monetary), 0.0) AS future_monetary
  FROM tx_money, cal_end WHERE "time" > calibration_end GROUP BY visitorid""")
register_cte("clv_eval", ["clv_fixed", "holdout"], """
  SELECT c.*, h.future_monetary FROM clv_fixed c LEFT JOIN holdout h ON c.visitorid = h.visitorid""")


def _tx_money(spark, d):
    """The eligible customers' purchases, written once per state of the order tables:
    the calibration end, both periods and the overall mean read them."""
    def build():
        tm = rf.purchase_rollup(fr.btx_once(spark, d))
        return staged_parquet(tm.join(fr.users_pipeline(spark, d).select("visitorid"), "visitorid", "left_semi"), "purchases")
    return fr.memo(("tx_money", fr.orders_state(spark, d)), build)


def _split(spark, d):
    calib, hold, end = clv.calibration_split(_tx_money(spark, d), HOLDOUT)
    return calib, hold, end


def _summary(spark, d):
    calib, _, end = _split(spark, d)
    return clv.clv_summary(calib, end)


def _fixed(spark, d):
    calib, hold, end = _split(spark, d)
    s = stage(clv.clv_summary(calib, end))
    s = s.withColumn("predicted_purchases", F.col("frequency") / F.col("T") * F.lit(float(FUTURE)))
    overall = calib.agg(F.avg("monetary").alias("_overall"))
    s = clv.expected_average_profit(s.crossJoin(F.broadcast(overall)), FIXED_GG, F.col("_overall")).drop("_overall")
    s = s.withColumn("predicted_clv", F.col("predicted_purchases") * F.col("predicted_avg_transaction"))
    return clv.eval_table(s, clv.holdout_target(hold))


SUMMARY_D = ["recency", "T", "monetary_value"]
FIXED_D = SUMMARY_D + ["predicted_purchases", "predicted_avg_transaction", "predicted_clv"]


@register("c1_calibration_holdout", with_ctes("tx_money", "cal_end") + """
SELECT visitorid, transactionid, monetary, "time",
       CASE WHEN "time" <= calibration_end THEN 'calibration' ELSE 'holdout' END AS period
FROM tx_money, cal_end""", doubles=["monetary"], ids="C1,P7,J6")
def q_c1(spark, d):
    calib, hold, _ = _split(spark, d)
    return calib.withColumn("period", F.lit("calibration")).unionByName(hold.withColumn("period", F.lit("holdout")))


@register("c2_clv_summary", with_ctes("clv_summary") + "SELECT * FROM clv_summary", doubles=SUMMARY_D, ids="C2")
def q_c2(spark, d):
    return _summary(spark, d)


@register("c7_c8_fixed_param_clv", with_ctes("clv_fixed") + "SELECT * FROM clv_fixed", doubles=FIXED_D,
          ids="C7,C8")
def q_c7(spark, d):
    return _fixed(spark, d).drop("future_monetary")


@register("c10_holdout_target", with_ctes("holdout") + "SELECT * FROM holdout", doubles=["future_monetary"],
          ids="C10")
def q_c10(spark, d):
    _, hold, _ = _split(spark, d)
    return clv.holdout_target(hold)


@register("c12_eval_table", with_ctes("clv_eval") + "SELECT * FROM clv_eval", doubles=FIXED_D + ["future_monetary"],
          ids="C12,J10")
def q_c12(spark, d):
    return _fixed(spark, d)


@register("c11_clv_metrics", with_ctes("clv_eval") + """
, m AS (SELECT future_monetary AS y, predicted_clv AS p FROM clv_eval
        WHERE future_monetary IS NOT NULL AND predicted_clv IS NOT NULL AND future_monetary >= 0 AND predicted_clv >= 0)
, rk AS (SELECT *, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry,
                rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rp FROM m)
SELECT * FROM (SELECT avg(abs(y - p)) AS "MAE", sqrt(avg(pow(y - p, 2))) AS "RMSE", corr(ry, rp) AS "Spearman",
                      avg(abs(ln(1 + y) - ln(1 + p))) AS "MAE_log1p",
                      avg(CASE WHEN y > 0 THEN abs((y - p) / y) END) AS "MAPE", count(*) AS n_eval FROM rk)
WHERE n_eval > 0""", doubles=["MAE", "RMSE", "Spearman", "MAE_log1p", "MAPE"], ids="C11,W11")
def q_c11(spark, d):
    return clv.clv_metrics(_fixed(spark, d), "future_monetary", "predicted_clv")


@register("c13_prediction_summary", with_ctes("clv_fixed") + """
SELECT 'predicted_clv' AS "column", count(predicted_clv) AS count, avg(predicted_clv) AS mean,
       stddev_samp(predicted_clv) AS std, min(predicted_clv) AS "min", quantile_cont(predicted_clv, 0.25) AS p25,
       quantile_cont(predicted_clv, 0.5) AS p50, quantile_cont(predicted_clv, 0.75) AS p75, max(predicted_clv) AS "max"
FROM clv_fixed""", doubles=["mean", "std", "min", "p25", "p50", "p75", "max"], ids="C13,A16")
def q_c13(spark, d):
    return clv.prediction_summary(_fixed(spark, d), ["predicted_clv"])


@register("c14_residual_band", with_ctes("clv_eval") + """
SELECT stddev_pop(lp - lt) AS residual_std, least(min(lt), min(lp)) AS log_min, greatest(max(lt), max(lp)) AS log_max,
       count(*) AS n
FROM (SELECT ln(1 + future_monetary) AS lt, ln(1 + predicted_clv) AS lp FROM clv_eval
      WHERE future_monetary IS NOT NULL AND predicted_clv IS NOT NULL AND future_monetary >= 0 AND predicted_clv >= 0)""",
          doubles=["residual_std", "log_min", "log_max"], ids="C14")
def q_c14(spark, d):
    return clv.residual_band(_fixed(spark, d), "future_monetary", "predicted_clv")


@register("c15_clv_density", with_ctes("clv_fixed") + f"""
, v AS (SELECT ln(1 + greatest(predicted_clv, 0.0)) AS v FROM clv_fixed WHERE predicted_clv IS NOT NULL)
, st AS (SELECT *, mn - 3.0 * h AS lo, (mx - mn + 6.0 * h) / 199 AS step FROM (
           SELECT *, pow(CAST(n AS DOUBLE), -0.2) * sd AS h FROM (
             SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS mn, max(v) AS mx FROM v)))
SELECT CAST(gi AS BIGINT) AS grid_id, lo + gi * step AS x,
       sum(exp(-0.5 * pow(((lo + gi * step) - v) / h, 2))) / (max(n) * max(h) * {SQRT_2PI}) AS density
FROM v, st, (SELECT range AS gi FROM range(200)) g GROUP BY gi, lo, step""",
          doubles=["x", "density"], ids="C15,A21")
def q_c15(spark, d):
    return clv.kde_curve(_fixed(spark, d), "predicted_clv")


# ------------------------------------------------------- fitted (rows only)
_FITS: dict = {}


def _fit(spark, d, holdout=HOLDOUT, future=FUTURE):
    """One fit per (session, data folder, horizon); the evaluation table is
    written once (reliable checkpoint) and shared by the reports."""
    state = fingerprint(spark, [f"{d}/orders.parquet", f"{d}/lineitem.parquet"])
    key = (id(spark), spark.sparkContext.applicationId, d, state, holdout, future)
    if key not in _FITS:
        ev, fits, metrics = clv.fit_and_predict(_tx_money(spark, d), holdout_days=holdout, future_days=future)
        _FITS[key] = (stage(ev), fits, metrics)
    return _FITS[key]


@register("c3_c5_fitted_parameters", ids="C3,C4,C5")
def q_c3(spark, d):
    _, fits, _ = _fit(spark, d)
    return clv.params_frame(spark, fits)


@register("c6_c9_fitted_predictions", ids="C6,C7,C8,C9,C12")
def q_c6(spark, d):
    ev, _, _ = _fit(spark, d)
    return ev


@register("c11_fitted_metrics", ids="C11")
def q_c11f(spark, d):
    _, _, m = _fit(spark, d)
    return m


@register("c16_refit_users_pipeline", ids="C16,J10")
def q_c16(spark, d):
    ev, _, _ = _fit(spark, d, holdout=0, future=30)
    f = ev.select("visitorid", "predicted_avg_transaction", "predicted_clv_bg_gamma", "predicted_purchases_bgf")
    return fr.users_pipeline(spark, d).join(f, "visitorid", "left")
