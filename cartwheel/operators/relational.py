"""Generic relational building blocks shared by the analytic operators.

Everything here is a composition of DataFrame operators; nothing collects
rows to the driver. Scale rules applied throughout:

* windows over an ordered column run inside equi-depth ranges of it, whose
  edges are sampled quantiles (``equi_depth``), plus a small table of range
  totals (``running_sums``); ranks and quantiles come from ordered scans;
* windows over raw rows are never partitioned by a key alone when that key
  can be hot (one item holding a third of the rows): the time axis is cut into
  ranges and a small per-(key, range) table carries state across their borders
  (``asof_join``); lags and running sums per key are in ``scan``;
* lookups by a key that can be hot go through ``join_spread``;
* global orderings only run on already-aggregated (small) tables;
* the only broadcasts are one-row scalar frames or tables bounded by a fixed
  parameter (number of bins, grid points, segments).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.semantics import col
from cartwheel.operators.scan import ordered_scan
from cartwheel.session import staged_parquet

# ---------------------------------------------------------------- as-of join
def _micros(df: DataFrame, c: str) -> Column:
    """A time column as microseconds, in its own order whatever the session's
    time zone."""
    if dict(df.dtypes)[c] == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c))
    return F.unix_micros(F.col(c).cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, by: str, left_on: str, right_on: str,
              right_cols: list[str] | None = None, per_key: DataFrame | None = None) -> DataFrame:
    """Backward as-of join (J1): every left row gets the latest right row of the
    same ``by`` key with ``right_on <= left_on`` (exact matches allowed).

    The whole matched right row is taken, so a matched snapshot with a NULL
    attribute stays NULL (no skipping to older snapshots).

    Plan: union both sides, window over (key, time range) ordered by time with
    right rows first on ties -> running ``last(struct, ignorenulls)``. The time
    ranges hold equally many rows of both sides, so a hot key is spread even if
    it has all rows of one day. Matches from earlier ranges come from a
    per-(key, range) "last snapshot" table whose window per key has at most one
    row per range. The union is staged, so both inputs run once. Columns of
    ``per_key`` (unique on ``by``) ride on that same table: a hot key gets them by
    (key, range), not by the key alone.
    """
    rc = right_cols or [c for c in right.columns if c not in (by, right_on)]
    snap = F.struct(*[F.col(c) for c in rc])
    lcols = left.columns
    L = left.withColumn("_aj_t", F.col(left_on)).withColumn("_aj_tag", F.lit(1))
    R = right.select(F.col(by), F.col(right_on).alias("_aj_t"), snap.alias("_aj_snap")) \
        .withColumn("_aj_tag", F.lit(0))
    u = staged_parquet(L.unionByName(R, allowMissingColumns=True), "asof-union")
    u = equi_depth(u.withColumn("_aj_v", _micros(u, "_aj_t")), "_aj_v", "_aj_b").drop("_aj_v")
    w = Window.partitionBy(by, "_aj_b").orderBy("_aj_t", "_aj_tag") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = u.withColumn("_aj_hit", F.last("_aj_snap", ignorenulls=True).over(w)) \
        .where(F.col("_aj_tag") == 1)

    # last snapshot of each (key, range), carried to the key's later ranges
    last = u.groupBy(by, "_aj_b").agg(F.max_by("_aj_snap", F.when(F.col("_aj_tag") == 0, F.col("_aj_t"))).alias("_aj_last"))
    wb = Window.partitionBy(by).orderBy("_aj_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(by, "_aj_b", F.last("_aj_last", ignorenulls=True).over(wb).alias("_aj_carry"))
    extra = [] if per_key is None else [c for c in per_key.columns if c != by]
    if extra:
        carry = carry.join(per_key, by, "left")

    out = hit.join(carry, [by, "_aj_b"], "left") \
        .withColumn("_aj_m", F.coalesce("_aj_hit", "_aj_carry"))
    return out.select(*[F.col(c) for c in lcols], *[F.col("_aj_m")[c].alias(c) for c in rc], *extra)


# ------------------------------------------------------------- hot-key join
HOT_KEYS = 1000


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``table`` (unique on ``keys``), whatever the share of one key.
    ``size`` is the column of ``table`` with the number of ``rows`` of its key, and
    ``total`` bounds their sum. A key is hot if it holds more than one
    ``HOT_KEYS``-th of ``total``, so there are at most ``HOT_KEYS`` hot ones: they
    are broadcast, and their rows stay where they are. The others are joined as
    usual. ``rows`` is read twice, so it should be staged or a plain scan."""
    payload = [c for c in table.columns if c not in keys and c != size]
    is_hot = F.coalesce(F.col(size) * F.lit(HOT_KEYS) > F.lit(total), F.lit(False))
    hot = table.where(is_hot).select(*keys, F.struct(*payload).alias("_js"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    near = marked.where(F.col("_js").isNotNull()).select(*rows.columns, *[F.col("_js")[c].alias(c) for c in payload])
    far = marked.where(F.col("_js").isNull()).select(*rows.columns).join(table.where(~is_hot).select(*keys, *payload), keys, how)
    return near.unionByName(far.select(*rows.columns, *payload))


# ------------------------------------------------------------- aggregates
def value_counts(df: DataFrame, key: str, normalize: bool = False, name: str = "count") -> DataFrame:
    """Counts per non-null key, with share of total when ``normalize``."""
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    if normalize:
        out = out.withColumn("share", F.col(name) / F.sum(name).over(Window.partitionBy()))
    return out


def quantile(c, p) -> Column:
    """Linear-interpolated quantile (pandas/numpy default) for groups whose
    size a parameter bounds; ``exact_quantiles`` takes any other."""
    return F.percentile(col(c), p) if not isinstance(p, (list, tuple)) \
        else F.percentile(col(c), F.array(*[F.lit(float(x)) for x in p]))


def describe(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Pandas ``describe()`` per column (std with ddof=1), long format.
    Quartiles come from ``exact_quantiles`` (distributed, no group buffer)."""
    out = None
    for c in cols:
        m = df.agg(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
                   F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
                   F.max(c).cast("double").alias("max"))
        q = exact_quantiles(df, [], c, [0.25, 0.5, 0.75]) if exact else \
            df.agg(*[F.percentile_approx(c, p, 100000).cast("double").alias(f"q_{i}")
                     for i, p in enumerate([0.25, 0.5, 0.75])])
        row = m.crossJoin(q).select("column", "count", "mean", "std", "min", F.col("q_0").alias("p25"),
                                    F.col("q_1").alias("p50"), F.col("q_2").alias("p75"), "max")
        out = row if out is None else out.unionByName(row)
    return out


def minmax_scale(df: DataFrame, cols: list[str], invert: bool = False, suffix: str = "_norm") -> DataFrame:
    """(x - min) / (max - min) over the table; constant column -> 0.
    The min/max are one broadcast row."""
    stats = df.agg(*[F.min(c).alias(f"_mn_{c}") for c in cols], *[F.max(c).alias(f"_mx_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(stats))
    for c in cols:
        v = F.coalesce(F.try_divide(F.col(c) - F.col(f"_mn_{c}"), F.col(f"_mx_{c}") - F.col(f"_mn_{c}")),
                       F.lit(0.0))
        out = out.withColumn(c + suffix, (F.lit(1.0) - v) if invert else v)
    return out.drop(*[f"_mn_{c}" for c in cols], *[f"_mx_{c}" for c in cols])


def histogram(df: DataFrame, c: str, bins: int, lo: float | None = None, hi: float | None = None,
              spark=None) -> DataFrame:
    """Equi-width histogram like ``numpy.histogram`` (last bin closed).

    Returns every bin (empty ones with 0): bin, bin_lo, bin_hi, count. The
    bounds are one broadcast row; the bin table has ``bins`` rows."""
    x = F.col(c).cast("double")
    vals = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    if lo is None or hi is None:
        b = vals.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    else:
        b = vals.sparkSession.range(1).select(F.lit(float(lo)).alias("_lo"), F.lit(float(hi)).alias("_hi"))
    # numpy widens a zero-width range to (v - 0.5, v + 0.5)
    b = b.select(F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                 F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    idx = F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(bins)).cast("long"),
                  F.lit(bins - 1))
    counts = vals.crossJoin(F.broadcast(b)) \
        .where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))) \
        .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = vals.sparkSession.range(bins).withColumnRenamed("id", "bin").crossJoin(F.broadcast(b))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def boxplot_stats(df: DataFrame, c: str, exact: bool = True) -> DataFrame:
    """Five-number summary with 1.5 IQR whiskers (matplotlib convention)."""
    q = df.agg(F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max")) \
        .crossJoin(exact_quantiles(df, [], c, [0.25, 0.5, 0.75]))
    q = q.select("n", "min", "max", F.col("q_0").alias("q1"), F.col("q_1").alias("median"),
                 F.col("q_2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    x = df.select(F.col(c).cast("double").alias("_x")).crossJoin(F.broadcast(q.select("q1", "q3", "iqr")))
    wh = x.agg(
        F.min(F.when(F.col("_x") >= F.col("q1") - 1.5 * F.col("iqr"), F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= F.col("q3") + 1.5 * F.col("iqr"), F.col("_x"))).alias("whisker_hi"),
        F.count_if((F.col("_x") < F.col("q1") - 1.5 * F.col("iqr"))
                   | (F.col("_x") > F.col("q3") + 1.5 * F.col("iqr"))).alias("n_outliers"))
    return q.crossJoin(wh)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """``orderBy(...).limit(n)`` -> TakeOrderedAndProject (per-partition
    top-n, then a merge of n * partitions rows)."""
    return df.orderBy(*order).limit(n)


COARSE, FINE = 16, 16


def equi_depth(df: DataFrame, t: str, name: str, descending: bool = False) -> DataFrame:
    """Add ``name``: the number (0 .. COARSE * FINE - 1) of the value range that
    ``t`` falls in. The ranges hold about equally many rows of ``df``, whatever
    the distribution: their edges are sampled quantiles (one row, one
    aggregation), so a heavy tail or a fixed calendar neither collapses nor
    caps them. Equal values share a range; with ``descending`` range 0 is the
    highest. NULL falls in the first range."""
    n = COARSE * FINE
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    v = F.col(t).cast("double")
    edges = df.agg(F.percentile_approx(v, probs, 20 * n).alias("_edges"))
    # every FINE-th edge first, then the few between: 2 * 16 comparisons a row
    edges = edges.select("_edges", F.filter("_edges", lambda x, i: i % FINE == FINE - 1).alias("_steps"))
    d = df.crossJoin(F.broadcast(edges))
    step = F.size(F.filter("_steps", lambda e: e <= v))
    d = d.withColumn("_step", F.coalesce(F.greatest(step, F.lit(0)), F.lit(0)))
    fine = F.size(F.filter(F.slice("_edges", F.col("_step") * FINE + 1, F.lit(FINE - 1)), lambda e: e <= v))
    number = F.col("_step") * FINE + F.coalesce(F.greatest(fine, F.lit(0)), F.lit(0))
    if descending:
        number = F.lit(n - 1) - number
    return d.withColumn(name, number.cast("int")).drop("_edges", "_steps", "_step")


def avg_rank(df: DataFrame, c: str, name: str, partition: list[str] | None = None) -> DataFrame:
    """Average rank with ties (1-based) = rows below + (ties + 1) / 2,
    from the distinct-value count table with bucketed running sums (no
    window over all values)."""
    part = partition or []
    d = df.groupBy(*part, c).agg(F.count(F.lit(1)).alias("_n"))
    d = d.withColumn("_v", F.col(c).cast("double"))
    d = running_sums(d, part, "_v", ["_n"], prefix="_cum")
    d = d.withColumn(name, F.col("_cum_n") - (F.col("_n") - 1) / 2.0).select(*part, c, name)
    return df.join(d, part + [c], "left")


def qcut_labels(df: DataFrame, c: str, probs: list[float], labels: list[str], name: str) -> DataFrame:
    """``pd.qcut(s, q, labels)`` with right-closed bins on exact edges."""
    q = exact_quantiles(df, [], c, probs)
    edges = q.select(F.array(*[F.col(f"q_{i}") for i in range(len(probs))]).alias("_e"))
    d = df.crossJoin(F.broadcast(edges))
    expr = None
    for i, lab in enumerate(labels[:-1]):
        cond = F.col(c) <= F.col("_e")[i]
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    expr = expr.otherwise(labels[-1])
    return d.withColumn(name, F.when(F.col(c).isNotNull(), expr)).drop("_e")


def trapezoid_area(curve: DataFrame, key: list[str], t: str, s: str, name: str) -> DataFrame:
    """Area under a step-sampled curve with the trapezoid rule."""
    w = Window.partitionBy(*key).orderBy(t)
    d = curve.withColumn("_t2", F.lead(t).over(w)).withColumn("_s2", F.lead(s).over(w))
    return d.groupBy(*key).agg(
        F.coalesce(F.sum((F.col("_t2") - F.col(t)) * (F.col(s) + F.col("_s2")) / 2.0), F.lit(0.0)).alias(name))


def _nearest_before(u: DataFrame, keys: list[str], x: str, tag: str, value: str, rng: str, name: str,
                    descending: bool = False) -> DataFrame:
    """Add the last non-null ``value`` at or before each row in (x, tag) order
    within ``keys`` (at or after it with ``descending``): a window per (keys,
    range ``rng`` of x), and the last value of earlier ranges from a table of
    one row per (keys, range)."""
    order = F.desc(x) if descending else F.asc(x)
    w = Window.partitionBy(*keys, rng).orderBy(order, F.asc(tag)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pick = F.min_by if descending else F.max_by
    per = u.groupBy(*keys, rng).agg(pick(value, F.when(F.col(value).isNotNull(), F.col(x))).alias("_end"))
    border = F.desc(rng) if descending else F.asc(rng)
    wb = Window.partitionBy(*keys).orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*keys, rng, F.last("_end", ignorenulls=True).over(wb).alias("_carry"))
    d = u.withColumn("_in", F.last(value, ignorenulls=True).over(w)).join(carry, keys + [rng], "left")
    return d.withColumn(name, F.coalesce("_in", "_carry")).drop("_in", "_carry")


def interp_at(points: DataFrame, curve: DataFrame, key: list[str], x: str, t: str, s: str,
              name: str) -> DataFrame:
    """``np.interp(x, t, s)`` per key, clamped at both ends.

    The bracketing curve points come from a forward and a backward fill over
    the union of query points and curve points (no points x curve join), in
    equi-depth ranges of x, so one key with all rows is spread over them.
    Returns one row per distinct (key, x)."""
    P = points.select(*key, F.col(x).cast("double").alias("_x")).distinct() \
        .withColumn("_tag", F.lit(1)).withColumn("_s", F.lit(None).cast("double"))
    C = curve.select(*key, F.col(t).cast("double").alias("_x"), F.lit(0).alias("_tag"),
                     F.col(s).cast("double").alias("_s"))
    u = equi_depth(P.unionByName(C), "_x", "_xb") \
        .withColumn("_pt", F.when(F.col("_tag") == 0, F.struct(F.col("_x").alias("t"), F.col("_s").alias("s"))))
    u = _nearest_before(u, key, "_x", "_tag", "_pt", "_xb", "_lo")
    u = _nearest_before(u, key, "_x", "_tag", "_pt", "_xb", "_hi", descending=True)
    v = F.when(F.col("_lo").isNull(), F.col("_hi.s")) \
        .when(F.col("_hi").isNull(), F.col("_lo.s")) \
        .when(F.col("_hi.t") == F.col("_lo.t"), F.col("_lo.s")) \
        .otherwise(F.col("_lo.s") + (F.col("_x") - F.col("_lo.t")) * (F.col("_hi.s") - F.col("_lo.s"))
                   / (F.col("_hi.t") - F.col("_lo.t")))
    return u.where(F.col("_tag") == 1).select(*key, F.col("_x").alias(x), v.alias(name))


def ffill_on_grid(grid: DataFrame, steps: DataFrame, key: list[str], t: str, v: str, name: str) -> DataFrame:
    """``reindex(grid, method='ffill').fillna(0)`` of a step function.

    Bucketed like the as-of join: fill inside (key, t-bucket) windows, carry
    the last step of earlier buckets from a per-(key, bucket) table."""
    g = grid.select(*key, F.col(t).cast("double").alias("_t"), F.lit(None).cast("double").alias("_v"),
                    F.lit(1).alias("_tag"))
    s = steps.select(*key, F.col(t).cast("double").alias("_t"), F.col(v).cast("double").alias("_v"),
                     F.lit(0).alias("_tag"))
    u = g.unionByName(s)
    u = equi_depth(u, "_t", "_b")
    w = Window.partitionBy(*key, "_b").orderBy("_t", "_tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_in", F.last("_v", ignorenulls=True).over(w))
    last = u.where(F.col("_tag") == 0).groupBy(*key, "_b").agg(F.max_by("_v", "_t").alias("_lastv"))
    # grid buckets sort before the same bucket's last step: carry = last step
    # of strictly earlier buckets
    gb = u.where(F.col("_tag") == 1).select(*key, "_b").distinct().withColumn("_k", F.lit(0))
    lb = last.withColumn("_k", F.lit(1))
    wb = Window.partitionBy(*key).orderBy("_b", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = gb.unionByName(lb, allowMissingColumns=True) \
        .withColumn("_carry", F.last("_lastv", ignorenulls=True).over(wb)) \
        .where(F.col("_k") == 0).select(*key, "_b", "_carry")
    out = u.where(F.col("_tag") == 1).join(carry, key + ["_b"], "left")
    return out.select(*key, F.col("_t").alias(t),
                      F.coalesce(F.col("_in"), F.col("_carry"), F.lit(0.0)).alias(name))


def linspace(spark, start: float, stop: float, num: int, name: str = "x") -> DataFrame:
    """``np.linspace`` as a small frame (id, x)."""
    step = (stop - start) / (num - 1) if num > 1 else 0.0
    return spark.range(num).select(F.col("id").alias("grid_id"),
                                   (F.lit(float(start)) + F.col("id") * F.lit(step)).alias(name))


def running_sums(df: DataFrame, keys: list[str], t: str, cols: list[str], descending: bool = False,
                 ties: list[str] | None = None, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``cols`` in ``t`` order within ``keys``.

    Rows are windowed per (keys, equi-depth range of ``t``); each range adds the
    totals of all earlier ranges from a small per-(keys, range) table.
    A global or hot-key order never lands in a single task. All columns are
    built in single projections (wide inputs plan in linear time)."""
    ties = ties or []
    tord = F.desc(t) if descending else F.asc(t)
    w = Window.partitionBy(*keys, "_rb").orderBy(tord, *[F.asc(c) for c in ties]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = equi_depth(df, t, "_rb", descending)
    d = ranged.select("*", *[F.sum(c).over(w).alias("_in_" + c) for c in cols])
    tot = ranged.groupBy(*keys, "_rb").agg(*[F.sum(c).alias("_t_" + c) for c in cols])
    wb = Window.partitionBy(*keys).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, "_rb", *[F.coalesce(F.sum("_t_" + c).over(wb), F.lit(0)).alias("_b_" + c) for c in cols])
    d = d.join(tot, keys + ["_rb"], "left")
    keep = [F.col(c) for c in df.columns]
    return d.select(*keep, *[(F.col("_in_" + c) + F.col("_b_" + c)).alias(prefix + c) for c in cols])


def count_dominating(data: DataFrame, queries: DataFrame, keys: list[str], t: str = "t", w: str = "w",
                     tie_flag: str = "tie_counts", qid: list[str] | None = None) -> DataFrame:
    """For each query row: total weight of data rows in the same ``keys``
    group with ``t_data > t_query``, or ``t_data == t_query`` when the data
    row's ``tie_flag`` is true. Bucketed like ``running_sums``; no pairs are
    formed. Returns queries' ``qid`` columns + ``cnt``."""
    qid = qid or []
    D = data.select(*keys, F.col(t).alias("_t"), F.col(w).cast("double").alias("_w"),
                    F.when(F.col(tie_flag), F.lit(0)).otherwise(F.lit(2)).alias("_k"),
                    *[F.lit(None).alias(c) for c in qid])
    Q = queries.select(*keys, F.col(t).alias("_t"), F.lit(0.0).alias("_w"), F.lit(1).alias("_k"),
                       *[F.col(c) for c in qid])
    D = D.select(*keys, "_t", "_w", "_k", *[F.col(c).cast(dict(Q.dtypes)[c]).alias(c) for c in qid])
    u = equi_depth(D.unionByName(Q), "_t", "_rb", descending=True)
    win = Window.partitionBy(*keys, "_rb").orderBy(F.desc("_t"), F.asc("_k")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_run", F.sum("_w").over(win))
    tot = u.groupBy(*keys, "_rb").agg(F.sum("_w").alias("_tot"))
    wb = Window.partitionBy(*keys).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("_above", F.coalesce(F.sum("_tot").over(wb), F.lit(0.0)))
    q = u.where(F.col("_k") == 1).join(tot.select(*keys, "_rb", "_above"), keys + ["_rb"], "left")
    return q.select(*keys, *qid, (F.col("_run") + F.col("_above")).alias("cnt"))


def _dense_rank_by_range(d: DataFrame, c: str, name: str) -> DataFrame:
    """Rank of distinct values via ``repartitionByRange``: partition p holds
    a contiguous, sample-balanced value range, so rank = (rows of the earlier
    partitions) + row number inside p. Partition ids are pinned by a reliable
    checkpoint so counts and rows come from the same split; the offset table
    has one row per partition."""
    from cartwheel.session import stage
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = stage(d.repartitionByRange(parts, c).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    off = r.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = Window.partitionBy("_p").orderBy(c)
    return r.join(F.broadcast(off.select("_p", "_off")), "_p") \
        .select(c, (F.col("_off") + F.row_number().over(within) - 1).cast("long").alias(name))


def dense_rank_exact(values: DataFrame, c: str, name: str = "rank") -> DataFrame:
    """Exact 0-based dense rank of the distinct values of ``c``: a bucketed
    running count over the distinct-value table (windows per value bucket
    plus a small bucket-total table), so no single task sees all values.
    Non-numeric columns (no order-preserving double key) are ranked over
    range partitions of the distinct values instead."""
    from pyspark.sql import types as T
    d = values.select(F.col(c)).where(F.col(c).isNotNull()).distinct()
    if not isinstance(values.schema[c].dataType, T.NumericType):
        return _dense_rank_by_range(d, c, name)
    d = d.withColumn("_v", F.col(c).cast("double")).withColumn("_one", F.lit(1))
    r = running_sums(d, [], "_v", ["_one"], ties=[c], prefix="_cum")
    return r.select(c, (F.col("_cum_one") - 1).cast("long").alias(name))


# ------------------------------------------------- exact ranks, hot-group safe
def exact_rank(df: DataFrame, group: list[str], value: str, tiebreak: str, name: str = "rank") -> DataFrame:
    """0-based ``row_number() over (partition by group order by value, tiebreak)``
    without a window over a whole group: the row's position in one ordered scan,
    whose range partitions cut hot groups and hot values alike. Null values come
    first. ``tiebreak`` must be a unique long per row within the group. ``group``
    has one column at most. Also adds ``<name>_n``, the group size."""
    keyed = df.withColumn("_xv", F.col(value).cast("double")).withColumn("_xk", _one_key(group))
    d = ordered_scan(keyed, "_xk", ["_xv", tiebreak], position="_xp")
    n = d.groupBy("_xk").agg(F.count(F.lit(1)).alias(name + "_n")).withColumnRenamed("_xk", "_xg")
    return d.join(n, F.col("_xk").eqNullSafe(F.col("_xg"))).withColumn(name, F.col("_xp")) \
        .select(*[F.col(f"`{c}`") for c in df.columns], name + "_n", name)


def _one_key(group: list[str]) -> Column:
    """The scan key of a group of no or one column."""
    if len(group) > 1:
        raise ValueError("one group column at most")
    return F.col(group[0]) if group else F.lit(0)


def row_key(*cols) -> Column:
    """A long tie-break key for ``exact_rank`` from the given columns."""
    return F.xxhash64(*[col(c) for c in cols])


def exact_quantiles(df: DataFrame, group: list[str], value: str, probs: list[float], name: str = "q") -> DataFrame:
    """Linear-interpolated quantiles (numpy / pandas default) per group,
    distributed and exact: the (group, value) -> count table (partial
    aggregation, so hot groups and heavy ties collapse), its running counts by one
    ordered scan, then the values holding ranks floor/ceil(p * (n - 1)). ``group``
    has one column at most. One row per group with columns ``<name>_<i>``; no
    buffer of a whole group."""
    d = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_xv"))
    dv = d.groupBy(*group, "_xv").agg(F.count(F.lit(1)).alias("_c")).withColumn("_xk", _one_key(group))
    dv = ordered_scan(dv, "_xk", ["_xv"], sums={"_c": "_cum_c"}).drop("_xk")
    n = dv.groupBy(*group).agg(F.max("_cum_c").alias("_n"))
    dv = (dv.join(n, group) if group else dv.crossJoin(F.broadcast(n))) \
        .withColumn("_below", F.col("_cum_c") - F.col("_c"))
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        klo, khi = F.floor(pos), F.ceil(pos)
        has_lo = (F.col("_below") <= klo) & (klo < F.col("_cum_c"))
        has_hi = (F.col("_below") <= khi) & (khi < F.col("_cum_c"))
        aggs.append(F.max(F.when(has_lo, F.col("_xv"))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when(has_hi, F.col("_xv"))).alias(f"_hi{i}"))
        aggs.append(F.max(pos - klo).alias(f"_fr{i}"))
    cand = dv.where(F.lit(False) if not probs else
                    __import__("functools").reduce(lambda a, b: a | b, [
                        ((F.col("_below") <= F.floor(F.lit(float(p)) * (F.col("_n") - 1)))
                         & (F.floor(F.lit(float(p)) * (F.col("_n") - 1)) < F.col("_cum_c")))
                        | ((F.col("_below") <= F.ceil(F.lit(float(p)) * (F.col("_n") - 1)))
                           & (F.ceil(F.lit(float(p)) * (F.col("_n") - 1)) < F.col("_cum_c")))
                        for p in probs]))
    g = cand.groupBy(*group).agg(*aggs)
    return g.select(*group, *[(F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
                              .alias(f"{name}_{i}") for i in range(len(probs))])
