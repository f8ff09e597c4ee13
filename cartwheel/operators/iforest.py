"""Distributed isolation forest (F9), after Liu, Ting & Zhou (2008).

* Subsampling without an explode of rows x trees: every row computes one
  hash per tree in SQL and keeps only the trees whose hash falls under a
  small threshold (a row joins ~trees * oversample * psi / n trees); each
  tree keeps the ``psi`` rows with the smallest hashes.
* Trees are grown in parallel, one ``applyInPandas`` group per tree (group
  size ~ psi, bounded), and serialised as node arrays; the forest (<= trees
  x (2 psi - 1) nodes) is broadcast in the scoring closure.
* Scoring is ``mapInPandas`` (vectorised level-by-level descent); the
  decision threshold is the exact ``contamination`` percentile of the
  scores.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators.features import MODEL_FLAG_THRESHOLD
from cartwheel.operators.relational import exact_quantiles
from cartwheel.operators.survival import standardize
from cartwheel.session import staged_parquet

# Model features and forest settings of the anomaly stage.
MODEL_FEATURES = ["events_7d", "events_30d", "prop_addtocart", "prop_tx", "events_per_active_day"]
N_ESTIMATORS, MAX_SAMPLES, CONTAMINATION, SEED = 100, 256, 1e-5, 42
EULER_GAMMA = 0.5772156649015329


def c_factor(n):
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(X: np.ndarray, rng: np.random.RandomState, max_depth: int):
    feat, thr, left, right, size = [], [], [], [], []

    def new(n):
        feat.append(-1); thr.append(0.0); left.append(-1); right.append(-1); size.append(n)
        return len(feat) - 1
    root = new(len(X))
    stack = [(np.arange(len(X)), 0, root)]
    while stack:
        idx, depth, node = stack.pop()
        if depth >= max_depth or len(idx) <= 1:
            continue
        cand = [q for q in rng.permutation(X.shape[1]) if X[idx, q].min() < X[idx, q].max()]
        if not cand:
            continue
        q = cand[0]
        lo, hi = X[idx, q].min(), X[idx, q].max()
        p = rng.uniform(lo, hi)
        m = X[idx, q] < p
        li, ri = new(int(m.sum())), new(int((~m).sum()))
        feat[node], thr[node], left[node], right[node] = q, p, li, ri
        stack.append((idx[m], depth + 1, li))
        stack.append((idx[~m], depth + 1, ri))
    return feat, thr, left, right, size


def _tree_builder(cols: list[str], psi: int, seed: int):
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values(["_h", "_rid"]).head(psi)
        X = pdf[cols].to_numpy(dtype=float)
        f, t, le, ri, sz = _grow(X, np.random.RandomState(seed + tree_id), max_depth)
        return pd.DataFrame({"tree_id": [tree_id], "feature": [f], "threshold": [t], "left": [le],
                             "right": [ri], "size": [sz], "n_samples": [len(X)]})
    return build


def fit(df: DataFrame, cols: list[str], key: str, n_estimators: int = N_ESTIMATORS, max_samples: int = MAX_SAMPLES,
        seed: int = SEED, oversample: float = 3.0):
    """Grow the forest; returns (trees as python lists, psi)."""
    n = df.count()
    psi = int(min(max_samples, n))
    frac = min(1.0, oversample * psi / max(n, 1))
    cut = int(frac * (1 << 31))
    h = F.expr(f"transform(sequence(0, {n_estimators - 1}), t -> struct(t AS tree_id, "
               f"pmod(xxhash64(_rid, t, {seed}), 2147483648) AS h))")
    s = df.select(F.col(key).alias("_rid"), *cols).withColumn("_th", F.explode(F.filter(h, lambda x: x["h"] < cut))) \
        .select("_rid", *cols, F.col("_th.tree_id").alias("tree_id"), F.col("_th.h").alias("_h"))
    schema = ("tree_id int, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
              "size array<int>, n_samples int")
    trees = s.groupBy("tree_id").applyInPandas(_tree_builder(cols, psi, seed), schema).collect()
    forest = [(np.array(r["feature"]), np.array(r["threshold"]), np.array(r["left"]), np.array(r["right"]),
               np.array(r["size"])) for r in sorted(trees, key=lambda r: r["tree_id"])]
    return forest, psi


def _path_lengths(X: np.ndarray, forest, psi: int) -> np.ndarray:
    total = np.zeros(len(X))
    for feat, thr, left, right, size in forest:
        node = np.zeros(len(X), dtype=int)
        depth = np.zeros(len(X))
        active = feat[node] >= 0
        while active.any():
            f = feat[node[active]]
            go_left = X[np.flatnonzero(active), f] < thr[node[active]]
            nxt = np.where(go_left, left[node[active]], right[node[active]])
            node[active] = nxt
            depth[active] += 1
            active = feat[node] >= 0
        total += depth + c_factor(size[node])
    return total / len(forest)


def score(df: DataFrame, cols: list[str], forest, psi: int, name: str = "score_samples") -> DataFrame:
    """sklearn-style ``score_samples`` = -2 ** (-E[h] / c(psi))."""
    cpsi = float(c_factor(np.array([psi]))[0]) or 1.0
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(name, T.DoubleType())])

    def kernel(it):
        for pdf in it:
            X = pdf[cols].to_numpy(dtype=float)
            pdf[name] = -np.power(2.0, -_path_lengths(X, forest, psi) / cpsi) if len(pdf) else np.array([])
            yield pdf
    return df.mapInPandas(kernel, out_schema)


def model_based_flags(df: DataFrame, seed: int = SEED, n_estimators: int = N_ESTIMATORS,
                      features: list[str] | None = None, key: str = "visitorid",
                      contamination: float = CONTAMINATION) -> DataFrame:
    """standardised features -> forest -> iso_score (decision function),
    iso_flag, iso_score_norm = 1 - minmax(iso_score), model_flag >= 0.6."""
    feats = [f for f in (features or MODEL_FEATURES) if f in df.columns]
    zs = [f"_z_{f}" for f in feats]
    df = staged_parquet(df, "iforest-users")  # read by the statistics, the fit and the scores
    x = standardize(df, df, feats, suffix="__z")
    x = x.select(*df.columns, *[F.col(f + "__z").alias(z) for f, z in zip(feats, zs)])
    forest, psi = fit(x, zs, key, n_estimators, seed=seed)
    s = staged_parquet(score(x, zs, forest, psi, "_ss"), "iforest-scores")
    off = exact_quantiles(s, [], "_ss", [float(contamination)]).select(F.col("q_0").alias("_off"))
    s = s.crossJoin(F.broadcast(off)).withColumn("iso_score", F.col("_ss") - F.col("_off")) \
        .withColumn("iso_flag", (F.col("iso_score") < 0).cast("int"))
    mm = s.agg(F.min("iso_score").alias("_mn"), F.max("iso_score").alias("_mx"))
    s = s.crossJoin(F.broadcast(mm)).withColumn(
        "iso_score_norm", F.when(F.col("_mx") == F.col("_mn"), F.lit(0.0))
        .otherwise(F.lit(1.0) - (F.col("iso_score") - F.col("_mn")) / (F.col("_mx") - F.col("_mn"))))
    return s.withColumn("model_flag", (F.col("iso_score_norm") >= MODEL_FLAG_THRESHOLD).cast("int")) \
        .drop("_ss", "_off", "_mn", "_mx", *zs)
