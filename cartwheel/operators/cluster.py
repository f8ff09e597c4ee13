"""Customer clustering with MLlib.

KMeans restarts (sklearn's ``n_init``) keep the fit with the lowest
training cost; they start from MLlib's k-means|| centers and share the passes of
Lloyd's steps. Gaussian mixtures use full covariances. Cluster ids are
relabelled by ascending mean of the first feature so that labels are stable
across runs and engines. Silhouette uses MLlib's distributed
``ClusteringEvaluator`` (squared Euclidean distance - the exact Euclidean
form needs all pairs and is not built)."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.rfm import adjusted_rand_index, bootstrap_sample
from cartwheel.operators.survival import standardize

CLUSTER_FEATURES = ["recency_days_log", "frequency_log", "monetary_avg_log"]
K_RANGE = range(2, 11)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


MAX_PARALLEL_FITS = 8


# Rows of a task whose distances are worked out at a time, and of a partition at least.
BLOCK_ROWS, FIT_ROWS_PER_TASK = 4096, 25_000


@dataclass
class FittedKMeans:
    """Centers, and the cost of the rows against the centers of the last step's start."""
    centers: np.ndarray
    cost: float

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """``df`` with the number of the nearest center (the first one on ties)."""
        x = vector_to_array(features)
        far = F.array(*[sum(((F.get(F.col("_x"), F.lit(i)) - F.lit(float(v))) ** 2 for i, v in enumerate(c)), F.lit(0.0))
                        for c in self.centers])
        return df.withColumn("_x", x).withColumn("_far", far) \
            .withColumn(out, (F.array_position("_far", F.array_min("_far")) - 1).cast("int")).drop("_x", "_far")


def _points(df: DataFrame) -> DataFrame:
    return df.select(vector_to_array("features").alias("x"))


def _lloyd_step(points: DataFrame, fits: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """One pass over the rows for all fits: per fit the rows and sums of its clusters
    and the cost. A task hands on these numbers alone."""
    d = fits[0].shape[1]
    ends = np.cumsum([len(c) * (d + 1) + 1 for c in fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = [np.zeros((len(c), d + 1)) for c in fits], 0
        cost = np.zeros(len(fits))
        for b in batches:
            rows = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, d)
            seen += len(rows)
            for at in range(0, len(rows), BLOCK_ROWS):
                x = rows[at:at + BLOCK_ROWS]
                for j, c in enumerate(fits):
                    far = -2.0 * (c @ x.T) + (c * c).sum(axis=1)[:, None]
                    near, best = np.zeros(len(x), dtype=np.int64), far[0].copy()
                    for i in range(1, len(c)):
                        near[far[i] < best] = i
                        np.minimum(best, far[i], out=best)
                    held[j][:, 0] += np.bincount(near, minlength=len(c))
                    for k in range(d):
                        held[j][:, k + 1] += np.bincount(near, x[:, k], len(c))
                    cost[j] += ((x - c[near]) ** 2).sum()
        if seen:
            flat = np.concatenate([np.append(h.ravel(), v) for h, v in zip(held, cost)])
            yield pa.RecordBatch.from_pydict({"sums": [flat]})

    parts = points.mapInArrow(run, "sums array<double>").collect()
    total = np.sum([np.array(r["sums"]) for r in parts], axis=0)
    out = []
    for c, part in zip(fits, np.split(total, ends[:-1])):
        sums = part[:-1].reshape(len(c), d + 1)
        out.append((sums[:, 0], sums[:, 1:], float(part[-1])))
    return out


def _start(df: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k-means|| start of MLlib: a fit without a step."""
    return np.array(KMeans(k=k, seed=seed, maxIter=0, featuresCol="features").fit(df).clusterCenters())


def lloyd(df: DataFrame, starts: list[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[FittedKMeans]:
    """Lloyd's steps from each start until no center moves farther than ``tol``. All
    fits that go on share a step's pass, so the Spark jobs are as many as the
    steps of the slowest fit. A cluster without rows keeps its center."""
    points = _points(df).persist()
    fits = [FittedKMeans(c, 0.0) for c in starts]
    going = list(range(len(fits)))
    for _ in range(max_iter):
        if not going:
            break
        still = []
        for j, (n, sums, cost) in zip(going, _lloyd_step(points, [fits[j].centers for j in going])):
            old = fits[j].centers
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], old)
            fits[j] = FittedKMeans(new, cost)
            if (((new - old) ** 2).sum(axis=1) > tol * tol).any():
                still.append(j)
        going = still
    points.unpersist()
    return fits


def _best_restart(models: list[FittedKMeans]) -> FittedKMeans:
    """Lowest training cost; ties go to the earliest restart."""
    return min(enumerate(models), key=lambda im: (im[1].cost, im[0]))[1]


def fit_kmeans(df: DataFrame, k: int, seed: int = 42, n_init: int = 10, max_iter: int = 300, tol: float = 1e-4) -> FittedKMeans:
    """Best of ``n_init`` seeded restarts, which take their steps together."""
    with ThreadPoolExecutor(max_workers=min(n_init, MAX_PARALLEL_FITS)) as ex:
        starts = list(ex.map(lambda i: _start(df, k, seed + i), range(n_init)))
    return _best_restart(lloyd(df, starts, max_iter, tol))


def fit_input(df: DataFrame) -> DataFrame:
    """Kept rows in partitions of about ``FIT_ROWS_PER_TASK``, and no more of them than
    the cluster works on at once: a fit makes hundreds of passes, and each has a
    task's costs and results per partition."""
    most = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(1, min(most, -(-df.count() // FIT_ROWS_PER_TASK)))).persist()


def fit_gmm(df: DataFrame, k: int, seed: int = 42, max_iter: int = 100, tol: float = 1e-3):
    return GaussianMixture(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features").fit(df)


def silhouette(pred: DataFrame, col: str = "prediction") -> float:
    return ClusteringEvaluator(predictionCol=col, featuresCol="features").evaluate(pred)


def relabel(pred: DataFrame, first_feature: str, col: str = "prediction", out: str = "segment") -> DataFrame:
    """Stable ids: clusters ordered by the mean of ``first_feature`` (small table)."""
    order = pred.groupBy(col).agg(F.avg(first_feature).alias("_m"))
    order = order.withColumn(out, (F.row_number().over(Window.orderBy("_m", col)) - 1).cast("int"))
    return pred.join(F.broadcast(order.select(col, out)), col).drop(col)


def compare_models(df: DataFrame, cols: list[str] | None = None, k_range=K_RANGE, scale: bool = True,
                   seed: int = 42, n_init: int = 10) -> DataFrame:
    """Silhouette of KMeans and GMM for each k on (population-)scaled features."""
    cols = cols or CLUSTER_FEATURES
    x = standardize(df, df, cols) if scale else df
    x = fit_input(assemble(x, cols).select("features"))

    ks = list(k_range)

    def gmm_row(k):
        return ("GMM", k, silhouette(fit_gmm(x, k, seed).transform(x)))
    # the mixtures are fitted beside the joint steps of all (k, restart) fits
    with ThreadPoolExecutor(max_workers=MAX_PARALLEL_FITS) as ex:
        tried = [(k, i) for k in ks for i in range(n_init)]
        starts = list(ex.map(lambda ki: _start(x, ki[0], seed + ki[1]), tried))
        gm = [ex.submit(gmm_row, k) for k in ks]
        km = dict(zip(tried, lloyd(x, starts)))
        best = {k: _best_restart([km[k, i] for i in range(n_init)]) for k in ks}
        sil = {k: ex.submit(silhouette, best[k].transform(x)) for k in ks}
        rows = [("KMeans", k, sil[k].result()) for k in ks] + [f.result() for f in gm]
    x.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, k int, silhouette double")


def comparison_pivot(results: DataFrame) -> DataFrame:
    return results.groupBy("k").pivot("model", ["GMM", "KMeans"]).agg(F.first("silhouette"))


def segment(df: DataFrame, cols: list[str] | None = None, model: str = "gmm", k: int = 4, seed: int = 42,
            n_init: int = 10, key: str = "visitorid"):
    """Labels on unscaled features, silhouette and
    bootstrap-stability ARI (refit on a Poisson bootstrap sample, compare
    labels of the resampled rows)."""
    cols = cols or CLUSTER_FEATURES
    x = fit_input(assemble(df, cols))
    fitter = (lambda d: fit_gmm(d, k, seed)) if model == "gmm" else (lambda d: fit_kmeans(d, k, seed, n_init))
    m1 = fitter(x)
    p1 = m1.transform(x)
    sil = silhouette(p1)
    boot = bootstrap_sample(x, seed)
    m2 = fitter(boot)
    both = m2.transform(m1.transform(boot).withColumnRenamed("prediction", "l1")
                        .drop("probability", "rawPrediction")).withColumnRenamed("prediction", "l2")
    ari = adjusted_rand_index(both, "l1", "l2").first()["ari"]
    labels = relabel(p1.select(key, cols[0], "prediction"), cols[0]).select(key, "segment")
    out = df.join(labels, key, "left")
    metrics = df.sparkSession.createDataFrame([(model, k, float(sil), float(ari))],
                                              "model string, k int, silhouette double, stability_ari double")
    return out, metrics
