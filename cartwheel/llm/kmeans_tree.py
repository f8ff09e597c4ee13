"""Approximate nearest neighbours by a hierarchical k-means tree.

* *Tree.* k-means with ``BRANCH`` centres is repeated inside each cluster until
  a leaf stands for about ``leaf_rows`` rows (default: four times the square
  root of their number). It is fitted in one task on at
  most ``SAMPLE_ROWS`` vectors chosen by a hash of the id (a documented bound);
  every row is then put in a leaf by descending to the nearest centre.
* *Search.* A query keeps a priority queue of tree nodes by the inner product
  with their centres, opens the best one first and visits leaves until the
  calibrated number is reached and the visited leaves hold enough rows. Its
  best leaves are compared first; the k-th score found there bounds what the
  others return.
* *Calibration.* For up to ``CALIBRATION`` queries the true neighbours are found
  by brute force over all rows; leaf visits are widened until the mean share of
  true neighbours inside the visited leaves reaches ``recall``.

Rows meet queries per leaf. Leaves and visit lists are dealt into blocks of at
most ``LEAF_BLOCK`` rows and ``QUERY_BLOCK`` queries, so a vector that a third of
all rows repeat fills many tasks instead of one; nothing is capped. The
driver gets the tree, the leaf sizes and the calibration ranks only, all
bounded by the sample size.

Scores are inner products in double precision, summed in component order, so
equal vectors tie exactly and ties go to the smaller id. Vectors that are null,
empty, zero, or hold null or non-finite components take no part, nor do those
of another length than the most frequent one (ties: the longer); neither do
rows without id. Repeated ids count once, with the smallest vector. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import staged

SAMPLE_ROWS = 20_000
BRANCH = 16
CALIBRATION = 256
LEAF_BLOCK = 2048
QUERY_BLOCK = 512


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (array of doubles) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = rows.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()) \
        .where((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)) \
        .select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
    sizes = ok.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    ok = ok.where(F.size("vec") == (sizes[0][0] if sizes else 0))
    return ok.groupBy("id").agg(F.min("vec").alias("vec"))


def _matrix(col: pd.Series) -> np.ndarray:
    return np.array(col.tolist(), np.float64).reshape(len(col), -1)


def _lloyd(x: np.ndarray, k: int, rng: np.random.RandomState) -> tuple[np.ndarray, np.ndarray]:
    """Centres and memberships; empty centres vanish."""
    far = np.full(len(x), np.inf)
    centres = [x[rng.randint(len(x))]]
    for _ in range(1, k):  # spread starts
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(axis=1))
        if far.sum() <= 0:
            break
        centres.append(x[rng.choice(len(x), p=far / far.sum())])
    c = np.array(centres)
    for _ in range(12):
        own = ((c * c).sum(axis=1)[None] - 2 * x @ c.T).argmin(axis=1)
        used = np.unique(own)
        c = np.array([x[own == i].mean(axis=0) for i in used])
    own = ((c * c).sum(axis=1)[None] - 2 * x @ c.T).argmin(axis=1)
    used, own = np.unique(own, return_inverse=True)
    return c[used], own


def build_tree(x: np.ndarray, leaf_size: float) -> dict:
    """Arrays: ``centre`` per node, ``first`` and ``count`` of its children
    (contiguous), ``leaf`` number or -1. Node 0 is the root."""
    rng = np.random.RandomState(11)
    centre, first, count, leaf = [x.mean(axis=0)], [0], [0], [-1]
    todo, leaves = [(0, x)], 0
    while todo:
        node, own = todo.pop()
        k = int(min(BRANCH, np.ceil(len(own) / max(leaf_size, 1.0))))
        c, member = _lloyd(own, k, rng) if k > 1 else (own[:1], np.zeros(len(own), int))
        if len(c) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        first[node], count[node] = len(centre), len(c)
        for i in range(len(c)):
            todo.append((len(centre), own[member == i]))
            centre.append(c[i]), first.append(0), count.append(0), leaf.append(-1)
    return {"centre": np.array(centre), "first": np.array(first), "count": np.array(count),
            "leaf": np.array(leaf), "leaves": leaves}


def assign(tree: dict, x: np.ndarray) -> np.ndarray:
    """Leaf of each row of ``x``."""
    node = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(tree["leaf"][node] < 0)
        if not len(inner):
            return tree["leaf"][node]
        for n in np.unique(node[inner]):
            rows = inner[node[inner] == n]
            kids = tree["centre"][tree["first"][n]:tree["first"][n] + tree["count"][n]]
            # component by component, so that equal rows get equal leaves in any batch
            dist = np.zeros((len(rows), len(kids)))
            for d in range(kids.shape[1]):
                dist += (x[rows, d][:, None] - kids[None, :, d]) ** 2
            node[rows] = tree["first"][n] + dist.argmin(axis=1)


def best_bins(tree: dict, q: np.ndarray) -> Iterator[int]:
    """Leaves in best-bin-first order for the query."""
    queue = [(0.0, 0)]
    while queue:
        _, n = heapq.heappop(queue)
        if tree["leaf"][n] >= 0:
            yield int(tree["leaf"][n])
            continue
        a, m = int(tree["first"][n]), int(tree["count"][n])
        for i, s in enumerate(tree["centre"][a:a + m] @ q):
            heapq.heappush(queue, (-float(s), a + i))


def inner_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    out = np.zeros((len(q), len(v)))
    for d in range(q.shape[1]):
        out += q[:, d][:, None] * v[None, :, d]
    return out


def top_rows(q_id: np.ndarray, q: np.ndarray, v_id: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest rows of each query among ``v``, ties to the smaller id."""
    order = np.argsort(v_id, kind="stable")
    v_id, v = v_id[order], v[order]
    score = inner_products(q, v)
    own = q_id[:, None] == v_id[None, :]
    place = np.argsort(np.where(own, np.inf, -score), axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(len(q)), place.shape[1])
    cols = place.ravel()
    keep = ~own[rows, cols]
    return pd.DataFrame({"query_id": q_id[rows[keep]], "vec_id": v_id[cols[keep]], "score": score[rows[keep], cols[keep]]})


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def fit_tree(index: DataFrame, rows: int, leaf_rows: int, sample_rows: int) -> dict:
    leaf_size = leaf_rows * min(1.0, sample_rows / max(rows, 1))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [_matrix(pdf["vec"]) for pdf in batches if len(pdf)]
        if parts:
            yield pd.DataFrame({"tree": [pickle.dumps(build_tree(np.concatenate(parts), max(leaf_size, 8.0)))]})

    sample = index.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("id", "vec")
    got = sample.repartition(1).sortWithinPartitions("id").select("vec").mapInPandas(fit, "tree binary").collect()
    return pickle.loads(bytes(got[0]["tree"]))


def calibrate(index: DataFrame, queries: DataFrame, tree: dict, tree_b, k: int, recall: float, n: int) -> int:
    """Leaf visits at which the mean recall of the calibration queries holds."""
    chosen = queries.orderBy(F.xxhash64("id"), "id").limit(n).toPandas()
    if not len(chosen):
        return 1
    sc = index.sparkSession.sparkContext
    ids, vecs = chosen["id"].to_numpy(np.int64), _matrix(chosen["vec"])
    probe_b = sc.broadcast((ids, vecs))

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q_id, q = probe_b.value
        for pdf in batches:
            v_id, leaf = pdf["id"].to_numpy(np.int64), pdf["leaf"].to_numpy()
            v = _matrix(pdf["vec"])
            for a in range(0, len(pdf), LEAF_BLOCK):
                out = top_rows(q_id, q, v_id[a:a + LEAF_BLOCK], v[a:a + LEAF_BLOCK], k)
                at = dict(zip(v_id[a:a + LEAF_BLOCK].tolist(), leaf[a:a + LEAF_BLOCK].tolist()))
                yield out.assign(leaf=out["vec_id"].map(at).astype("int32"))

    truth = _best(index.mapInPandas(brute, "query_id long, vec_id long, score double, leaf int"), k) \
        .select("query_id", "leaf").toPandas()  # at most n * k rows
    order = {int(i): {leaf: r for r, leaf in enumerate(best_bins(tree, v))} for i, v in zip(ids, vecs)}
    ranks = np.array([order[int(a)][int(b)] for a, b in zip(truth["query_id"], truth["leaf"])])
    visits = 1
    while visits < tree["leaves"] and len(ranks) and (ranks < visits).mean() < recall:
        visits += max(1, visits // 8)
    return min(visits, tree["leaves"])


def search(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           recall: float = 0.97, leaf_rows: int | None = None, sample_rows: int = SAMPLE_ROWS,
           calibration: int = CALIBRATION) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query row
    (``is_query`` is a condition on the column ``id``)."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    vectors = staged(valid_vectors(rows, id_col, vec_col), "vectors")
    total = vectors.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # visits and rows compared per query both grow with the square root of the rows
    tree = fit_tree(vectors, total, leaf_rows or max(128, int(4 * total ** 0.5)), sample_rows)
    tree_b = sc.broadcast(tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(leaf=assign(tree_b.value, _matrix(pdf["vec"])).astype(np.int32))

    index = staged(vectors.mapInPandas(place, "id long, vec array<double>, leaf int"), "leaf-index")
    queries = vectors.where(is_query)
    visits = calibrate(index, queries, tree, tree_b, k, recall, calibration)
    sizes = np.zeros(tree["leaves"], np.int64)
    for r in index.groupBy("leaf").count().collect():  # a row per leaf
        sizes[r[0]] = r[1]
    sizes_b = sc.broadcast(sizes)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = sizes_b.value
        for pdf in batches:
            out: list[tuple] = []
            for i, q in zip(pdf["id"], _matrix(pdf["vec"]) if len(pdf) else []):
                seen = 0
                for n, leaf in enumerate(best_bins(tree_b.value, q)):
                    if n >= visits and seen > k:
                        break
                    seen += size[leaf]
                    if size[leaf]:
                        out.append((i, leaf, n))
            yield pd.DataFrame(out, columns=["id", "leaf", "n"])

    visited = staged(queries.mapInPandas(visit, "id long, leaf int, n int"), "leaf-visits")
    asks = np.zeros(tree["leaves"], np.int64)
    for r in visited.groupBy("leaf").count().collect():
        asks[r[0]] = r[1]
    blocks = spark.createDataFrame(  # a row per leaf
        [(int(i), int(-(-sizes[i] // LEAF_BLOCK)), int(-(-asks[i] // QUERY_BLOCK)))
         for i in range(tree["leaves"]) if sizes[i] and asks[i]], "leaf int, nv int, nq int")
    dealt = F.broadcast(blocks)

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def one(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    right = index.join(dealt, "leaf").withColumn("vb", one("nv")).withColumn("qb", every("nq")) \
        .select("leaf", "vb", "qb", "id", "vec")

    def compare(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q_id = q["id"].to_numpy(np.int64)
        out = top_rows(q_id, _matrix(q["vec"]), v["id"].to_numpy(np.int64), _matrix(v["vec"]), k)
        least = dict(zip(q_id.tolist(), q["least"].tolist()))
        return out[out["score"] >= out["query_id"].map(least)]

    def candidates(visits_: DataFrame) -> DataFrame:
        left = visits_.join(queries, "id").join(dealt, "leaf") \
            .withColumn("qb", one("nq")).withColumn("vb", every("nv")).select("leaf", "vb", "qb", "id", "vec", "least")
        return left.groupBy("leaf", "vb", "qb").cogroup(right.groupBy("leaf", "vb", "qb")) \
            .applyInPandas(compare, "query_id long, vec_id long, score double")

    # the best leaves first: their k-th score bounds what the other leaves need to return
    none = F.lit(float("-inf"))
    first = F.col("n") < max(1, visits // 8)
    near = staged(_best(candidates(visited.where(first).withColumn("least", none)), k), "near-candidates")
    bound = near.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    rest = visited.where(~first).join(bound, "id", "left").withColumn("least", F.coalesce("least", none))
    found = near.drop("rank").unionByName(candidates(rest))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
