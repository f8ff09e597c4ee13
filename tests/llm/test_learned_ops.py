"""Quality, toxicity, nearest neighbours and the pipeline: held-out accuracy,
recall against brute force, planted cases and edge rows."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import kmeans_tree, labelled, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def with_labels(spark, name, column):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert list(got["held_out"]) == [held_out(i) for i in got["doc_id"]]
    assert got["score"].between(0, 1).all()
    return got.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id"), got


def auc(score, y):
    r = pd.Series(score).rank()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (r[(y == 1).to_numpy()].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_quality_held_out(spark):
    m, got = with_labels(spark, "op1_quality", "quality")
    m = m[m["held_out"]].reset_index(drop=True)
    assert auc(m["score"], m["quality"]) > 0.97 and (m["predicted"] == m["quality"]).mean() > 0.95
    assert ((got["score"] >= 0.3).astype(int) == got["predicted"]).all()


def test_toxicity_held_out(spark):
    m, got = with_labels(spark, "op9_toxicity", "toxic")
    m = m[m["held_out"]].reset_index(drop=True)
    assert auc(m["score"], m["toxic"]) > 0.85
    assert ((m["predicted"] == 1) & (m["toxic"] == 0)).sum() == 0


EDGE = [(900_001, None), (900_002, ""), (900_003, " \n\t"), (900_004, "word " * 30_000), (None, "no id here"),
        (900_005, "dup"), (900_005, "dup"), (900_006, "🙂 ü"), (900_007, "!!!")]


def planted(spark):
    rng = random.Random(9)
    words = ["river", "stone", "green", "walk", "light", "paper", "house", "north"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        t = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        if bad:
            for _ in range(rng.randint(2, 5)):
                t.insert(rng.randrange(len(t)), rng.choice(["glorkish", "glorkers", "idiot", "scum"]))
        rows.append((i, " ".join(t)))
        labels.append((i, 1 - int(bad), int(bad)))
    docs = spark.createDataFrame([(*r, "x") for r in rows + EDGE], "doc_id long, text string, score string").repartition(4)
    labels += [(900_001, None, None), (900_002, 3, 3), (None, 0, 1), (5, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("op", ["quality", "toxicity"])
def test_planted_labels_and_edge_rows(spark, op):
    docs, labels = planted(spark)
    if op == "quality":
        out = quality.score_quality(docs, quality.train_model(docs, labels, "quality"))
    else:
        out = toxicity.score_toxicity(docs, toxicity.train_model(docs, labels, "toxic"))
    got = out.toPandas()
    assert len(got) == 400 + len(EDGE) and got["score"].between(0, 1).all()
    main = got[got["doc_id"] < 400]
    wrong = ((main["score"] >= 0.5).astype(int) != [(i % 4 == 0) == (op == "toxicity") for i in main["doc_id"]]).mean()
    assert wrong < 0.02
    same = got[got["doc_id"] == 900_005]["score"]
    assert same.nunique() == 1 and len(same) == 2
    blank = got[got["doc_id"].isin([900_001, 900_002, 900_003])]["score"]
    assert blank.nunique() == 1
    empty = docs.limit(0)
    model = (quality if op == "quality" else toxicity).train_model(empty, labels.limit(0))
    assert "share" in model
    score = quality.score_quality if op == "quality" else toxicity.score_toxicity
    assert score(docs, model).select("score").distinct().count() == 1 and score(empty, model).count() == 0


def test_training_sample_leaves_the_fold_out(spark):
    docs, labels = planted(spark)
    ids = docs.withColumn("text", F.col("doc_id").cast("string"))
    got = labelled.training_sample(ids, labels, "toxic", 50).toPandas()
    assert len(got) == 50 and not any(held_out(i) for i in got["text"])
    assert len(labelled.training_sample(ids, labels, "toxic", 10_000).toPandas()) == sum(not held_out(i) for i in range(400))


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.RandomState(0)
    rows = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(200)]
    y = np.where(rng.rand(200) < 0.5, 1, -1)
    rows = [np.append(r, 50 if t > 0 else 51) for r, t in zip(rows, y)]
    values = [np.ones(len(r)) for r in rows]
    w = quality.fit_dual(rows, values, y, 1.0, 200)

    def objective(w):
        m = np.array([w[r].sum() + w[-1] for r in rows]) * y
        return 0.5 * (w @ w) + np.maximum(0, 1 - m).sum()
    best = objective(w)
    for _ in range(200):
        d = np.zeros(len(w))
        d[rng.choice(52, 5)] = rng.randn(5) * 0.02
        assert objective(w + d) >= best - 1e-2


def test_label_model_learns_accuracies():
    rng = np.random.RandomState(1)
    truth = rng.rand(2000) < 0.2
    noisy = np.where(rng.rand(2000) < 0.05, ~truth, truth).astype(int)
    good = [truth & (rng.rand(2000) < 0.7) for _ in range(4)]
    copies = [good[0].copy() for _ in range(3)]
    bad = [rng.rand(2000) < 0.1 for _ in range(2)]
    post = toxicity.label_model(np.stack(good + copies + bad, 1), noisy)
    assert ((post > 0.5) == truth).mean() > ((noisy == 1) == truth).mean()


# -- nearest neighbours -------------------------------------------------------

def exact(ids, x, k):
    out = {}
    for i in range(len(ids)):
        if ids[i] % 20 == 0:
            s = x @ x[i]
            s[i] = -np.inf
            o = np.lexsort((ids, -np.round(s, 12)))[:k]
            out[int(ids[i])] = [int(ids[j]) for j in o if j != i]
    return out


def run_search(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(3)
    got = kmeans_tree.search(df, F.col("id") % 20 == 0, k=20, **kw).toPandas().sort_values(["query_id", "rank"])
    return {int(q): g["vec_id"].tolist() for q, g in got.groupby("query_id")}, got


def test_recall_and_scores(spark):
    rng = np.random.RandomState(2)
    centres = rng.randn(30, 16) * 2
    x = (centres[rng.randint(30, size=3000)] + rng.randn(3000, 16)).astype(np.float32)
    rows = [(i, [float(v) for v in x[i]], "e") for i in range(3000)]
    got, frame = run_search(spark, rows, leaf_rows=64)
    want = exact(np.arange(3000), x.astype(np.float64), 20)
    assert np.mean([len(set(got[q]) & set(w)) / 20 for q, w in want.items()]) >= 0.93
    d = x.astype(np.float64)
    assert np.allclose(frame["score"], (d[frame["query_id"]] * d[frame["vec_id"]]).sum(axis=1))
    assert (frame.groupby("query_id")["rank"].apply(list) .map(lambda r: r == list(range(1, 21)))).all()


def test_hot_vector_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_BLOCK", 50)
    monkeypatch.setattr(kmeans_tree, "QUERY_BLOCK", 7)
    rng = np.random.RandomState(3)
    x = rng.randn(900, 8).astype(np.float32)
    x[rng.permutation(900)[:300]] = x[5]
    got, _ = run_search(spark, [(i, [float(v) for v in x[i]], "e") for i in range(900)], leaf_rows=900)
    assert got == exact(np.arange(900), x.astype(np.float64), 20)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "e"), (20, [0.5, 0.5], "e"), (3, [0.0, 1.0], "e"), (4, None, "e"), (5, [], "e"), (6, [0.0, 0.0], "e"),
            (7, [nan, 1.0], "e"), (8, [inf, 1.0], "e"), (9, [None, 1.0], "e"), (None, [9.0, 9.0], "e"), (10, [1.0, 2.0, 3.0], "e"),
            (3, [0.0, 1.0], "e"), (40, [nan, nan], "e")]
    got, _ = run_search(spark, rows)
    assert got == {0: [20, 3], 20: [0, 3]}
    assert run_search(spark, rows[3:6])[1].empty


# -- pipeline -----------------------------------------------------------------

def test_pipeline_on_planted_cases(spark, tmp_path):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "ra", "to", "vi", "zu") for b in ("den", "fel", "gor", "hap", "jin", "lor")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, labels = [], []
    for i in range(300):
        docs.append((i, text(60), "en", f"src{i % 12}"))
    for i in range(0, 100, 4):  # toxic rows, most of them labelled
        docs[i] = (i, docs[i][1] + " you worthless idiot scum idiot", "en", "src0")
    labels = [(i, 1, int(i < 100 and i % 4 == 0)) for i in range(160)]
    for i in range(110, 130):  # a line that many share
        docs[i] = (i, docs[i][1] + "\nAll rights reserved by the printer", "en", "src1")
    item = text(12)
    docs[141] = (141, docs[141][1] + " " + item + " end", "en", "src2")
    copy, near = docs[150][1], docs[151][1].split()
    near[30] = "changed"
    docs += [(400, copy, "en", "src3"), (401, " ".join(near), "en", "src3"), (402, None, "en", None), (None, "no id " + text(20), "en", "src4"),
             (403, "", "de", "src5"), (155, docs[155][1], "en", "src5")]
    frame = spark.createDataFrame([(*r, len(r[1] or ""), "extra") for r in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long, mix_class string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    ids = sorted(int(i) for i in out["doc_id"].dropna())
    want = sorted({i for i in range(300) if not (i < 100 and i % 4 == 0)} - {141} | {402, 403})
    assert ids == want and out["doc_id"].isna().sum() == 1
    assert not any("All rights" in (t or "") for t in out["text"])
    assert sorted(out["mix_position"]) == list(range(len(out)))
    by_id = {d: t for d, t, *_ in docs[:300]}
    for d, t in zip(out["doc_id"], out["text"]):
        if d in by_id and not 110 <= d < 130:
            assert t == by_id[d]


def test_pipeline_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0).withColumn("extra", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
