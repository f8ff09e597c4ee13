"""F1 of the third list of round 3: the toxicity fit's memory for each pair of a
text and a word, and that working in blocks and slices changes no result."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartwheel.llm import toxicity


def sample(n_texts=1_500, n_bases=30_000, each=1_500, seed=3):
    """Texts' distinct hashes, their counts, words per text, shapes and labels;
    twenty hashes go with label 1."""
    rng = np.random.RandomState(seed)
    bases = np.unique(rng.randint(1, 2 ** 62, n_bases).astype(np.uint64))
    y = (np.arange(n_texts) % 6 == 0).astype(np.int64)
    docs, words = [], []
    for label in y:
        mine = rng.randint(20, len(bases), each)
        if label:
            mine = np.concatenate([mine, rng.choice(20, 4, replace=False).repeat(rng.randint(1, 4))])
        h, c = np.unique(bases[mine], return_counts=True)
        docs.append((h, c))
        words.append(int(c.sum()))
    return docs, np.array(words), np.zeros((n_texts, toxicity.SHAPES), bool), y


def test_fit_takes_few_bytes_a_pair():
    docs, words, shapes, y = sample()
    held = [(h, toxicity.level_bits(c, w)) for (h, c), w in zip(docs, words)]
    n_pairs = sum(len(h) for h, _ in docs)
    del docs
    tracemalloc.start()
    try:
        model = toxicity.fit(held, shapes, y)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert "weights" in model and not held
    assert peak < 18 * n_pairs


def test_blocks_sum_and_find_like_plain_counting(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    rng = np.random.RandomState(5)
    sizes = [3, 0, 0, 5, 20, 1, 0, 6, 6, 0]  # texts without words, and one beyond a block
    bases = [np.sort(rng.choice(30, n, replace=False)) for n in sizes]
    times = [rng.randint(1, 5, n) for n in sizes]
    words = [int(t.sum()) + 150 * (i % 2) for i, t in enumerate(times)]
    held = [toxicity.level_bits(t, w) for t, w in zip(times, words)]
    pairs = toxicity.Pairs(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(bases).astype(np.int32), np.concatenate(held), 30)
    true = {(i, int(b) * 4 + k) for i, (bs, ts, w) in enumerate(zip(bases, times, words)) for b, t in zip(bs, ts)
            for k, holds in enumerate([t >= 1, t >= 2, t >= 3, t * 100 >= w]) if holds}
    weight = rng.rand(len(sizes))
    number, mass = np.zeros(120, np.int64), np.zeros(120)
    for i, col in sorted(true):
        number[col] += 1
        mass[col] += weight[i]
    assert (pairs.sums() == number).all() and (pairs.sums(weight) == mass).all()
    wanted = rng.rand(120) < 0.3
    assert set(zip(*(x.tolist() for x in pairs.of(wanted)))) == {(i, c) for i, c in true if wanted[c]}
    place = np.where(np.arange(30) % 3 == 0, np.arange(30) // 3, -1)
    got = zip(*(x.tolist() for x in pairs.inside(place)))
    assert sorted(got) == sorted((i, int(b) // 3, int(h)) for i, (bs, hs) in enumerate(zip(bases, held)) for b, h in zip(bs, hs) if b % 3 == 0)


def test_logistic_in_blocks_reaches_the_optimum(monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_BLOCK", 64)
    rng = np.random.RandomState(7)
    x = rng.rand(300, 12) < 0.3
    target = np.where(x[:, 2] | x[:, 5], 0.9, 0.1)
    row, col = np.nonzero(x)
    w = toxicity.fit_logistic(row, col, 12, target)
    m = x @ w[:-1] + w[-1]
    grad = np.append(x.T @ (1 / (1 + np.exp(-m)) - target) + 0.5 * w[:-1], (1 / (1 + np.exp(-m)) - target).sum())
    assert np.abs(grad).max() < 1e-2


def test_rows_score_the_same_in_any_batch(spark):
    texts = [None, "", "idiot"] + [f"river stone {'scum ' * (i % 7)}number {i}" for i in range(300)]
    labels = spark.createDataFrame([(i + 3, int(i % 7 >= 3)) for i in range(300)], "doc_id long, toxic int")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.train_model(docs, labels, "toxic")
    assert "weights" in model
    whole, parts = (toxicity.score_toxicity(d, model).orderBy("doc_id").select("doc_id", "score").collect()
                    for d in (docs.coalesce(1), docs.repartition(40)))
    assert whole == parts and len(whole) == 303
    assert whole[0].score == whole[1].score  # null and empty: the bias alone
    assert whole[6].score > whole[4].score  # scum thrice, once
    assert toxicity.score_toxicity(docs, model).where(F.col("score").isNull()).count() == 0


def test_texts_of_a_batch_come_in_order():
    texts = pa.array([None if i % 5 == 0 else str(i) for i in range(200)])
    assert list(toxicity._few_at_a_time(texts)) == texts.to_pylist()
    assert list(toxicity._few_at_a_time(texts.slice(190, 10))) == texts.to_pylist()[190:]
