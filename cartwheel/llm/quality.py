"""Quality classifier: Naive Bayes support vectors.

Features are indicators of n-grams, hashed to ``DIM`` slots: words and word
pairs (blank-separated, A-Z folded) and runs of one to three word *shapes* (case
pattern, digits, inner and final punctuation, length class, repetition of the
previous word). Each present n-gram is scaled by its class log-count ratio and
the document vector brought to length 1; a linear hinge-loss model is fitted by
dual coordinate descent. Margins are turned into probabilities by a sigmoid
fitted on out-of-fold margins.

The fit uses at most ``FIT_ROWS`` labelled rows (a documented bound: one task
holds their feature numbers); feature extraction and scoring run on all
executors, and the model sent to them has a fixed size.

Null, empty or blank texts have no n-grams and get the score of the bias alone.
Without any labelled row of one class every score is the share of label 1
(0.5 without labels). Rows are scored one by one: repeated rows score alike;
input columns named like an added column are replaced; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm import textkit as tk
from cartwheel.llm.common import without
from cartwheel.llm.labelled import training_sample

FIT_ROWS = 10_000
DIM_BITS = 18
DIM = 1 << DIM_BITS
SMOOTH, COST, EPOCHS, FOLDS = 1.0, 4.0, 12, 3


def _class_table(lo_hi: list[tuple[int, int]]) -> np.ndarray:
    t = np.zeros(256, np.int64)
    for lo, hi in lo_hi:
        t[lo:hi + 1] = 1
    return t


UPPER, LOWER, DIGIT = _class_table([(0x41, 0x5A)]), _class_table([(0x61, 0x7A), (0x80, 0xFF)]), _class_table([(0x30, 0x39)])
PUNCT = _class_table([(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)])


def word_shapes(words: tk.Words) -> np.ndarray:
    """A code per word of its case pattern, digits, punctuation, length class
    and whether it repeats the previous word of its text."""
    raw, s, e = words.raw, words.starts, words.ends

    def many(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[raw])])
        return sums[e] - sums[s]

    upper, lower, digit, punct = many(UPPER), many(LOWER), many(DIGIT), many(PUNCT)
    last = raw[e - 1].astype(np.int64) if len(e) else e
    final = np.where(PUNCT[last] == 1, last, 0) if len(e) else e
    h = words.hashes
    again = np.zeros(len(h), np.int64)
    if len(h):
        again[1:] = h[1:] == h[:-1]
        starts = words.bounds[:-1]
        again[starts[starts < len(h)]] = 0
    size = np.digitize(e - s, [2, 4, 8, 16])
    parts = [np.minimum(upper, 2), np.minimum(lower, 1), np.minimum(digit, 1), np.minimum(punct, 3), size, again]
    code = final
    for p in parts:
        code = code * 8 + p
    return tk.mix64(code.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))


def _runs(h: np.ndarray, text: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and text of each run of k codes that stays inside a text."""
    if len(h) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = text[k - 1:] == text[:len(text) - k + 1]
    g = tk.mix64(tk.shingles(h, k) + np.uint64(seed))
    return (g[inside] >> np.uint64(64 - DIM_BITS)).astype(np.int64), text[:len(text) - k + 1][inside]


def features(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per piece: first and last text, and the distinct (text, slot) pairs."""
    for first, last, words in tk.pieces(texts, tk.BLANK_SEPARATED):
        text, shapes = words.texts(), word_shapes(words)
        found = [_runs(words.hashes, text, 1, 11), _runs(words.hashes, text, 2, 12),
                 *[_runs(shapes, text, k, 20 + k) for k in (1, 2, 3)]]
        key = np.unique(np.concatenate([t * DIM + slot for slot, t in found]))
        yield first, last, key >> DIM_BITS, key & (DIM - 1)


def fit_dual(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float, epochs: int) -> np.ndarray:
    """Weights (last one: bias) of an L2-regularised hinge-loss model by dual
    coordinate descent; ``rows`` are slots, ``values`` their entries."""
    w = np.zeros(DIM + 1)
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.RandomState(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            grad = y[i] * (float(w[r] @ v) + w[DIM]) - 1.0
            new = min(max(alpha[i] - grad / square[i], 0.0), cost)
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[r] += (step * y[i]) * v
                w[DIM] += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost:
            break
    return w


def fit_sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """P(1) = 1 / (1 + exp(a * margin + b)) by Newton steps on smoothed targets."""
    pos, neg = float((y > 0).sum()), float((y <= 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = -1.0, math.log((neg + 1) / (pos + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(a * margin + b, -500, 500)))
        d, h = t - p, np.maximum(p * (1 - p), 1e-12)
        g = np.array([(d * margin).sum(), d.sum()])
        m = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray) -> dict:
    """Model of slot rows and 0/1 labels: per-slot weight and scale, sigmoid."""
    if len(y) == 0 or y.min() == y.max():
        return {"share": float(y.mean()) if len(y) else 0.5}

    def ratio(pick: np.ndarray) -> np.ndarray:
        n = [np.full(DIM, SMOOTH), np.full(DIM, SMOOTH)]
        for i in pick:
            n[y[i]][rows[i]] += 1
        return np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())

    def unit(r: np.ndarray, row: np.ndarray) -> np.ndarray:
        v = r[row]
        return v / (math.sqrt(float(v @ v)) or 1.0)

    def train(pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r = ratio(pick)
        return r, fit_dual([rows[i] for i in pick], [unit(r, rows[i]) for i in pick], 2 * y[pick] - 1, COST, EPOCHS)

    everyone = np.arange(len(y))
    fold = np.random.RandomState(3).permutation(len(y)) % FOLDS
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        rest = everyone[fold != k]
        r, w = train(rest) if y[rest].min() != y[rest].max() else (np.zeros(DIM), np.zeros(DIM + 1))
        for i in everyone[fold == k]:
            margin[i] = float(w[rows[i]] @ unit(r, rows[i])) + w[DIM]
    a, b = fit_sigmoid(margin, y)
    r, w = train(everyone)
    return {"ratio": r.astype(np.float32), "weight": w[:DIM].astype(np.float32), "bias": float(w[DIM]), "a": a, "b": b}


def train_model(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = FIT_ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Fit in one task over the bounded sample; the driver gets the model only."""
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first, last, text, slot in features(pdf["text"]):
                cut = np.searchsorted(text, np.arange(last - first + 1))
                yield pd.DataFrame({"slots": [slot[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])],
                                    "label": pdf["label"].iloc[first:last].to_numpy()})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows_, y = [], []
        for pdf in batches:
            rows_ += [np.frombuffer(b, np.int32) for b in pdf["slots"]]
            y += pdf["label"].tolist()
        m = fit(rows_, np.array(y, np.int64))
        yield pd.DataFrame({"share": [m.get("share")], "ratio": [m["ratio"].tobytes() if "ratio" in m else None],
                            "weight": [m["weight"].tobytes() if "weight" in m else None],
                            "bias": [m.get("bias", 0.0)], "a": [m.get("a", 0.0)], "b": [m.get("b", 0.0)]})

    slots = training_sample(docs, labels, label_col, rows, id_col, text_col).mapInPandas(extract, "slots binary, label int")
    got = slots.repartition(1).mapInPandas(
        learn, "share double, ratio binary, weight binary, bias double, a double, b double").collect()
    if not got or got[0]["ratio"] is None:
        return {"share": got[0]["share"] if got else 0.5}
    g = got[0]
    return {"ratio": np.frombuffer(bytes(g["ratio"]), np.float32), "weight": np.frombuffer(bytes(g["weight"]), np.float32),
            "bias": g["bias"], "a": g["a"], "b": g["b"]}


def score_quality(docs: DataFrame, model: dict, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` plus the probability of label 1."""
    model_b = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = model_b.value
        if "share" not in m:
            square, product = (m["ratio"].astype(np.float64) ** 2), m["ratio"].astype(np.float64) * m["weight"]
        for texts in series:
            if "share" in m:
                yield pd.Series(np.full(len(texts), m["share"]))
                continue
            margin = np.full(len(texts), m["bias"])
            for first, last, text, slot in features(texts):
                n = last - first
                norm = np.sqrt(np.bincount(text, square[slot], n))
                margin[first:last] += np.bincount(text, product[slot], n) / np.where(norm > 0, norm, 1.0)
            yield pd.Series(1 / (1 + np.exp(np.clip(m["a"] * margin + m["b"], -500, 500))))

    return docs.select(*without(docs, (out_col,)), score(F.col(text_col).cast("string")).alias(out_col))
