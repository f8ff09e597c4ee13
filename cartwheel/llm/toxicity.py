"""Toxicity by weak supervision.

*Voters.* A lexicon voter fires on a word of the insult lists below; a pattern
voter fires on a word or word beginning (4 to 8 bytes) at one of four levels -
present, twice, three times, or one word in a hundred - mined from the labelled
training rows: significantly more frequent in toxic than in clean ones, chosen
greedily by the toxic rows it adds; shape voters fire on shouting and overlong
words.

*Label model.* A generative model with a latent label: class-conditional firing
rates of every voter (their accuracies), fitted by expectation-maximisation.
A voter that doesn't fire abstains; "no voter fires" votes for clean, and the
annotator's label is one more voter whose error rates are estimated too.
Correlations of voters given the latent label are estimated from the
posteriors; a voter's evidence is divided by its effective number of
correlated copies, and the model is refitted.

*Classifier.* Logistic regression on the posterior labels over indicators of
voters, of the number of firing voters, and of the words and word beginnings
that go with the posteriors. Only this linear model scores documents.

The fit uses at most ``FIT_ROWS`` labelled rows (a documented bound: one task
holds their word hashes, nine bytes each, then five). Scoring covers every document; the model sent to the
executors has at most ``MAX_FEATURES`` mined columns beside the voters: all 3,800
significant ones of the check table gave the same predictions on held-out rows
(426 of 427 toxic, none of 3,634 others) and a fit of 100 s in place of 5.

Null, empty or blank texts have no features and get the score of the bias
alone, as has any text when there is no labelled row of one class (then the
share of label 1, 0 without labels). Repeated rows score alike; input columns
named like an added column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm import textkit as tk
from cartwheel.llm.common import without
from cartwheel.llm.labelled import training_sample

FIT_ROWS = 8_000
MAX_PATTERNS = 64
MAX_FEATURES = 256
HEADS = (4, 5, 6, 7, 8)
LEVELS = 4

# Insult words by language.
LEXICON = {
    "en": "idiot moron stupid dumb loser scum trash garbage worthless pathetic disgusting clown imbecile fool "
          "jerk bastard filthy ugly vermin scumbag dimwit creep freak coward hateful vile",
    "de": "idiot trottel depp dumm dummkopf abschaum wertlos erbärmlich ekelhaft widerlich versager arschloch "
          "schwein drecksack blöd",
    "fr": "idiot idiote imbécile crétin stupide ordure racaille pathétique dégoûtant salaud connard minable abruti nul",
    "es": "idiota imbécil estúpido basura escoria patético asqueroso inútil payaso perdedor cabrón tonto",
}


def _hash_words(words: list[str]) -> np.ndarray:
    return tk.split_words([tk.encode(w) for w in words], tk.ALNUM_SEPARATED, tk._Powers()).hashes


def lexicon_hashes() -> np.ndarray:
    return np.unique(_hash_words(sorted({w for ws in LEXICON.values() for w in ws.split()})))


HEAD_SEED = 0x1B873593CC9E2D51
SHAPES = 3


def features(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: first and last text; text number and hash of each word and
    word beginning (of words long enough); words per text; a (text, SHAPES) table."""
    for first, last, words in tk.pieces(texts, tk.ALNUM_SEPARATED):
        text, n = words.texts(), last - first
        size = words.ends - words.starts
        hashes, owner = [words.hashes], [text]
        for k in HEADS:
            long = size >= k
            hashes.append(tk.mix64(words.heads(k)[long] ^ np.uint64(HEAD_SEED + k)))
            owner.append(text[long])
        upper = np.concatenate([[0], np.cumsum((words.raw >= 0x41) & (words.raw <= 0x5A))])
        loud = ((upper[words.ends] - upper[words.starts]) == size) & (size > 2)
        count = np.maximum(np.diff(words.bounds), 1)
        shout = np.bincount(text[loud], minlength=n) / count if len(text) else np.zeros(n)
        shapes = np.zeros((n, SHAPES), bool)
        shapes[:, 0], shapes[:, 1] = shout > 0.1, shout > 0.5
        shapes[:, 2] = np.bincount(text[size > 20], minlength=n) > 0 if len(text) else False
        yield first, last, np.concatenate(owner), np.concatenate(hashes), np.diff(words.bounds), shapes


def level_bits(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The levels that hold for counts of a base in texts of so many words, one
    bit each: once, twice, thrice, one in a hundred."""
    held = (times >= 1).astype(np.uint8)
    for k, more in enumerate((times >= 2, times >= 3, times * np.int64(100) >= words), 1):
        held |= more.astype(np.uint8) << k
    return held


def levels(base: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns base * LEVELS + level that hold, and the row of each."""
    rows = [np.flatnonzero(held & (1 << k)) for k in range(LEVELS)]
    return (np.concatenate([base[row].astype(np.int64) * LEVELS + k for k, row in enumerate(rows)]), np.concatenate(rows))


def significance(n1: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """How far the mass of label 1 lies above its expectation, in deviations."""
    return (n1 - n * share) / np.sqrt(n * share * (1 - share) + 1e-9)


BLOCK = 250_000  # pairs laid out at a time


class Pairs:
    """(text, base) pairs of the sample, text by text (those of text i are
    ``bounds[i]:bounds[i + 1]``), with the bits of the levels that hold: five bytes
    a pair. Owners, columns and weights are laid out for one block of texts at a time."""

    def __init__(self, bounds: np.ndarray, base: np.ndarray, held: np.ndarray, n_bases: int) -> None:
        self.bounds, self.base, self.held, self.n_cols = bounds, base, held, n_bases * LEVELS

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text, base and levels of the pairs of consecutive texts."""
        i, n = 0, len(self.bounds) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.bounds, self.bounds[i] + BLOCK, side="right")) - 1)
            part = slice(self.bounds[i], self.bounds[j])
            yield np.repeat(np.arange(i, j), np.diff(self.bounds[i:j + 1])), self.base[part], self.held[part]
            i = j

    def sums(self, weight: np.ndarray | None = None) -> np.ndarray:
        """Per column the number, or the weight, of its texts, added up in their order."""
        out = np.zeros(self.n_cols, np.int64 if weight is None else np.float64)
        for owner, base, held in self.blocks():
            col, row = levels(base, held)
            np.add.at(out, col, 1 if weight is None else weight[owner[row]])
        return out

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts and columns of the pairs in the columns that are true in ``wanted``."""
        rows, cols = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for owner, base, held in self.blocks():
            col, row = levels(base, held)
            rows.append(owner[row[wanted[col]]])
            cols.append(col[wanted[col]])
        return np.concatenate(rows), np.concatenate(cols)

    def inside(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, new base and levels of the pairs whose base has a place (not -1)."""
        found = [(owner[at], place[base[at]], held[at]) for owner, base, held in self.blocks()
                 for at in [np.flatnonzero(place[base] >= 0)]]
        none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint8)
        return tuple(np.concatenate(x) for x in zip(none, *found))


def mine_patterns(pairs: Pairs, n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Columns that mark toxic rows: per pass the one that adds most toxic rows
    less three times the clean rows it adds."""
    n_cols = pairs.n_cols
    n1 = pairs.sums((y == 1).astype(np.float64))
    least = max(3, round(0.004 * int((y == 1).sum())))
    good = (n1 >= least) & (n1 >= 0.75 * n) & (significance(n1, n, float(y.mean())) > 5)
    rows, cols = pairs.of(good)
    toxic = y[rows] == 1
    gains = np.where(toxic, 1.0, -3.0)
    covered = np.zeros(len(y), bool)
    picked: list[int] = []
    while len(picked) < MAX_PATTERNS and len(cols):
        gain = np.bincount(cols, gains * ~covered[rows], n_cols)
        best = int(np.lexsort((-n1[good], -gain[good]))[0])
        best = int(np.flatnonzero(good)[best])
        if gain[best] < 2:
            break
        picked.append(best)
        covered[rows[cols == best]] = True
    return np.array(sorted(picked), np.int64)


def label_model(votes: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Posterior of the latent label for a votes matrix (rows, voters) and the
    annotator's labels."""
    v = np.concatenate([votes, ~votes.any(axis=1)[:, None], (y == 1)[:, None]], axis=1).astype(np.float64)
    weight = np.ones(v.shape[1])
    abstains = np.append(np.ones(v.shape[1] - 1), 0.0)
    post = np.clip(y.astype(np.float64), 0.05, 0.95)
    for round_ in range(3):
        for _ in range(30):
            p1, p0 = post.sum() + 1, (1 - post).sum() + 1
            a, b = (post @ v + 0.5) / p1, ((1 - post) @ v + 0.5) / p0
            a, b = np.clip(a, 1e-4, 1 - 1e-4), np.clip(b, 1e-4, 1 - 1e-4)
            on, off = np.log(a / b), np.log((1 - a) / (1 - b)) * (1 - abstains)
            odds = np.log(p1 / p0) + v @ (weight * (on - off)) + (weight * off).sum()
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            done = np.abs(new - post).max() < 1e-6
            post = new
            if done:
                break
        # correlations of the voters given the label, pooled over both classes
        r1, r0 = v - a, v - b
        cov = (r1 * post[:, None]).T @ r1 + (r0 * (1 - post)[:, None]).T @ r0
        spread = np.sqrt(np.diag(cov) + 1.0)  # a pseudo-row, so that voters without variance have no correlation
        corr = cov / spread[:, None] / spread[None, :]
        np.fill_diagonal(corr, 0)
        corr[:, -1] = corr[-1, :] = 0  # the annotator stays a voter of full weight
        weight = 1 / (1 + np.where(corr > 0.1, corr, 0).sum(axis=1))
    return post


FIT_BLOCK = 1_000


def fit_logistic(row: np.ndarray, col: np.ndarray, n_features: int, target: np.ndarray, l2: float = 0.5) -> np.ndarray:
    """Weights (last one: bias) on soft labels by Newton steps with halving,
    over the columns that occur. One byte a cell; numbers for FIT_BLOCK rows at a time."""
    active, place = np.unique(col, return_inverse=True)
    x = np.zeros((len(target), len(active) + 1), bool)
    x[row, place] = True
    x[:, -1] = True
    penalty = np.append(np.full(len(active), l2), 1e-6)
    parts = [slice(i, i + FIT_BLOCK) for i in range(0, len(target), FIT_BLOCK)]

    def margins(w: np.ndarray) -> np.ndarray:
        return np.concatenate([x[part].astype(np.float64) @ w for part in parts])

    def slopes(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        grad, curve = penalty * w, np.diag(penalty + 1e-9)
        for part in parts:
            rows = x[part].astype(np.float64)
            grad += (p[part] - target[part]) @ rows
            curve += (rows * (p[part] * (1 - p[part]))[:, None]).T @ rows
        return grad, curve

    def loss(w: np.ndarray) -> float:
        m = margins(w)
        return float((np.logaddexp(0, m) - target * m).sum() + 0.5 * (penalty * w * w).sum())

    w = np.zeros(x.shape[1])
    best = loss(w)
    for _ in range(50):
        grad, curve = slopes(1 / (1 + np.exp(-np.clip(margins(w), -30, 30))))
        step = np.linalg.solve(curve, grad)
        size, now = 1.0, best
        while size > 1e-6 and (now := loss(w - size * step)) > best:
            size /= 2
        if now >= best - 1e-7 * max(1.0, best):
            break
        w, best = w - size * step, now
    out = np.zeros(n_features + 1)
    out[active], out[-1] = w[:-1], w[-1]
    return out


def _find(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted table, -1 if it isn't there."""
    if not len(table):
        return np.full(len(h), -1)
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    return np.where(table[at] == h, at, -1)


def _encode_rows(text: np.ndarray, base: np.ndarray, held: np.ndarray, shapes: np.ndarray,
                 n_bases: int, voters: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, feature) pairs from the levels of known bases: these, the
    shapes, and at least one, two, three firing voters."""
    size = n_bases * LEVELS + SHAPES + 3
    col, row = levels(base, held)
    owner = text[row]
    t, k = np.nonzero(shapes)
    fired = np.bincount(owner[np.isin(col, voters)], minlength=len(shapes))
    pairs = [owner * size + col, t * size + n_bases * LEVELS + k,
             *[np.flatnonzero(fired > j) * size + n_bases * LEVELS + SHAPES + j for j in range(3)]]
    key = np.unique(np.concatenate(pairs))
    return key // size, key % size, size


PARTS = 16  # ranges of hashes counted one after the other


def _frequent(docs: list[tuple[np.ndarray, np.ndarray]], part: int, lexicon: np.ndarray) -> np.ndarray:
    """The hashes of one range found in three or more texts, or in the lexicon."""
    ends = np.array([part, part + 1], dtype=object) * (2 ** 64 // PARTS)
    lo, hi = np.uint64(ends[0]), np.uint64(min(ends[1], 2 ** 64) - 1)
    mine = np.concatenate([h[np.searchsorted(h, lo):np.searchsorted(h, hi, side="right")] for h, _ in docs])
    uniq, n = np.unique(mine, return_counts=True)
    return uniq[(n >= 3) | (_find(lexicon, uniq) >= 0)]


def fit(docs: list[tuple[np.ndarray, np.ndarray]], shapes: np.ndarray, y: np.ndarray) -> dict:
    """Model of each text's distinct hashes with the bits of their levels, shape
    flags and 0/1 labels. Empties ``docs`` as it goes."""
    if len(y) == 0 or y.min() == y.max():
        return {"share": float(y.mean()) if len(y) else 0.0}
    # bases in fewer than three rows can neither be mined nor be significant, but lexicon words stay
    lexicon = lexicon_hashes()
    uniq = np.concatenate([_frequent(docs, k, lexicon) for k in range(PARTS)])
    size = sum(len(h) for h, _ in docs)
    bounds, base, held = np.zeros(len(docs) + 1, np.int64), np.empty(size, np.int32), np.empty(size, np.uint8)
    docs.reverse()
    for i in range(len(docs)):  # each text's hashes go as they are looked up
        h, bits = docs.pop()
        at = _find(uniq, h)
        found = slice(bounds[i], bounds[i] + int((at >= 0).sum()))
        base[found], held[found] = at[at >= 0], bits[at >= 0]
        bounds[i + 1] = found.stop
    pairs = Pairs(bounds, base, held, len(uniq))
    n = pairs.sums()

    own = np.flatnonzero(_find(lexicon, uniq) >= 0) * LEVELS
    voters = np.union1d(own, mine_patterns(pairs, n, y))
    votes = np.zeros((len(y), len(voters)), bool)
    wanted = np.zeros(pairs.n_cols, bool)
    wanted[voters] = True
    rows, cols = pairs.of(wanted)
    votes[rows, np.searchsorted(voters, cols)] = True
    post = label_model(np.concatenate([votes, shapes], axis=1), y)

    z = significance(pairs.sums(post), n, float(post.mean()))
    strong = np.flatnonzero((z > 6) & (n >= 5))
    strong = strong[np.argsort(-z[strong], kind="stable")][:MAX_FEATURES]
    chosen = np.union1d(voters, strong) // LEVELS
    bases = np.unique(chosen)
    # the lexicon is kept whole: a word without training rows still counts as a voter
    table = np.union1d(lexicon, uniq[bases])
    place = _find(table, uniq)
    voters = np.union1d(place[voters // LEVELS] * LEVELS + voters % LEVELS, _find(table, lexicon) * LEVELS)
    row, col, size = _encode_rows(*pairs.inside(place), shapes, len(table), voters)
    del pairs, base, held
    return {"voters": voters, "table": table, "weights": fit_logistic(row, col, size, post)}


def train_model(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = FIT_ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Fit in one task over the bounded sample; the driver gets the model only."""
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first, last, text, h, words, shapes in features(pdf["text"]):
                out = []
                order = np.argsort(text, kind="stable")
                cut = np.searchsorted(text[order], np.arange(last - first + 1))
                for a, b in zip(cut, cut[1:]):
                    u, c = np.unique(h[order[a:b]], return_counts=True)
                    out.append((u.tobytes(), level_bits(c, words[len(out)]).tobytes()))
                yield pd.DataFrame({"hashes": [x for x, _ in out], "held": [x for _, x in out],
                                    "shapes": [x.tobytes() for x in shapes],
                                    "label": pdf["label"].iloc[first:last].to_numpy()})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs_, shapes, y = [], [], []
        for pdf in batches:
            docs_ += [(np.frombuffer(h, np.uint64), np.frombuffer(b, np.uint8)) for h, b in zip(pdf["hashes"], pdf["held"])]
            shapes += [np.frombuffer(s, bool) for s in pdf["shapes"]]
            y += pdf["label"].tolist()
            del pdf
        m = fit(docs_, np.array(shapes, bool).reshape(len(y), SHAPES), np.array(y, np.int64))
        yield pd.DataFrame({"share": [m.get("share")],
                            **{k: [m[k].tobytes() if k in m else None] for k in ("voters", "table", "weights")}})

    sample = training_sample(docs, labels, label_col, rows, id_col, text_col) \
        .mapInPandas(extract, "hashes binary, held binary, shapes binary, label int")
    got = sample.repartition(1).mapInPandas(learn, "share double, voters binary, table binary, weights binary").collect()
    if not got or got[0]["weights"] is None:
        return {"share": got[0]["share"] if got else 0.0}
    g = got[0]
    return {"voters": np.frombuffer(bytes(g["voters"]), np.int64), "table": np.frombuffer(bytes(g["table"]), np.uint64),
            "weights": np.frombuffer(bytes(g["weights"]), np.float64)}


def _few_at_a_time(texts: pa.Array) -> Iterator[str | None]:
    """The texts as Python strings, never those of a whole batch together."""
    for i in range(0, len(texts), 64):
        yield from texts.slice(i, 64).to_pylist()


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` plus the probability of label 1."""
    model_b = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model_b.value
        for texts in batches:
            if "share" in m:
                yield pa.array(np.full(len(texts), m["share"]))
                continue
            margin = np.full(len(texts), m["weights"][-1])
            for first, last, text, h, words, shapes in features(_few_at_a_time(texts)):
                at = _find(m["table"], h)
                key, times = np.unique(text[at >= 0] * len(m["table"]) + at[at >= 0], return_counts=True)
                held = level_bits(times, words[key // len(m["table"])])
                row, col, _ = _encode_rows(key // len(m["table"]), key % len(m["table"]), held, shapes,
                                           len(m["table"]), m["voters"])
                margin[first:last] += np.bincount(row, m["weights"][col], last - first)
            yield pa.array(1 / (1 + np.exp(-np.clip(margin, -500, 500))))

    return docs.select(*without(docs, (out_col,)), score(F.col(text_col).cast("string")).alias(out_col))
