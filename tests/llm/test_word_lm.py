"""Word bigram scores: brute force over several packs, and words that differ
only in digits or accents."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import queries, word_lm


def brute(rows):
    seqs = [re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in t or "")) for t, _ in rows]
    one, two = [Counter(), Counter()], [Counter(), Counter()]
    for s, (_, flag) in zip(seqs, rows):
        p = [None, *s, None]
        for a, b in zip(p, p[1:]) if s else ():
            for which in (0, 1) if flag else (1,):
                one[which][b] += 1
                two[which][a, b] += 1
    mass = [sum(c.values()) for c in one]

    once = [sum(c[0][k] == 1 for k in c[0]) / mass[0] if mass[0] else 0.5 for c in (one, two)]
    once = [min(max(x, 0.5 / mass[0]), 1 - 0.5 / mass[0]) if mass[0] else x for x in once]
    prior = mass[0] * once[0] / (1 - once[0])
    grid = [2.0 ** e for e in range(-10, 41)]
    lower = [sum(c * m / (c + m) for c in one[0].values()) / mass[0] for m in grid]
    hi = next(i for i, x in enumerate(lower) if x >= once[1])
    at = (once[1] - lower[hi - 1]) / (lower[hi] - lower[hi - 1])
    pair_prior = grid[hi - 1] ** (1 - at) * grid[hi] ** at

    out = []
    for s, (_, flag) in zip(seqs, rows):
        p = [None, *s, None]
        events = list(zip(p, p[1:])) if s else []
        mine, own, pairs = [1 if flag else 0, 1], Counter(b for _, b in events), Counter(events)
        left = [m - len(events) * k for m, k in zip(mass, mine)]

        def prob(a, b, which):
            scale = (left[0] / left[1] if left[1] else 0.0) if which else 1.0
            low = ((one[which][b] - own[b] * mine[which]) * scale + prior / len(one[1])) / (left[0] + prior)
            return ((two[which][a, b] - pairs[a, b] * mine[which]) * scale + pair_prior * low) \
                / ((one[which][a] - own[a] * mine[which]) * scale + pair_prior)
        d = [math.log(prob(a, b, 1)) - math.log(prob(a, b, 0)) for a, b in events]
        out.append((len(s), sum(d) / len(d) if d else 0.0))
    return out


@pytest.mark.parametrize("run", [60, word_lm.RUN])
def test_word_scores_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(word_lm, "RUN", run)
    rng = random.Random(12)
    rows = [(" ".join(rng.choice("red Red sea 12 13 é è über".split() if i % 2 else "sky sea, 12 blau ё\n ж".split(" "))
                      for _ in range(rng.randint(0, 30))), i % 2 == 1) for i in range(50)]
    rows += [(None, True), ("", True), (" \n", None), ("alone", None), ("x " * 400, False), rows[1], rows[1]]
    df = spark.createDataFrame([(i, t, f, 5, [i]) for i, (t, f) in enumerate(rows)],
                               "doc_id long, text string, flag boolean, score int, extra array<int>").repartition(3)
    got = word_lm.score_documents(df, F.col("flag")).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(len(rows)))
    for r, (n, s), (t, _) in zip(got, brute(rows), rows):
        assert r.n_tokens == n and r.score == pytest.approx(s, abs=1e-9) and r.text == t and r.extra == [r.doc_id]


def test_no_target_or_rows(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    assert [r.score for r in word_lm.score_documents(df, F.lit(False)).collect()] == [0.0, 0.0]
    assert word_lm.score_documents(df.limit(0), F.lit(True)).count() == 0
    assert [r.score for r in word_lm.score_documents(df.where("doc_id = 2"), F.lit(True)).collect()] == [0.0]


def test_own_text_is_left_out(spark):
    """The only target knows nothing of itself; a text that occurs twice is told
    from one that occurs once, the rest of its words being equal."""
    df = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in word_lm.score_documents(df, F.col("doc_id") == 1).collect()}
    assert got[1] == 0.0 and got[2] == pytest.approx(0, abs=1e-12)  # without text 2, all documents are the target
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=80)) for _ in range(60)]
    rows = [(i, t, True) for i, t in enumerate([*texts, *texts[:5]])] + \
        [(100 + i, " ".join(rng.choices(words, k=80)), False) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, flag boolean").repartition(4)
    got = {r.doc_id: r.score for r in word_lm.score_documents(df, F.col("flag")).collect()}
    twice = [got[i] for i in range(5)] + [got[60 + i] for i in range(5)]
    assert max(twice) < min(got[i] for i in range(5, 60))
    assert all(got[i] == pytest.approx(got[60 + i], abs=1e-9) for i in range(5))


def test_query_tells_words_apart(spark, tmp_path):
    """Digits, accents and letters of one block are different words."""
    rows = [(i, f"in {a} the {b} ж" if i % 2 else f"in {c} the {d} з", "en" if i % 2 else "de", "s", 9)
            for i, (a, b, c, d) in enumerate([("1987", "café", "2024", "cafè")] * 20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op2_lm_score"](spark, str(tmp_path)).collect()}
    assert len(got) == 20 and all(r.n_tokens == 5 for r in got.values())
    assert got[1].score < -0.1 and got[0].score > 0.1
