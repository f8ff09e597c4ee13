"""Rank-order language profiles against a brute-force version, on edge rows, and
their held-out accuracy."""

from collections import Counter

from pyspark.sql import functions as F

from cartwheel.llm import language_id as li
from cartwheel.llm.queries import QUERIES
from cartwheel.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def brute_grams(text):
    found = Counter()
    for word in li.WORD.findall((text or "").lower()):
        w = f" {word} "
        found.update(w[i:i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i:i + n].strip())
    return found


def brute_ranked(counts, k):
    return [g for g, _ in sorted(counts.items(), key=lambda e: (-e[1], pack(e[0])))][:k]


def pack(gram):
    out = 0
    for ch in gram:
        out = (out << li.BITS) | ord(ch)
    return out


def brute_predict(rows, texts, k):
    by_lang = {}
    for lang, text in rows:
        if lang is not None and brute_grams(text):
            by_lang.setdefault(lang, Counter()).update(brute_grams(text))
    profiles = {lang: {g: i for i, g in enumerate(brute_ranked(c, k))} for lang, c in by_lang.items()}
    out = []
    for text in texts:
        top = brute_ranked(brute_grams(text), k)
        if not top or not profiles:
            out.append(("und", 0.0))
            continue
        dist = {lang: sum(abs(p[g] - i) if g in p else k for i, g in enumerate(top)) for lang, p in profiles.items()}
        best = min(dist, key=lambda lang: (dist[lang], lang))
        out.append((best, 1 - dist[best] / (k * len(top))))
    return out


TRAIN = [("en", "The cat sat on the mat and the dog sat too."), ("en", "there is the other thing"), ("fr", "Le chat est sur la table, où l'été"),
         ("de", "Die Katze sitzt über dem Tisch und schläft"), (None, "ignored text"), ("xx", None), ("yy", "12 34 !?"), ("el", "Η γάτα κάθεται")]
TEXTS = ["the dog", "la table", "über den Tisch", None, "", "  \n\t", "123 + 4", "γάτα", "İstanbul ẞ", "x", "ét́e",
         "\U0001d4ea\U0001d4eb the", "the " * 300 + "katze " * 200, "zzz qqq"]


def frames(spark):
    docs = spark.createDataFrame(TRAIN, "lang string, text string")
    texts = spark.createDataFrame([(i, t, "clash", 0.5) for i, t in enumerate(TEXTS)], "id long, text string, lang_pred string, score double")
    return docs, texts


def predicted(spark, k, **sizes):
    docs, texts = frames(spark)
    out = li.predict_language(texts, li.learn_profiles(docs, grams=k), grams=k)
    assert out.columns == ["id", "text", "lang_pred", "score"]
    return [(r.lang_pred, r.score) for r in out.orderBy("id").collect()]


def same(a, b):
    return [x[0] for x in a] == [x[0] for x in b] and all(abs(x[1] - y[1]) < 1e-12 for x, y in zip(a, b))


def test_equal_to_brute_force(spark):
    for k in (5, 400):
        assert same(predicted(spark, k), brute_predict(TRAIN, TEXTS, k))


def test_blocks_of_languages_and_pieces_change_nothing(spark, monkeypatch):
    whole = predicted(spark, 50)
    monkeypatch.setattr(li, "BLOCK_LANGS", 1)
    assert predicted(spark, 50) == whole
    words = " ".join(f"w{chr(97 + i % 26)}x{chr(97 + i % 7)}" for i in range(5000))
    once = li.count_grams(words)
    monkeypatch.setattr(li, "PIECE_WORDS", 7)
    cut = li.count_grams(words)
    assert once[0].tolist() == cut[0].tolist() and once[1].tolist() == cut[1].tolist()
    monkeypatch.setattr(li, "FLUSH_GRAMS", 3)
    assert predicted(spark, 50) == whole


def test_nothing_learned_and_empty_table(spark):
    docs, texts = frames(spark)
    none = li.learn_profiles(docs.where(F.col("lang").isNull()))
    assert {(r.lang_pred, r.score) for r in li.predict_language(texts, none).collect()} == {("und", 0.0)}
    empty = li.predict_language(texts.limit(0), li.learn_profiles(docs))
    assert empty.columns == ["id", "text", "lang_pred", "score"] and empty.count() == 0


def test_held_out_accuracy_and_whole_result(spark):
    out = QUERIES["op13_language_id"](spark, SF)
    docs = read_table(spark, SF, "documents").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.99
