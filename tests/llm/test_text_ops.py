"""Word splitting, n-gram join, decontamination, page extraction: brute force, planted cases and edge rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, graph, html_extract, ngram_join
from cartwheel.llm import textkit as tk


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


EDGE_TEXTS = ["", None, " ", "\n\t", "a", "A b\tC", "é É ü", "x" * 10_000, "a " * 9000, "no-break thin space", "\x00\x1f\x7f",
              "Tab\x0bVT\x0cFF", "🙂 emoji🙂", "a,b;c9 D"]


# -- word splitting -----------------------------------------------------------

@pytest.mark.parametrize("table, words", [(tk.BLANK_SEPARATED, blank_words), (tk.ALNUM_SEPARATED, alnum_words)])
def test_words_match_the_patterns(table, words, monkeypatch):
    monkeypatch.setattr(tk, "PIECE", 64)
    rng = random.Random(5)
    texts = EDGE_TEXTS + ["".join(rng.choice(" \tabAB09é-.,\n") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    got, by_word = [], {}
    for first, last, w in tk.pieces(texts, table):
        for d in range(last - first):
            span = range(w.bounds[d], w.bounds[d + 1])
            got.append([w.word(i).decode() for i in span])
            for i in span:
                assert by_word.setdefault(w.word(i), w.hashes[i]) == w.hashes[i]
    assert got == [words(t) for t in texts]
    assert len(set(by_word.values())) == len(by_word)


def test_shingles_distinguish_order_and_length():
    h = tk.split_words([b"a b c a b d"], tk.BLANK_SEPARATED, tk._Powers()).hashes
    assert len(set(tk.shingles(h, 2).tolist())) == 4
    assert len(tk.shingles(h[:2], 4)) == 1 and len(tk.shingles(h[:0], 4)) == 0
    assert tk.shingles(h[:2], 4)[0] == tk.shingles(h, 2)[0]


# -- components ---------------------------------------------------------------

def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)] + \
        [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# -- n-gram join --------------------------------------------------------------

def brute_join(rows, width, percent):
    sets = []
    for _, t in rows:
        w = blank_words(t)
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def join_rows(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocab) for _ in range(40)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([3, 12, 60, 150]))] for _ in range(12)]
    rows = []
    for i in range(110):
        t = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        if rng.random() < .3:
            t += passage
        rows.append((i * 3 + 1, "  ".join(t) if rng.random() < .8 else "\n".join(t).upper()))
    rows += [(i + 1000, t) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, rows[3][1]), (None, "only a null id row here"), rows[5], rows[5], (2, rows[7][1])]
    return rows


@pytest.mark.parametrize("width, percent, block", [(4, 85, 1024), (5, 80, 3)])
def test_ngram_join_brute_force(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "RUN", 2000)
    rows = join_rows(width)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, node string").repartition(5)
    got = ngram_join.join_ngrams(df, width, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_join(rows, width, percent)


def test_ngram_join_empty(spark):
    assert ngram_join.join_ngrams(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- decontamination ----------------------------------------------------------

def brute_contamination(rows, items, window):
    out = []
    for doc, text in rows:
        w, hit, who = alnum_words(text), set(), set()
        for item, t in items:
            iw = alnum_words(t)
            for s in range(max(1, len(iw) - window + 1)) if iw else []:
                win = iw[s:s + window]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        who.add(item or "")
        out.append((doc, len(w), len(hit), sorted(who)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [100_000, 7])
def test_decontamination_brute_force(spark, block):
    rng = random.Random(6)
    vocab = [f"k{i}" for i in range(12)] + ["Ünï", "Z9"]
    items = [(str(i), " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 5, 9, 10, 11, 25])))) for i in range(25)]
    items += [("a", None), ("b", ""), ("c", "..."), (None, "null item words here"), ("3", items[4][1])]
    rows = []
    for i in range(60):
        t = " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))
        if rng.random() < .5:
            t += ", " + rng.choice(items[:25])[1].upper() + "! "
        rows.append((i, t))
    rows += [(i + 100, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, items[3][1]), rows[2], (3, "null item words here")]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, n_hit string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.find_contamination(docs, bench, window=10, block_windows=block) \
        .select("doc_id", "n_words", "n_hit", "item_ids").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_contamination(rows, items, 10)


def test_decontamination_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.find_contamination(docs, none).select("doc_id", "n_words", "n_hit").orderBy("doc_id").collect()] \
        == [(1, 2, 0), (2, 0, 0)]
    assert decontaminate.find_contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


# -- page extraction ----------------------------------------------------------

PARA = "This is a long paragraph of plain running text with many words and hardly any tags at all. " * 3
CASES = {
    "article": (f"<html><head><title>T</title><style>p{{}}</style><script>var a='<p>x</p>';</script></head><body><header><h1>Site</h1></header>"
                f"<nav><ul><li><a href=x>Home</a></li></ul></nav><article class='post has-comments'><header><h1>Title &amp; more</h1></header>"
                f"<p>{PARA}</p><p>Short.</p><form><label>Name</label><input></form><aside>side</aside><div class=\"ad-slot\">Buy</div>"
                f"<p>Line<br>two&nbsp;&eacute;&#8364;</p><section id=comments><p>Nice one, {PARA}</p></section></article>"
                f"<div class=sidebar>{PARA}</div><footer>&copy; x</footer></body></html>",
                ["Title & more", PARA.strip(), "Short.", "Line two é€"]),
    "soup": (f"<body><div class=menu><a>a</a> <a>b</a></div><div id=page><div id=top-nav>x</div><div id=body-text><h2>Head</h2>{PARA}<p>{PARA}"
             f"<p>End</div></div><div class='cookie-notice'>We use cookies {PARA}</div></body>",
             ["Head", PARA.strip(), PARA.strip(), "End"]),
    "unclosed": (f"<article><h1>T</h1><p><b>Lead in<br><p>{PARA}<p>cut off &am", ["T", "Lead in", PARA.strip(), "cut off &am"]),
    "hidden": (f"<main><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>{PARA}</p><div role=complementary>no</div></main>",
               [PARA.strip()]),
    "list": (f"<article><p>{PARA}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><blockquote>q</blockquote></article>",
             [PARA.strip(), "one", "two", "a", "b", "q"]),
    "plain": ("just words", ["just words"]),
    "comment": (f"<article><!-- <p>no</p> --><p>a <!-- no --> b {PARA}</p></article>", [f"a b {PARA}".strip()]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_page_cases(name):
    html, want = CASES[name]
    assert html_extract.main_text(html).split("\n") == [" ".join(w.split()) for w in want]


def test_pages_edge_rows(spark):
    rows = [(1, None, "o"), (2, "", "o"), (3, "<p></p>", "o"), (4, CASES["article"][0], "o"), (4, CASES["article"][0], "o"),
            (5, "<div>" * 3000 + "deep" + "</div>" * 3000, "o"), (6, "<p>" + "word " * 100_000, "o"), (7, "<a <b <<< &&&; </", "o")]
    df = spark.createDataFrame(rows, "page_id long, html string, TEXT string")
    got = {r.page_id: r.text for r in html_extract.extract_main_text(df).collect()}
    assert got[1] == got[2] == got[3] == "" and got[4].startswith("Title & more") and got[5] == "deep"
    assert len(got[6]) == 499_999
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


def test_smoothing_is_a_weighted_mean():
    assert html_extract.smoothed([3.0] * 7) == pytest.approx([3.0] * 7)
    s = html_extract.smoothed([0, 0, 0, 10.0, 0, 0, 0])
    assert s[3] == max(s) and s[2] == pytest.approx(s[4]) and s[0] == 0


def test_bitmap_bounds_the_difference():
    rng = np.random.RandomState(1)
    for _ in range(50):
        x, y = (np.unique(rng.randint(0, 500, 80).astype(np.uint64)) for _ in range(2))
        bits = np.frombuffer(ngram_join.bitmap(x), np.uint64) ^ np.frombuffer(ngram_join.bitmap(y), np.uint64)
        assert int(np.bitwise_count(bits).sum()) <= len(np.setxor1d(x, y))
    assert Counter(ngram_join.bitmap(x[:0]))[0] == ngram_join.BITS // 8
