"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is cut into windows of ``window`` consecutive words (a
shorter item is one window). A window's set is its shingles of ``shingle``
words. Containment of the whole window needs all of its shingles, so for
containment 1 the necessary prefix is a single one: the rarest, with shingles
ordered by how often they occur in all documents (counted in a first pass).
Documents join on these prefix tokens only; each match at word p with token
offset o places the window at p - o, the positional bound (start inside the
text) and the length bound (the rest of the window fits) drop the impossible
ones, and the window's words are compared one by one with the text.

The window table is a stated query set against all documents. Its size is
counted first: up to ``BLOCK_WINDOWS`` windows are sent to the tasks at once;
beyond that the windows are dealt by hash into blocks of about that size, each
block scans the documents in a job of its own, and the few matching texts are
merged by a 128-bit text hash. So no broadcast exceeds the bound and no
benchmark size is refused. Shuffles: shingle counts, and for several blocks
the matches; the texts are never shuffled in the one-block case.

Words are split by vectorised code in Arrow batches. Defined results: null or
empty text has no words and is clean; items without words have no windows;
a null item id counts as the empty string; repeated item ids are one item;
repeated documents are judged row by row and alike; an empty benchmark leaves
every document clean; input columns named like an added column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm import textkit as tk
from cartwheel.llm.common import hash_pair, staged, without

BLOCK_WINDOWS = 100_000
ADDED = ("n_words", "n_hit", "item_ids", "hit_spans")

HIT_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("item_ids", T.ArrayType(T.StringType()))])


def window_table(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """``item_id, words``: one row per item and window, words joined by a space."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first, _, words in tk.pieces(pdf["text"], tk.ALNUM_SEPARATED):
                rows = []
                for i in range(len(words.bounds) - 1):
                    lo, hi = int(words.bounds[i]), int(words.bounds[i + 1])
                    item = [words.word(j).decode("utf-8", "surrogatepass") for j in range(lo, hi)]
                    rows += [(pdf["item_id"].iloc[first + i], " ".join(item[s:s + window]))
                             for s in range(max(1, len(item) - window + 1)) if item]
                yield pd.DataFrame(rows, columns=["item_id", "words"])

    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
                             F.col(text_col).cast("string").alias("text"))
    return items.mapInPandas(cut, "item_id string, words string").distinct()


# What is broadcast holds plain arrays and lists only (no classes of this package).
Entries = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # width -> shingle hash, window, offset


def index_windows(rows: list[tuple[str, str]], shingle: int) -> tuple[dict, Entries]:
    """Distinct windows of one block with their items and word counts, and per
    shingle width all of their shingles."""
    items: dict[bytes, set[str]] = {}
    for item, words in rows:
        items.setdefault(tk.encode(words), set()).add(item)
    windows = sorted(items)
    hashed = tk.split_words(windows, tk.ALNUM_SEPARATED, tk._Powers()) if windows else None
    length = np.diff(hashed.bounds) if windows else np.zeros(0, np.int64)
    by_width: dict[int, list[tuple[np.ndarray, int]]] = {}
    for i, n in enumerate(length):
        h = hashed.hashes[hashed.bounds[i]:hashed.bounds[i + 1]]
        by_width.setdefault(min(shingle, int(n)), []).append((tk.shingles(h, shingle), i))
    entries = {w: (np.concatenate([s for s, _ in own]), np.concatenate([np.full(len(s), i) for s, i in own]),
                   np.concatenate([np.arange(len(s)) for s, _ in own])) for w, own in by_width.items()}
    return {"windows": windows, "items": [sorted(items[w]) for w in windows], "length": length}, entries


def rarest(entries: Entries, counts: dict[int, int]) -> Entries:
    """The rarest shingle of each window, ties to the smaller hash."""
    chosen = {}
    for w, (h, win, off) in entries.items():
        seen = np.fromiter((counts.get(int(x), 0) for x in h.astype(np.int64)), np.int64, len(h))
        order = np.lexsort((off, h, seen, win))
        first = order[np.concatenate([[True], win[order][1:] != win[order][:-1]])]
        chosen[w] = (h[first], win[first], off[first])
    return chosen


def token_table(entries: Entries) -> dict[int, tuple]:
    """Per width: sorted distinct tokens, where each one's entries begin, the
    entries' windows and offsets, and a 16-bit prefilter."""
    parts = {}
    for w, (h, win, off) in entries.items():
        o = np.argsort(h, kind="stable")
        uniq, at = np.unique(h[o], return_index=True)
        seen = np.zeros(1 << 16, bool)
        seen[(uniq >> np.uint64(48)).astype(np.int64)] = True
        parts[w] = (uniq, np.append(at, len(h)), win[o], off[o], seen)
    return parts


def _matches(parts: dict[int, tuple], words: tk.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per width: word positions whose shingle is a token, and the token's number."""
    n, ends = len(words.hashes), words.bounds[1:]
    for w, (uniq, _, _, _, seen) in parts.items():
        if n < w:
            continue
        h = tk.shingles(words.hashes, w)
        at = np.flatnonzero(seen[(h >> np.uint64(48)).astype(np.int64)])
        no = np.searchsorted(uniq, h[at])
        no[no == len(uniq)] = 0
        ok = uniq[no] == h[at]
        at, no = at[ok], no[ok]
        inside = at + w <= ends[np.searchsorted(ends, at, side="right")]  # not across two texts
        yield w, at[inside], no[inside]


def _count_tokens(docs: DataFrame, text_col: str, table) -> dict[int, int]:
    """Occurrences of each token in all documents (at most one row per token)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = table.value
        sums = {w: np.zeros(len(p[0]), np.int64) for w, p in tokens.items()}
        for pdf in batches:
            for _, _, words in tk.pieces(pdf["text"], tk.ALNUM_SEPARATED):
                for w, _, no in _matches(tokens, words):
                    np.add.at(sums[w], no, 1)
        for w, s in sums.items():
            hit = np.flatnonzero(s)
            yield pd.DataFrame({"token": tokens[w][0][hit].astype(np.int64), "n": s[hit]})

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(count, "token long, n long") \
        .groupBy("token").agg(F.sum("n")).collect()
    return {r[0]: r[1] for r in rows}


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _finder(index_b, prefix_b):
    @F.pandas_udf(HIT_TYPE)
    def find(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index, prefix = index_b.value, prefix_b.value
        windows, length = index["windows"], index["length"]
        for texts in series:
            n_words, spans, items = [], [], []
            for first, last, words in tk.pieces(texts, tk.ALNUM_SEPARATED):
                found: dict[int, tuple[list, set]] = {}
                for w, at, no in _matches(prefix, words):
                    _, rows, win, off, _ = prefix[w]
                    doc = np.searchsorted(words.bounds, at, side="right") - 1
                    for p, k, d in zip(at.tolist(), no.tolist(), doc.tolist()):
                        lo, hi = int(words.bounds[d]), int(words.bounds[d + 1])
                        for r in range(rows[k], rows[k + 1]):
                            start, size = p - int(off[r]), int(length[win[r]])
                            if start < lo or start + size > hi:
                                continue
                            if b" ".join(words.word(j) for j in range(start, start + size)) == windows[win[r]]:
                                s, it = found.setdefault(d, ([], set()))
                                s.append((start - lo, start - lo + size))
                                it.update(index["items"][win[r]])
                n_words += np.diff(words.bounds).tolist()
                for d in range(last - first):
                    s, it = found.get(d, ((), ()))
                    spans.append(_merge(list(s)))
                    items.append(sorted(it))
            yield pd.DataFrame({"n_words": n_words, "hit_spans": spans, "item_ids": items})
    return find


@F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
def _merge_spans(spans: pd.Series) -> pd.Series:
    return pd.Series([_merge([tuple(x) for x in s]) if s is not None else [] for s in spans])


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5,
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_words``, ``n_hit`` (words inside
    any occurring window), ``item_ids`` (sorted) and ``hit_spans`` (word ranges)."""
    sc = docs.sparkSession.sparkContext
    table = staged(window_table(benchmark, window, item_col, item_text_col), "windows")
    blocks = max(1, -(-table.count() // block_windows))
    text = F.col(text_col).cast("string")
    finders = []
    for b in range(blocks):
        rows = table.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).collect()  # about block_windows rows
        index, entries = index_windows([(r[0], r[1]) for r in rows], shingle)
        counts = _count_tokens(docs, text_col, sc.broadcast(token_table(entries)))
        finders.append(_finder(sc.broadcast(index), sc.broadcast(token_table(rarest(entries, counts)))))

    if blocks == 1:
        found = docs.withColumn("_dc", finders[0](text))
        n_words, spans, items = F.col("_dc.n_words"), F.col("_dc.hit_spans"), F.col("_dc.item_ids")
    else:
        t1, t2 = hash_pair(F.coalesce(text, F.lit("")))
        keyed = docs.withColumn("_dc_1", t1).withColumn("_dc_2", t2)
        union = None
        for find in finders:
            hits = keyed.select("_dc_1", "_dc_2", find(text).alias("_dc")).where(F.size("_dc.hit_spans") > 0)
            hits = staged(hits.groupBy("_dc_1", "_dc_2").agg(F.first("_dc").alias("_dc")), "block-hits")
            union = hits if union is None else union.unionByName(hits)
        merged = staged(union.groupBy("_dc_1", "_dc_2").agg(
            F.flatten(F.collect_list("_dc.hit_spans")).alias("_dc_s"),
            F.flatten(F.collect_list("_dc.item_ids")).alias("_dc_i")), "merged-hits")
        found = keyed.join(merged, ["_dc_1", "_dc_2"], "left")
        found = found.withColumn("_dc", _counter()(text)).withColumn("_dc_s", _merge_spans("_dc_s"))
        n_words, spans = F.col("_dc"), F.col("_dc_s")
        items = F.coalesce(F.array_sort(F.array_distinct("_dc_i")), F.array().cast("array<string>"))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))
    return found.select(*without(docs, ADDED), n_words.alias("n_words"), n_hit.alias("n_hit"),
                        items.alias("item_ids"), spans.alias("hit_spans"))


def _counter():
    @F.pandas_udf(T.LongType())
    def count_words(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            out: list[int] = []
            for _, _, words in tk.pieces(texts, tk.ALNUM_SEPARATED):
                out += np.diff(words.bounds).tolist()
            yield pd.Series(out, dtype="int64")
    return count_words
