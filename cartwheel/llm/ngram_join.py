"""Word-shingle Jaccard join by multiple-global-order filtering.

Two documents link when ``100 * |x & y| >= percent * |x | y|`` for their sets of
``width``-word shingles; the result is each document's component over all
links. Steps, each a Spark job on all documents:

1. *Profiles.* Size and 64-bit signature of each set. Equal signatures are one
   node, so exact copies are never compared or expanded.
2. *Orders.* Shingles seen at least ``HOT_LOCAL`` times within a run of texts
   are counted over the corpus; every order puts these last, by count, and the
   rest in a pseudo-random order of its own. Any total order keeps the prefix
   filter exact, so the count table may be bounded (``HOT_TABLE``).
3. *Prefixes.* If two sets link they share a token among the first
   ``n - ceil(percent n / 100) + 1`` of every order. Prefixes under the first
   order are shuffled by token. Before the shuffle equal tokens of a run are
   gathered: they are already known to be shared, only one of them goes to the
   token's own partition. What remains are postings of shared tokens.
4. *Stars.* Each posting is paired with its token's smallest node, the hub -
   linear in the postings - and the pairs that link give first components.
5. *Cross pairs.* The nodes of all tokens of one hub that lie in several
   components are compared within blocks of about ``BLOCK`` nodes (block against
   block beyond that), only across components and only emitting pairs that pass
   the length bound and an overlap bound of ``BITS`` parity bits
   (|x| + |y| - popcount(x^y)). Two nodes that share a prefix token share its
   hub, so nothing that stars leave undecided is missed, and nothing is capped.
6. *Filters of the other orders.* A candidate must also share prefix tokens
   under the second and third order (compared as 32-bit hashes: false
   positives only); these filters are intersected before
7. *Verification* of the shingle sets of both texts.

Pairs inside one component are not verified further, as they cannot change it.
Stated results: null or blank text has an empty set (size 0) and links with
nothing, its component is its own id; a null id takes part, but a component is
named by its smallest non-null id (null if it has none); repeated rows are
copies; other columns of the input are not read; an empty table gives an empty
table. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import graph
from cartwheel.llm import textkit as tk
from cartwheel.llm.common import staged
from cartwheel.session import drop_staged

HOT_LOCAL = 3          # times within a run of texts
RUN = 1_500_000        # shingles of a run
HOT_TABLE = 1_000_000  # most frequent shingles whose counts order the prefixes
BLOCK = 1024           # nodes of a block of one token
BITS = 2048
ORDERS = [0x0, 0xA24BAED4963EE407, 0x9FB21C651E98DF25]


def _sets(batches: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, int, np.ndarray, int]]:
    """(batch, row, shingle set, signature) for each text with words."""
    for pdf in batches:
        for first, last, words in tk.pieces(pdf["text"], tk.BLANK_SEPARATED):
            for d in range(last - first):
                h = words.hashes[words.bounds[d]:words.bounds[d + 1]]
                if len(h):
                    s = np.unique(tk.shingles(h, width))
                    yield pdf, first + d, s, signature(s)


def signature(s: np.ndarray) -> int:
    mixed = tk.mix64(s + np.uint64(0x632BE59BD9B4E019))
    return int(tk.mix64(np.array([mixed.sum() + np.uint64(len(s))], np.uint64)).astype(np.int64)[0])


def prefix(s: np.ndarray, seed: int, hot: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """The prefix of a set under one order, in that order."""
    tokens, counts = hot
    rank = np.zeros(len(s), np.int64)
    if len(tokens):
        at = np.searchsorted(tokens, s)
        at[at == len(tokens)] = 0
        rank = np.where(tokens[at] == s, counts[at], 0)
    n = len(s)
    order = np.lexsort((tk.mix64(s ^ np.uint64(seed)) if seed else s, rank))
    return s[order[:n + (-percent * n // 100) + 1]]


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the number of tokens per bit: a bound on set differences."""
    counts = np.bincount((tk.mix64(s + np.uint64(1)) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """Rows (node, n) per document and rows (token, df) of locally frequent shingles."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending: list[np.ndarray] = []
        held = 0
        seen: set[int] = set()

        def frequent() -> pd.DataFrame:
            tokens, df = np.unique(np.concatenate(pending), return_counts=True)
            keep = df >= HOT_LOCAL
            return pd.DataFrame({"token": tokens[keep].astype(np.int64), "df": df[keep]})

        for pdf in batches:
            node, size = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for _, i, s, sig in _sets(iter([pdf]), width):
                node[i], size[i] = sig, len(s)
                if sig not in seen:
                    seen.add(sig)
                    pending.append(s)
                    held += len(s)
                if held > RUN:
                    yield frequent()
                    pending.clear()
                    seen.clear()
                    held = 0
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "node": node, "n": size})
        if pending:
            yield frequent()

    def tagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in run(batches):
            if "token" in out:
                yield pd.DataFrame({"doc_id": pd.array([None] * len(out), "Int64"), "node": 0, "n": 0,
                                    "token": out["token"], "df": out["df"]})
            else:
                yield pd.DataFrame({"doc_id": out["doc_id"].astype("Int64"), "node": out["node"], "n": out["n"],
                                    "token": 0, "df": 0})

    return docs.mapInPandas(tagged, "doc_id long, node long, n long, token long, df long")


def _postings(docs: DataFrame, width: int, percent: int, hot_b) -> DataFrame:
    """Prefix postings under the first order. ``shared``: 0 alone in its run,
    1 shared in its run and counted for the token, 2 shared as well."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = hot_b.value
        parts: list[tuple[np.ndarray, int, int]] = []
        held = 0
        seen: set[int] = set()

        def flush() -> pd.DataFrame:
            token = np.concatenate([t for t, _, _ in parts])
            lens = [len(t) for t, _, _ in parts]
            node = np.repeat(np.array([x for _, x, _ in parts], np.int64), lens)
            n = np.repeat(np.array([x for _, _, x in parts], np.int64), lens)
            order = np.argsort(token, kind="stable")
            t = token[order]
            same = np.concatenate([[False], t[1:] == t[:-1]])
            alone = ~same & ~np.concatenate([same[1:], [False]])
            shared = np.where(alone, 0, np.where(same, 2, 1))
            return pd.DataFrame({"token": t.astype(np.int64), "node": node[order],
                                 "n": n[order].astype(np.int32), "shared": shared.astype(np.int32)})

        for _, _, s, sig in _sets(batches, width):
            if sig in seen:
                continue
            seen.add(sig)
            p = prefix(s, ORDERS[0], hot, percent)
            parts.append((p, sig, len(s)))
            held += len(p)
            if held > RUN // 4:
                yield flush()
                parts.clear()
                seen.clear()
                held = 0
        if parts:
            yield flush()

    return docs.mapInPandas(run, "token long, node long, n int, shared int")


def _node_table(docs: DataFrame, needed: DataFrame, width: int, percent: int, hot_b) -> DataFrame:
    """``node, n, bits, second, third, text`` of the nodes in ``needed``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = hot_b.value
        seen: set[int] = set()
        rows: list[tuple] = []
        held = 0
        cols = ["node", "n", "bits", "second", "third", "text"]
        for pdf, i, s, sig in _sets(batches, width):
            if sig in seen:
                continue
            seen.add(sig)
            others = [np.unique(prefix(s, seed, hot, percent).astype(np.uint32)).tobytes() for seed in ORDERS[1:]]
            text = pdf["text"].iloc[i]
            rows.append((sig, len(s), bitmap(s), *others, text))
            held += len(text) + 4 * len(s)
            if held > 4_000_000:
                yield pd.DataFrame(rows, columns=cols)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=cols)

    out = docs.mapInPandas(run, "node long, n int, bits binary, second binary, third binary, text string")
    return out.join(needed, "node", "left_semi").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "bits", "second", "third", "text")])


def _length_ok(percent: int):
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _verify(pairs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: filters of the other orders, then the sets."""
    small = nodes.select("node", "n", "bits", "second", "third")

    def side(frame: DataFrame, c: str) -> DataFrame:
        return frame.select(*[F.col(x).alias(c if x == "node" else f"{x}_{c}") for x in frame.columns])

    def overlaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            for i, r in enumerate(pdf.itertuples(index=False)):
                x, y = np.frombuffer(r.bits_a, np.uint64), np.frombuffer(r.bits_b, np.uint64)
                differ = int(np.bitwise_count(x ^ y).sum())
                if (100 + percent) * (r.n_a + r.n_b - differ) < 2 * percent * (r.n_a + r.n_b):
                    continue
                keep[i] = all(len(np.intersect1d(np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32), True))
                              for p, q in ((r.second_a, r.second_b), (r.third_a, r.third_b)))
            yield pdf.loc[keep, ["a", "b"]]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            left, right = pdf[["text_a"]].set_axis(["text"], axis=1), pdf[["text_b"]].set_axis(["text"], axis=1)
            for (_, i, x, _), (_, _, y, _) in zip(_sets(iter([left]), width), _sets(iter([right]), width)):
                both = len(np.intersect1d(x, y, True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pdf.loc[keep, ["a", "b"]]

    filtered = pairs.join(side(small, "a"), "a").join(side(small, "b"), "b").where(_length_ok(percent)) \
        .mapInPandas(overlaps, "a long, b long")
    filtered = staged(filtered, "candidates")
    texts = nodes.select("node", "text")

    def needed(c: str) -> DataFrame:
        """The texts of one side's nodes only: the hubs' side has few."""
        return side(texts.join(filtered.select(F.col(c).alias("node")).distinct(), "node", "left_semi"), c)

    links = staged(filtered.join(needed("b"), "b").join(needed("a"), "a").select("a", "b", "text_a", "text_b")
                   .mapInPandas(verify, "a long, b long"), "links")
    drop_staged(filtered)
    return links


def _cross_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs across components that share a hub and pass the bounds.
    ``members``: hub, node - the nodes of all tokens with that hub."""
    comp = members.join(labels, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    comp = staged(comp, "labelled-members")
    open_hubs = staged(comp.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                               F.count(F.lit(1)).alias("m"))
                       .where(F.col("lo") != F.col("hi"))
                       .select("hub", F.ceil(F.col("m") / F.lit(BLOCK)).cast("int").alias("nb")), "open-hubs")
    rows = comp.join(open_hubs, "hub").join(nodes.select("node", "n", "bits"), "node")
    blk = F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")
    rows = rows.withColumn("blk", blk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))) \
        .withColumn("bi", F.least("blk", "other")).withColumn("bj", F.greatest("blk", "other"))

    def compare(group: pd.DataFrame) -> np.ndarray:
        blk, node, comp_ = group["blk"].to_numpy(), group["node"].to_numpy(), group["comp"].to_numpy()
        n = group["n"].to_numpy(np.int64)
        bits = np.frombuffer(b"".join(group["bits"]), np.uint64).reshape(len(group), BITS // 64)
        two = group["bi"].iloc[0] != group["bj"].iloc[0]
        found = []
        for i in range(len(group) - 1):
            j = slice(i + 1, None)
            ok = (comp_[i] != comp_[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            if two:
                ok &= blk[i] != blk[j]
            hit = np.flatnonzero(ok) + i + 1
            if len(hit):
                differ = np.bitwise_count(bits[i] ^ bits[hit]).sum(axis=1).astype(np.int64)
                total = n[i] + n[hit]
                hit = hit[(100 + percent) * (total - differ) >= 2 * percent * total]
                if len(hit):
                    found.append(np.stack([np.minimum(node[i], node[hit]), np.maximum(node[i], node[hit])], 1))
        return np.concatenate(found) if found else np.zeros((0, 2), np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        keys = ["hub", "bi", "bj"]

        def groups(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            k = frame[keys].to_numpy()
            cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            edges = [0, *cut.tolist(), len(frame)]
            for lo, hi in zip(edges, edges[1:]):
                yield frame.iloc[lo:hi]

        for pdf in batches:
            frame = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            own = list(groups(frame))
            held = own.pop()
            found = [compare(g) for g in own if len(g) > 1]
            if found:
                both = np.unique(np.concatenate(found), axis=0)
                yield pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})
        if held is not None and len(held) > 1:
            both = compare(held)
            yield pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    dealt = rows.select("hub", "bi", "bj", "blk", "node", "comp", "n", "bits") \
        .repartition("hub", "bi", "bj").sortWithinPartitions("hub", "bi", "bj")
    pairs = staged(dealt.mapInPandas(run, "a long, b long").distinct(), "cross-pairs")
    drop_staged(comp, open_hubs)
    return pairs


def join_ngrams(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``<id_col>, n_shingles, component_id``, one row per document."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    body = texts.where(F.col("text").isNotNull()).select("text")

    profile = staged(_profiles(texts, width), "profiles")
    rows = profile.where(F.col("df") == 0).select("doc_id", "node", "n")
    hot = profile.where(F.col("df") > 0).groupBy("token").agg(F.sum("df").alias("df")) \
        .orderBy(F.desc("df"), "token").limit(HOT_TABLE).toPandas()
    tokens = hot["token"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(tokens)
    hot_b = sc.broadcast((tokens[order], hot["df"].to_numpy(np.int64)[order]))

    raw = _postings(body, width, percent, hot_b)
    deal = F.when(F.col("shared") == 2, F.pmod(F.xxhash64("node"), F.lit(1 << 20)) + 1).otherwise(F.lit(0))
    own = Window.partitionBy("token", "deal")
    postings = staged(raw.withColumn("deal", deal).withColumn("m", F.count(F.lit(1)).over(own))
                      .where((F.col("m") > 1) | (F.col("shared") > 0))
                      .select("token", "node", "n"), "postings")
    needed = staged(postings.select("node").distinct(), "needed-nodes")
    nodes = staged(_node_table(body, needed, width, percent, hot_b), "nodes")
    drop_staged(needed)

    hubs = staged(postings.groupBy("token").agg(F.min(F.struct("n", "node")).alias("hub"))
                  .select("token", F.col("hub.node").alias("hub"), F.col("hub.n").alias("n_a")), "hubs")
    members = staged(postings.join(hubs, "token").select("hub", "n_a", "node", F.col("n").alias("n_b")).distinct(), "members")
    drop_staged(postings, hubs)
    stars = members.where((F.col("hub") != F.col("node")) & _length_ok(percent)) \
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
    stars = staged(stars, "stars")
    links = _verify(stars, nodes, width, percent)
    labels = staged(graph.components(links, "a", "b"), "star-components")
    pairs = _cross_pairs(members.select("hub", "node"), nodes, labels, percent)
    cross = _verify(pairs, nodes, width, percent)
    drop_staged(stars, labels, members, pairs, nodes)
    labels = staged(graph.components(links.unionByName(cross), "a", "b"), "components")
    drop_staged(links, cross)

    with_words = rows.where(F.col("n") > 0)
    least = with_words.groupBy("node").agg(F.min("doc_id").alias("least"))
    named = staged(least.join(labels, "node", "left")
                   .select("node", "least", F.coalesce("component", "node").alias("component")), "named")
    smallest = staged(named.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    by_node = staged(named.join(smallest, "component").select("node", "component_id"), "by-node")
    alone = rows.where(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = with_words.join(by_node, "node").select("doc_id", "n", "component_id").unionByName(alone)
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
