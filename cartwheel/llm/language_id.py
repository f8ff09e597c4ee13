"""Language identification by rank-order n-gram profiles.

*Profiles.* Every training text is lower-cased and cut into words of letters and
their marks; a word, padded by a blank at both ends, gives its n-grams of one to
three code points. The n-grams of a language are counted over all its training
texts (partial counts in the tasks, sums in Spark); its profile is the
``PROFILE_GRAMS`` most frequent ones by rank, ties by the n-gram's code points.

*Distance.* The ``PROFILE_GRAMS`` most frequent n-grams of a document, ranked alike
over its whole text, are compared to each profile: an n-gram is out of place by
the difference of its two ranks, and by ``PROFILE_GRAMS`` if the profile lacks it.
The language of the smallest sum wins, ties to the smaller name; the score is
one less the sum's share of the largest possible one.

N-grams are packed into 63 bits (three code points of 21 bits), so their
comparison is exact. Profiles reach the tasks in blocks of ``BLOCK_LANGS``
languages, whatever the number of languages, which bounds what one scan carries.

Null texts and texts without letters are ``und`` with score 0, as is every text
when nothing was learned. Training rows with null language or without any
letter teach nothing. Very long texts are counted piece by piece. Repeated rows
are predicted alike; input columns named like an added column are replaced; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import staged, without

PROFILE_GRAMS = 400
BLOCK_LANGS = 200
UNDETERMINED = "und"

# One task's partial counts are handed on beyond this many n-grams, and a text
# is counted in pieces of this many words, so a task's memory doesn't grow.
FLUSH_GRAMS = 500_000
PIECE_WORDS = 100_000

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
BITS = 21


def _piece_grams(words: list[str]) -> np.ndarray:
    """The packed n-grams (one to three code points) of some words."""
    padded = " " + " ".join(words) + " "
    c = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    blank = c == 32
    two = (c[:-1] << BITS) | c[1:]
    three = (two[:-1] << BITS) | c[2:]
    return np.concatenate([c[~blank], two, three[~blank[1:-1]]])


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    grams, place = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    counts = np.zeros(len(grams), dtype=np.int64)
    np.add.at(counts, place, np.concatenate([a[1], b[1]]))
    return grams, counts


def count_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a whole text in ascending order, and their counts."""
    found = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    words: list[str] = []
    for m in WORD.finditer(text.lower() if text else ""):
        words.append(m.group())
        if len(words) == PIECE_WORDS:
            found = _merge(found, np.unique(_piece_grams(words), return_counts=True))
            words = []
    if words:
        piece = np.unique(_piece_grams(words), return_counts=True)
        found = _merge(found, piece) if len(found[0]) else piece
    return found


def _top(grams: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` most frequent n-grams in rank order (ties: smaller n-gram first;
    ``grams`` is ascending, so a stable sort keeps that order)."""
    return grams[np.argsort(-counts, kind="stable")[:k]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   grams: int = PROFILE_GRAMS) -> DataFrame:
    """``lang, rank, gram``: the ranked profile of every language of ``docs``,
    counted over all its rows."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                g, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)],
                                                 names=["lang", "gram", "n"])
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = count_grams(text)
                if len(found[0]):
                    held.setdefault(lang, []).append(found)
                    size += len(found[0])
                if size > FLUSH_GRAMS:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.mapInArrow(partial, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    return staged(ranked.where(F.col("rank") <= grams).select("lang", (F.col("rank") - 1).alias("rank"), "gram"), "profiles")


def _profile_matrix(rows: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language names in order, the n-grams of any profile in order, and a
    matrix of ranks (-1: not in the profile)."""
    langs = sorted({r.lang for r in rows})
    vocabulary = np.unique(np.array([r.gram for r in rows], dtype=np.int64))
    ranks = np.full((len(vocabulary), len(langs)), -1, dtype=np.int64)
    for r in rows:
        ranks[np.searchsorted(vocabulary, r.gram), langs.index(r.lang)] = r.rank
    return langs, vocabulary, ranks


def out_of_place(text: str | None, vocabulary: np.ndarray, ranks: np.ndarray, grams: int) -> tuple[np.ndarray, int] | None:
    """The distance of a text to every profile and the largest possible one;
    None without letters."""
    top = _top(*count_grams(text), grams)
    if not len(top):
        return None
    at = np.minimum(np.searchsorted(vocabulary, top), len(vocabulary) - 1)
    place = np.where((vocabulary[at] == top)[:, None], ranks[at], -1)
    moved = np.abs(place - np.arange(len(top))[:, None])
    return np.where(place < 0, grams, moved).sum(axis=0), grams * len(top)


def predict_language(docs: DataFrame, profiles: DataFrame, text_col: str = "text", grams: int = PROFILE_GRAMS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. Every block of at most
    ``BLOCK_LANGS`` profiles is one step over the documents that keeps the nearest
    language so far; all steps run in one scan."""
    names = [r.lang for r in profiles.select("lang").distinct().orderBy("lang").toLocalIterator()]
    plain = without(docs, ["lang_pred", "score", "_lang", "_dist"])
    out = docs.select(*plain, F.lit(None).cast("string").alias("_lang"), F.lit(None).cast("double").alias("_dist"))
    schema = out.schema

    def step(block: tuple) -> object:
        langs, vocabulary, ranks = block

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best, far = batch.column("_lang").to_pylist(), batch.column("_dist").to_pylist()
                for i, text in enumerate(batch.column(text_col)):
                    found = out_of_place(text.as_py(), vocabulary, ranks, grams)
                    if found is None:
                        continue
                    j = int(np.argmin(found[0]))
                    share = float(found[0][j]) / found[1]
                    if far[i] is None or share < far[i]:
                        best[i], far[i] = langs[j], share
                cols = batch.columns[:-2] + [pa.array(best, pa.string()), pa.array(far, pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
        return run

    for i in range(0, len(names), BLOCK_LANGS):
        rows = profiles.where(F.col("lang").isin(names[i:i + BLOCK_LANGS])).collect()  # BLOCK_LANGS x grams rows at most
        out = out.mapInArrow(step(_profile_matrix(rows)), schema)
    return out.select(*[F.col(f"`{c}`") for c in out.columns[:-2]],
                      F.coalesce("_lang", F.lit(UNDETERMINED)).alias("lang_pred"),
                      F.coalesce(1 - F.col("_dist"), F.lit(0.0)).alias("score"))
