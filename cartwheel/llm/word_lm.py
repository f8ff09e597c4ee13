"""Language-model scoring by cross-entropy difference over the corpus's words.

A target model (documents that meet a condition) and a background model (all
documents) are word bigram models over one shared vocabulary: every word of the
corpus (runs of anything but ASCII white space, ASCII letters folded) and a
boundary symbol that stands before and after each text. Both use the same
Dirichlet-interpolated estimate, bigram to unigram to 1 / vocabulary, and
background counts are scaled to the target's mass, so the models are matched in
vocabulary, order, smoothing and amount of evidence. Every document is scored by
counts that leave its own out: a model never knows the text it is asked about,
but a copy elsewhere counts. A document's score is the mean over its words and its
end of target loss minus background loss in nats: the lower, the more like the
target. No word or bigram is cut, whatever its count.

The two interpolation masses are held-out estimates from the target's counts. A
symbol left out of its model is unseen if its count is 1; the mass is the one
under which an event's mean weight of the lower order equals that share, for
bigrams interpolated on the fixed grid ``MASSES``.

1. *Packs.* Each task packs its rows into runs of about ``RUN`` bytes of text.
2. *Requests.* A pack sends each of its distinct words and bigrams once, with
   its own two counts, to the range of hashes (bucket) the n-gram falls into.
   A row is one pack's n-grams of one bucket, so rows never outnumber n-grams.
3. *Replies.* A bucket adds up the counts of all packs and returns to each pack
   the corpus counts of what it asked for, in the order it asked.
4. *Scores.* Each pack meets its replies; every look-up has been counted.

Nothing of the corpus is held by the driver but five sums and a sum per mass of
the grid, and nothing is broadcast. A bucket gets an n-gram once a pack, however often it occurs, and the
number of buckets follows the number of packs.

Words and bigrams are compared by 63-bit hashes. Defined results: null or blank
text has no words and scores 0; if no document is a target, or there are no
words at all, every score is 0, as is that of the only target; a null condition is false; repeated rows count
and score each; input columns named like an added column are replaced; an empty
table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm import textkit as tk
from cartwheel.llm.common import staged, without

ADDED = ("n_tokens", "score")
MASSES = 2.0 ** np.arange(-10, 41)
RUN = 6_000_000  # bytes of text of a pack
_TEXT, _FLAG = "_lm_text", "_lm_flag"
_BOUNDARY = np.uint64(0xD6E8FEB86659FD93)
_ONE = np.uint64(1)


def _squeeze(a: np.ndarray) -> bytes:
    """Eight-byte integers by byte planes, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes()
    return pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _expand(blob: bytes, n: int, kind: type) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(blob, 8 * n, asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def word_events(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the predicted symbols and of the symbols before them, over all
    texts, first event of each text, and words per text. A text of n words has
    n + 1 events, one without words none."""
    found, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, words in tk.pieces(texts, tk.BLANK_SEPARATED):
        found.append(words.hashes)
        sizes.append(np.diff(words.bounds))
    n_words = np.concatenate(sizes)
    events = n_words + (n_words > 0)
    ends = np.cumsum(events)
    cur = np.full(int(events.sum()), _BOUNDARY)
    inner = np.ones(len(cur), bool)
    inner[ends[n_words > 0] - 1] = False
    cur[inner] = np.concatenate(found)
    prev = np.concatenate([[_BOUNDARY], cur[:-1]]).astype(np.uint64)[:len(cur)]
    return cur, prev, ends - events, n_words


def gram_keys(cur: np.ndarray, prev: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words (odd) and of bigrams (even)."""
    two = tk.mix64(tk.mix64(prev * np.uint64(0x9FB21C651E98DF25)) + cur)
    return tk.mix64(cur) | _ONE, two & ~_ONE


def _packs(docs: DataFrame) -> DataFrame:
    """``pack, body``: runs of rows, compressed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_pydict({"pack": pa.array([uuid.uuid4().int >> 65], pa.int64()),
                                               "body": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            own = pc.fill_null(pc.binary_length(batch.column(_TEXT)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(own[at:]), RUN - size, side="right"))
                if not fits and size:
                    yield flush()
                    held, size = [], 0
                    continue
                end = min(batch.num_rows, at + max(1, fits))
                held.append(batch.slice(at, end - at))
                size += int(own[at:end].sum())
                at = end
        if held:
            yield flush()

    return docs.mapInArrow(pack, "pack long, body binary")


def _open(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def _requests(packs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, pack, n, keys, target, background``: sorted keys as differences."""
    kind = pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), ("n", pa.int64()),
                      ("keys", pa.binary()), ("target", pa.binary()), ("background", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column("pack"), batch.column("body")):
                table = _open(body.as_py())
                cur, prev, _, n_words = word_events(table.column(_TEXT).to_pylist())
                flags = np.repeat(np.array(table.column(_FLAG).to_pylist(), bool), n_words + (n_words > 0))
                del table
                keys = np.concatenate(gram_keys(cur, prev))
                del cur, prev
                wanted = np.sort(keys[np.concatenate([flags, flags])])
                keys.sort()
                cut = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
                background = np.diff(cut, append=len(keys))
                keys = keys[cut]
                target = np.searchsorted(wanted, keys, "right") - np.searchsorted(wanted, keys, "left")
                del wanted, flags, cut
                where = bucket_of(keys, buckets)
                cuts = np.flatnonzero(np.diff(where)) + 1
                rows: list[tuple] = []
                held = 0
                for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                    if hi > lo:
                        gaps = np.diff(keys[lo:hi], prepend=np.uint64(0))
                        rows.append((int(where[lo]), name.as_py(), int(hi - lo), _squeeze(gaps),
                                     _squeeze(target[lo:hi]), _squeeze(background[lo:hi])))
                        held += hi - lo
                    if held > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    return packs.mapInArrow(ask, "bucket long, pack long, n long, keys binary, target binary, background binary")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key: equal ranges of keys, in their order."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _replies(requests: DataFrame) -> DataFrame:
    """``pack, bucket, n, target, background``: corpus counts of the keys asked
    for; a row without pack has the bucket's vocabulary, masses, the target's numbers
    of words and bigrams seen once, and its words' weight of the lower order per mass."""
    kind = pa.schema([("pack", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("target", pa.binary()),
                      ("background", pa.binary()), ("mass_t", pa.int64()), ("mass_b", pa.int64()),
                      ("once", pa.int64()), ("once_pairs", pa.int64()), ("weights", pa.list_(pa.float64()))])

    def add_up(asked: pa.Table) -> pa.Table:
        sizes = asked.column("n").to_pylist()
        keys, target, background = (
            [_expand(b.as_py(), n, t) for b, n in zip(asked.column(c), sizes)]
            for c, t in (("keys", np.uint64), ("target", np.int64), ("background", np.int64)))
        own, at = np.unique(np.concatenate([np.cumsum(k, dtype=np.uint64) for k in keys]), return_inverse=True)
        # sums of integers below 2^53: exact in any order
        t = np.bincount(at, np.concatenate(target), len(own)).astype(np.int64)
        b = np.bincount(at, np.concatenate(background), len(own)).astype(np.int64)
        word = (own & _ONE) == _ONE
        bucket = asked.column("bucket")[0].as_py()
        seen, many = np.unique(t[word], return_counts=True)
        weights = [float((seen * many * m / (seen + m)).sum()) for m in MASSES]
        rows = [(None, bucket, int(word.sum()), None, None, int(t[word].sum()), int(b[word].sum()),
                 int((t[word] == 1).sum()), int((t[~word] == 1).sum()), weights)]
        ends = np.cumsum(sizes)
        for name, n, end in zip(asked.column("pack").to_pylist(), sizes, ends):
            mine = at[end - n:end]
            rows.append((name, bucket, n, _squeeze(t[mine]), _squeeze(b[mine]), *[None] * 5))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    return requests.groupBy("bucket").applyInArrow(
        add_up, "pack long, bucket long, n long, target binary, background binary, mass_t long, mass_b long, "
                "once long, once_pairs long, weights array<double>")


def interpolation_masses(mass: float, once: float, once_pairs: float, weights: list[float]) -> tuple[float, float]:
    """Masses of the uniform and of the unigram estimate in a model of ``mass``
    events. ``weights``: summed weights of the unigrams for each of ``MASSES``."""
    unseen, unseen_pairs = (min(max(n / mass, 0.5 / mass), 1 - 0.5 / mass) for n in (once, once_pairs))
    pairs = float(np.exp(np.interp(unseen_pairs, np.array(weights) / mass, np.log(MASSES))))
    return mass * unseen / (1 - unseen), float(f"{pairs:.9g}")


def own_counts(doc: np.ndarray, key: np.ndarray, keys: int) -> np.ndarray:
    """How often each event's key occurs in the event's document."""
    _, at, n = np.unique(doc * keys + key, return_inverse=True, return_counts=True)
    return n[at]


def score_documents(docs: DataFrame, is_target: Column, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_tokens`` (words) and ``score``."""
    once = dict(docs.dtypes).get(text_col) == "string" and text_col not in ADDED  # packed as _TEXT alone
    kept = docs.select(*without(docs, ADDED)).schema.fields
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept if not (once and f.name == text_col)],
                       F.col(text_col).cast("string").alias(_TEXT), F.coalesce(is_target, F.lit(False)).alias(_FLAG))
    out_type = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])
    names = [f.name for f in kept]
    held = [_TEXT if once and n == text_col else n for n in names]

    packs = staged(_packs(rows), "lm-packs")
    buckets = packs.count() // 2 + 1  # about as many n-grams as four packs
    replies = staged(_replies(_requests(packs, buckets)), "lm-replies")
    sums = replies.where(F.col("pack").isNull())
    vocabulary, mass_t, mass_b, seen_once, pairs_once = (float(x or 0) for x in sums.agg(
        *[F.sum(c) for c in ("n", "mass_t", "mass_b", "once", "once_pairs")]).first())
    weights = [r[0] for r in sums.select(F.posexplode("weights")).groupBy("pos").agg(F.sum("col").alias("w"))
               .orderBy("pos").select("w").collect()]
    prior, pair_prior = interpolation_masses(mass_t, seen_once, pairs_once, weights) if mass_t else (1.0, 1.0)

    def score(pack: pa.Table, reply: pa.Table) -> pa.Table:
        parts = []
        for body in pack.column("body"):
            table = _open(body.as_py())
            cur, prev, first, n_words = word_events(table.column(_TEXT).to_pylist())
            scores = np.zeros(len(n_words))
            if mass_t and len(cur):
                order = np.argsort(reply.column("bucket").to_numpy())
                sizes = reply.column("n").to_numpy()
                t, b = (np.concatenate([_expand(reply.column(c)[int(i)].as_py(), int(sizes[i]), np.int64) for i in order])
                        for c in ("target", "background"))
                words, pairs = gram_keys(cur, prev)
                del cur, prev
                keys = np.unique(np.concatenate([words, pairs]))
                if len(keys) != len(t):
                    raise ValueError(f"{len(t)} replies to {len(keys)} requests")
                word_at, pair_at = (np.searchsorted(keys, c).astype(np.int32) for c in (words, pairs))
                n_keys = len(keys)
                del words, pairs, keys
                n_events = n_words + (n_words > 0)
                doc = np.repeat(np.arange(len(n_words)), n_events)
                flag = np.array(table.column(_FLAG).to_pylist(), bool)
                own_word, own_pair = (own_counts(doc, c, n_keys) for c in (word_at, pair_at))
                # a symbol precedes as often as it is predicted; a text's first event follows the end of a text
                loss = np.zeros(len(doc))
                left_t = mass_t - flag * n_events
                left_b = mass_b - n_events
                match = np.divide(left_t, left_b, out=np.zeros(len(left_t)), where=left_b > 0)
                mass = left_t[doc]
                for counts, mine, scale, sign in ((t, flag[doc], 1.0, -1.0), (b, True, match[doc], 1.0)):
                    seen = (counts[word_at] - own_word * mine) * scale
                    p = (seen + prior / vocabulary) / (mass + prior)
                    before = (np.roll(counts[word_at], 1) - np.roll(own_word, 1) * mine) * scale
                    p = ((counts[pair_at] - own_pair * mine) * scale + pair_prior * p) / (before + pair_prior)
                    loss += sign * np.log(p)
                some = n_words > 0
                scores[some] = np.add.reduceat(loss, first[some]) / n_events[some]
            parts.append(table.select(held).rename_columns(names).append_column("n_tokens", pa.array(n_words, pa.int64()))
                         .append_column("score", pa.array(scores, pa.float64())))
        return pa.concat_tables(parts) if parts else None

    return packs.groupBy("pack").cogroup(replies.where(F.col("pack").isNotNull()).groupBy("pack")) \
        .applyInArrow(score, out_type)
