"""Vectorised word splitting and hashing over batches of texts (numpy).

Texts are joined into byte runs, separators are one table look-up, and each
word's hash is a difference of prefix sums of a polynomial over its bytes, so
no Python object is made per word. Words longer or shorter, empty and null
texts and texts of any length are handled alike; a batch is worked off in
pieces of about ``PIECE`` bytes, cut between texts or, inside a long text,
between words, which bounds the temporary arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

PIECE = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (the splitmix64 constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))


BYTE_VALUE = _byte_values()


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), PIECE)
            up, down = np.full(size, _BASE, _U), np.full(size, _INVERSE, _U)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


def separators(ranges: Iterable[tuple[int, int]]) -> np.ndarray:
    """256 booleans: the bytes of the given closed ranges separate words."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


# Words of any characters but ASCII white space.
BLANK_SEPARATED = separators([(0x20, 0x20), (0x09, 0x0D)])
# Words of ASCII letters and digits and of all characters beyond ASCII.
ALNUM_SEPARATED = separators([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of a piece: raw and folded bytes, byte spans, hashes of the folded
    words, and for each text the range of its words (``bounds[i]:bounds[i + 1]``)."""
    raw: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def texts(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def heads(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each folded word (the whole
        word where it is shorter)."""
        return _word_hashes(self.data, self.starts, np.minimum(self.starts + size, self.ends), _Powers())

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Hash of each byte span; works off about ``PIECE`` bytes at a time."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        run = data[base:ends[j - 1]]
        up, down = powers.get(len(run) + 1)
        sums = np.empty(len(run) + 1, _U)
        sums[0] = 0
        np.cumsum(BYTE_VALUE[run] * up[:len(run)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(_U))
        i = j
    return out


def split_words(texts: list[bytes], sep: np.ndarray, powers: _Powers) -> Words:
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined, np.uint8)
    data = _FOLD[raw]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    gap = np.empty(len(data) + 1, bool)
    gap[0] = True
    gap[1:] = sep[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[0::2], edges[1::2]
    text_end = np.cumsum(lengths)
    bounds = np.concatenate([[0], np.searchsorted(starts, text_end)])
    return Words(raw, data, starts, ends, _word_hashes(data, starts, ends, powers), bounds)


def pieces(texts: Iterable[str | None], sep: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """``(first, last + 1, words)`` for consecutive groups of the texts."""
    powers = _Powers()
    batch: list[bytes] = []
    first = size = 0
    for text in texts:
        b = encode(text)
        if batch and size + len(b) > PIECE:
            yield first, first + len(batch), split_words(batch, sep, powers)
            first, batch, size = first + len(batch), [], 0
        batch.append(b)
        size += len(b) + 1
    if batch:
        yield first, first + len(batch), split_words(batch, sep, powers)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words; with fewer words, the whole
    sequence as one; none without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    acc = hashes[:n - width + 1].copy()
    for j in range(1, width):
        acc = mix64(acc * _U(0x9FB21C651E98DF25)) + hashes[j:n - width + 1 + j]
    return mix64(acc + _U(width))
