"""Words and shingles of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in pieces of about this many bytes, one text at least, which bounds the working memory.
CHUNK_BYTES = 1 << 20
SHINGLE = 5

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ODD = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)
_powers = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each value over all 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**n modulo 2**64, kept between calls."""
    if len(_powers[base]) <= n:
        steps = np.full(n + 1, base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][: n + 1]


class Words:
    """The words of a list of texts: byte spans, 64-bit hashes of the words in lower case, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        inside = ~_SPACE[data]
        first, last = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
        first[offsets[:-1]] = True
        last[offsets[1:]] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:n]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | last[1:n]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _power(_BASE, n)[:n], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * _power(_INVERSE, n)[self.starts])
        self.first = np.searchsorted(self.starts, offsets)

    def shingles(self) -> Iterator[np.ndarray]:
        """Per text, the hashes of its distinct five-word shingles in ascending order.

        A shorter text has its whole sequence as one shingle, a text without words none.
        """
        h = self.hashes
        whole = np.zeros(max(0, len(h) - SHINGLE + 1), dtype=np.uint64)
        for j in range(SHINGLE):
            whole += h[j : j + len(whole)] * _ODD[j]
        whole = mix(whole)
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= SHINGLE:
                yield np.unique(whole[a : b - SHINGLE + 1])
            elif b > a:
                yield mix((h[a:b] * _ODD[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, dtype=np.uint64)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts as (first row, end row, bytes, offsets of each text in them); null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
