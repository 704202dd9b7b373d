"""Vectorised text primitives used inside Arrow tasks.

Texts of an Arrow batch are handled as one UTF-8 byte buffer with offsets, so
words, shingles and windows are found and hashed by a fixed number of numpy
passes over the buffer instead of a Python loop over words.

Hashes are 64 bits wide: a polynomial over random per-byte values, taken from
prefix sums so any span costs O(1), finished with a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5  # odd and 5 mod 8: powers differ in high 2-adic order only
_BASE -= (_BASE - 5) % 8
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: 256 fixed random byte values.
_BYTE_VALUE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers = np.ones(1, dtype=U64)
_inverse_powers = np.ones(1, dtype=U64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the base and of its inverse (grown when needed)."""
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, 1 << 16)
        step = np.full(size, _BASE, dtype=U64)
        step[0] = 1
        _powers = np.multiply.accumulate(step)
        step = np.full(size, _BASE_INV, dtype=U64)
        step[0] = 1
        _inverse_powers = np.multiply.accumulate(step)
    return _powers, _inverse_powers


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_slices(batch: pa.RecordBatch, text_col: str, max_bytes: int = 4 << 20,
                max_rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of the batch holding at most ``max_bytes`` of text (a longer
    single text is a range of its own) and ``max_rows`` rows each, which
    bounds the working set."""
    _, offsets = text_buffer(batch.column(text_col))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), start + (max_rows or batch.num_rows), batch.num_rows)
        yield start, end
        start = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text.
    Offsets start at 0 and have one entry more than the column has rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    n = len(column)
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the byte polynomial; ``span_hash`` reads spans from it."""
    powers, _ = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=U64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[data] * powers[:len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end); equal bytes give equal hashes."""
    _, inverse = _power_tables(len(sums))
    return mix64((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that stay within one text."""
    if len(mask) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(mask))]
    first[edge] = mask[edge]
    last[edge - 1] = mask[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Words:
    """Words of a slice of texts: byte spans, hashes and per-text offsets."""

    def __init__(self, column: pa.Array, lower: bool = True, is_word: np.ndarray | None = None,
                 hashes: bool = True):
        data, self.text_offsets = text_buffer(column)
        self.data = lower_ascii(data) if lower else data
        mask = ~_IS_SPACE[self.data] if is_word is None else is_word[self.data]
        self.start, self.end = runs(mask, self.text_offsets)
        #: words of text i are offsets[i]:offsets[i + 1]
        self.offsets = np.searchsorted(self.start, self.text_offsets)
        self.counts = np.diff(self.offsets)
        if hashes:
            self.sums = prefix_hash(self.data)
            self.hash = span_hash(self.sums, self.start, self.end)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text offsets) of all k-word shingles in order; a text of
        1..k-1 words has its whole word sequence as its one shingle."""
        counts = np.where(self.counts >= k, self.counts - k + 1, np.minimum(self.counts, 1))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(counts)), counts)
        first = self.offsets[text] + np.arange(offsets[-1]) - offsets[text]
        have = np.minimum(self.counts[text], k)
        padded = np.concatenate([self.hash, np.zeros(k, dtype=U64)])
        out = have.astype(U64)
        for j in range(k):
            word = padded[first + j]
            if len(have) and have.min() <= j:
                word = np.where(have > j, word, U64(0))
            out = mix64(out * U64(_BASE) + word)
        return out, offsets


def distinct_sorted(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each segment and the new offsets."""
    parts, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for i in range(len(counts)):
        seg = values[offsets[i]:offsets[i + 1]]
        if len(seg):
            seg = np.sort(seg)
            seg = seg[np.concatenate([[True], seg[1:] != seg[:-1]])]
            parts.append(seg)
            counts[i] = len(seg)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=values.dtype)
    return flat, np.concatenate([[0], np.cumsum(counts)])
