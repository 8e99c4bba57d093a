"""Words of Arrow text columns, as NumPy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D.  Those bytes never
occur inside a longer UTF-8 sequence, so texts are cut as bytes.  Everything here
runs on bounded chunks of rows, inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD_SEPARATORS = np.zeros(256, dtype=bool)
WORD_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_KEYS = np.random.default_rng(20260113).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers = {_BASE: np.ones(1, dtype=np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that any bits of them serve as a hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:count]


def _range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every range, independent of where the range lies."""
    inverse = pow(_BASE, -1, 2**64)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(inverse, len(values) + 1)[starts])


@dataclass
class Words:
    """Words of some texts: byte ranges, 64-bit hashes, and the text each lies in."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each text, the number of its first word; one more at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """Of each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words and hashes of all runs of `size` words that lie in one text."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        last = np.repeat(self.first[1:], self.counts())
        at = np.flatnonzero(np.arange(n) + size <= last)
        return at, _range_sums(self.hashes, at, at + size)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts one after another, and their offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    apart = WORD_SEPARATORS[data]
    inside = ~apart
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= apart[:-1]
    closes[:-1] &= apart[1:]
    borders = np.unique(offsets)
    borders = borders[borders < len(data)]
    begins[borders] |= inside[borders]
    borders = borders[borders > 0] - 1
    closes[borders] |= inside[borders]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, _range_sums(_BYTE_KEYS[data], starts, ends), first)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `limit` bytes of text; a longer text stands alone."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end
