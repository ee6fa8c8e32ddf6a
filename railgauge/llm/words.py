"""Words and word hashes of whole Arrow batches, without a Python object per word.

A word is a run of UTF-8 bytes other than space and \\x09-\\x0D. A word's hash is a polynomial in a
table value per byte, taken from running sums modulo 2**64 and shifted back to position 0 with the
inverse of the base, so equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = bytes([0x20, *range(0x09, 0x0E)])
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
WORD_BASE = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(maxsize=4)
def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64."""
    return _powers(base, 1 << max(count - 1, 1).bit_length())[:count]


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    """The words of a batch of texts. starts and ends are byte positions in data."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: first[d]:first[d + 1] are the words of text d
    first: np.ndarray
    #: data[bounds[d]:bounds[d + 1]] are the bytes of text d
    bounds: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash per word; lower: A-Z count as a-z."""
        n = len(self.data)
        if not len(self.starts):
            return np.empty(0, dtype=np.uint64)
        values = _BYTE_VALUES[_LOWER] if lower else _BYTE_VALUES
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        terms = values[self.data]
        terms *= powers(BASE, n)
        np.cumsum(terms, out=sums[1:])
        out = sums[self.ends] - sums[self.starts]
        out *= powers(INVERSE, n)[self.starts]
        return mix(out)

    def slice_bytes(self, a: int, b: int) -> bytes:
        """Words a to b - 1, joined by one space."""
        data = self.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True))


def words_of(texts: pa.Array, separators: bytes = SPACES) -> Words:
    """The words of a string column; a null text has none. Separators are ASCII bytes."""
    parts = np.zeros(256, dtype=bool)
    parts[list(separators)] = True
    texts = texts.fill_null("")
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    bounds = offsets - low
    inside = ~parts[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds), bounds)


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes (len(hashes) - k + 1 of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    factor = np.uint64(WORD_BASE)
    for j in range(k):
        out *= factor
        out += hashes[j : j + n]
    return mix(out)


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 4 << 20):
    """Runs of a batch's rows with a bounded amount of text, one row at least."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(size)
    if begin < batch.num_rows:
        yield batch.slice(begin)
