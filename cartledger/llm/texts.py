"""Whole texts as numpy arrays: words, their 64-bit hashes, and Arrow batches in bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that one round of array work holds; a longer text makes a round of its own.
SLICE_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240229)
_BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: One odd factor for each place of a word in a shingle or context.
PLACE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int, _kept: dict = {}) -> np.ndarray:  # noqa: B006
    """1, base, base^2, ... modulo 2^64; kept by worker and grown on demand."""
    have = _kept.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), np.uint64(base), dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= 4 * SLICE_BYTES:
            _kept[base] = have
    return have[:n]


def text_key() -> list[Column]:
    """``body`` and ``body2`` of ``text``: 96 bits of hash that tell texts apart; null counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("body"), F.hash(text).alias("body2")]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of at most SLICE_BYTES of ``column``, one row at least."""
    if not batch.num_rows:
        return
    at = batch.schema.get_field_index(column)
    offsets = text_buffer(batch.column(at))[1]
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the rows end to end, and their offsets (rows + 1); null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all else unchanged."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts of one slice.

    ``starts`` and ``ends`` are byte places, ``first`` the index of each text's first word
    (texts + 1 entries), ``hashes`` one 64-bit hash for each word. ``blank`` marks other bytes that part words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, blank: np.ndarray | None = None):
        if blank is None:
            blank = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = edge[:-1].copy()
        before[1:] |= blank[:-1]
        after = edge[1:].copy()
        after[:-1] |= blank[1:]
        self.data, self.offsets = data, offsets
        self.starts = np.flatnonzero(before & ~blank)
        self.ends = np.flatnonzero(after & ~blank) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def array(self) -> pa.Array:
        """All words, byte for byte."""
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        held = self.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        offsets = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        return pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)])

    @property
    def hashes(self) -> np.ndarray:
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[self.data] * _powers(_BASE, len(self.data)), out=total[1:])
        span = total[self.ends] - total[self.starts]
        size = (self.ends - self.starts).astype(np.uint64)
        return mix(span * _powers(_BASE_INVERSE, len(self.data) + 1)[self.starts] + size)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; len(words) - k + 1 of them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * PLACE_CODES[0]
    for j in range(1, k):
        total = total + words[j : j + n] * PLACE_CODES[j]
    return mix(total + np.uint64(k))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] long, for every i, end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.repeat(starts - begin, counts) + np.arange(total)
