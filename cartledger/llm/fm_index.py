"""A compressed FM-index: wavelet matrix over the Burrows-Wheeler transform, searched in batches.

Suffixes are sorted by their first DEPTH symbols only, which is enough for patterns up to that length:
the rows that start with a pattern stand together, and a step of backward search counts whole rows.
"""

from __future__ import annotations

import numpy as np

#: Longest pattern that may be searched.
DEPTH = 128
#: Occurrences of a pattern, at most, that are located and read on in the text instead of the wavelet matrix.
FEW = 64


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes by their first DEPTH symbols, in any order where these are equal.

    Ranks by a prefix are put together to ranks by one as many times longer as ranks fit into 63 bits.
    """
    n = len(symbols)
    rank, width = symbols.astype(np.int64), 1
    while True:
        bits = max(1, (int(rank.max(initial=0)) + 1).bit_length())
        times = min(max(2, 63 // bits), -(-DEPTH // width))
        key = rank + 1
        for i in range(1, times):
            key <<= bits
            key[: max(0, n - i * width)] |= rank[i * width :] + 1
        order = np.argsort(key)
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])]) if n else key
        width *= times
        if width >= DEPTH or (n and rank[order[-1]] == n - 1):
            return order


class _Bits:
    """A bit vector in 64-bit words with counts before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(counts, dtype=np.int32) - counts
        self.zeros = int(len(bits) - counts.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Index of a symbol sequence (0 separates texts) whose positions carry a number, such as a doc_id."""

    def __init__(self, symbols: np.ndarray, owners: np.ndarray):
        order = _suffix_order(symbols)
        last = symbols[order - 1]  # of place 0, the last symbol: the sequence ends in a separator
        self.n, self.symbols, self.order = len(symbols), symbols, order
        sigma = int(symbols.max(initial=0)) + 1
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))]).astype(np.int64)
        self.levels, self.shifts = [], list(range(max(1, (sigma - 1).bit_length()) - 1, -1, -1))
        line = last
        for shift in self.shifts:
            bit = (line >> shift) & 1
            self.levels.append(_Bits(bit.astype(np.uint8)))
            line = np.concatenate([line[bit == 0], line[bit == 1]])
        self.begin = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))
        # least owner of any run of rows: minima over runs of 1, 2, 4, ...
        self.least = [owners[order]]
        while 2 ** len(self.least) <= self.n:
            half, prev = 2 ** (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(prev[:-half], prev[half:]))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in zip(self.shifts, self.levels, strict=True):
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1 == 1, bits.zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``symbol`` + pattern from the rows [lo, hi) of each pattern."""
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.less[symbol] - self.begin[symbol]
        return base + both[: len(lo)], base + both[len(lo) :]

    def smallest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least owner in rows [lo, hi), all non-empty."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.least[0].dtype)
        for k in np.unique(level).tolist():
            m = level == k
            out[m] = np.minimum(self.least[k][lo[m]], self.least[k][hi[m] - 2**k])
        return out

    def reach(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, below: np.ndarray) -> np.ndarray:
        """For each pattern text[starts:ends], searched from its end: where its search stopped.

        That is starts - 1 if all of it stands in a text whose owner is less than ``below``; else the
        place p of the symbol with which text[p:ends] has no such occurrence.
        """
        place = np.array(ends, np.int64)
        lo, hi = np.zeros(len(place), np.int64), np.full(len(place), self.n, np.int64)
        live = np.flatnonzero(place > starts)
        place -= 1
        while len(live):
            low, high = self.extend(text[place[live]], lo[live], hi[live])
            some = np.flatnonzero(high > low)
            some = some[self.smallest(low[some], high[some]) < below[live[some]]]
            live, low, high = live[some], low[some], high[some]
            lo[live], hi[live] = low, high
            place[live] -= 1
            few = high - low <= FEW
            self._read_on(text, live[few], low[few], high[few], place, starts, below)
            live = live[~few]
            live = live[place[live] >= starts[live]]
        return place

    def _read_on(self, text, rows, low, high, place, starts, below) -> None:
        """Moves ``place`` of each pattern on while one of its occurrences, in rows [low, high), goes on like it."""
        count = high - low
        row = np.repeat(rows, count)
        found = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        fits = self.least[0][found] < below[row]
        row, at = row[fits], self.order[found[fits]]
        while len(row):
            # before the first symbol comes the last, a separator
            goes = np.flatnonzero((place[row] >= starts[row]) & (self.symbols[at - 1] == text[place[row]]))
            row, at = row[goes], at[goes] - 1
            place[row] = place[row] - 1  # once, however many occurrences go on
