"""Periodic runs: stretches of words that repeat one pattern, from an enhanced suffix array of each text.

A run is a stretch with smallest period q (words q apart are identical) of at least
max(MIN_LENGTH, MIN_EXPONENT * q) words that no neighbouring word extends keeping q.

1. Word numbers of the texts of a slice are sorted by suffix, each text for itself, by doubling; only
   suffixes that are not told apart yet go into the next round. What each round knew (which positions agree
   on 1, 2, 4, ... words) is kept and answers every later question of how far two positions agree, forwards
   or backwards. So the LCP table comes without a pass over the text.
2. A square of period d whose next word differs from the word d before it ("branching") starts at i if
   suffixes i and i + d lie in different children of one LCP interval of depth d. Intervals and children
   are ranges between smaller values of the LCP table: arrays, no tree. For every child but the
   largest of its interval, each suffix s asks by the inverse array whether s + d or s - d lies in the interval but not
   in the child: O(n log n) questions.
3. A branching square is the right end of its run. Rotating it to the left as long as words agree gives the run's
   start; runs found with a multiple of their period have equal ends and are merged into the smallest.

A text in which no MIN_LENGTH - 1 words occur twice has no run, and leaves before step 1.

Nulls: a null text has no words and no runs; a null doc_id is returned as it is. Texts of blanks only are empty. Very long
texts: a text is held whole by one task, with some hundred bytes for each word. Ties: of runs with equal start, the
smaller period comes first. Repeated rows each return a row of their own. Empty tables give empty results. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import Words, gram_hashes, ranges, slices, text_buffer

#: Fewest words of a run, and fewest periods that it holds.
MIN_LENGTH, MIN_EXPONENT = 6, 4

RUN = pa.schema([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class SuffixArray:
    """Suffixes of several texts, text by text; ``begin`` and ``end`` give the text of each position."""

    def __init__(self, codes: np.ndarray, first: np.ndarray):
        n, counts = len(codes), np.diff(first)
        self.n = n
        self.begin, self.end = np.repeat(first[:-1], counts), np.repeat(first[1:], counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        key = owner * (int(codes.max(initial=0)) + 1) + codes
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, bool)
        fresh[1:] = np.diff(key[order]) != 0
        slot = np.arange(n)
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(fresh, slot, 0))
        undecided = slot[~(fresh & np.append(fresh[1:], True))]
        #: Of positions that agree with another one on 2^k words: place and group.
        self.agree: list[tuple[np.ndarray, np.ndarray]] = []
        width = 1
        while len(undecided):
            at = order[undecided]
            self.agree.append((at, rank[at]))
            after = at + width
            inside = after < self.end[at]
            key = rank[at] * (n + 1)
            key[inside] += rank[after[inside]] + 1
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            order[undecided] = at
            fresh = np.ones(len(at), bool)
            fresh[1:] = np.diff(key) != 0
            rank[at] = np.maximum.accumulate(np.where(fresh, undecided, 0))
            undecided = undecided[~(fresh & np.append(fresh[1:], True))]
            width *= 2
        self.order, self.rank = order, rank
        self._group = np.full(n + 1, -1, np.int64)
        self.lcp = np.zeros(n + 1, np.int64)  # of slots j - 1 and j; 0 at both ends
        self.lcp[1:n] = self.common(order[:-1], order[1:])

    def common(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """Words on which positions a and b of one text agree, from them on or (``back``) before them."""
        total, group = np.zeros(len(a), np.int64), self._group
        for k in range(len(self.agree) - 1, -1, -1):
            place, of = self.agree[k]
            group[place] = of
            if back:
                x, y = a - total - (1 << k), b - total - (1 << k)
                low = (x >= 0) & (y >= 0)
                x, y = np.maximum(x, 0), np.maximum(y, 0)
            else:
                x, y, low = a + total, b + total, True
            x = group[x]
            total += ((x >= 0) & (x == group[y]) & low).astype(np.int64) << k
            group[place] = -1
        return total


def _previous(depth: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place in ``at``, the last place before it whose depth is not larger; depth[0] is 0."""
    before = np.arange(-1, len(depth) - 1)
    todo = at
    while len(todo):
        p = before[todo]
        m = depth[p] > depth[todo]
        todo = todo[m]
        before[todo] = before[p[m]]
    return before


def _first_equal(depth: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Leftmost place of the chain of equal depths that each place in ``at`` hangs on."""
    up = np.arange(len(depth))
    same = at[depth[before[at]] == depth[at]]
    up[same] = before[same]
    while True:
        higher = up[up[same]]
        if (higher == up[same]).all():
            return up
        up[same] = higher


def branching_squares(index: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all branching squares, each once."""
    depth, n = index.lcp, index.n
    at = np.flatnonzero(depth)
    if not len(at):
        return at, at
    left = _previous(depth, at)
    right = n - _previous(depth[::-1], n - at)[::-1]
    head = _first_equal(depth, left, at)
    lo = left[head[at]]  # an interval is the slots from lo to before its end
    tail = at[depth[right[at]] < depth[at]]
    end = np.zeros(n + 1, np.int64)
    end[head[tail]] = right[tail]
    # children: left of every edge, and right of the last edge of each interval
    child = np.concatenate([left[at], tail])
    size = np.concatenate([at - left[at], right[tail] - tail])
    edge = np.concatenate([at, tail])
    low = np.concatenate([lo, left[head[tail]]])
    by = np.lexsort((-size, head[edge]))
    largest = np.ones(len(by), bool)
    largest[1:] = np.diff(head[edge][by]) != 0
    by = by[~largest]
    child, size, edge, low = child[by], size[by], edge[by], low[by]
    slot = ranges(child, size)
    d, c, e = np.repeat(depth[edge], size), np.repeat(child, size), np.repeat(child + size, size)
    low, high = np.repeat(low, size), np.repeat(end[head[edge]], size)
    s = index.order[slot]
    starts, periods = [], []
    for t, inside in ((s + d, s + d < index.end[s]), (s - d, s - d >= index.begin[s])):
        q = index.rank[np.where(inside, t, 0)]
        hit = inside & (q >= low) & (q < high) & ((q < c) | (q >= e))
        starts.append(np.minimum(s, t)[hit])
        periods.append(d[hit])
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return found[0], found[1]


def runs(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period; starts count over all texts."""
    index = SuffixArray(codes, first)
    start, period = branching_squares(index)
    back = index.common(start, start + period, back=True)
    length = 2 * period + back
    start = start - back
    keep = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
    start, length, period = start[keep], length[keep], period[keep]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    once = np.ones(len(by), bool)
    once[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    out = np.stack([start[once], length[once], period[once]], axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _may_repeat(codes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Texts in which some MIN_LENGTH - 1 words may occur twice; equal words have equal hashes."""
    k = MIN_LENGTH - 1
    grams = gram_hashes(codes.astype(np.uint64) + np.uint64(1), k)
    out = np.zeros(texts, bool)
    if len(grams):
        whole = owner[: len(grams)] == owner[k - 1 :]
        keys = grams[whole] ^ (owner[: len(grams)][whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        by = np.argsort(keys)
        out[owner[: len(grams)][whole][by[1:][np.diff(keys[by]) == 0]]] = True
    return out


def runs_of_texts(words: Words, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of the texts of a slice, starts counted over the slice, and the text of each."""
    texts = len(words.counts)
    owner = np.repeat(np.arange(texts), words.counts)
    some = np.flatnonzero(_may_repeat(codes, owner, texts))
    if not len(some):
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    counts = words.counts[some]
    first = np.concatenate([[0], np.cumsum(counts)])
    found = runs(codes[ranges(words.first[some], counts)], first)
    of = np.searchsorted(first, found[:, 0], side="right") - 1
    found[:, 0] += words.first[some[of]] - first[of]
    return found, some[of]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(*text_buffer(part.column("text")))
            array = words.array()
            codes = array.dictionary_encode().indices.to_numpy().astype(np.int64)
            found, of = runs_of_texts(words, codes)
            cover = np.zeros(len(codes) + 1, np.int32)
            np.add.at(cover, found[:, 0] + found[:, 2], 1)
            np.add.at(cover, found[:, 0] + found[:, 1], -1)
            kept = np.cumsum(cover[:-1]) == 0
            ends = np.concatenate([[0], np.cumsum(kept)])[words.first]
            array = array.filter(pa.array(kept)) if len(found) else array
            lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), array)
            text = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.string())
            found[:, 0] -= words.first[of]
            columns = [pa.array(np.ascontiguousarray(found[:, i])) for i in range(3)]
            per_text = pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)), pa.int32())
            listed = pa.ListArray.from_arrays(per_text, pa.StructArray.from_arrays(columns, fields=list(RUN)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), listed, text], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, ``runs`` by start and period, and the text with each run cut to its first period (words joined by one
    space)."""
    return docs.select("doc_id", "text").mapInArrow(_find, FOUND)


def with_loops(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the tail of one text in ten made periodic: a fixed load of the query.

    With h = crc32 of the id and g = h div 10, of the n words of a text with h % 10 = 0 each word i >= a = g % n becomes
    word a + (i - a) % p, where p = 1 + (n - a) div (3 + g % 8)."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    docs = docs.withColumn("w", F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(text, '([^\\x20\\x09-\\x0D]+)', 1)")))
    docs = docs.withColumns({"n": F.size("w"), "g": F.expr("h div 10")})
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    looped = F.expr("array_join(transform(sequence(0L, n - 1L), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The runs of every document, with_loops() applied: their number, the longest (ties: smallest start, then period),
    and digests of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda x: F.struct(
        (-x["length"]).alias("minus"), x["start"].alias("start"), x["period"].alias("period"))))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", *[x[c].cast("string") for c in RUN.names]), F.lit("\n")))
    return periodic_runs(with_loops(docs)).withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        (-F.col("best.minus")).alias("length"),
        "best.period",
        F.expr("-1000 * best.minus div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
