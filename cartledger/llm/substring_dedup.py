"""Repeated passages: FM-indexes of passage contexts, asked for matching statistics.

A window of WINDOW words is a repeat if its word sequence also starts in a document with a smaller
doc_id; every word that a repeat covers is removed. Whole texts are streamed twice.

1. Each text is winnowed: of every WINDOW consecutive words, the gram of GRAM words with the least hash
   is an anchor, so equal windows have an equal anchor at the same place. An anchor's context is all
   words of the windows that can hold it. Only anchors seen in two documents go on, and equal
   contexts are one: in all but their first document, all of their windows are repeats.
2. What is left to find is which windows of a context stand in another context with a smaller first
   document. Contexts are put into shards by anchor. A shard builds an FM-index of its contexts
   and streams them through it: backward search over a wavelet matrix, restarted behind the place
   where it failed, yields the matching statistics, from which intervals of WINDOW words or more
   are reported. An anchor with very many contexts would overfill a shard: its contexts meet by whole
   windows instead, with a minimum for each, which gives the same answer.
3. Texts meet the repeats of their contexts, and words are removed.

Nulls: a null text has no words; a null doc_id is smaller than none, and nothing is removed from its
rows. Repeated rows do not repeat each other, as their doc_id is equal. Empty tables give empty
results. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartledger.session import cut_lineage

from .fm_index import FMIndex
from .texts import Words, _powers, gram_hashes, mix, ranges, slices, text_buffer

WINDOW, GRAM = 50, 12
#: Windows that hold an anchor: one for each place it may have.
PLACES = WINDOW - GRAM + 1
#: Contexts of a shard, about, and of one anchor in a shard at most.
SHARD_CONTEXTS, ANCHOR_CONTEXTS = 16_000, 2_000

_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_ALL = (1 << PLACES) - 1


def _slide(values: np.ndarray, width: int, reduce) -> np.ndarray:
    """reduce over every run of ``width`` values, by doubling."""
    have, run = 1, values
    while have * 2 <= width:
        run = reduce(run[:-have], run[have:])
        have *= 2
    return reduce(run[: len(values) - width + 1], run[width - have : width - have + len(values) - width + 1])


class Anchors:
    """Anchors of the texts of a slice: owner, place, gram hash, and context [lo, hi) in all words."""

    def __init__(self, words: Words):
        self.words, hashes = words, words.hashes
        grams = gram_hashes(hashes, GRAM)
        owner, place = [], []
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if b - a < WINDOW:
                continue
            own = grams[a : b - GRAM + 1]
            least = _slide(own, PLACES, np.minimum)
            # chosen if the least of some window: the largest of the minima it takes part in
            padded = np.concatenate([np.zeros(PLACES - 1, np.uint64), least, np.zeros(PLACES - 1, np.uint64)])
            at = np.flatnonzero(_slide(padded, PLACES, np.maximum) == own)
            owner.append(np.full(len(at), i))
            place.append(at + a)
        none = np.zeros(0, np.int64)
        self.owner = np.concatenate(owner) if owner else none
        self.place = np.concatenate(place) if place else none
        self.gram = grams[self.place] if len(self.place) else np.zeros(0, np.uint64)
        begin, end = words.first[self.owner], words.first[self.owner + 1]
        self.lo = np.maximum(self.place - (PLACES - 1), begin)
        self.hi = np.minimum(self.place + WINDOW, end)
        self.left = self.place - self.lo
        # sum of hashes[lo + j] * _BASE**(j + 1) over the context, from running sums
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * _powers(_BASE, len(hashes)), out=total[1:])
        code = (total[self.hi] - total[self.lo]) * np.uint64(_BASE) * _powers(_BASE_INVERSE, len(hashes) + 1)[self.lo]
        size = self.hi - self.lo
        #: One number for each context and its anchor's place in it.
        self.context = (mix(code + mix((self.left * 256 + size).astype(np.uint64))) >> np.uint64(1)).astype(np.int64)
        self.hashes = hashes


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = Anchors(Words(*text_buffer(part.column("text"))))
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            rows = np.unique(np.stack([ids[found.owner].astype(np.int64), found.context, (found.gram >> np.uint64(1)).astype(np.int64)], axis=1), axis=0) if len(found.owner) else np.zeros((0, 3), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], names=["doc_id", "context", "anchor"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the contexts that a text is asked for, in ``wanted``."""
    for batch in batches:
        for part in slices(batch, "text"):
            found = Anchors(Words(*text_buffer(part.column("text"))))
            asked = part.column("wanted")
            owner = np.repeat(np.arange(part.num_rows), asked.value_lengths().fill_null(0).to_numpy())
            wanted = asked.flatten().to_numpy(zero_copy_only=False)
            # (text, context) pairs on both sides; of equal ones in a text the first is told
            pairs = np.stack([np.concatenate([owner, found.owner]), np.concatenate([wanted, found.context])])
            _, same = np.unique(pairs, axis=1, return_inverse=True) if pairs.size else (None, np.zeros(0, np.int64))
            same = same.reshape(-1)
            at = np.flatnonzero(np.isin(same[len(owner) :], same[: len(owner)]))
            at = at[np.unique(same[len(owner) :][at], return_index=True)[1]]
            size = found.hi[at] - found.lo[at]
            words = found.hashes[ranges(found.lo[at], size)] if len(at) else np.zeros(0, np.uint64)
            ends = np.concatenate([[0], np.cumsum(size * 8)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.context[at]), pa.array(found.left[at].astype(np.int32)),
                 pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(words))])],
                names=["context", "left", "words"],
            )


def repeats_in_shard(shard: pd.DataFrame) -> pd.DataFrame:
    """context, mask: bit b for the window that starts PLACES - 1 - b words before the anchor.

    Each context is streamed through the index of all. With its windows lo..hi open, all words of windows lo..last are
    sought from their end, ``last`` being hi at first. If they stand, the windows are closed and ``last`` moves on by a growing
    stride. If the search fails at a place, the words behind it stand; the next search ends at the place, or else
    takes window lo alone. If that fails at a place, the next open window starts behind it, and is taken alone.
    """
    shard = shard.sort_values(["first_doc", "context"], kind="stable")
    each = [np.frombuffer(w, np.uint64) for w in shard["words"]]
    size = np.array([len(w) for w in each])
    begin = np.cumsum(size + 1) - size - 1
    text = np.zeros(int((size + 1).sum()), np.int64)
    inside = ranges(begin, size)
    text[inside] = np.unique(np.concatenate(each), return_inverse=True)[1] + 1
    docs = shard["first_doc"].to_numpy()
    ids, rank = np.unique(docs, return_inverse=True)
    index = FMIndex(text, np.repeat(rank, size + 1).astype(np.int32))
    left = shard["left"].to_numpy()
    # windows of a context that hold its anchor, by their start in the context
    lo = np.maximum(0, left + GRAM - WINDOW)
    hi = np.minimum(left, size - WINDOW)
    smallest = shard.groupby("anchor")["first_doc"].transform("min").to_numpy()
    live = np.flatnonzero((smallest < docs) & (lo <= hi))
    mask = np.zeros(len(shard), np.int64)

    def stands(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return index.reach(text, begin[rows] + a, begin[rows] + b, rank[rows]) - begin[rows]

    def mark(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        mask[rows] |= ((np.int64(1) << (b - a + 1)) - 1) << (a + PLACES - 1 - left[rows])

    last, stride = hi.copy(), np.full(len(shard), PLACES)
    while len(live):
        stop = stands(live, lo[live], last[live] + WINDOW)
        holds = stop < lo[live]
        rows = live[holds]
        mark(rows, lo[rows], last[rows])
        lo[rows] = last[rows] + 1
        last[rows] = np.minimum(hi[rows], lo[rows] + stride[rows])
        stride[rows] = np.maximum(1, 4 * stride[rows])
        rows, stop = live[~holds], stop[~holds]
        one = last[rows] == lo[rows]  # a window that fails: so do all that hold the place and end behind it
        lo[rows[one]] = stop[one] + 1
        last[rows[one]], stride[rows[one]] = lo[rows[one]], PLACES
        rows, stop = rows[~one], stop[~one]
        tail = (stop < last[rows]) & (last[rows] == hi[rows])  # windows behind the place stand
        mark(rows[tail], stop[tail] + 1, hi[rows[tail]])
        hi[rows[tail]] = stop[tail]
        before = stop - WINDOW >= lo[rows]  # next, what ends at the place; else the first window by itself
        last[rows] = np.where(before, stop - WINDOW, lo[rows])
        stride[rows] = np.where(before, 0, 1)
        live = live[lo[live] <= hi[live]]
    some = mask != 0
    return pd.DataFrame({"context": shard["context"].to_numpy()[some], "mask": mask[some]})


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of each context: its hash, and its bit."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("words"))
        first = offsets // 8
        left = batch.column("left").to_numpy().astype(np.int64)
        lo = np.maximum(0, left + GRAM - WINDOW)
        count = np.maximum(0, np.minimum(left, np.diff(first) - WINDOW) + 1 - lo)
        keys = gram_hashes(np.frombuffer(data.tobytes(), np.uint64), WINDOW)
        row = np.repeat(np.arange(len(left)), count)
        start = ranges(lo, count)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(row)) for c in ("context", "first_doc")]
            + [pa.array((keys[first[row] + start] >> np.uint64(1)).astype(np.int64)), pa.array((start + PLACES - 1 - left[row]).astype(np.int32))],
            names=["context", "first_doc", "window", "bit"],
        )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_buffer(part.column("text"))
            words = Words(data, offsets)
            cover = np.zeros(len(words.starts) + 1, np.int32)
            hits = part.column("hits").to_pylist()
            if any(hits):
                found = Anchors(words)
                ends = np.searchsorted(found.owner, np.arange(part.num_rows + 1))
                for i, own in enumerate(hits):
                    if not own:
                        continue
                    lo, hi = ends[i], ends[i + 1]
                    keys = np.array([h["context"] for h in own], np.int64)
                    order = np.argsort(keys)
                    keys, masks = keys[order], np.array([h["mask"] for h in own], np.int64)[order]
                    at = np.minimum(np.searchsorted(keys, found.context[lo:hi]), len(keys) - 1)
                    fits = keys[at] == found.context[lo:hi]
                    place, bits = found.place[lo:hi][fits], masks[at[fits]]
                    a, b = words.first[i], words.first[i + 1]
                    for bit in range(PLACES):
                        start = place[(bits >> bit) & 1 == 1] - (PLACES - 1) + bit
                        start = start[(start >= a) & (start + WINDOW <= b)]
                        np.add.at(cover, start, 1)
                        np.add.at(cover, start + WINDOW, -1)
            gone = np.cumsum(cover[:-1]) > 0
            raw, first = data.tobytes(), words.first.tolist()
            removed, digests = [], []
            for i, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                own, out = raw[x:y].split(), gone[first[i] : first[i + 1]]
                removed.append(int(out.sum()))
                if removed[-1]:
                    own = [w for w, g in zip(own, out.tolist(), strict=True) if not g]
                digests.append(hashlib.sha256(b" ".join(own)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, context, mask) of every context with windows that repeat an earlier document."""
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    anchors = cut_lineage(texts.mapInArrow(_anchors, "doc_id long, context long, anchor long"))
    known = anchors.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
    known = cut_lineage(known.where("x < y").select("anchor"))
    common = cut_lineage(anchors.join(known, "anchor", "left_semi"))
    once = cut_lineage(
        common.groupBy("context", "anchor").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    )
    several = once.groupBy("anchor").agg(F.count("*").alias("contexts"), F.min("first_doc").alias("x"), F.max("first_doc").alias("y"))
    several = cut_lineage(several.where("x < y"))
    open_ = cut_lineage(once.join(several.select("anchor", "contexts"), "anchor").select("context", "anchor", "first_doc", "contexts"))

    asked = open_.groupBy(F.col("first_doc").alias("of")).agg(F.collect_list("context").alias("wanted"))
    told = texts.join(asked, F.col("doc_id") == F.col("of")).select("text", "wanted")
    told = told.mapInArrow(_contexts, "context long, left int, words binary").dropDuplicates(["context"])
    told = cut_lineage(told.join(open_.withColumnRenamed("context", "c"), F.col("context") == F.col("c")).drop("c"))

    shards = max(1, -(-told.where(F.col("contexts") <= ANCHOR_CONTEXTS).count() // SHARD_CONTEXTS))
    few = told.where(F.col("contexts") <= ANCHOR_CONTEXTS).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = few.groupBy("shard").applyInPandas(repeats_in_shard, "context long, mask long")

    many = told.where(F.col("contexts") > ANCHOR_CONTEXTS).select("context", "first_doc", "left", "words")
    windows = cut_lineage(many.mapInArrow(_windows, "context long, first_doc long, window long, bit int"))
    # a table of its own, so that the join deals both sides itself and adaptive execution may split a hot window
    least = cut_lineage(windows.groupBy(F.col("window").alias("w")).agg(F.min("first_doc").alias("earliest")))
    late = windows.join(least, F.col("window") == F.col("w")).where("earliest < first_doc")
    found = found.union(late.groupBy("context").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")))
    found = cut_lineage(found.withColumnRenamed("context", "c"))

    merged = once.join(found, F.col("context") == F.col("c"), "left").where("mask is not null or first_doc < last_doc")
    merged = cut_lineage(merged.select(F.col("context").alias("c"), "first_doc", F.coalesce("mask", F.lit(0)).alias("mask")))
    own = F.when(F.col("doc_id") > F.col("first_doc"), F.lit(_ALL)).otherwise(F.col("mask"))
    return common.join(merged, F.col("context") == F.col("c")).select("doc_id", "context", own.alias("mask")).where("mask <> 0")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    hits = repeats(docs).groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("context", "mask")).alias("hits"))
    joined = docs.select("doc_id", "text").join(cut_lineage(hits), F.col("doc_id") == F.col("of"), "left")
    return joined.select("doc_id", "text", "hits").mapInArrow(_removed, "doc_id long, n_words long, n_removed long, kept_sha256 string")
