"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct words (A-Z lower-cased, outer punctuation stripped) and their
beginnings of five characters, each hashed into 2^20 slots. The score is

    sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>)

over the slots present, so that a pair of terms, such as an insult and a group, weighs more than its
parts. Training uses a documented sample: per label at most SAMPLE_ROWS labelled training rows, those
with the least hashes. From these, the slots that differ most between the labels are kept; all others
are zero in the model. The model is a few hundred KB at any size of the corpus.

A row is for training if crc32(doc_id as text) mod 3 is not 1. Nulls and empty texts score the
model's intercept; rows with a null doc_id or null label are never learned from. Repeated rows score
alike. Without labelled rows of both kinds every score is the share of label 1, or 0. Columns other
than doc_id and text are not read, and labels only in training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import Words, lowered, mix, slices, text_buffer

#: Bound of the training sample, by label.
SAMPLE_ROWS = 3000
SLOTS = 1 << 20
#: Slots that the model keeps, and documents of the sample that must have one.
KEPT_SLOTS, LEAST_DOCS = 4096, 4
FACTORS = 8
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.05, 1e-4
THRESHOLD = 0.7
BEGINNING = 5

_EDGE = np.ones(256, bool)
_EDGE[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = False


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def text_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, slot) pairs, sorted: the terms of each whole text."""
    data = lowered(data)
    # blank out what stands at the edges of words, by making every edge byte a blank
    plain = data.copy()
    plain[_EDGE[data]] = 32
    words = Words(plain, offsets)
    whole = words.hashes
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    # the first BEGINNING characters: cut each longer word at its next character start
    starts_char = (plain & 0xC0) != 0x80
    seen = np.concatenate([[0], np.cumsum(starts_char)])
    length = seen[words.ends] - seen[words.starts]
    long = length > BEGINNING
    places = np.flatnonzero(starts_char)
    cut = places[seen[words.starts[long]] + BEGINNING] if long.any() else np.zeros(0, np.int64)
    short = Words.__new__(Words)
    short.data, short.offsets, short.starts, short.ends = plain, offsets, words.starts[long], cut
    heads = mix(short.hashes + np.uint64(1))
    keys = np.concatenate([whole, heads]) & np.uint64(SLOTS - 1)
    pairs = np.concatenate([owner, owner[long]]).astype(np.uint64) << np.uint64(20) | keys
    pairs = np.unique(pairs)
    return (pairs >> np.uint64(20)).astype(np.int64), (pairs & np.uint64(SLOTS - 1)).astype(np.int64)


def _sum_by(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    if values.ndim == 1:
        return np.bincount(owner, values, n)
    return np.stack([np.bincount(owner, values[:, k], n) for k in range(values.shape[1])], axis=1)


class Machine:
    """Intercept, linear weights and factors of the kept slots; ``at`` maps a slot to its place or -1."""

    def __init__(self, slots: np.ndarray, seed: int = 5):
        self.at = np.full(SLOTS, -1, np.int32)
        self.at[slots] = np.arange(len(slots))
        self.w0, self.w = 0.0, np.zeros(len(slots))
        self.v = np.random.default_rng(seed).normal(0, 0.02, (len(slots), FACTORS))

    def margin(self, owner: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        v = self.v[place]
        total = _sum_by(owner, v, n)
        pairs = 0.5 * (total**2 - _sum_by(owner, v**2, n)).sum(axis=1)
        return self.w0 + np.bincount(owner, self.w[place], n) + pairs, total

    def fit(self, owner: np.ndarray, place: np.ndarray, label: np.ndarray) -> None:
        """Adaptive-step gradient descent on the logistic loss, labels weighing the same in all."""
        n = len(label)
        weight = np.where(label == 1, n / (2 * max(1, label.sum())), n / (2 * max(1, n - label.sum())))
        first = np.searchsorted(owner, np.arange(n + 1))
        g0, gw, gv = 1e-8, np.full(self.w.shape, 1e-8), np.full(self.v.shape, 1e-8)
        rng = np.random.default_rng(11)
        for _ in range(EPOCHS):
            order = rng.permutation(n)
            for lo in range(0, n, BATCH):
                rows = order[lo : lo + BATCH]
                counts = first[rows + 1] - first[rows]
                begin = np.cumsum(counts) - counts
                at = place[np.repeat(first[rows] - begin, counts) + np.arange(counts.sum())]
                own = np.repeat(np.arange(len(rows)), counts)
                margin, total = self.margin(own, at, len(rows))
                slope = weight[rows] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[rows]) / len(rows)
                used, back = np.unique(at, return_inverse=True)
                d = slope[own]
                dw = np.bincount(back, d, len(used)) + DECAY * self.w[used]
                dv = _sum_by(back, d[:, None] * (total[own] - self.v[at]), len(used)) + DECAY * self.v[used]
                d0 = slope.sum()
                g0 += d0**2
                gw[used] += dw**2
                gv[used] += dv**2
                self.w0 -= RATE * d0 / np.sqrt(g0)
                self.w[used] -= RATE * dw / np.sqrt(gw[used])
                self.v[used] -= RATE * dv / np.sqrt(gv[used])

    def score(self, owner: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        place = self.at[slot]
        has = place >= 0
        margin, _ = self.margin(owner[has], place[has], n)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def telling_slots(owner: np.ndarray, slot: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Slots whose presence differs most between the labels, by the size of their z statistic."""
    n1 = max(1, int(label.sum()))
    n0 = max(1, len(label) - n1)
    one = np.bincount(slot, label[owner], SLOTS)
    every = np.bincount(slot, minlength=SLOTS)
    p = every / (n0 + n1)
    z = (one / n1 - (every - one) / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n0 + 1 / n1))
    z = np.where(every >= LEAST_DOCS, np.abs(z), 0)
    best = np.argsort(-z, kind="stable")[:KEPT_SLOTS]
    return np.sort(best[z[best] >= 3])


def _slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            owner, slot = text_slots(*text_buffer(part.column("text")))
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            rows = [slot[a:b].astype(np.int32).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(rows, pa.binary())], names=["label", "slots"])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Machine | None, float]:
    """The machine, and what to answer without one."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.where(~held_out())
    picked = None
    for value in (0, 1):  # two bounded lists of ids
        few = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(sample_rows)
        picked = few if picked is None else picked.union(few)
    sample = docs.select(F.col("doc_id").alias("id"), "text").join(picked, F.col("id") == F.col("doc_id"))
    # one text of each sampled id, so that sample_rows bounds what reaches the driver
    text = F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")
    sample = sample.groupBy("id").agg(text, F.max("label").cast("long").alias("label"))
    rows = sample.select("text", "label").mapInArrow(_slots_of, "label long, slots binary")
    rows = sorted((r["label"], bytes(r["slots"])) for r in rows.toLocalIterator())
    label = np.array([r[0] for r in rows], np.int64)
    if len(set(label.tolist())) < 2:
        return None, float(label.mean()) if len(label) else 0.0
    each = [np.frombuffer(r[1], np.int32) for r in rows]
    owner = np.repeat(np.arange(len(each)), [len(x) for x in each])
    slot = np.concatenate(each).astype(np.int64)
    machine = Machine(telling_slots(owner, slot, label))
    place = machine.at[slot]
    machine.fit(owner[place >= 0], place[place >= 0].astype(np.int64), label)
    return machine, 0.5


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    machine, otherwise = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                if shared.value is None:
                    scores = np.full(part.num_rows, otherwise)
                else:
                    scores = shared.value.score(*text_slots(*text_buffer(part.column("text"))), part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
