"""Language identification with string kernels: Nystrom landmarks and kernel ridge regression.

A text is cut into pieces of PIECE_BYTES, all of them. The kernel of two pieces is the blended-spectrum
presence kernel: the number of byte n-grams, n from 1 to 4, that both have, divided by the geometric
mean of their own numbers. N-grams are hashed into SPECTRUM slots. LANDMARKS pieces of the training
sample, the same number for each language, span the kernel: with K_mm between landmarks and K_nm to
the sample, one ridge regression for each language (one against the rest) solves
(K_nm' K_nm + r K_mm) a = K_nm' y. A batch is scored by two matrix products: pieces times landmarks,
then times the coefficients. A text's score in a language is the mean over its pieces, by length.

Learned from at most SAMPLE_ROWS texts a language (those with the least hashes; the first pieces of
each in a fixed random order) whose crc32(doc_id as text) mod 3 is not 1 and whose lang is not null. A text that
is null or has no letter is ``und`` with score 0. Without training rows all texts are ``und``.
Repeated rows are scored alike; empty tables give empty results. Columns other than doc_id and text
are not read in scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .texts import lowered, mix, slices, text_buffer
from .toxicity import held_out

#: Bounds of the training sample: texts of a language, and pieces of a text.
SAMPLE_ROWS, SAMPLE_PIECES = 600, 2
LANDMARKS = 48
SPECTRUM = 1 << 12
LENGTHS = (1, 2, 3, 4)
PIECE_BYTES = 1024
RIDGE = 0.1
UNKNOWN = "und"
#: How sharply the best language's lead shows in the score.
SHARPNESS = 8.0

_FACTORS = np.random.default_rng(9).integers(1, 1 << 31, len(LENGTHS), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end of the pieces of each text."""
    sizes = np.diff(offsets)
    counts = -(-sizes // PIECE_BYTES)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + nth * PIECE_BYTES
    return owner, starts, np.minimum(starts + PIECE_BYTES, offsets[owner + 1])


def presence(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """0/1 matrix of pieces by hashed n-grams; blanks and digits count as one kind of byte."""
    out = np.zeros((len(starts), SPECTRUM), np.float32)
    if not len(starts):
        return out
    lo, hi = int(starts[0]), int(ends[-1])
    plain = lowered(data[lo:hi]).copy()
    plain[(plain < 97) | ((plain > 122) & (plain < 128))] = 32
    code = plain.astype(np.uint32)
    piece = np.repeat(np.arange(len(starts)), ends - starts)
    gram = np.zeros(len(code), np.uint32)
    for n in LENGTHS:
        m = len(code) - n + 1
        if m <= 0:
            break
        gram = gram[:m] * np.uint32(257) + code[n - 1 :]
        slot = (gram * _FACTORS[n - 1] + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) >> np.uint32(20)
        inside = piece[:m] == piece[n - 1 :]
        out[piece[:m][inside], slot[inside]] = 1
    return out


def normed(spectrum: np.ndarray) -> np.ndarray:
    """Rows scaled so that a product of two is their kernel."""
    return spectrum / np.sqrt(np.maximum(spectrum.sum(axis=1, keepdims=True), 1))


class Classifier:
    def __init__(self, names: list[str], landmarks: np.ndarray, coefficients: np.ndarray):
        self.names, self.landmarks, self.coefficients = names, landmarks, coefficients

    def scores(self, spectrum: np.ndarray) -> np.ndarray:
        return (normed(spectrum) @ self.landmarks.T) @ self.coefficients

    def predict(self, data: np.ndarray, offsets: np.ndarray, batch: int = 512) -> tuple[list[str], np.ndarray]:
        owner, starts, ends = pieces(data, offsets)
        total = np.zeros((len(offsets) - 1, len(self.names)))
        for lo in range(0, len(owner), batch):
            s = slice(lo, lo + batch)
            weight = (ends[s] - starts[s])[:, None]
            np.add.at(total, owner[s], self.scores(presence(data, starts[s], ends[s])) * weight)
        mean = total / np.maximum(np.diff(offsets), 1)[:, None]
        best = mean.argmax(axis=1)
        odds = np.exp(SHARPNESS * (mean - mean.max(axis=1, keepdims=True)))
        return [self.names[i] for i in best.tolist()], 1 / odds.sum(axis=1)


def _sample_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_buffer(part.column("text"))
            owner, starts, ends = pieces(data, offsets)
            turn = mix(np.arange(len(owner), dtype=np.uint64) - np.searchsorted(owner, owner).astype(np.uint64))
            order = np.lexsort((turn, owner))
            nth = np.empty(len(owner), np.int64)
            nth[order] = np.arange(len(owner)) - np.searchsorted(owner[order], owner[order])
            at = np.flatnonzero(nth < SAMPLE_PIECES)
            langs = part.column("lang").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in owner[at]], pa.string()), pa.array([data[starts[i] : ends[i]].tobytes() for i in at], pa.binary())],
                names=["lang", "piece"],
            )


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier | None:
    known = docs.where("lang is not null and doc_id is not null and text is not null").where(~held_out())
    # the first ids of each language by hash; a window limit keeps no more of a language on the map side either
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(4)), "doc_id")
    ids = known.select("lang", "doc_id").distinct().withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= sample_rows)
    ids = ids.select(F.col("doc_id").alias("id")).distinct()
    rows = known.select("doc_id", "lang", "text").join(ids, F.col("doc_id") == F.col("id"))
    # one text of each sampled id, so that sample_rows bounds what reaches the driver
    one = F.min_by(F.struct("lang", "text"), F.struct(F.xxhash64("lang", "text"), F.length("text"))).alias("one")
    rows = rows.groupBy("id").agg(one).select("one.lang", "one.text")
    rows = rows.select("lang", "text").mapInArrow(_sample_pieces, "lang string, piece binary")
    rows = sorted({(r["lang"], bytes(r["piece"])) for r in rows.toLocalIterator()})
    names = sorted({lang for lang, _ in rows})
    if not rows:
        return None
    ends = np.cumsum([len(p) for _, p in rows])
    x = normed(presence(np.frombuffer(b"".join(p for _, p in rows), np.uint8), ends - [len(p) for _, p in rows], ends))
    label = np.array([names.index(lang) for lang, _ in rows])
    rng = np.random.default_rng(3)
    chosen = np.concatenate([rng.permutation(np.flatnonzero(label == k))[:LANDMARKS] for k in range(len(names))])
    marks = x[chosen]
    near, own = (x @ marks.T).astype(float), (marks @ marks.T).astype(float)
    weight = (len(label) / (len(names) * np.bincount(label)))[label]
    y = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    left = (near * weight[:, None]).T @ near + RIDGE * own + 1e-6 * np.eye(len(chosen))
    return Classifier(names, marks, np.linalg.solve(left, (near * weight[:, None]).T @ y).astype(np.float32))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                if shared.value is not None:
                    names, scores = shared.value.predict(*text_buffer(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("speaks"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "speaks", "name", "score"],
                )

    speaks = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("speaks")
    scored = docs.select("doc_id", speaks, "text").mapInArrow(score, "doc_id long, speaks boolean, name string, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"),
        F.when(F.col("speaks"), F.col("name")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("speaks"), F.col("score")).otherwise(0.0).alias("score"),
    )
