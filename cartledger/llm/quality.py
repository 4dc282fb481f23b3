"""Quality rules: limits that adapt to each language and source, from mergeable quantile sketches.

Whole texts are measured once. Each measure of a (language, source) group is summed up in a
log-linear histogram: integer values keyed by their five leading bits, so a quantile is off by at
most one sixteenth. Sketches of this kind merge by adding counts, in any order and exactly, and so
a group of few rows takes the merged sketch of its language, or else that of all rows. A document is
rejected if a measure lies far outside the quartiles of its group.

Nulls: a null text has no words; a null language or source is a group like any other. Repeated rows
count and return each. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartledger.session import cut_lineage

from .texts import Words, gram_hashes, slices, text_buffer, text_key

#: Smallest number of documents for which a sketch sets limits of its own.
OWN_SKETCH_ROWS = 100
#: Interquartile ranges that a value may lie beyond its quartile.
RANGES = 3
#: Room beyond that range, by measure: what is harmless in any group.
SLACK = {"symbol_rate": 150, "dup_line_rate": 500, "repeat_rate": 400, "word_length": 250}
#: Fixed base rule: fewest words, and largest percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
REPEAT_WINDOW = 3

OWN = ("doc_id", "lang", "source", "body", "body2")
MEASURED = (
    "doc_id long, lang string, source string, body long, body2 int, n_words long, word_chars long, n_symbols long,"
    " n_lines long, n_dup_lines long, n_repeat_words long"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets])


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _repeated(words: Words) -> np.ndarray:
    """By text: words in windows that occur twice or more in it."""
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    keys = gram_hashes(words.hashes, REPEAT_WINDOW)
    covered = np.zeros(len(owner), bool)
    if len(keys):
        at = np.flatnonzero(owner[: len(keys)] == owner[REPEAT_WINDOW - 1 :])
        keys, place = keys[at], owner[at]
        order = np.lexsort((keys, place))
        same = (keys[order][1:] == keys[order][:-1]) & (place[order][1:] == place[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hits = at[order[twice]]
        for j in range(REPEAT_WINDOW):
            covered[hits + j] = True
    return np.add.reduceat(np.append(covered, False), words.first[:-1]) * (words.counts > 0) if len(words.counts) else words.counts


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_buffer(part.column("text"))
            words = Words(data, offsets)
            inside = np.zeros(len(data) + 1, np.int8)
            inside[words.starts] += 1
            inside[words.ends] -= 1
            in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
            raw = data.tobytes()
            lines = np.array(
                [_lines(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)],
                np.int64,
            ).reshape(-1, 2)
            columns = [
                words.counts.astype(np.int64),
                _sums(in_word & ((data & 0xC0) != 0x80), offsets),
                _sums(_SYMBOL[data], offsets),
                lines[:, 0],
                lines[:, 1],
                _repeated(words).astype(np.int64),
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in OWN] + [pa.array(c) for c in columns],
                names=[*OWN, "n_words", "word_chars", "n_symbols", "n_lines",
                       "n_dup_lines", "n_repeat_words"],
            )


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text: words, their characters, symbols, repeated lines and words."""
    return docs.select("doc_id", "lang", "source", *text_key(), "text").mapInArrow(_measure, MEASURED)


def rates() -> dict[str, Column]:
    """The measures that limits adapt to, as whole numbers."""
    n, lines = F.col("n_words"), F.col("n_lines")
    per = lambda value, of, times: F.when(of > 0, F.floor(value * times / of)).otherwise(0).cast("long")
    return {
        "symbol_rate": per(F.col("n_symbols"), n, 1000),
        "dup_line_rate": per(F.col("n_dup_lines"), lines, 1000),
        "repeat_rate": per(F.col("n_repeat_words"), n, 1000),
        "word_length": per(F.col("word_chars"), n, 100),
    }


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): one histogram for each group and measure."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in rates().items()
    ]))
    shift = "greatest(0, length(bin(pair.value)) - 5)"
    return (
        measured.where(F.col("n_words") > 0)
        .select("lang", "source", pairs.alias("pair"))
        .select(
            "lang", "source", "pair.measure",
            F.expr(f"shiftleft(shiftright(pair.value, {shift}), {shift})").alias("bin"),
        )
        .groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))
    )


def _quartiles(bins: DataFrame, prefix: str, *by: str) -> DataFrame:
    """Rows, first and third quartile of each sketch; a sketch holds a few hundred bins at most."""
    merged = bins.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    steps = F.array_sort(F.collect_list(F.struct("bin", "n")))
    total = F.sum("n")
    point = lambda q: F.expr(
        f"aggregate(steps, named_struct('seen', 0L, 'at', 0L), (s, x) -> named_struct("
        f"'seen', s.seen + x.n, 'at', if(100 * s.seen < {q} * rows, x.bin, s.at))).at"
    )
    return (
        merged.groupBy(*by, "measure").agg(steps.alias("steps"), total.alias("rows"))
        .select(*by, "measure", F.struct("rows", point(25).alias("q1"), point(75).alias("q3")).alias(prefix))
    )


def limits(bins: DataFrame) -> DataFrame:
    """(lang, source) with ``<measure>_low`` and ``<measure>_high``, all inclusive."""
    own = _quartiles(bins, "own", "lang", "source")
    lang = _quartiles(bins, "by_lang", "lang").withColumnRenamed("lang", "of_lang").withColumnRenamed("measure", "m1")
    every = _quartiles(bins, "every").withColumnRenamed("measure", "m2")
    best = (
        own.join(lang, F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("measure") == F.col("m1")))
        .join(every, F.col("measure") == F.col("m2"))
        .select("lang", "source", "measure",
                F.when(F.col("own.rows") >= OWN_SKETCH_ROWS, F.col("own"))
                .when(F.col("by_lang.rows") >= OWN_SKETCH_ROWS, F.col("by_lang"))
                .otherwise(F.col("every")).alias("q"))
    )
    room = F.element_at(F.create_map(*[F.lit(x) for pair in SLACK.items() for x in pair]), F.col("measure"))
    reach = RANGES * (F.col("q.q3") - F.col("q.q1")) + room
    return best.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == name, edge)).alias(f"{name}_{side}")
        for name in SLACK
        for side, edge in (("low", F.col("q.q1") - reach), ("high", F.col("q.q3") + reach))
    ])


def quality_rules(docs: DataFrame) -> DataFrame:
    """Every document with its counts, ``base_failed`` and ``kept``."""
    return judged(docs).drop("lang", "source", "body", "body2")


def judged(docs: DataFrame) -> DataFrame:
    """As ``quality_rules``, with all that the decision on a row depends on: lang, source and the key of its text."""
    measured = cut_lineage(measure(docs))
    found = cut_lineage(limits(sketch(measured))).withColumnsRenamed({"lang": "l", "source": "s"})
    fine = F.lit(True)
    for name, value in rates().items():
        fine = fine & value.between(F.col(f"{name}_low"), F.col(f"{name}_high"))
    return measured.join(
        found, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left"
    ).select(
        *OWN, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(fine, F.lit(True))).alias("kept"),
    )
