"""Phrase collocations by set-oriented mining: occurrence relations, grown by one word at a time.

Texts are cut into pieces at punctuation and line ends, and pieces into words; everything is counted by language.

1. The occurrence relation of single words is persisted in blocks of whole texts, sorted by piece and position: the words
   of a block as numbers of its own vocabulary in reading order, with a gap between pieces.
2. Groups (distinct phrases) are counted in each block and then over all blocks. As a block holds a phrase once, the commonest
   word has no more rows than there are blocks.
3. Before the next length, each block's groups are semi-joined with the frequent ones, and occurrences of others leave its
   relation. What is left is merge-joined with itself by piece and adjacent position: both relations are sorted alike,
   so the join is a comparison of neighbours. Its result is the sorted relation of the next length.

A phrase's score is its count squared over the product of the counts of its two parts, at the cut where that is lowest.
Counts of first and last parts come along from the shorter phrases, since a phrase is joined from its first and last words.

Nulls: a null text is empty; a null language is ``und``. Empty texts and pieces have no words. Very long texts: a text is
held whole by one task, in a block of its own if it passes BLOCK_BYTES. Ties: equal scores go by count, then by the phrase's bytes;
equal cuts to the shorter first part. Repeated rows count each. Empty tables give empty results. Columns other than lang
and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartledger.session import cut_lineage, release

from .texts import Words, lowered, slices, text_buffer

#: Fewest occurrences of a phrase, most words of it, and phrases reported by language.
MIN_COUNT, LONGEST, REPORTED = 10, 3, 2000
#: A phrase inside a longer one that has this percentage of its count or more is dropped.
INSIDE_PERCENT = 50
SCALE = 1_000_000
#: Bytes of text that a block holds, about: its vocabulary and numbers are in memory at once.
BLOCK_BYTES = 12 << 20

_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = _ENDS_PIECE.copy()
_BLANK[list(b" \t")] = True

OCCURRENCES = "block long, lang array<string>, word array<string>, n array<long>, codes binary"
GROUPS = "block long, local int, first long, last long, n long, codes binary"


def _packed(codes: np.ndarray) -> bytes:
    return zstandard.compress(codes.astype(np.int32).tobytes(), 1)


def _unpacked(codes: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(codes), np.int32)


def _block(block: int, parts: list[tuple[pa.Array, np.ndarray, np.ndarray]], langs: list[str]) -> pa.RecordBatch:
    """One row: the vocabulary of the block with counts, and its words in order, -1 before each piece."""
    coded = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    lang, opens = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    key = coded.indices.to_numpy().astype(np.int64) * len(langs) + lang
    groups, local, n = np.unique(key, return_inverse=True, return_counts=True)
    codes = np.full(len(key) + int(opens.sum()), -1, np.int32)
    codes[np.arange(len(key)) + np.cumsum(opens)] = local
    columns = [
        pa.array(langs, pa.string()).take(pa.array(groups % len(langs))),
        coded.dictionary.cast(pa.large_string()).take(pa.array(groups // len(langs))).cast(pa.string()),
        pa.array(n),
    ]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(groups)], pa.int32()), c) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array([block]), *lists, pa.array([_packed(codes)], pa.binary())], names=["block", "lang", "word", "n", "codes"])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, parts, held, langs = TaskContext.get().partitionId() << 33, [], 0, {}
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_buffer(part.column("text"))
            data = lowered(data)
            words = Words(data, offsets, _BLANK[data])
            if len(words.starts):
                ended = np.concatenate([[0], np.cumsum(_ENDS_PIECE[data])])
                opens = np.ones(len(words.starts), bool)
                opens[1:] = ended[words.starts[1:]] != ended[words.ends[:-1]]
                opens[words.first[:-1][words.counts > 0]] = True
                own = np.array([langs.setdefault("und" if x is None else x, len(langs)) for x in part.column("lang").to_pylist()])
                parts.append((words.array(), np.repeat(own, words.counts), opens))
                held += len(data)
            if held >= BLOCK_BYTES:
                yield _block(block, parts, list(langs))
                block, parts, held, langs = block + 1, [], 0, {}
    if parts:
        yield _block(block, parts, list(langs))


def _extended(keep: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Merge-join of a block's relation with itself by adjacent position, after its semi-join with the frequent groups; with
    ``keep`` the joined relation comes along in a row of its own."""

    def extend(relation: pa.Table, frequent: pa.Table) -> pa.Table:
        names = ["block", "local", "first", "last", "n", "codes"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        if not relation.num_rows or not frequent.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        codes = _unpacked(relation.column("codes")[0].as_py())
        number = np.full(int(codes.max(initial=0)) + 2, -1, np.int64)  # the last entry is that of code -1
        number[frequent.column("local").to_numpy()] = frequent.column("gid").to_numpy()
        gid = number[codes]
        at = np.flatnonzero((gid[:-1] >= 0) & (gid[1:] >= 0))
        key = codes[at].astype(np.int64) * len(number) + codes[at + 1]
        _, one, local, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        block, size = relation.column("block")[0].as_py(), len(one)
        columns = [np.full(size, block), np.arange(size, dtype=np.int32), gid[at[one]], gid[at[one] + 1], n]
        columns = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)] + [pa.nulls(size, pa.binary())]
        out = pa.table(columns, names=names)
        if keep:
            grown = np.full(len(codes), -1, np.int32)
            grown[at] = local
            row = [[block], [None], [None], [None], [None], [_packed(grown)]]
            out = pa.concat_tables([out, pa.table([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names=names)])
        return out

    return extend


def _frequent(groups: DataFrame, by: list[str], min_count: int) -> DataFrame:
    counted = groups.groupBy(*by).agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    return cut_lineage(counted.withColumn("gid", F.monotonically_increasing_id()))


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 1, 2, ... words, and (lang, total) of all word occurrences.

    Phrases: gid, lang, phrase, last_word, f, ``heads`` and ``tails`` (counts of its first, and last, 1, 2, ... words), and for
    two words or more ``first`` and ``last``, the gids of all words but the last, and but the first."""
    table = cut_lineage(docs.select("lang", "text").mapInArrow(_occurrences, OCCURRENCES), "zstd")
    groups = table.select("block", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("local", "g"))
    groups = groups.select("block", "local", "g.lang", "g.word", "g.n")
    totals = cut_lineage(groups.groupBy("lang").agg(F.sum("n").alias("total")))
    known = _frequent(groups, ["lang", "word"], min_count)
    passed = groups.join(known, ["lang", "word"]).select(F.col("block").alias("of"), "local", "gid")
    counts = F.array("f")
    phrases = [known.select("gid", "lang", F.col("word").alias("phrase"), F.col("word").alias("last_word"), "f",
                            counts.alias("heads"), counts.alias("tails"))]
    relation = table.select("block", "codes")
    for k in range(2, longest + 1):
        joined = relation.groupBy("block").cogroup(passed.groupBy("of")).applyInArrow(_extended(k < longest), GROUPS)
        joined = cut_lineage(joined, "zstd")
        release(table)
        table = joined
        groups = joined.where("codes is null").drop("codes")
        known = _frequent(groups, ["first", "last"], min_count)
        if k < longest:
            passed = groups.join(known, ["first", "last"]).select(F.col("block").alias("of"), "local", "gid")
            relation = joined.where("codes is not null").select("block", "codes")
        a = phrases[-1].select(F.col("gid").alias("first"), "lang", F.col("phrase").alias("head"), "heads")
        b = phrases[-1].select(F.col("gid").alias("last"), "last_word", "tails")
        grown = known.join(a, "first").join(b, "last").select(
            "gid", "lang", F.concat_ws(" ", "head", "last_word").alias("phrase"), "last_word", "f",
            F.array_append("heads", F.col("f")).alias("heads"), F.array_append("tails", F.col("f")).alias("tails"), "first", "last",
        )
        phrases.append(cut_lineage(grown))
    release(table)
    return phrases, totals


def _scored(phrases: DataFrame, words: int) -> DataFrame:
    """lang, phrase, a, l, r, score at the lowest cut. Whole-number arithmetic in 38 decimal digits; more raise an error."""
    wide = lambda x: x.cast("decimal(15,0)")
    cuts = []
    for k in range(1, words):
        head, tail = F.col("heads")[k - 1], F.col("tails")[words - k - 1]
        top, bottom = F.lit(SCALE).cast("decimal(7,0)") * (wide(F.col("f")) * wide(F.col("f"))), wide(head) * wide(tail)
        cuts.append(F.struct(F.call_function("div", top, bottom).alias("score"), F.lit(k).alias("k"), head.alias("l"), tail.alias("r")))
    return phrases.withColumn("cut", F.array_min(F.array(*cuts))).select(
        "gid", "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"
    )


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, reported: int = REPORTED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``longest`` words."""
    phrases, totals = frequent_phrases(docs, longest, min_count)
    found = None
    for words in range(2, longest + 1):
        scored = _scored(phrases[words - 1], words)
        if words < longest:
            # a longer phrase still that holds this one has no larger count than the next longer ones
            longer = phrases[words]
            inside = longer.select(F.col("first").alias("gid"), "f").union(longer.select(F.col("last").alias("gid"), "f"))
            inside = inside.groupBy("gid").agg(F.max("f").alias("most"))
            dropped = 100 * F.col("most") >= INSIDE_PERCENT * F.col("a")
            scored = scored.join(inside, "gid", "left").where(~F.coalesce(dropped, F.lit(False))).drop("most")
        found = scored if found is None else found.unionByName(scored)
    # first among a share of a language's phrases, then among the best of all shares: no task sorts a whole language
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.desc("score"), F.desc("a"), "phrase"
    ranked = found.withColumn("share", F.pmod(F.xxhash64("gid", "phrase"), F.lit(shares)))
    for by in (["lang", "share"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= reported)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
