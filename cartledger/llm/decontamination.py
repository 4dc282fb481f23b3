"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are runs of ASCII letters and digits and all non-ASCII characters, A-Z lower-cased. Of every
WINDOW consecutive words the least hash of GRAM words is a fingerprint, so a text and an item
that share WINDOW words share a fingerprint: no shared span of that length is missed. Items of fewer
words are one gram of their own length, for which texts make grams of that length too. Texts
that share a fingerprint with an item are candidates; their hits are then extended and confirmed by
whole windows, as a window is compared by 96 bits of hash.

Texts are told apart by their content, so equal texts are examined once, whatever their doc_id.
The fingerprints of the benchmark are a table; Spark broadcasts it if it measures it as small.

Nulls and texts without words have no hits; items without words, and null items, occur nowhere. Repeated
rows return each. An empty benchmark hits nothing. Columns other than doc_id, text and item_id are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartledger.session import cut_lineage

from .texts import text_key

WINDOW, GRAM = 10, 5
#: Fixed pattern of what stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(low, BETWEEN), lambda w: w != "")


def _rough_words(text: Column) -> Column:
    """As ``words`` for the search for candidates, with the empty words that may stand at the ends."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BETWEEN)


def _count(rough: Column) -> Column:
    n = F.size(rough)
    return n - (rough[0] == "").cast("int") - ((n > 1) & (F.element_at(rough, -1) == "")).cast("int")


def _next(values: Column, i: Column, n: int) -> list[Column]:
    return [F.get(values, i + j) for j in range(1, n)]


def fingerprints(rough: Column, lengths: list[int]) -> Column:
    """Distinct window minima of a text's grams, and its grams of each of ``lengths``."""

    def grams_of(hashes: Column, n: int) -> Column:
        return F.transform(hashes, lambda h, i: F.xxhash64(F.lit(n), h, *_next(hashes, i, n)))

    def of(hashes: Column) -> Column:
        grams = grams_of(hashes, GRAM)
        least = let(grams, lambda g: F.transform(g, lambda x, i: F.least(x, *_next(g, i, WINDOW - GRAM + 1))))
        whole = [grams_of(hashes, n) for n in lengths]
        return F.array_distinct(F.concat(least, *whole) if whole else least)

    return let(F.transform(rough, lambda w: F.xxhash64(w)), of)


def _whole(rough: Column, n: int) -> Column:
    hashes = F.transform(rough, lambda w: F.xxhash64(w))
    return F.array(let(hashes, lambda h: F.xxhash64(F.lit(n), h[0], *_next(h, F.lit(0), n))))


def _windows(own: Column, n: int) -> Column:
    """(place, size, key, check) of every run of n words."""
    one = lambda i: let(F.concat_ws(" ", F.slice(own, i + 1, n)), lambda s: F.struct(
        i.alias("place"), F.lit(n).alias("size"), F.xxhash64(F.lit(n), s).alias("key"), F.hash(s).alias("check")))
    some = F.transform(F.sequence(F.lit(0), F.greatest(F.size(own) - n, F.lit(0))), one)
    return F.when(F.size(own) >= n, some).otherwise(F.slice(some, 1, 0))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    return judged(docs, items).drop("body", "body2")


def judged(docs: DataFrame, items: DataFrame) -> DataFrame:
    """As ``decontaminated``, with the key of each row's text."""
    items = cut_lineage(items.select("item_id", words(F.col("text")).alias("own")).where(F.size("own") > 0))
    lengths = sorted(r[0] for r in items.where(F.size("own") < WINDOW).select(F.size("own")).distinct().collect())

    # of an item with a window: its window minima; of a shorter one: its gram
    prints = None
    for n, part in [(None, items.where(F.size("own") >= WINDOW)), *((n, items.where(F.size("own") == n)) for n in lengths)]:
        # a short item's first gram of its own length is all of it
        made = fingerprints(F.col("own"), []) if n is None else _whole(F.col("own"), n)
        part = part.select(F.explode(made).alias("print"))
        prints = part if prints is None else prints.union(part)
    prints = cut_lineage(prints.distinct())

    body = text_key()
    made = let(_rough_words(F.col("text")), lambda w: F.struct(_count(w).cast("long").alias("n_words"), fingerprints(w, lengths).alias("prints")))
    told = docs.select("doc_id", *body, made.alias("made"))
    told = cut_lineage(told.select("doc_id", "body", "body2", "made.n_words", "made.prints"))

    candidates = told.select("body", "body2", F.explode("prints").alias("print")).join(prints, "print", "left_semi")
    candidates = cut_lineage(candidates.select("body", "body2").distinct())
    texts = docs.select(*body, "text").join(candidates, ["body", "body2"], "left_semi").dropDuplicates(["body", "body2"])
    texts = texts.select("body", "body2", words(F.col("text")).alias("own"))
    every = lambda own, sizes: F.explode(F.concat(*[_windows(own, n) for n in sizes])).alias("w")
    asked = items.select("item_id", every(F.col("own"), [WINDOW]))
    for n in lengths:
        asked = asked.union(items.where(F.size("own") == n).select("item_id", every(F.col("own"), [n])))
    asked = cut_lineage(asked.select("item_id", "w.key", "w.check").distinct())
    found = texts.select("body", "body2", every(F.col("own"), [WINDOW, *lengths])).select("body", "body2", "w.*")
    found = found.join(asked, ["key", "check"])

    spans = F.array_sort(F.collect_set(F.struct("place", (F.col("place") + F.col("size")).alias("end"))))
    covered = F.expr(
        "aggregate(spans, named_struct('until', 0, 'n', 0L), (s, x) -> named_struct('until', greatest(s.until, x.end),"
        " 'n', s.n + greatest(0, x.end - greatest(s.until, x.place)))).n"
    )
    names = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    hits = found.groupBy("body", "body2").agg(spans.alias("spans"), names.alias("names"))
    hits = cut_lineage(hits.select(F.col("body").alias("b"), F.col("body2").alias("b2"), covered.alias("n_hit"), "names"))
    joined = told.select("doc_id", "body", "body2", "n_words").join(hits, (F.col("body") == F.col("b")) & (F.col("body2") == F.col("b2")), "left")
    names = F.coalesce(F.col("names"), F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "body", "body2", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
