"""Texts beyond one slice of array work, and what label propagation saves."""

import hashlib

import numpy as np
import pytest

from cartledger.llm import decontamination, exact_dedup, language, near_dedup, quality, sharding, substring_dedup
from cartledger.llm.texts import SLICE_BYTES

from test_operators import brute_groups, brute_removed, collected, prose, words

LONG = prose(300_000, 1)
CHANGED = " ".join("new" if i % 90_000 == 7 else w for i, w in enumerate(LONG.split()))
TABLE = [(1, LONG), (2, CHANGED), (3, prose(80, 2)), (4, LONG[: len(LONG) // 2].lower()), (5, None), (6, "x" * (2 * SLICE_BYTES))]


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG) > SLICE_BYTES
    return spark.createDataFrame([(i, t, "en", "s") for i, t in TABLE], "doc_id long, text string, lang string, source string")


def test_counts(docs):
    assert {r.doc_id: r.n_words for r in quality.quality_rules(docs).collect()} == {i: len(words(t)) for i, t in TABLE}


def test_near_duplicates(docs):
    assert collected(near_dedup.near_duplicates(docs)) == sorted(brute_groups(TABLE), key=repr)


def test_substrings(docs):
    assert collected(substring_dedup.substring_dedup(docs)) == brute_removed(TABLE, 50)


def test_benchmark_passage_deep_in_a_text(spark, docs):
    passage = "planted passage of more than ten words that stands far behind everything else here"
    late = docs.selectExpr("doc_id", f"text || ' {passage} end' AS text")
    items = spark.createDataFrame([(1, passage), (2, "words that never stand in any of the texts of this table at all")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontamination.decontaminated(late, items).collect()}
    assert got == {i: (14, 1, True) if t is not None else (0, 0, False) for i, t in TABLE}


def test_exact_copies_and_languages(docs):
    got = exact_dedup.exact_duplicates(docs)
    assert {r.doc_id: r.text_sha256 for r in got.collect()} == {
        i: hashlib.sha256("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode()).hexdigest() for i, t in TABLE
    }
    assert language.languages(docs).count() == len(TABLE)


def test_propagation_cuts_fewer_links(spark):
    """Cut links of groups of four against a start without moves, where nearly all are cut."""
    df = spark.createDataFrame([(i, f"text {i // 4 if i < 480 else i}") for i in range(960)], "doc_id long, text string")

    def cut(rounds):
        shards = sharding.sharded(df, rounds=rounds).toPandas().groupby("text_crc32")["shard"]
        return int(np.sum(shards.apply(lambda s: (s != s.iloc[0]).sum())))

    assert cut(0) > 300 and cut(sharding.ROUNDS) < 0.25 * cut(0)
