import datetime
import random

import pytest
from pyspark.sql import functions as F

from cartledger import schemas
from cartledger.operators import review, state, terms

GOLD = "canonical_id bigint, canonical_name string, coarse_category string, source string, price double"
NOW = datetime.datetime(2026, 7, 30)


def test_candidates(spark):
    gold = spark.createDataFrame([
        (1, "Bananas", "produce", "a", 1.0), (1, "Bananas", "produce", "b", 2.0),
        (2, "Banana Pudding", "snack", "a", 1.0), (3, "Organic Banana", None, "a", 0.5),
        (4, "Pineapple", "produce", "a", 1.0), (5, "Apple Chips", "snack", "a", 1.0),
        (6, "Green Apples", "produce", "a", 1.0), (7, "Russet  Potatoes", "produce", "a", 1.0),
        (8, "Half & Half", "dairy", "a", 1.0)], GOLD)
    wanted = spark.createDataFrame([("banana", "produce"), ("apple", "produce"), ("russet potato", None),
                                    ("half & half", None), ("apple", None)], "keyword string, coarse string")
    found = terms.term_candidates(wanted, terms.gold_products(gold))
    got = {}
    for r in found.collect():
        got.setdefault((r.keyword, r.coarse), set()).add(r.canonical_id)
    assert got == {("banana", "produce"): {1, 3}, ("apple", "produce"): {6}, ("russet potato", None): {7},
                   ("half & half", None): {8}, ("apple", None): {5, 6}}
    top = terms.best_candidates(found, terms.TERM_FIELDS, 1).filter("keyword = 'banana'").first()
    assert top.canonical_id == 1
    cache = spark.createDataFrame([("banana", 1, "no_match", 0.9), ("banana", 3, "no_match", 0.5)],
                                  "term string, canonical_id bigint, verdict string, confidence double")
    left = terms.term_candidates(wanted, terms.gold_products(gold), cache).filter("keyword = 'banana'")
    assert [r.canonical_id for r in left.collect()] == [3]


def test_candidates_of_lists(spark):
    gold = spark.createDataFrame([(i, f"Plum {'x' * i}", None, "a", 1.0) for i in range(1, 6)], GOLD)
    lists = spark.createDataFrame([(1, "plum", None), (2, "plum", None), (2, "fig", None), (3, "plum", "dairy")],
                                  "list_id int, keyword string, coarse string")
    every = terms.term_candidates(lists, terms.gold_products(gold))
    assert {r.list_id: r["count"] for r in every.groupBy("list_id").count().collect()} == {1: 5, 2: 5, 3: 5}
    best = terms.term_candidates(lists, terms.gold_products(gold), limit=2)
    assert sorted((r.list_id, r.canonical_id) for r in best.collect()) == [(i, c) for i in (1, 2, 3) for c in (1, 2)]
    rejected = spark.createDataFrame([("plum", 1, "no_match", 0.9)],
                                     "term string, canonical_id bigint, verdict string, confidence double")
    left = terms.term_candidates(lists, terms.gold_products(gold), rejected, limit=1)
    assert sorted((r.list_id, r.canonical_id) for r in left.collect()) == [(1, 2), (2, 2), (3, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_assignment_equals_choosing_in_order(spark, seed):
    r = random.Random(seed)
    cached, found, want = [], [], {}
    for lst in range(4):
        taken = set()
        for pos in range(1, 9):
            tier0 = [(lst, pos, c, r.choice([0.9, 0.95]), 1.0) for c in r.sample(range(6), r.randrange(0, 3))]
            tier1 = [(lst, pos, c, r.randrange(2), 1, 5, 1.0) for c in r.sample(range(9), r.randrange(0, 5))]
            cached += tier0
            found += tier1
            order = [t[2] for t in sorted(tier0, key=lambda t: (-t[3], t[4], t[2]))]
            order += [t[2] for t in sorted(tier1, key=lambda t: (-t[3], -t[4], t[5], t[6], t[2]))]
            pick = next((c for c in order if c not in taken), None)
            taken.add(pick)
            want[lst, pos] = pick
    lists = spark.createDataFrame([(i, p) for i in range(4) for p in range(1, 9)], "list_id bigint, position int")
    c = spark.createDataFrame(cached, "list_id bigint, position int, canonical_id bigint, confidence double, min_price double")
    f = spark.createDataFrame(found, "list_id bigint, position int, canonical_id bigint, starts int, n_sources int, name_length int, min_price double")
    got = {(x.list_id, x.position): x.canonical_id for x in terms.assign_basket(lists, c, f).collect()}
    assert got == want


SEEN = """source string, source_sku string, raw_name string, raw_brand string, raw_size_text string,
    category_hint string, coarse_category string, seen_at timestamp, line int"""


def test_upsert_in_batches_equals_at_once(spark):
    t = lambda h: NOW + datetime.timedelta(hours=h)
    rows = [("k", "1", "Old", "B1", "1 oz", None, None, t(0), 1), ("k", "1", "New", "B2", "2 oz", "Dairy", "dairy", t(2), 2),
            ("k", "1", "Mid", "B3", "3 oz", "Snack", "snack", t(1), 3), ("k", None, "Loose", None, None, None, None, t(0), 4),
            ("k", None, "Loose", None, None, None, None, t(0), 5)]
    df = spark.createDataFrame(rows, SEEN)
    table = lambda s: sorted(map(tuple, state.source_product_table(s).collect()), key=str)
    once = state.upsert_source_products(None, df, ["seen_at", "line"])
    first = state.upsert_source_products(None, df.filter("line > 1"), ["seen_at", "line"])
    assert table(once) == table(state.upsert_source_products(first, df.filter("line <= 1"), ["seen_at", "line"]))
    assert table(once) == table(state.upsert_source_products(once, df, ["seen_at", "line"]))
    rows = {r.source_sku: r for r in state.source_product_table(once).collect()}
    assert len(table(once)) == 3
    one = rows["1"]
    assert (one.raw_name, one.raw_brand, one.raw_size_text, one.category_hint) == ("New", "B1", "2 oz", "Snack")
    assert (one.first_seen_at, one.last_seen_at) == (t(0), t(2))


def test_verdicts_and_reviews(spark):
    fields = "term string, canonical_id bigint, verdict string, confidence double, reason string, model string, decided_by string, created_at timestamp"
    change = lambda v, c, at: spark.createDataFrame([("milk", 1, v, c, "r", "m", "llm", at)], fields)
    empty = schemas.empty(spark, "match_verdicts")
    cache = state.upsert_verdicts(empty, change("match", 0.7, NOW))
    later = NOW + datetime.timedelta(days=1)
    cache = state.upsert_verdicts(cache, change("no_match", 0.8, later)).withColumn("verdict_id", F.lit(5).cast("bigint"))
    row = cache.first()
    assert (row.verdict, row.created_at, row.updated_at) == ("no_match", NOW, later)
    with pytest.raises(Exception, match="invalid verdict"):
        state.upsert_verdicts(empty, change("maybe", 0.7, NOW)).collect()
    queue = schemas.conform(state.enqueue_review(cache, schemas.empty(spark, "match_review_queue")), "match_review_queue")
    assert queue.count() == 1 and state.enqueue_review(cache, queue).count() == 0
    ruling = spark.createDataFrame([(5, False, NOW, "me")], "verdict_id bigint, approve boolean, decided_at timestamp, resolved_by string")
    cache, queue = state.apply_reviews(cache, queue, ruling)
    row, closed = cache.first(), queue.first()
    assert (row.verdict, row.confidence, row.decided_by, row.model) == ("match", 1.0, "human", None)
    assert (closed.status, closed.resolved_by) == ("rejected", "me")


def test_pairs_are_decided_once(spark):
    pairs = spark.createDataFrame([("Milk", None, "milk", 1, "Whole Milk", "dairy"), ("Milk", None, "milk", 2, "Soap", None),
                                   ("Milk", None, "milk", 3, "Boom", None), ("Milk", None, "milk", 1, "Whole Milk", "dairy")],
                                  "keyword string, coarse string, term string, canonical_id bigint, canonical_name string, coarse_category string")

    def decide(term, candidate):
        if candidate["name"] == "Boom":
            raise RuntimeError("down")
        return {"verdict": "match" if term["keyword"] in candidate["name"] else "no_match", "confidence": 3, "reason": "r"}

    cache, answers = review.adjudicate_pairs(pairs, schemas.empty(spark, "match_verdicts"), decide, NOW, "stub")
    rows = {r.canonical_id: r for r in cache.collect()}
    assert {k: (r.verdict, r.confidence) for k, r in rows.items()} == {1: ("match", 1.0), 2: ("no_match", 1.0)}
    assert answers.filter("error IS NOT NULL").count() == 1
    again = state.fresh_pairs(pairs, cache)
    assert [r.canonical_id for r in again.collect()] == [3]


def test_queue_and_guard(spark):
    sp = spark.createDataFrame([(1, "a", "Chicken", None, None, "protein", 10, 0.9, "rapidfuzz"),
                                (2, "b", "Chicken", None, None, "protein", 10, 0.95, "llm_adjudicator"),
                                (3, "c", "Crackers", None, None, None, None, None, None)],
                               "source_product_id bigint, source string, raw_name string, raw_size_text string, raw_brand string,"
                               " coarse_category string, canonical_id bigint, match_confidence double, match_method string")
    canonical = spark.createDataFrame([(10, "Chicken Crackers", "x", "snack")], "canonical_id bigint, name string, category string, coarse_category string")
    cut = state.sever_cross_category(sp, canonical)
    assert {r.source_product_id: (r.severed, r.canonical_id) for r in cut.collect()} == {1: (True, None), 2: (False, 10), 3: (False, None)}
    assert state.sever_cross_category(cut.drop("severed"), canonical).filter("severed").count() == 0
    queue = spark.createDataFrame([(1, 3, 10, 0.8, "open"), (2, 1, 10, 0.99, "open"), (3, 3, 10, 0.8, "rejected")],
                                  "queue_id bigint, source_product_id bigint, candidate_canonical_id bigint, proposed_confidence double, status string")
    rows = review.prioritized(review.open_queue(queue, sp, canonical)).collect()
    assert [(r.queue_id, r.adds_source) for r in rows] == [(1, 1)]  # the cross-category pair is never asked
    decisions = review.decide_queue(review.open_queue(queue, sp, canonical), lambda s, c: {"same_product": True, "confidence": 0.9, "reason": "ok"})
    products, closed = review.apply_adjudication(sp, queue, decisions)
    linked = products.filter("source_product_id = 3").first()
    assert (linked.canonical_id, linked.match_confidence, linked.match_method) == (10, 0.9, "llm_adjudicator")
    assert {r.queue_id: r.status for r in closed.collect()} == {1: "approved", 2: "open", 3: "rejected"}


def test_small_state_changes(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("y", 9), ("z", 3)], "k string, v int")
    assert sorted(map(tuple, state.insert_new(a, b, ["k"]).collect())) == [("x", 1), ("y", 2), ("z", 3)]
    assert [r.k for r in state.delete_where(a, b, ["k"]).collect()] == ["x"]
    assert [r.k for r in state.deleted_where(a, b, ["k"]).collect()] == ["y"]


def test_a_word_in_every_name_is_no_key(spark):
    """Keywords are looked up by their rarest word; candidates are those of the pattern on every name."""
    names = [f"Organic {w} {i}" for i, w in enumerate(["Milk", "Oats", "Eggs", "half-and-half", "Milks", "$ Deal"] * 30)]
    products = spark.createDataFrame(
        [(i, n, "dairy", 1, 1.0) for i, n in enumerate(names)],
        "canonical_id bigint, canonical_name string, coarse_category string, n_sources bigint, min_price double")
    keywords = ["organic milk", "organic", "Organic half-and-half", "organic none", "$", "egg", "organic  milk"]
    lists = spark.createDataFrame([(k, None) for k in keywords], "keyword string, coarse string")
    words = products.select(F.explode(terms._word_keys(F.col("canonical_name"))).alias("_word"))
    rarest = {r["keyword"]: r["_word"] for r in terms.rarest_words(lists.select("keyword"), words).collect()}
    assert rarest["organic milk"] == "milk" and rarest["organic none"] == "none" and rarest["organic"] == "organic"
    assert rarest["Organic half-and-half"] in ("and", "half")
    got = {(r.keyword, r.canonical_id) for r in terms.term_candidates(lists, products).collect()}
    want = lists.join(products, F.regexp_like(F.lower("canonical_name"), terms.term_pattern(F.col("keyword"))))
    assert got == {(r.keyword, r.canonical_id) for r in want.collect()} and len(got) > 200
