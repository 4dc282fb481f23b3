"""Golden results of the demo data set."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from cartledger import schemas
from cartledger.operators import basket as B
from cartledger.plans import jobs
from cartledger.plans import narration as N
from cartledger.plans import reports
from cartledger.plans.baskets import basket_tables
from cartledger.sources.demo import demo_tables, shopping_list


@pytest.fixture(scope="module")
def demo(spark):
    tables = demo_tables(spark, datetime.datetime(2026, 7, 30, 12))
    for name in ("match_verdicts", "match_review_queue", "resolution_queue"):
        tables[name] = schemas.empty(spark, name)
    return tables


@pytest.fixture(scope="module")
def plan(demo):
    gold = jobs.current_gold(demo).withColumn("price_id", F.col("price_id").cast("string"))
    return basket_tables(demo["basket_items"], gold)


def test_ranking(plan):
    rows = {(r["mode"], r["source"]): r for r in plan.ranking.collect()}
    total = {k: float(r.store_total) for k, r in rows.items()}
    covered = {k: r.items_covered for k, r in rows.items()}
    assert total["flexible", "kroger"] == 123.17 and rows["flexible", "kroger"]["rank"] == 1
    assert total["flexible", "wholefoods"] == 169.27
    assert (total["flexible", "traderjoes"], covered["flexible", "traderjoes"]) == (128.36, 25)
    assert (total["flexible", "aldi_kcl"], covered["flexible", "aldi_kcl"]) == (83.48, 23)
    assert (total["exact", "kroger"], covered["exact", "kroger"]) == (106.21, 24)
    assert rows["exact", "wholefoods"]["rank"] == 1
    assert all(covered[m, s] <= covered["flexible", s] for m, s in covered)


def test_verdict_and_split(plan):
    v = plan.verdict.first()
    assert (v.flexible_winner, float(v.flexible_total), v.exact_winner) == ("kroger", 123.17, "wholefoods")
    assert (float(v.split_total), float(v.split_savings), v.worth_it) == (99.33, 23.84, True)
    assert v.stores_used == ["aldi_kcl", "kroger", "traderjoes"]
    o = B.optimize_basket(plan.sheet).first()
    assert (o.n_items, o.best_single_source, float(o.savings_vs_single)) == (26, "kroger", 23.84)
    up = {r["mode"]: r for r in B.runner_up(plan.ranking).collect()}["flexible"]
    assert (up.runner_up, float(up.runner_up_total), float(up.saving)) == ("wholefoods", 169.27, 46.10)


def test_missing_and_lines(plan):
    missing = plan.missing.filter("mode = 'flexible' AND source = 'aldi_kcl'")
    assert sorted(r.label for r in missing.collect()) == ["broccoli", "cookies", "salmon"]
    rows = reports.verdict_lines(plan.ranking, plan.missing).collect()
    lines = {(r["mode"], r.source): r.line for r in rows if r.label is None}
    assert lines["flexible", "kroger"] == "WINNER: kroger wins this week at $123.17 (covers all 26 items)"
    assert lines["flexible", "wholefoods"] == "wholefoods: would've been $169.27"
    assert lines["flexible", "aldi_kcl"] == "aldi_kcl: $83.48 but missing 3 of 26 items"
    labels = [r.label for r in rows if (r["mode"], r.source) == ("flexible", "aldi_kcl") and r.label]
    assert sorted(labels) == ["broccoli", "cookies", "salmon"]


def test_verdict_lines_have_one_shape_at_every_size(spark):
    ranking = spark.createDataFrame([(1, "flexible", "s", 2, False, 3.0, 1500, 1502)],
        "basket_id long, mode string, source string, rank int, full_coverage boolean, store_total double, missing_count int, n_items int")
    missing = spark.range(1500).selectExpr("1L AS basket_id", "'flexible' AS mode", "'s' AS source", "concat('label ', id) AS label")
    rows = reports.verdict_lines(ranking, missing).collect()
    assert [r.line for r in rows if r.label is None] == ["s: $3.00 but missing 1500 of 1502 items"]
    assert len({r.label for r in rows if r.label}) == 1500


def test_facts_and_audit(spark, demo, plan):
    pack = N.fact_pack(plan.ranking, plan.missing, plan.verdict, demo["sources"], plan.provenance)
    facts = json.loads(pack.first().facts)
    assert facts["winner"]["store"] == "Harris Teeter / Kroger" and facts["winner"]["total"] == 123.17
    assert facts["runner_up"]["store"] == "Whole Foods Market" and facts["saving_vs_runner_up"] == 46.1
    assert facts["split"]["extra_saving"] == 23.84 and facts["split"]["n_stores"] == 3
    aldi = next(s for s in facts["other_stores"] if s["store"] == "Aldi")
    assert aldi["missing_count"] == 3 and aldi["missing_labels"] == ["broccoli", "cookies", "salmon"]
    assert facts["_provenance"]["price_id_count"] == 100 and len(set(facts["_provenance"]["price_ids"])) == 100
    texts = {
        "It costs $123.17 for all 26 items, not $169.27: save $46.10. A 3-store split is $99.33, another $23.84.": 0,
        "You save $999.99 this week!": 1,
        "Covers 27 items": 1,
        "For the ad week of 2026-07-29, pay $123.17.": 0,
        "$1,234.5 and $ 123.17 and 123.170": 1,
    }
    asked = pack.join(spark.createDataFrame([(t,) for t in texts], "t string"), F.lit(True))
    got = {r.t: len(r.v) for r in asked.select("t", N.audit(F.col("t"), F.col("numbers")).alias("v")).collect()}
    assert got == texts
    assert pack.first().citations.startswith("basket 1 · ad week 2026-07-29 · 100 gold price rows (price_id 101,")
    assert pack.first().citations.endswith("…)")


def test_narrate(demo):
    good, bad = jobs.narrate(demo, lambda pack: f"Winner at ${json.loads(pack)['winner']['total']:.2f}.", "stub")
    assert [(r.narration, r.audit_ok, r.model) for r in good.collect()] == [("Winner at $123.17.", True, "stub")]
    assert bad.count() == 0
    for write in (lambda p: "All is $1.99!", lambda p: "", lambda p: 1 / 0):
        good, bad = jobs.narrate(demo, write)
        assert good.count() == 0 and bad.count() == 1


def test_narrate_keeps_every_price_id(demo):
    out = jobs.narrate(demo, lambda pack: "Fine." if "_provenance" not in pack else "", "stub")
    stored = out.accepted.first()
    ids = json.loads(stored.facts)["_provenance"]["price_ids"]
    assert len(ids) == len(set(ids)) == 100
    assert sorted(r.price_id for r in out.provenance_rows.filter(f"basket_id = {stored.basket_id}").collect()) == ids
    assert stored.citations.count(",") == 19 and stored.citations.endswith("…)")


def test_optimize_job_finds_the_demo_basket(spark, demo):
    out = jobs.optimize(shopping_list(spark), demo)
    assert out["missing_terms"].count() == 0
    v = out["verdict"].first()
    assert (v.flexible_winner, float(v.flexible_total)) == ("kroger", 123.17)


def test_register_and_conform(spark, demo):
    assert schemas.register(demo) == schemas.register(demo)
    assert spark.table("prices").count() == 100
    old = spark.createDataFrame([(1, "x")], "canonical_id bigint, name string")
    assert schemas.conform(old, "canonical_products").first().coarse_category is None
