import datetime

import pytest

from cartledger import schemas
from cartledger.plans import jobs
from cartledger.sources.demo import demo_tables, shopping_list

NOW = datetime.datetime(2026, 7, 30, 12)


@pytest.fixture(scope="module")
def demo(spark):
    tables = demo_tables(spark, NOW)
    for name in ("match_verdicts", "match_review_queue", "resolution_queue"):
        tables[name] = schemas.empty(spark, name)
    return tables


def test_adjudicate_list_asks_once(spark, demo):
    def decide(term, candidate):
        weak = term["keyword"] == "milk"
        return {"verdict": "match", "confidence": 0.5 if weak else 0.95, "reason": candidate["name"]}

    lists = shopping_list(spark)
    out, answers = jobs.adjudicate_list(lists, demo, decide, NOW, "stub")
    n = answers.count()
    assert n >= 26 and out["match_verdicts"].count() == n
    assert out["match_review_queue"].count() == answers.filter("confidence < 0.85").count() == 1
    again, asked = jobs.adjudicate_list(lists, {**demo, **out}, decide, NOW, "stub")
    assert asked.count() == 0 and again["match_verdicts"].count() == n
    assert again["match_review_queue"].count() == 1


def test_adjudicate_queue_links(spark, demo):
    loose = schemas.conform(spark.createDataFrame(
        [(1, "giant", "Whole Milk 1 gal", "dairy")], "source_product_id bigint, source string, raw_name string, coarse_category string"),
        "source_products")
    queue = schemas.conform(spark.createDataFrame(
        [(5, 1, 9, 0.8, "open")],
        "queue_id bigint, source_product_id bigint, candidate_canonical_id bigint, proposed_confidence double, status string"),
        "resolution_queue")
    tables = {**demo, "source_products": demo["source_products"].unionByName(loose), "resolution_queue": queue}
    out, stats = jobs.adjudicate_queue(tables, lambda s, c: {"same_product": c["name"] == "Whole Milk", "confidence": 0.9, "reason": "r"})
    assert stats == {"linked": 1, "before": 26, "after": 26}
    row = out["source_products"].filter("source_product_id = 1").first()
    assert (row.canonical_id, row.match_method) == (9, "llm_adjudicator")
    assert out["resolution_queue"].first().status == "approved"
