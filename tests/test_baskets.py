import pytest

from cartledger.operators import basket as B

GOLD = """canonical_id bigint, canonical_name string, source string, store_id string, price decimal(10,2),
    unit_price double, unit string, match_confidence double, price_id string"""


def sheet(spark, offers, items):
    rows = [(c, f"p{c}", s, "1", p, None, None, conf, f"{s}{c}") for c, s, p, conf in offers]
    from decimal import Decimal

    rows = [(*r[:4], None if r[4] is None else Decimal(str(r[4])), *r[5:]) for r in rows]
    offers = B.product_offers(spark.createDataFrame(rows, GOLD))
    lines = spark.createDataFrame(items, "basket_id bigint, canonical_id bigint, label string, quantity bigint")
    return B.basket_sheet(lines, offers), lines, offers


MILK_EGGS = [(1, 1, "milk", 1), (1, 2, "eggs", 1)]


def test_full_coverage_beats_cheaper_partial(spark):
    s, lines, offers = sheet(spark, [(1, "wf", 1.0, 1.0), (1, "kr", 3.0, 1.0), (2, "kr", 4.0, 1.0),
                                     (1, "sa", 3.5, 1.0), (2, "sa", 4.5, 1.0)], MILK_EGGS)
    v = B.verdict(s).first()
    assert (v.flexible_winner, float(v.flexible_total)) == ("kr", 7.0)
    rank = {r.source: r for r in B.store_ranking(s).filter("mode = 'flexible'").collect()}
    assert [rank[k]["rank"] for k in ("kr", "sa", "wf")] == [1, 2, 3]
    assert rank["wf"].missing_count == 1 and not rank["wf"].full_coverage
    missing = B.missing_items(lines, offers, s).filter("mode = 'flexible'").collect()
    assert [(r.source, r.label) for r in missing] == [("wf", "eggs")]


def test_modes(spark):
    s, *_ = sheet(spark, [(1, "kr", 3.0, 0.90), (2, "kr", 4.0, 1.0)], MILK_EGGS)
    v = B.verdict(s).first()
    assert (v.flexible_winner, v.exact_winner) == ("kr", None)


@pytest.mark.parametrize("other, savings, worth", [(2.9, 0.1, False), (0.5, 2.5, True)])
def test_worth_it(spark, other, savings, worth):
    s, *_ = sheet(spark, [(1, "kr", 3.0, 1.0), (2, "kr", 4.0, 1.0), (1, "wf", other, 1.0)], MILK_EGGS)
    v = B.verdict(s).first()
    assert (float(v.split_savings), v.worth_it) == (savings, worth)


def test_unpriced_items_count_for_the_list_only(spark):
    s, *_ = sheet(spark, [(1, "kr", 3.0, 1.0), (2, "kr", None, 1.0)], MILK_EGGS + [(2, 7, "ghost", 1)])
    rows = {r.basket_id: r for r in B.verdict(s).collect()}
    assert (rows[1].flexible_winner, rows[1].n_items, rows[1].n_list) == (None, 1, 2)
    assert rows[1].has_footnote and rows[1].split_savings is None
    assert (rows[2].has_footnote, rows[2].n_items) == (False, 0)
    best = {r.basket_id: r.best_single_source for r in B.optimize_basket(s).collect()}
    assert best == {1: "kr", 2: None}  # the optimizer asks for priced items only


def test_replace_basket(spark):
    items = spark.createDataFrame([(1, 5), (2, 6)], "basket_id bigint, canonical_id bigint")
    out = B.replace_basket(items, 1, spark.createDataFrame([(9,)], "canonical_id bigint"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 9), (2, 6)]


def test_missing_masks_of_more_than_64_sources(spark):
    """150 stores take three words; every third lacks the eggs, every seventh sells nothing trusted exactly."""
    stores = [f"s{i:03d}" for i in range(150)]
    offers = [(1, s, 1.0, 0.9 if i % 7 == 0 else 1.0) for i, s in enumerate(stores)]
    offers += [(2, s, 2.0, 0.9 if i % 7 == 0 else 1.0) for i, s in enumerate(stores) if i % 3]
    lines = [*MILK_EGGS, (1, 9, "ghost", 1), (2, 1, "milk", 1), (3, 9, "ghost", 1)]
    s, items, table = sheet(spark, offers, lines)
    expected = set()
    for mode in ("flexible", "exact"):
        for i, store in enumerate(stores):
            if mode == "flexible" or i % 7:
                expected |= {(1, mode, store, 9, "ghost")} | ({(1, mode, store, 2, "eggs")} if i % 3 == 0 else set())
    rows = [tuple(r) for r in B.missing_items(items, table, s).collect()]
    assert len(rows) == len(expected) and set(rows) == expected
    flexible = B.missing_items(items, table, s, modes=("flexible",)).collect()
    assert {tuple(r) for r in flexible} == {e for e in expected if e[1] == "flexible"}
    counts = B.missing_counts(B.missing_masks(items, table, s, B.source_bits(s))).collect()
    assert {(r.basket_id, r.label): (r.lacking_flexible, r.lacking_exact) for r in counts} == {
        (1, "ghost"): (150, 128), (1, "eggs"): (50, 42)}


def test_basket_tables_write_only_what_a_report_asks_for(spark, monkeypatch):
    from cartledger.plans import baskets, reports

    s, items, _ = sheet(spark, [(1, "kr", 3.0, 1.0), (2, "kr", 4.0, 1.0), (1, "wf", 1.0, 1.0)], MILK_EGGS)
    gold = spark.createDataFrame([(1, "milk", "kr", "1", None, None, None, 1.0, "a")], GOLD)
    written = []
    monkeypatch.setattr(baskets, "cut_lineage", lambda df: written.append(df.columns) or df)
    tables = baskets.basket_tables(items, gold)
    assert written == []
    reports.verdict_lines(tables.ranking, tables.missing)
    assert [c[0] for c in written] == ["canonical_id", "basket_id", "source"] and "price_id" not in sum(written, [])
    tables.missing_masks
    assert len(written) == 3


def test_rows_per_source_are_not_shuffled(spark):
    """Offers meet the lines after these are dealt by basket; nothing moves after the explode. Repeated lines add up."""
    from cartledger.session import cut_lineage

    lines = [*MILK_EGGS, (1, 1, "milk", 2), (2, 1, "milk", None), (2, 9, "ghost", 1)]
    _, items, offers = sheet(spark, [(1, "kr", 3.0, 1.0), (2, "kr", 4.0, 0.9), (1, "wf", 1.0, 1.0)], lines)
    offers = cut_lineage(offers)
    s = B.basket_sheet(items, offers)
    for df in (s, B.store_ranking(s), B.verdict(s), B.optimize_basket(s), B.basket_store_totals(items, offers)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[:plan.index("Generate")]
    rows = {(r.basket_id, r.source): r for r in s.collect()}
    assert set(rows) == {(1, "kr"), (1, "wf"), (2, "kr"), (2, "wf"), (2, None)}
    kr = rows[1, "kr"]
    assert (kr.covered_flexible, kr.cents_flexible, kr.covered_exact, kr.cents_exact) == (3, 1300, 2, 900)
    assert (sum(rows[1, x].n_items for x in ("kr", "wf")), rows[1, "wf"].best_lines) == (3, 2)
    assert (rows[2, "kr"].covered_flexible, rows[2, "kr"].cents_flexible, rows[2, None].n_items) == (1, None, 1)
    totals = {(r.basket_id, r.source): (r.items_covered, r.store_total) for r in B.basket_store_totals(items, offers).collect()}
    assert totals[1, "kr"] == (3, 13) and totals[2, "wf"] == (1, None)


def test_provenance_names_the_first_ids_without_gathering_all(spark):
    gold = spark.createDataFrame(
        [(1, f"a{i}", "2026-01-01") for i in range(5)] + [(2, "a0", "2026-02-01"), (2, "a00", None), (3, None, "2026-03-01")],
        "canonical_id bigint, price_id string, ad_week string",
    )
    items = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 9), (3, 3)], "basket_id bigint, canonical_id bigint")
    full = {r.basket_id: r for r in B.provenance(items, gold).collect()}
    assert full[1].price_ids == ["a0", "a0", "a00", "a1", "a2", "a3", "a4"]
    assert (full[1].n_price_ids, full[1].ad_week) == (7, "2026-02-01")
    assert (full[2].n_price_ids, full[2].price_ids, full[3].n_price_ids, full[3].price_ids) == (0, None, 0, [])
    first = {r.basket_id: r for r in B.provenance(items, gold, ids=3).collect()}
    assert first[1].price_ids == full[1].price_ids[:3] and first[1].n_price_ids == 7
    assert (first[2].price_ids, first[3].price_ids) == (None, [])
    unread = B.provenance(items, gold).drop("price_ids")._jdf.queryExecution().optimizedPlan().toString()
    assert unread.count("Join") == 1 and "collect_list" not in unread


def test_tasks_grow_with_the_rows_that_lines_become(spark, monkeypatch):
    """Twenty lines of a product of two sources are forty rows; few rows keep the usual number of tasks."""
    from cartledger.session import cut_lineage

    lines = [(basket, 1, "milk", 1) for basket in range(20)]
    _, items, offers = sheet(spark, [(1, "kr", 3.0, 1.0), (1, "wf", 1.0, 1.0)], lines)
    dealt = cut_lineage(B.basket_list(items))
    assert B.basket_tasks(dealt, offers) == 16
    monkeypatch.setattr(B, "ROWS_A_TASK", 1)
    assert B.basket_tasks(dealt, offers) == 40
    for rows in (B.basket_sheet(items, offers), B.basket_store_totals(items, offers)):
        assert "40), REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()


def test_rows_with_all_ids_are_neither_shuffled_nor_sorted(spark):
    gold = spark.createDataFrame([(1, "b", "2026-01-01"), (1, "a", "2026-01-08"), (2, "c", None)],
                                 "canonical_id bigint, price_id string, ad_week string")
    items = spark.createDataFrame([(1, 2), (1, 1), (1, 1), (2, 1), (None, 2), (3, None)], "basket_id bigint, canonical_id bigint")
    rows = B.provenance(items, gold, tasks=3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("BroadcastHashJoin")]
    assert not [word for word in ("Exchange", "Sort", "Aggregate") if word in above]
    assert {r.basket_id: (r.ad_week, r.n_price_ids, r.price_ids) for r in rows.collect()} == {
        1: ("2026-01-08", 3, ["a", "b", "c"]), 2: ("2026-01-08", 2, ["a", "b"]), None: (None, 1, ["c"]), 3: (None, 0, None)}


def test_packs_keep_the_rows_of_a_basket_where_they_were_dealt(spark):
    import json

    from cartledger.plans import narration as N
    from cartledger.plans.baskets import basket_tables

    gold = spark.createDataFrame([(1, "milk", "kr", "1", None, None, None, 1.0, "a")], GOLD).selectExpr("*", "date'2026-01-01' AS ad_week")
    gold = gold.selectExpr("canonical_id", "canonical_name", "inline(array(struct('kr' AS source, 3.00BD AS price), struct('wf' AS source, 1.00BD AS price)))",
                           "store_id", "unit_price", "unit", "match_confidence", "price_id", "ad_week")
    items = spark.createDataFrame([*MILK_EGGS, (1, 7, "bread", 1), (2, 1, "milk", 1)], "basket_id bigint, canonical_id bigint, label string, quantity bigint")
    sources = spark.createDataFrame([("kr", "Kr")], "source string, banner string")
    t = basket_tables(items, gold)
    packs = N.fact_pack(t.ranking, t.missing_flexible, t.verdict, sources, t.provenance)
    plan = packs._jdf.queryExecution().executedPlan().toString()
    assert "mode#" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    facts = {r.basket_id: json.loads(r.facts) for r in packs.collect()}
    assert [(x["store"], x["missing_labels"]) for x in facts[1]["other_stores"]] == [("wf", ["bread", "eggs"]), ("Kr", ["bread", "eggs"])]
    assert facts[2]["winner"]["missing_labels"] == [] and facts[2]["_provenance"]["price_ids"] == ["a", "a"]


def test_a_reader_of_numbers_gathers_no_price_ids(spark, monkeypatch):
    """Packs know their numbers without ids, however many these are; facts hold all of them."""
    import json
    import re
    from decimal import Decimal

    from cartledger.plans import narration as N
    from cartledger.plans.baskets import basket_tables

    gold = spark.createDataFrame([(1, "milk", "kr", "1", Decimal(3), None, None, 1.0, "b"), (1, "milk", "wf", "2", Decimal(2), None, None, 1.0, "a")], GOLD)
    gold = gold.selectExpr("*", "date'2026-01-01' AS ad_week")
    items = spark.createDataFrame([*MILK_EGGS, (2, 1, "milk", 1)], "basket_id bigint, canonical_id bigint, label string, quantity bigint")
    sources = spark.createDataFrame([("kr", "Kr")], "source string, banner string")
    for most in (B.SENT_IDS, 0):
        monkeypatch.setattr(B, "SENT_IDS", most)
        t = basket_tables(items, gold, write_gold=True)
        packs = N.fact_pack(t.ranking, t.missing_flexible, t.verdict, sources, t.provenance)
        unread = packs.select("basket_id", "numbers")._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list(price_id" not in unread and not re.search(r"\bids#", unread)
        facts = {r.basket_id: json.loads(r.facts) for r in packs.collect()}
        assert facts[2]["_provenance"] == {"basket_id": 2, "price_id_count": 2, "price_ids": ["a", "b"], "views": facts[1]["_provenance"]["views"]}
        assert list(facts[2])[0] == "n_items" and list(facts[2])[-1] == "_provenance" and facts[2]["winner"]["total"] == 2.0


def test_ids_too_many_to_send_are_the_same_ids(spark, monkeypatch):
    gold = spark.createDataFrame([(1, "b", "2026-01-01"), (1, "a", "2026-01-08"), (2, "c", None), (4, None, None)],
                                 "canonical_id bigint, price_id string, ad_week string")
    items = spark.createDataFrame([(1, 2), (1, 1), (1, 1), (2, 1), (None, 2), (3, None), (4, 4)], "basket_id bigint, canonical_id bigint")
    sent = B.provenance(items, gold, tasks=3).collect()
    monkeypatch.setattr(B, "SENT_IDS", 0)
    rows = B.provenance(items, gold, tasks=3)
    assert sorted(map(str, rows.collect())) == sorted(map(str, sent)) and len(sent) == 5
    unread = rows.drop("price_ids")._jdf.queryExecution().optimizedPlan().toString()
    assert unread.count("Join") == 1 and "collect_list" not in unread


def test_dealt_lines_are_not_dealt_again(spark):
    from decimal import Decimal

    from cartledger.plans.baskets import basket_tables

    _, items, _ = sheet(spark, [], MILK_EGGS)
    gold = spark.createDataFrame([(1, "milk", "kr", "1", Decimal(3), None, None, 1.0, "b")], GOLD)
    dealt = basket_tables(B.by_basket(items, 7), gold, dealt=7)
    for rows in (dealt.ranking, dealt.verdict, dealt.missing_masks):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(basket_id" in x]
        assert moved and all(", 7), REPARTITION_BY_NUM" in x for x in moved) and len(moved) <= 2
    plain = basket_tables(items, gold)
    assert sorted(map(str, dealt.missing.collect())) == sorted(map(str, plain.missing.collect())) != []
    assert sorted(map(str, dealt.verdict.collect())) == sorted(map(str, plain.verdict.collect()))


@pytest.fixture
def nothing_small(spark):
    """No table is small enough for Spark to send it to all tasks by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_offers_are_sent_to_the_lines_whatever_their_guessed_size(spark, nothing_small):
    _, items, offers = sheet(spark, [(1, "kr", 3.0, 1.0), (2, "kr", 4.0, 0.9), (1, "wf", 1.0, 1.0)], MILK_EGGS)
    s = B.basket_sheet(items, offers)
    for df in (s, B.store_ranking(s), B.verdict(s), B.basket_store_totals(items, offers)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[:plan.index("Generate")]
    assert {(r.source, r.covered_flexible) for r in s.collect()} == {("kr", 2), ("wf", 1)}


def test_labels_stay_where_their_basket_was_dealt(spark, nothing_small, monkeypatch):
    """A basket's masks are sent to its lines, though the sheet has other tasks; packs ask for the tasks of the sheet."""
    from pyspark.sql.functions import broadcast

    monkeypatch.setattr(B, "ROWS_A_TASK", 1)
    _, items, offers = sheet(spark, [(1, "kr", 3.0, 1.0), (2, "kr", 4.0, 1.0), (1, "wf", 1.0, 1.0)], [
        (basket, product, f"label {product}", 1) for basket in range(10) for product in (1, 2)])
    s, dealt = B.basket_sheet(items, offers), B.by_basket(items).groupBy("basket_id", "canonical_id", "label").count()

    def moved(**how):
        masks = B.missing_masks(dealt, offers, s, broadcast(B.source_bits(s)), **how)
        plan = masks._jdf.queryExecution().executedPlan().toString()
        found = sum("Exchange hashpartitioning(basket_id" in x and "ENSURE_REQUIREMENTS" in x for x in plan.splitlines())
        return found, {(r.basket_id, r.label, r.lacking_flexible) for r in B.missing_counts(masks).collect()}

    expected = {(basket, "label 2", 1) for basket in range(10)}
    assert moved() == (0, expected) and moved(like_sheet=True) == (1, expected)


def test_rows_of_a_basket_stand_together(spark):
    items = spark.range(3000).selectExpr("id % 300 AS basket_id", "id DIV 300 AS canonical_id", "1L AS quantity")
    rows = B.basket_list(items.repartition(2, "basket_id")).collect()
    starts = [r.basket_id for before, r in zip([None, *rows], rows) if before is None or before.basket_id != r.basket_id]
    assert len(starts) == len(set(starts)) == 300 and len(rows) == 3000


def test_gold_rows_are_dealt_once(spark, nothing_small, tmp_path):
    """Prices and listings are dealt by listing while narrow; stores, parts and sizes are sent to them. The rows are those of
    the prices as they come, with keys that are null, twice or nobody's."""
    from checks.roles import PRICE_TIES, Roles
    from cartledger.operators.gold import gold_current_prices

    tables = {
        "region": ([(1, "EUROPE")], "r_regionkey bigint, r_name string"),
        "nation": ([(1, "FRANCE", 1), (2, "SPAIN", 1)], "n_nationkey bigint, n_name string, n_regionkey bigint"),
        "supplier": ([(1, "s1", 1), (2, "s2", 2), (3, "s3", None)], "s_suppkey bigint, s_name string, s_nationkey bigint"),
        "part": ([(k, f"red n{k % 3}", "b", "t", 3) for k in range(3, 21)] + [(20, "red n2", "b", "t", 3)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"),
        "lineitem": (
            [(o, p, s, n, 2.0, 10.0 * o + p, 0.1 * (n % 2), f"199{o % 8}-01-0{n}")
             for n, (o, p, s) in enumerate([(o, p, s) for o in range(1, 4) for p in (19, 20, 99, None) for s in (1, 2, 3, None)][:9] * 2, 1)
             for n in [n % 9 + 1]],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_shipdate string",
        ),
    }
    for name, (rows, ddl) in tables.items():
        df = spark.createDataFrame(rows, ddl)
        df = df.withColumn("l_shipdate", df.l_shipdate.cast("timestamp")) if name == "lineitem" else df
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    r = Roles(spark, str(tmp_path))
    exchanges = [x for x in r.gold._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in x]
    assert sum("hashpartitioning(concat_ws" in x for x in exchanges) == 2
    assert not [x for x in exchanges if any(f"hashpartitioning({k}#" in x for k in ("source_product_id", "l_suppkey", "l_partkey", "source", "_sku"))]
    assert r.prices.exceptAll(r.dealt_prices).count() == r.dealt_prices.exceptAll(r.prices).count() == 0
    plain = gold_current_prices(r.prices, r.source_products, r.canonical, r.stores, tie_break=PRICE_TIES)
    kept = ["canonical_id", "source", "store_id", "price_id", "price"]
    assert sorted(r.gold.select(*kept).distinct().collect()) == sorted(plain.select(*kept).distinct().collect()) != []
