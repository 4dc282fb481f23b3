"""The driver's tables in the roles the operators work on.

``ROLES_SQL`` in ``oracle.py`` states the same definitions for the check engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartledger.session import cut_lineage

SIZE_FORMS = ["{n} oz", "{n} lb", "{n} ct", "{n} fl oz", "{n} gal", "per lb", "1/2 gal", "{n} 1/2 oz"]

PRICE_TIES = ("price", "regular_price")

#: Rows of a lookup that are sent to all tasks at most; beyond that Spark joins it by its written size.
SENT_ROWS = 2_000_000


def lookup(rows: DataFrame) -> DataFrame:
    """Suppliers or parts, which line items look up, written first: by the plan's guess, the product of the sizes of the
    tables they come from, line items would be dealt by each of their keys to meet them."""
    written = cut_lineage(rows)
    return F.broadcast(written) if written.count() <= SENT_ROWS else written


def size_text():
    n = F.col("p_size").cast("string")
    forms = []
    for f in SIZE_FORMS:
        before, found, after = f.partition("{n}")
        forms.append(F.concat(n, F.lit(after)) if found else F.lit(before))
    return F.element_at(F.array(*forms), (F.col("p_partkey") % len(forms) + 1).cast("int"))


def to_money(cents):
    return (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def nations(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @cached_property
    def sources(self) -> DataFrame:
        """One source per nation; every fifth has no banner row."""
        return self.nations.filter("n_nationkey % 5 <> 4").select(
            F.col("n_name").alias("source"), F.col("r_name").alias("banner")
        )

    @cached_property
    def stores(self) -> DataFrame:
        return lookup(self.table("supplier").join(
            self.nations, F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("n_name").alias("source"),
            F.col("s_suppkey").alias("store_id"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("region"),
        ))

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.stores.select(F.col("store_id").alias("l_suppkey"), "source")

    @cached_property
    def parts(self) -> DataFrame:
        """Parts with the canonical product they belong to."""
        part = self.table("part")
        groups = part.groupBy("p_brand", "p_name").agg(
            F.min("p_partkey").alias("canonical_id"), F.min("p_type").alias("category")
        )
        return lookup(part.join(groups, ["p_brand", "p_name"]))

    @cached_property
    def canonical(self) -> DataFrame:
        noun = F.element_at(F.split("p_name", " "), -1)
        return self.table("part").groupBy("p_brand", "p_name").agg(
            F.min("p_partkey").alias("canonical_id"), F.min("p_type").alias("category")
        ).select(
            "canonical_id",
            F.concat_ws(" ", "p_brand", "p_name").alias("name"),
            "category",
            F.when(F.col("canonical_id") % 10 != 0, noun).alias("coarse_category"),
            F.col("p_brand").alias("brand"),
        )

    @cached_property
    def source_products(self) -> DataFrame:
        """One listing per (supplier, part) seen in the line items, dealt by the id that prices meet it by."""
        words = F.split("p_name", " ")
        confidence = ((F.col("p_partkey") % 21 + 80).cast("double") / 100).alias("match_confidence")
        linked = F.col("p_partkey") % 21 >= 3
        method = F.element_at(
            F.array(F.lit("rapidfuzz"), F.lit("llm_adjudicator"), F.lit("manual")),
            (F.col("p_size") % 3 + 1).cast("int"),
        )
        listing_id = F.concat_ws("-", "l_suppkey", "l_partkey")
        dealt = self.table("lineitem").select("l_suppkey", "l_partkey").repartition(listing_id)
        listings = dealt.withColumn("source_product_id", listing_id).distinct()
        return (
            listings.join(self.parts.withColumnRenamed("p_partkey", "l_partkey").withColumn("p_partkey", F.col("l_partkey")), "l_partkey")
            .join(self.suppliers, "l_suppkey")
            .select(
                "source_product_id",
                "source",
                F.col("l_partkey").cast("string").alias("source_sku"),
                F.col("p_name").alias("raw_name"),
                F.col("p_brand").alias("raw_brand"),
                size_text().alias("raw_size_text"),
                F.col("p_type").alias("category_hint"),
                F.when(F.col("p_size") % 10 == 1, F.element_at(words, 1))
                .when(F.col("p_size") % 10 != 0, F.element_at(words, -1))
                .alias("coarse_category"),
                F.when(linked, F.col("canonical_id")).alias("canonical_id"),
                F.when(linked, confidence).alias("match_confidence"),
                F.when(linked, method).alias("match_method"),
                F.col("canonical_id").alias("best_guess"),
                confidence.alias("guess_confidence"),
            )
        )

    @cached_property
    def queue(self) -> DataFrame:
        """Listings without a link wait here with their best guess."""
        return self.source_products.filter("canonical_id IS NULL").select(
            F.col("source_product_id").alias("queue_id"),
            "source_product_id",
            F.col("best_guess").alias("candidate_canonical_id"),
            F.col("guess_confidence").alias("proposed_confidence"),
            F.lit("open").alias("status"),
        )

    @cached_property
    def listed_lines(self) -> DataFrame:
        """Line items with their whole-cent regular price."""
        regular = F.expr(
            "(2 * cast(floor(l_extendedprice * 100 + 0.5) as bigint) + cast(l_quantity as bigint))"
            " div (2 * cast(l_quantity as bigint))"
        )
        percent = F.floor(F.col("l_discount") * 100 + 0.5).cast("bigint")
        return self.table("lineitem").withColumn("regular_cents", regular).withColumn(
            "percent", percent
        )

    @staticmethod
    def paid(lines: DataFrame) -> DataFrame:
        return lines.withColumn(
            "paid_cents",
            F.expr("(2 * regular_cents * (100 - percent) + 100) div 200"),
        )

    @cached_property
    def priced_lines(self) -> DataFrame:
        """Line items with whole-cent regular and paid prices."""
        return self.paid(self.listed_lines)

    @cached_property
    def prices(self) -> DataFrame:
        """Every line item is one observed price."""
        return self.prices_of(self.priced_lines)

    @cached_property
    def dealt_prices(self) -> DataFrame:
        """The same rows, dealt by listing while they are numbers: latest rows are found and meet their listings there, and
        ids are not shuffled as text."""
        lines = self.listed_lines.select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "regular_cents", "percent"
        ).repartition(F.concat_ws("-", "l_suppkey", "l_partkey"))
        return self.prices_of(self.paid(lines))

    def prices_of(self, lines: DataFrame) -> DataFrame:
        from cartledger.functions.pricing import ad_week

        return lines.join(self.suppliers, "l_suppkey").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("price_id"),
            F.concat_ws("-", "l_suppkey", "l_partkey").alias("source_product_id"),
            "source",
            F.col("l_suppkey").alias("store_id"),
            F.col("l_shipdate").alias("observed_at"),
            ad_week(F.col("l_shipdate")).alias("ad_week"),
            to_money(F.col("paid_cents")).alias("price"),
            F.when(F.col("percent") > 0, to_money(F.col("regular_cents"))).alias("regular_price"),
            (F.col("percent") > 0).alias("is_promo"),
        )

    @cached_property
    def gold(self) -> DataFrame:
        """Current trusted prices; the unit price is read off the listing's size."""
        from cartledger.functions.sizes import parse_size, price_per_base
        from cartledger.operators.gold import gold_current_prices

        gold = gold_current_prices(
            self.dealt_prices, self.source_products, self.canonical, self.stores, tie_break=PRICE_TIES
        )
        sizes = lookup(self.table("part").select(
            F.col("p_partkey").cast("string").alias("_sku"), parse_size(size_text()).alias("_size")
        ))
        sku = F.substring_index("source_product_id", "-", -1)
        priced = price_per_base(F.col("price"), F.col("_size"))
        return (
            gold.withColumn("_sku", sku)
            .join(sizes, "_sku", "left")
            .withColumn("unit_price", priced["unit_price"])
            .withColumn("unit", priced["unit"])
            .drop("_sku", "_size")
        )

    @cached_property
    def basket_tables(self):
        from cartledger.plans.baskets import basket_tables

        return basket_tables(self.items, self.gold, dealt=self.item_tasks)

    @property
    def offers(self) -> DataFrame:
        return self.basket_tables.offers

    @cached_property
    def baskets(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("basket_id"),
            F.concat(F.lit("order "), F.col("o_orderkey")).alias("name"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def item_tasks(self) -> int:
        """How many tasks basket lines are dealt into."""
        from cartledger.operators.basket import tasks_of

        return tasks_of(self.spark, self.table("lineitem").count(), self.table("nation").count() or 1)

    @cached_property
    def items(self) -> DataFrame:
        """Basket lines: an order's products with summed quantity. An order's few lines are dealt together, so that all
        that goes by basket meets them where they are."""
        from cartledger.operators.basket import by_basket

        names = lookup(self.canonical.select(
            "canonical_id", F.col("name").alias("label"), "category"
        ))
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(
            self.parts.select(F.col("p_partkey").alias("l_partkey"), "canonical_id"), "l_partkey"
        )
        dealt = by_basket(lines.select(
            F.col("l_orderkey").alias("basket_id"), "canonical_id", F.col("l_quantity").cast("bigint").alias("quantity")
        ), self.item_tasks)
        return (
            dealt.groupBy("basket_id", "canonical_id")
            .agg(F.sum("quantity").alias("quantity"))
            .join(names, "canonical_id")
        )

    @property
    def sheet(self) -> DataFrame:
        return self.basket_tables.sheet

    @cached_property
    def ranking(self) -> DataFrame:
        from cartledger.operators.basket import store_ranking

        return store_ranking(self.sheet)

    @cached_property
    def verdicts(self) -> DataFrame:
        """Cached verdicts: each product against the two words of its name."""
        words = F.split(F.element_at(F.split("name", " ", 2), 2), " ")
        rows = self.canonical.select(
            "canonical_id", F.posexplode(words).alias("pos", "term")
        )
        return rows.select(
            (F.col("canonical_id") * 2 + F.col("pos")).alias("verdict_id"),
            "term",
            "canonical_id",
            F.when(F.col("canonical_id") % 4 == 0, "no_match").otherwise("match").alias("verdict"),
            ((F.col("canonical_id") % 31 + 70).cast("double") / 100).alias("confidence"),
            F.concat(F.lit("rule for "), F.col("term")).alias("reason"),
            F.lit("stub").alias("model"),
            F.lit("llm").alias("decided_by"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("canonical_id")).alias("created_at"),
            F.lit(None).cast("timestamp").alias("updated_at"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Open reviews for two thirds of the weak verdicts."""
        return self.verdicts.filter("confidence < 0.85 AND canonical_id % 3 <> 0").select(
            "verdict_id",
            F.when(F.col("canonical_id") % 3 == 1, "open").otherwise("approved").alias("status"),
            F.lit(None).cast("timestamp").alias("resolved_at"),
            F.lit(None).cast("string").alias("resolved_by"),
        )

    @cached_property
    def terms(self) -> DataFrame:
        """Shopping-list terms: every part name and every word in one, in
        alphabetical order; category is the noun where the term ends in one."""
        names = self.table("part").select("p_name").distinct()
        noun = F.element_at(F.split("p_name", " "), -1)
        terms = (
            names.select(F.col("p_name").alias("keyword"), noun.alias("coarse"))
            .unionByName(names.select(F.element_at(F.split("p_name", " "), 1).alias("keyword"),
                                      F.lit(None).cast("string").alias("coarse")))
            .unionByName(names.select(noun.alias("keyword"), noun.alias("coarse")))
            .distinct()
        )
        return terms
