"""Registered queries: name -> (Spark query, SQL twin or None)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartledger.operators import basket as B
from cartledger.operators import gold as G
from cartledger.operators import keyed_table as K
from cartledger.session import work_dir

from .harness import shared_folder
from .oracle import sql
from .roles import PRICE_TIES, Roles

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, twin: str | None = None, **extra: str):
    def add(fn):
        def run(spark, sf_dir):
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # ad weeks and stamps
            shared_folder(spark)
            return fn(Roles(spark, sf_dir))

        QUERIES[name] = run
        if twin is not None:
            ORACLE[name] = sql(twin, **extra)
        return fn

    return add


def dbl(*names):
    return [F.col(n).cast("double").alias(n) for n in names]


def day(name):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def joined(name):
    return F.array_join(name, ",").alias(name)


@query(
    "gold_current_prices",
    """SELECT canonical_id, canonical_name, category, coarse_category, source, store_id,
       store_name, store_region, strftime(ad_week, '%Y-%m-%d') AS ad_week,
       strftime(observed_at, '%Y-%m-%d') AS observed_at, price::DOUBLE AS price,
       regular_price::DOUBLE AS regular_price, unit_price, unit, is_promo,
       source_product_id, match_confidence, price_id FROM gold""",
)
def _(r):
    return r.gold.select(
        "canonical_id", "canonical_name", "category", "coarse_category", "source", "store_id",
        "store_name", "store_region", day("ad_week"), day("observed_at"),
        *dbl("price", "regular_price", "unit_price"), "unit", "is_promo", "source_product_id",
        "match_confidence", "price_id",
    )


@query(
    "gold_incremental",
    """SELECT canonical_id, source, store_id, source_product_id, strftime(observed_at, '%Y-%m-%d') AS observed_at,
       price::DOUBLE AS price, price_id FROM gold""",
)
def _(r):
    """A snapshot of the prices before 1997 kept up by the weeks after, each in a refresh of its own."""
    columns = [f.name for f in G.latest_prices(r.prices.limit(0), PRICE_TIES).schema]
    prices = r.prices.select(*[c for c in columns if c in r.prices.columns])
    latest = K.KeyedTable(
        r.spark, f"{work_dir(r.spark)}/latest-{uuid.uuid4().hex}", ("source_product_id", "store_id"),
        G.latest_prices(prices, PRICE_TIES)._jdf.schema().toDDL(), parts=16,
    )
    edges = ["1900-01-01", "1997-01-01", "1998-01-01", "2100-01-01"]
    for lo, hi in zip(edges, edges[1:], strict=False):
        rows = prices.filter(F.col("observed_at").between(lo, F.expr(f"timestamp'{hi}' - interval 1 second")))
        if lo == edges[0]:
            latest.create(G.latest_prices(rows, PRICE_TIES))
        else:
            K.refresh_latest(latest, G.latest_prices(rows, PRICE_TIES), PRICE_TIES)
    gold = G.gold_of_latest(latest.read(), r.source_products, r.canonical, r.stores)
    return gold.select("canonical_id", "source", "store_id", "source_product_id", day("observed_at"), *dbl("price"), "price_id")


@query(
    "cheapest_source_per_item",
    """SELECT canonical_id, source, store_id, unit_price, unit, price_id FROM gold
       QUALIFY row_number() OVER (PARTITION BY canonical_id
         ORDER BY unit_price ASC NULLS LAST, source, store_id, price_id) = 1""",
)
def _(r):
    return G.cheapest_source_per_item(r.gold).select(
        "canonical_id", "source", "store_id", *dbl("unit_price"), "unit", "price_id"
    )


@query(
    "basket_item_cost",
    """SELECT basket_id, category, label, quantity, canonical_id, source, store_id,
       price::DOUBLE AS price, unit_price, line_cost::DOUBLE AS line_cost, price_id FROM item_cost""",
)
def _(r):
    return B.basket_item_cost(r.items, r.offers).select(
        "basket_id", "category", "label", "quantity", "canonical_id", "source", "store_id",
        *dbl("price", "unit_price", "line_cost"), "price_id",
    )


@query(
    "basket_store_totals",
    """SELECT basket_id, source, count(*) AS items_covered,
       sum(price * quantity)::DOUBLE AS store_total
       FROM (SELECT * FROM items JOIN offers USING (canonical_id) WHERE mode = 'flexible')
       GROUP BY basket_id, source""",
)
def _(r):
    return B.basket_store_totals(r.items, r.offers).select(
        "basket_id", "source", "items_covered", *dbl("store_total")
    )


@query(
    "store_ranking",
    """SELECT basket_id, mode, source, items_covered, n_items, store_total::DOUBLE AS store_total,
       missing_count, full_coverage, rank FROM ranking""",
)
def _(r):
    return r.ranking.withColumn("store_total", F.col("store_total").cast("double"))


@query(
    "verdict_winner",
    "SELECT basket_id, mode, source, store_total::DOUBLE AS store_total, n_items FROM winners",
)
def _(r):
    return B.verdict_winner(r.ranking).select(
        "basket_id", "mode", "source", *dbl("store_total"), "n_items"
    )


@query(
    "store_deltas",
    """SELECT basket_id, mode, source, store_total::DOUBLE AS store_total, w::DOUBLE AS winner_total,
       CASE WHEN store_total > w THEN (store_total - w)::DOUBLE END AS above_winner
       FROM (SELECT *, max(CASE WHEN rank = 1 AND full_coverage THEN store_total END)
         OVER (PARTITION BY basket_id, mode) AS w FROM ranking)""",
)
def _(r):
    return B.store_deltas(r.ranking).select(
        "basket_id", "mode", "source", *dbl("store_total", "winner_total", "above_winner")
    )


@query(
    "runner_up",
    """SELECT w.basket_id, w.mode, w.source AS winner, w.store_total::DOUBLE AS winner_total,
       n.source AS runner_up, n.store_total::DOUBLE AS runner_up_total,
       (n.store_total - w.store_total)::DOUBLE AS saving
       FROM winners w LEFT JOIN (SELECT * FROM ranking WHERE rank = 2 AND full_coverage) n
       ON n.basket_id = w.basket_id AND n.mode = w.mode""",
)
def _(r):
    return B.runner_up(r.ranking).select(
        "basket_id", "mode", "winner", "runner_up",
        *dbl("winner_total", "runner_up_total", "saving"),
    )


@query(
    "missing_items",
    """SELECT s.basket_id, s.mode, s.source, i.canonical_id, i.label
       FROM (SELECT basket_id, mode, source FROM ranking) s JOIN items i ON i.basket_id = s.basket_id
       LEFT JOIN offers o ON o.canonical_id = i.canonical_id AND o.source = s.source AND o.mode = s.mode
       WHERE o.canonical_id IS NULL""",
)
def _(r):
    return r.basket_tables.missing


@query(
    "missing_counts",
    """SELECT i.basket_id, i.canonical_id, i.label,
       count(*) FILTER (WHERE s.mode = 'flexible') AS lacking_flexible,
       count(*) FILTER (WHERE s.mode = 'exact') AS lacking_exact
       FROM (SELECT basket_id, mode, source FROM ranking) s JOIN (SELECT DISTINCT basket_id, canonical_id, label FROM items) i ON i.basket_id = s.basket_id
       LEFT JOIN offers o ON o.canonical_id = i.canonical_id AND o.source = s.source AND o.mode = s.mode
       WHERE o.canonical_id IS NULL GROUP BY ALL""",
)
def _(r):
    """Stores that lack each basket line, counted in bits."""
    return B.missing_counts(r.basket_tables.missing_masks)


@query(
    "optimize_basket",
    """SELECT basket_id, n_list, n_items, split_total::DOUBLE AS split_total,
       array_to_string(coalesce(stores_used, []), ',') AS stores_used, best_single_source,
       best_single_total::DOUBLE AS best_single_total, savings_vs_single::DOUBLE AS savings_vs_single,
       multi_source_items, optimizer_value::DOUBLE AS optimizer_value FROM optimized""",
)
def _(r):
    return B.optimize_basket(r.sheet).select(
        "basket_id", "n_list", "n_items", joined("stores_used"), "best_single_source",
        *dbl("split_total", "best_single_total", "savings_vs_single", "optimizer_value"),
        "multi_source_items",
    )


@query(
    "verdict",
    """SELECT basket_id, n_items, n_list, flexible_winner, flexible_total::DOUBLE AS flexible_total,
       exact_winner, exact_total::DOUBLE AS exact_total, has_footnote,
       split_total::DOUBLE AS split_total, array_to_string(stores_used, ',') AS stores_used,
       split_savings::DOUBLE AS split_savings, worth_it FROM verdict""",
)
def _(r):
    return B.verdict(r.sheet).select(
        "basket_id", "n_items", "n_list", "flexible_winner", "exact_winner", "has_footnote",
        *dbl("flexible_total", "exact_total", "split_total", "split_savings"),
        joined("stores_used"), "worth_it",
    )
