"""Trust-gated views of current prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V

PRICE_FIELDS = {
    "ad_week": "date",
    "observed_at": "timestamp",
    "price": "decimal(10,2)",
    "regular_price": "decimal(10,2)",
    "unit_price": "double",
    "unit": "string",
    "is_promo": "boolean",
    "discount_pct": "double",
    "promo_text": "string",
    "bronze_manifest_id": "bigint",
}


def or_null(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name``, or a typed NULL where the input does not carry it."""
    return (F.col(name) if name in df.columns else F.lit(None).cast(kind)).alias(name)


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each group. Spark keeps only the running best row of a group
    on the map side (WindowGroupLimit), so a hot group never reaches one task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_prices(prices: DataFrame, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Latest price row per (source product, store); a NULL store is a group of its own.

    Latest rows of parts of the prices merge: the latest of (latest of some rows, other rows) is the latest of all. So a
    snapshot is kept up by new rows alone (see ``keyed_table.refresh_latest``), in any order of arrival.
    """
    facts = prices.select(
        "source_product_id",
        "source",
        "store_id",
        "price_id",
        *[or_null(prices, n, t) for n, t in PRICE_FIELDS.items()],
        *[c for c in tie_break if c not in PRICE_FIELDS],
    )
    return first_per_group(
        facts,
        ["source_product_id", "store_id"],
        [F.desc("observed_at"), F.desc("price_id"), *[F.desc(c) for c in tie_break]],
    )


def price_delta(prices: DataFrame, weeks: list) -> DataFrame:
    """Price rows of some ad weeks: a partition filter where prices are stored by ad week, so that a refresh reads the weeks
    that a delivery touched and no history."""
    return prices.filter(F.col("ad_week").isin(weeks))


def gold_current_prices(
    prices: DataFrame,
    source_products: DataFrame,
    canonical: DataFrame,
    stores: DataFrame,
    min_confidence: float = V.TRUST_CONFIDENCE,
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """Latest trusted price per (source product, store).

    Trust is a property of the source product, so it keeps or drops whole
    groups: taking the latest row first gives the same rows and shrinks the
    fact table before it meets any join. A NULL store is a group of its own.
    """
    latest = latest_prices(prices, tie_break)
    return gold_of_latest(latest, source_products, canonical, stores, min_confidence)


def gold_of_latest(
    latest: DataFrame,
    source_products: DataFrame,
    canonical: DataFrame,
    stores: DataFrame,
    min_confidence: float = V.TRUST_CONFIDENCE,
) -> DataFrame:
    """Gold rows of latest price rows, computed now or kept in a snapshot."""
    trusted = source_products.filter(
        F.col("canonical_id").isNotNull() & (F.col("match_confidence") >= min_confidence)
    ).select("source_product_id", "canonical_id", "match_confidence")
    items = canonical.select(
        "canonical_id",
        F.col("name").alias("canonical_name"),
        "category",
        or_null(canonical, "coarse_category", "string"),
        or_null(canonical, "canonical_unit", "string"),
    )
    places = stores.select(
        "source",
        "store_id",
        F.col("name").alias("store_name"),
        F.col("region").alias("store_region"),
    )
    return (
        latest.join(trusted, "source_product_id")
        .join(items, "canonical_id")
        .join(places, ["source", "store_id"], "left")
        .select(
            "canonical_id", "canonical_name", "category", "coarse_category",
            "canonical_unit", "source", "store_id", "store_name", "store_region",
            "ad_week", "observed_at", "price", "regular_price", "unit_price", "unit",
            "is_promo", "discount_pct", "promo_text", "source_product_id",
            "match_confidence", "price_id", "bronze_manifest_id",
        )
    )


def cheapest_source_per_item(gold: DataFrame, per_unit: bool = False) -> DataFrame:
    """Row with the lowest unit price per product. Units are compared as plain
    numbers; ``per_unit=True`` keeps one winner per unit instead."""
    keys = ["canonical_id", "unit"] if per_unit else ["canonical_id"]
    order = [F.asc_nulls_last("unit_price"), F.asc("source"), F.asc("store_id"), F.asc("price_id")]
    return first_per_group(gold, keys, order)


def cross_store_items(source_products: DataFrame) -> DataFrame:
    """Products resolved at two or more sources."""
    linked = source_products.filter("canonical_id IS NOT NULL")
    pairs = linked.select("canonical_id", "source").distinct()
    return pairs.groupBy("canonical_id").agg(F.count("*").alias("n_sources")).filter(
        "n_sources >= 2"
    )


def gold_report(gold: DataFrame, rows: int = V.REPORT_ROWS) -> DataFrame:
    """First rows by category and name; ties settled down to the price row."""
    order = [
        F.asc_nulls_last("category"), F.asc("canonical_name"), F.asc("source"),
        F.asc("store_id"), F.asc("source_product_id"),
    ]
    cols = ["category", "canonical_name", "source", "store_id", "price", "unit_price",
            "unit", "source_product_id"]
    return gold.select(*cols).orderBy(*order).limit(rows)
