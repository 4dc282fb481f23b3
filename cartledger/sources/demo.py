"""The demo data set: 26 products at up to four sources, one basket."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.pricing import ad_week, discount_pct
from ..functions.taxonomy import list_to_coarse
from ..schemas import conform

DEMO_SOURCES = list(V.DEMO_STORES)


def source_dimension(spark: SparkSession, extra: tuple = ()) -> DataFrame:
    names = "source string, banner string, chain_parent string, access_method string, confidence_tier string"
    return spark.createDataFrame([*V.SOURCES, *extra], names)


def shopping_list(spark: SparkSession) -> DataFrame:
    """(position, category, label, keyword, quantity, coarse)."""
    rows = [(i, *row) for i, row in enumerate(V.SHOPPING_LIST, 1)]
    df = spark.createDataFrame(
        rows, "position int, category string, label string, keyword string, quantity bigint"
    )
    return df.withColumn("coarse", list_to_coarse(F.col("category")))


def demo_tables(spark: SparkSession, now: datetime.datetime) -> dict[str, DataFrame]:
    """The demo tables by name. Writing them with overwrite replaces an earlier
    demo; nothing is random."""
    offers = [
        (label, name, size, source, price, confidence, V.DEMO_REGULAR_PRICES.get((label, source)))
        for label, name, size, carriers in V.DEMO_CATALOG
        for source, (price, confidence) in carriers.items()
    ]
    carried = spark.createDataFrame(
        offers,
        "label string, name string, size string, source string, price double,"
        " confidence double, regular double",
    )
    wanted = shopping_list(spark)
    items = wanted.join(carried.select("label", "name").distinct(), "label").withColumn(
        "canonical_id", F.col("position").cast("bigint")
    )
    at = F.lit(now).cast("timestamp")
    rows = carried.join(items.select("label", "canonical_id", "coarse"), "label").withColumn(
        "source_product_id",
        F.col("canonical_id") * 10
        + F.array_position(F.array(*[F.lit(s) for s in DEMO_SOURCES]), F.col("source")),
    )
    store = F.create_map(*[F.lit(x) for s, (sid, _) in V.DEMO_STORES.items() for x in (s, sid)])
    source_products = rows.select(
        "source_product_id", "source",
        F.concat(F.lit("demo-"), "source", F.lit("-"), "label").alias("source_sku"),
        F.col("name").alias("raw_name"),
        F.col("size").alias("raw_size_text"),
        F.col("coarse").alias("coarse_category"),
        "canonical_id",
        F.col("confidence").alias("match_confidence"),
        F.lit(V.DEMO_METHOD).alias("match_method"),
        at.alias("resolved_at"), at.alias("first_seen_at"), at.alias("last_seen_at"),
    )
    prices = rows.select(
        F.col("source_product_id").alias("price_id"), "source_product_id", "source",
        store[F.col("source")].alias("store_id"),
        F.lit("demo").alias("region"),
        at.alias("observed_at"), ad_week(at).alias("ad_week"),
        "price", F.col("regular").alias("regular_price"),
        F.col("regular").isNotNull().alias("is_promo"),
        discount_pct(F.col("regular"), F.col("price")).alias("discount_pct"),
        F.lit(0.99).alias("confidence"),
    )
    basket = spark.createDataFrame(
        [(1, V.DEMO_BASKET_NAME, 4, True, "seeded demo dataset")],
        "basket_id bigint, name string, household_size int, is_synthetic boolean, notes string",
    ).withColumn("created_at", at)
    stores = spark.createDataFrame(
        [(s, sid, name, "demo") for s, (sid, name) in V.DEMO_STORES.items()],
        "source string, store_id string, name string, region string",
    )
    tables = {
        "stores": stores,
        "canonical_products": items.select(
            "canonical_id", "name", "category", F.col("coarse").alias("coarse_category"),
            at.alias("created_at"),
        ),
        "source_products": source_products,
        "prices": prices,
        "baskets": basket,
        "basket_items": items.select(
            F.lit(1).cast("bigint").alias("basket_id"), "canonical_id", "category", "label", "quantity"
        ),
    }
    tables = {name: conform(df, name) for name, df in tables.items()}
    tables["sources"] = source_dimension(spark, (V.DEMO_EXTRA_SOURCE,))
    return tables
