"""State changes as pure functions: old state + changes -> new state.

Upserts are one aggregation by key whose parts are first/last values, so
applying changes in several batches gives the state of applying them at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.pricing import ad_week, source_confidence


def insert_new(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Old rows plus the new rows whose key is not there yet."""
    fresh = new.dropDuplicates(key).join(old.select(*key), key, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def delete_where(df: DataFrame, doomed: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not among ``doomed``."""
    return df.join(doomed.select(*key).distinct(), key, "left_anti")


def deleted_where(df: DataFrame, doomed: DataFrame, key: list[str]) -> DataFrame:
    return df.join(doomed.select(*key).distinct(), key, "left_semi")


# ---- source products -------------------------------------------------------

FIRST_KNOWN = ["category_hint", "coarse_category"]
FIRST_ROW = ["raw_brand"]
LAST_ROW = ["raw_name", "raw_size_text"]


def upsert_source_products(
    old: DataFrame | None, seen: DataFrame, arrival: list[str]
) -> DataFrame:
    """Fold sightings into (source, sku) rows.

    Name and size follow the last sighting, brand the first, category and coarse
    category the first known value; first and last sighting are kept. ``arrival``
    orders sightings totally. A row without sku is a product of its own, told
    apart by its arrival key. State rows carry what later batches need: the
    arrival keys behind each kept value.
    """
    order = F.struct(*arrival)
    lone = F.when(F.col("source_sku").isNull(), F.concat_ws("|", *[F.col(c).cast("string") for c in arrival]))
    rows = seen.select(
        "source",
        "source_sku",
        lone.alias("lone_key"),
        F.struct(order.alias("at"), *LAST_ROW).alias("last_row"),
        F.struct(order.alias("at"), *FIRST_ROW).alias("first_row"),
        *[
            F.when(F.col(c).isNotNull(), F.struct(order.alias("at"), F.col(c).alias("value"))).alias(c)
            for c in FIRST_KNOWN
        ],
        F.col("seen_at").alias("first_seen_at"),
        F.col("seen_at").alias("last_seen_at"),
    )
    if old is not None:
        rows = old.unionByName(rows)
    return rows.groupBy("source", "source_sku", "lone_key").agg(
        F.max("last_row").alias("last_row"),
        F.min("first_row").alias("first_row"),
        *[F.min(c).alias(c) for c in FIRST_KNOWN],
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )


def fold_states(state: DataFrame, other: DataFrame) -> DataFrame:
    """Merge states of different batches; order does not matter."""
    rows = state.unionByName(other)
    keys = ["source", "source_sku", "lone_key"]
    highest = {"last_row", "last_seen_at"}
    return rows.groupBy(*keys).agg(
        *[
            (F.max(c) if c in highest else F.min(c)).alias(c)
            for c in rows.columns
            if c not in keys
        ]
    )


def source_product_table(state: DataFrame, *arrival: str) -> DataFrame:
    """Readable rows of the upsert state, with a content-derived id, and the named parts of the arrival key of the first
    sighting."""
    key = F.concat_ws("\u0001", "source", F.coalesce("source_sku", F.concat(F.lit("\u0002"), "lone_key")))
    return state.select(
        F.xxhash64(key).alias("source_product_id"),
        "source",
        "source_sku",
        *[F.col(f"last_row.{c}").alias(c) for c in LAST_ROW],
        *[F.col(f"first_row.{c}").alias(c) for c in FIRST_ROW],
        *[F.col(f"{c}.value").alias(c) for c in FIRST_KNOWN],
        "first_seen_at",
        "last_seen_at",
        *[F.col(f"first_row.at.{c}").alias(c) for c in arrival],
    )


def price_observations(records: DataFrame, confidence: Column | None = None) -> DataFrame:
    """Price rows from parsed records: ad week and source confidence added."""
    return records.withColumn("ad_week", ad_week(F.col("observed_at"))).withColumn(
        "confidence", source_confidence(F.col("source")) if confidence is None else confidence
    )


# ---- categories --------------------------------------------------------------

def most_common(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent known value per key, ties by the value itself. Counts are
    taken per (key, value) first, so no group is gathered."""
    counts = df.filter(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(key, value).count()
    best = F.min(F.struct((-F.col("count")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(best.alias("best")).select(key, F.col("best.v").alias(value))


def backfill_categories(
    source_products: DataFrame, canonical: DataFrame, classify
) -> tuple[DataFrame, DataFrame]:
    """Fill unknown coarse categories: products from hint and name; canonicals
    from their name, else from the most common category of their products."""
    products = source_products.withColumn(
        "coarse_category",
        F.coalesce("coarse_category", classify(F.col("category_hint"), F.col("raw_name"))),
    )
    inherited = most_common(products, "canonical_id", "coarse_category").withColumnRenamed(
        "coarse_category", "_inherited"
    )
    named = classify(F.lit(None).cast("string"), F.col("name"))
    filled = canonical.join(inherited, "canonical_id", "left").withColumn(
        "coarse_category", F.coalesce("coarse_category", named, "_inherited")
    )
    return products, filled.drop("_inherited")


LINK_FIELDS = ["canonical_id", "match_confidence", "match_method", "resolved_at"]


def sever_cross_category(source_products: DataFrame, canonical: DataFrame) -> DataFrame:
    """Undo fuzzy links between two known, different categories; links made any
    other way stay. Adds ``severed``."""
    theirs = canonical.select("canonical_id", F.col("coarse_category").alias("_theirs"))
    bad = F.coalesce(
        (F.col("match_method") == V.METHOD_FUZZY) & (F.col("coarse_category") != F.col("_theirs")),
        F.lit(False),
    )
    joined = source_products.join(theirs, "canonical_id", "left").withColumn("severed", bad)
    fields = [c for c in LINK_FIELDS if c in source_products.columns]
    cleared = reduce(
        lambda d, c: d.withColumn(c, F.when(~F.col("severed"), F.col(c))), fields, joined
    )
    return cleared.select(*source_products.columns, "severed")


# ---- verdict cache ---------------------------------------------------------------

VERDICT_KEY = ["term", "canonical_id"]
VERDICT_FIELDS = ["verdict", "confidence", "reason", "model", "decided_by"]


def upsert_verdicts(old: DataFrame, changes: DataFrame) -> DataFrame:
    """Latest verdict per (term, product); the first ``created_at`` is kept and
    ``updated_at`` is the time of the last overwrite. ``changes`` carries
    ``created_at``; an unknown verdict word fails the job."""
    legal = F.col("verdict").isin("match", "no_match")
    checked = changes.withColumn(
        "verdict",
        F.when(legal, F.col("verdict")).otherwise(
            F.raise_error(F.concat(F.lit("invalid verdict: "), F.coalesce("verdict", F.lit("NULL"))))
        ),
    )
    def versions(df, at, is_new):
        return df.select(
            *VERDICT_KEY,
            F.struct(
                at.alias("at"), F.lit(is_new).alias("is_new"), *VERDICT_FIELDS
            ).alias("row"),
            F.col("created_at"),
        )
    both = versions(old, F.coalesce("updated_at", "created_at"), 0).unionByName(
        versions(checked, F.col("created_at"), 1)
    )
    out = both.groupBy(*VERDICT_KEY).agg(
        F.max("row").alias("row"), F.min("created_at").alias("created_at")
    )
    at = F.col("row.at")
    return out.select(
        *VERDICT_KEY,
        *[F.col(f"row.{c}").alias(c) for c in VERDICT_FIELDS],
        "created_at",
        F.when(at > F.col("created_at"), at).alias("updated_at"),
    )


def verdict_lookup(verdicts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cached verdicts of the asked pairs."""
    return pairs.join(verdicts, VERDICT_KEY)


def fresh_pairs(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Pairs not decided yet, each once."""
    return pairs.dropDuplicates(VERDICT_KEY).join(
        verdicts.select(*VERDICT_KEY), VERDICT_KEY, "left_anti"
    )


def enqueue_review(
    verdicts: DataFrame, queue: DataFrame, threshold: float = V.TRUST_CONFIDENCE
) -> DataFrame:
    """Reviews to open: weak verdicts without an open review."""
    waiting = queue.filter("status = 'open'").select("verdict_id")
    return (
        verdicts.filter(F.col("confidence") < threshold)
        .select("verdict_id")
        .distinct()
        .join(waiting, "verdict_id", "left_anti")
        .withColumn("status", F.lit("open"))
    )


def apply_reviews(
    verdicts: DataFrame, queue: DataFrame, decisions: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Apply human decisions (verdict_id, approve, decided_at, resolved_by):
    approval keeps the verdict, rejection flips it; both make it a human verdict
    of confidence 1 and close the open review."""
    d = decisions.select(
        "verdict_id",
        F.col("approve").alias("_approve"),
        F.col("decided_at").alias("_at"),
        F.col("resolved_by").alias("_by"),
    )
    hit = F.col("_approve").isNotNull()
    flipped = F.when(F.col("verdict") == "match", "no_match").otherwise("match")
    cache = (
        verdicts.join(d, "verdict_id", "left")
        .withColumn("verdict", F.when(hit & ~F.col("_approve"), flipped).otherwise(F.col("verdict")))
        .withColumn("confidence", F.when(hit, F.lit(1.0)).otherwise(F.col("confidence")))
        .withColumn("decided_by", F.when(hit, F.lit(V.DECIDED_BY_HUMAN)).otherwise(F.col("decided_by")))
        .withColumn("model", F.when(~hit, F.col("model")))
        .withColumn("updated_at", F.when(hit, F.col("_at")).otherwise(F.col("updated_at")))
        .select(*verdicts.columns)
    )
    closing = hit & (F.col("status") == "open")
    word = F.when(F.col("_approve"), "approved").otherwise("rejected")
    closed = (
        queue.join(d, "verdict_id", "left")
        .withColumn("_close", closing)
        .withColumn("status", F.when(F.col("_close"), word).otherwise(F.col("status")))
        .withColumn("resolved_at", F.when(F.col("_close"), F.col("_at")).otherwise(F.col("resolved_at")))
        .withColumn("resolved_by", F.when(F.col("_close"), F.col("_by")).otherwise(F.col("resolved_by")))
        .select(*queue.columns)
    )
    return cache, closed
