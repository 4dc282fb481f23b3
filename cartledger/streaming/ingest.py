"""Incremental ingest of landed payloads as a file stream.

The stream reads files of artifacts (manifest_id, source, store_id, region,
fetched_at, payload). Each micro-batch writes its price rows and its folded
sightings under ``batch=<id>``, replacing that folder: a batch replayed after a
failure gives the same files, and together with the stream checkpoint every
artifact counts once. A delivery is known by its ``manifest_id``, which the stream keeps as keyed
state: a second delivery within ``REMEMBERED`` of the first is dropped before its batch, without a look at
what is stored. The watermark that ends that memory runs on the time of arrival, so late observations are never dropped:
current prices order by ``observed_at``, and an older row never displaces a newer one.
The same payload from another store, or fetched at another time, is an observation of its own, and
a record is known by its place in the payload: equal records without a sku stay apart.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import PARSED_SOURCES
from ..functions.taxonomy import coarse_category
from ..operators.state import fold_states, price_observations, source_product_table, upsert_source_products
from ..sources.artifacts import is_pending, pending
from ..sources.catalogs import is_unreadable, parse_breadcrumb, parse_first_item, parse_string_price
from ..sources.pages import deal_records, parse_deals

ARTIFACT_SCHEMA = """manifest_id bigint, source string, store_id string, region string,
    fetched_at timestamp, request_params string, payload string"""

KEYS = ["manifest_id", "store_id", "region", "fetched_at"]
ARRIVAL = ["fetched_at", "manifest_id", "line"]
#: How long the stream knows a delivery again.
REMEMBERED = "30 days"
#: Where the stream keeps the deliveries it knows: on the executors' disks, in memory only as far as the bound of an executor goes.
#: Spark's default store holds all of them in the executors' heap, twice while a batch runs.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
}


def _deals(artifacts: DataFrame, keys: list[str], line: str | None = None) -> DataFrame:
    pages = artifacts.withColumn("html", F.col("payload"))
    return deal_records(parse_deals(pages, keys), keys, line=line)


PARSERS = {
    "kroger": parse_first_item,
    "wholefoods": parse_breadcrumb,
    "traderjoes": parse_string_price,
    "aldi_kcl": _deals,
}


def parse_artifacts(artifacts: DataFrame, parsers: dict = PARSERS) -> DataFrame:
    """Price records of every known source, categories assigned. ``line`` is a record's place
    in its artifact."""
    parsed = reduce(
        DataFrame.unionByName,
        [parse(artifacts.filter(F.col("source") == s), KEYS, line="line") for s, parse in parsers.items()],
    )
    return parsed.withColumn(
        "coarse_category", coarse_category(F.col("category_hint"), F.col("raw_name"))
    )


def _usual(artifacts: DataFrame) -> DataFrame:
    """An artifact without a status is pending; one without request parameters is what its source usually sends."""
    for name, default in (("parse_status", "pending"), ("request_params", None)):
        if name not in artifacts.columns:
            artifacts = artifacts.withColumn(name, F.lit(default).cast("string"))
    usual = {s: F.to_json(F.create_map(F.lit(rule[0].removeprefix("$.")), F.lit(rule[1])))
             for s, rule in PARSED_SOURCES.items() if rule}
    params = F.col("request_params")
    for source, value in usual.items():
        params = F.when((F.col("source") == source) & F.col("request_params").isNull(), value).otherwise(params)
    status = F.coalesce("parse_status", F.lit("pending"))
    return artifacts.withColumns({"parse_status": status, "request_params": params})


def waiting(artifacts: DataFrame) -> DataFrame:
    """Artifacts that a parser takes: see ``pending``."""
    return pending(_usual(artifacts))


def sightings(records: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """Folded source-product state of some records (see the upsert)."""
    return upsert_source_products(old, records.withColumn("seen_at", F.col("fetched_at")), ARRIVAL)


def prices_of(records: DataFrame) -> DataFrame:
    """Price rows keyed by the content-derived product id."""
    lone = F.concat(F.lit("\u0002"), F.concat_ws("|", *[F.col(c).cast("string") for c in ARRIVAL]))
    key = F.concat_ws("\u0001", "source", F.coalesce("source_sku", lone))
    rows = records.withColumn("observed_at", F.col("fetched_at")).select(
        F.xxhash64("manifest_id", "line").alias("price_id"),
        F.xxhash64(key).alias("source_product_id"),
        "source", "store_id", "region", "observed_at",
        F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("regular_price").cast("decimal(10,2)").alias("regular_price"),
        F.col("unit_price").cast("decimal(12,4)").alias("unit_price"),
        "unit", "is_promo", "discount_pct", "promo_text",
        F.col("manifest_id").alias("bronze_manifest_id"),
    )
    return price_observations(rows)


def _table(root: str, name: str) -> str:
    return os.path.join(root, name)


def ingest_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Write one micro-batch; running it again replaces its own output only. That no delivery of an earlier batch
    is among its rows is up to the stream's state."""
    _ingest_once(batch.dropDuplicates(["manifest_id"]), batch_id, root)


def _ingest_once(batch: DataFrame, batch_id: int, root: str) -> None:
    """The batch of a stream that gives every ``manifest_id`` once: no payload is sorted or dealt anew. What becomes of an
    artifact is read off its own row, and its payload is parsed once for both tables of its records."""
    rows = _usual(batch).withColumn("taken", F.coalesce(is_pending(), F.lit(False))).persist()
    taken = rows.filter("taken")
    known = F.col("taken") & F.col("manifest_id").isNotNull()
    failed = known & (F.col("source") != "aldi_kcl") & is_unreadable(F.col("payload"))
    log = rows.select(
        "manifest_id", "source", F.sha2("payload", 256).alias("sha"),
        F.when(failed, "failed").when(known, "parsed").otherwise("pending").alias("parse_status"),
    )
    records = parse_artifacts(taken).persist()
    folder = f"batch={batch_id}"
    prices_of(records).write.mode("overwrite").parquet(os.path.join(root, "prices", folder))
    sightings(records).write.mode("overwrite").parquet(os.path.join(root, "sightings", folder))
    log.write.mode("overwrite").parquet(os.path.join(_table(root, "artifacts"), folder))
    records.unpersist()
    rows.unpersist()


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """``STATE_STORE`` for streams that start meanwhile, unless the session names a store of its own. A stream that was started
    before goes on with the store in its checkpoint."""
    own = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    new = {} if own else {k: v for k, v in STATE_STORE.items() if spark.conf.get(k, None) is None}
    try:
        for key, value in new.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key in new:
            spark.conf.unset(key)


def ingest_stream(
    spark: SparkSession, incoming: str, root: str, file_format: str = "json", remembered: str = REMEMBERED
):
    """Ingest every file not ingested yet, then stop (``availableNow``). State of ``remembered`` deliveries is
    dealt by manifest id over the shuffle partitions of the first start."""
    files = (
        spark.readStream.format(file_format)
        .schema(" ".join(ARTIFACT_SCHEMA.split()))
        .load(incoming)
    )
    once = (
        files.withColumn("arrived_at", F.current_timestamp())
        .withWatermark("arrived_at", remembered)
        .dropDuplicatesWithinWatermark(["manifest_id"])
        .drop("arrived_at")
    )
    writer = (
        once.writeStream.foreachBatch(lambda df, i: _ingest_once(df, i, root))
        .option("checkpointLocation", os.path.join(root, "stream-checkpoint"))
        .trigger(availableNow=True)
    )
    with _state_store(spark):
        return writer.start()


def ingested_prices(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(_table(root, "prices")).drop("batch")


def ingested_products(spark: SparkSession, root: str) -> DataFrame:
    """Source products: the batches' folded sightings, folded once more."""
    state = spark.read.parquet(_table(root, "sightings")).drop("batch")
    none = state.limit(0)
    return source_product_table(fold_states(state, none))
