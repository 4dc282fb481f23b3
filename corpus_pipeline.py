"""The corpus pipeline: quality, near-dedup, decontamination, mixing, sharding.

Every stage judges whole texts of any length. A null text has no words: quality rejects it as it rejects
all short texts; a stage that gets one keeps it. A null doc_id, lang or source is a value like any other. Rows that repeat
share their fate, but for near-dedup, where one row of equal id and text stays. Ties of near copies go to the
smallest doc_id, those of shards to the lowest. Empty tables stay empty, and columns of any other name pass through.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartledger.llm import decontamination, mixing, near_dedup, quality, sharding
from cartledger.llm.texts import text_key
from cartledger.session import work_dir
from checks.harness import shared_folder


def _only(docs: DataFrame, judged: DataFrame, *also: str) -> DataFrame:
    """Rows of ``docs`` whose doc_id, text and ``also`` columns are among those of ``judged``; null is a value like any other."""
    keys = ["doc_id", *also]
    ids = judged.select(*[F.col(k).alias(f"{k}_") for k in keys], "body", "body2").distinct()
    body, body2 = text_key()
    on = (body == ids["body"]) & (body2 == ids["body2"])
    for k in keys:
        on = on & docs[k].eqNullSafe(ids[f"{k}_"])
    return docs.join(ids, on, "left_semi")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return _only(docs, quality.judged(docs).where("kept"), "lang", "source")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and one row of it: repeats have equal id and text.

    Of such repeats the row whose other columns are least stays.
    """
    kept, rest = _only(docs, near_dedup.survivors(docs)), [c for c in docs.columns if c not in ("doc_id", "text")]
    if not rest:
        return kept.distinct()
    return kept.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("rest_")).select("doc_id", "text", "rest_.*").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _only(docs, decontamination.judged(docs, items).where("not contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, as often as the mix of its source takes it."""
    return mixing.mixed(docs).select(*docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row; equal texts stay together."""
    return sharding.sharded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Mixing bisects an exponent and sharding iterates, which one SQL statement does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_folder(spark)
    folder = os.path.join(work_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
