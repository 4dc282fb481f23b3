import datetime
import glob
import tempfile

import pytest
from pyspark.sql import functions as F

from cartledger.operators import gold as G
from cartledger.operators import keyed_table as K

VERDICTS = "term string, canonical_id bigint, verdict string, confidence double, reason string, model string, decided_by string, created_at timestamp, updated_at timestamp"


def verdict(term, word, at):
    return (term, 1, word, 0.9, "r", "m", "llm", at, None)


def files(path):
    return {f for f in glob.glob(f"{path}/*/*.parquet")}


def test_untouched_partitions_keep_their_files(spark):
    day = lambda d: datetime.datetime(2024, 6, d)
    path = tempfile.mkdtemp() + "/verdicts"
    table = K.KeyedTable(spark, path, ("term", "canonical_id"), VERDICTS, parts=8)
    table.create(spark.createDataFrame([verdict(f"t{i}", "match", day(1)) for i in range(60)], VERDICTS))
    before = files(path)
    changes = spark.createDataFrame([verdict("t3", "no_match", day(2)), verdict("new", "match", day(2))], VERDICTS)
    touched = K.upsert_verdicts(table, changes)
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if not any(f"key_part={p}/" in f for p in touched)}
    assert kept and kept <= files(path) and not (before - kept) & files(path)
    rows = {r.term: r for r in table.read().collect()}
    assert len(rows) == 61 and rows["t3"].verdict == "no_match" and rows["t3"].created_at == day(1) and rows["t3"].updated_at == day(2)
    K.upsert_verdicts(table, changes)  # again: nothing changes
    assert {r.term: r for r in table.read().collect()} == rows
    assert K.upsert_verdicts(table, changes.limit(0)) == []
    plan = table.read([1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "key_part" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_rows_dealt_for_a_merge_are_not_dealt_again(spark, monkeypatch):
    """Old rows and changes move once each; the merge and the write after it move nothing, and a partition is one file."""
    path = tempfile.mkdtemp() + "/verdicts"
    table = K.KeyedTable(spark, path, ("term", "canonical_id"), VERDICTS, parts=8)
    at = datetime.datetime(2024, 6, 1)
    table.create(spark.createDataFrame([verdict(f"t{i}", "match", at) for i in range(60)], VERDICTS))
    plans, cut = [], K.cut_lineage
    monkeypatch.setattr(K, "cut_lineage", lambda df, *more: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, *more))
    K.upsert_verdicts(table, spark.createDataFrame([verdict(f"t{i}", "no_match", at) for i in range(40, 90)], VERDICTS))
    assert plans[1].count("Exchange") == plans[1].count("REPARTITION_BY_NUM") == 2
    assert len(files(path)) == 8 and table.read().count() == 90


def test_a_table_dealt_by_another_hash_is_refused(spark):
    path = tempfile.mkdtemp() + "/verdicts"
    rows = spark.createDataFrame([verdict(f"t{i}", "match", datetime.datetime(2024, 6, 1)) for i in range(60)], VERDICTS)
    rows.withColumn("key_part", F.expr("cast(pmod(xxhash64(term, canonical_id), 8) AS int)")).write.partitionBy("key_part").parquet(path)
    with pytest.raises(ValueError, match="another hash"):
        K.upsert_verdicts(K.KeyedTable(spark, path, ("term", "canonical_id"), VERDICTS, parts=8), rows.limit(3))


def test_latest_prices_are_kept_up(spark):
    """Snapshot and deltas, an old row arriving late and a null store among them, give the latest of all."""
    rows = spark.range(400).select(
        (F.col("id") % 37).alias("source_product_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("store_id"), F.col("id").alias("price_id"),
        F.expr("date'2024-01-03' + cast(7 * (id * 7 % 5) as int)").alias("ad_week"),
        F.expr("timestamp'2024-01-03' + make_interval(0, 0, id * 7 % 5, id % 4)").alias("observed_at"),
        (F.col("id") % 11).cast("decimal(10,2)").alias("price"),
    )
    folder = tempfile.mkdtemp()
    rows.write.partitionBy("ad_week").parquet(f"{folder}/prices")
    prices = spark.read.parquet(f"{folder}/prices").select(*rows.columns)
    whole = G.latest_prices(prices)
    weeks = sorted(r[0] for r in prices.select("ad_week").distinct().collect())
    table = K.KeyedTable(spark, f"{folder}/latest", ("source_product_id", "store_id"), whole._jdf.schema().toDDL(), parts=4)
    table.create(G.latest_prices(G.price_delta(prices, weeks[2:4])))
    for part in (weeks[4:], weeks[:2], weeks[:1]):
        delta = G.price_delta(prices, part)
        plan = delta._jdf.queryExecution().executedPlan().toString()
        assert "ad_week" in plan.split("PartitionFilters: [")[1].split("]")[0]
        K.refresh_latest(table, G.latest_prices(delta))
    assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
