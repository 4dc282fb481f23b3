import datetime
import json
import tempfile

from pyspark.sql import functions as F

from cartledger import fixed_values as V
from cartledger import schemas
from cartledger.operators import basket as B
from cartledger.plans import jobs
from cartledger.streaming import ingest as I

AT = datetime.datetime(2026, 7, 8, 10)


def product(sku, name, price):
    return {"productId": sku, "description": name, "categories": ["Dairy"], "items": [{"price": {"regular": price}, "size": "1 gal"}]}


def artifact(i, hours, *products, source="kroger", payload=None):
    return {"manifest_id": i, "source": source, "store_id": "s1", "region": "r",
            "fetched_at": (AT + datetime.timedelta(hours=hours)).isoformat(),
            "payload": payload or json.dumps({"data": list(products)})}


def drop(folder, name, *artifacts):
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(a) for a in artifacts))


def test_stream_counts_every_artifact_once(spark):
    incoming, root = tempfile.mkdtemp(), tempfile.mkdtemp()
    drop(incoming, "a", artifact(1, 0, product("1", "Milk", 3.0), product("2", "Cream", 2.0)), artifact(2, 0, payload="oops"))
    I.ingest_stream(spark, incoming, root).awaitTermination()
    assert I.ingested_prices(spark, root).count() == 2
    # the same payload again, a newer price, and an older one arriving late
    drop(incoming, "b", artifact(3, 1, product("1", "Milk", 3.0), product("2", "Cream", 2.0)),
         artifact(4, 2, product("1", "Whole Milk", 3.5)), artifact(5, -5, product("1", "Past Milk", 2.5)))
    I.ingest_stream(spark, incoming, root).awaitTermination()
    I.ingest_stream(spark, incoming, root).awaitTermination()
    prices = I.ingested_prices(spark, root)
    assert prices.count() == 6 and {str(r.ad_week) for r in prices.collect()} == {"2026-07-08"}
    products = {r.source_sku: r for r in I.ingested_products(spark, root).collect()}
    assert len(products) == 2 and products["1"].raw_name == "Whole Milk" and products["1"].coarse_category == "dairy"
    assert {r.parse_status for r in spark.read.parquet(f"{root}/artifacts").filter("manifest_id = 2").collect()} == {"failed"}
    latest = jobs.gold_current_prices(
        prices,
        I.ingested_products(spark, root).withColumn("canonical_id", F.col("source_product_id")).withColumn("match_confidence", F.lit(1.0)),
        I.ingested_products(spark, root).select(F.col("source_product_id").alias("canonical_id"), F.col("raw_name").alias("name"), F.lit("c").alias("category")),
        schemas.empty(spark, "stores"),
    )
    assert sorted(float(r.price) for r in latest.collect()) == [2.0, 3.5]


def test_a_replayed_batch_changes_nothing(spark):
    root = tempfile.mkdtemp()
    schema = " ".join(I.ARTIFACT_SCHEMA.split())
    batch = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(artifact(1, 0, product("1", "Milk", 3.0)))]))
    for batch_id in (0, 1, 1):
        I.ingest_batch(batch if batch_id else batch.limit(0), batch_id, root)
    assert I.ingested_prices(spark, root).count() == 1


def test_a_delivery_is_known_again(spark):
    """The same manifest id in a later file and twice in one file; the state outlives the query."""
    incoming, root = tempfile.mkdtemp(), tempfile.mkdtemp()
    one, two = artifact(1, 0, product("1", "Milk", 3.0)), artifact(2, 0, product("1", "Milk", 3.0))
    drop(incoming, "a", one, one)
    I.ingest_stream(spark, incoming, root).awaitTermination()
    drop(incoming, "b", one, two)
    I.ingest_stream(spark, incoming, root).awaitTermination()
    assert sorted(r.bronze_manifest_id for r in I.ingested_prices(spark, root).collect()) == [1, 2]
    assert spark.read.parquet(f"{root}/artifacts").count() == 2


def test_known_deliveries_are_kept_on_disk(spark):
    """The stream's state lies in RocksDB within a bound of memory; a store that the session names stays, and so does the session."""
    key, bound = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"

    def store(root):
        with open(f"{root}/stream-checkpoint/offsets/0") as f:
            return json.loads(f.read().split("\n")[1])["conf"][key]

    incoming, own = tempfile.mkdtemp(), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    drop(incoming, "a", artifact(1, 0, product("1", "Milk", 3.0)))
    first, second = tempfile.mkdtemp(), tempfile.mkdtemp()
    I.ingest_stream(spark, incoming, first).awaitTermination()
    assert store(first).endswith("RocksDBStateStoreProvider") and spark.conf.get(key, None) is spark.conf.get(bound, None) is None
    spark.conf.set(key, own)
    try:
        I.ingest_stream(spark, incoming, second).awaitTermination()
        assert store(second) == spark.conf.get(key) == own
    finally:
        spark.conf.unset(key)
    drop(incoming, "b", artifact(1, 1, product("1", "Milk", 4.0)), artifact(2, 1, product("1", "Milk", 5.0)))
    for root in (first, second):  # a stream goes on with the store it has
        I.ingest_stream(spark, incoming, root).awaitTermination()
        assert sorted(float(r.price) for r in I.ingested_prices(spark, root).collect()) == [3.0, 5.0]


def test_a_payload_is_parsed_once(spark, monkeypatch):
    """Prices and sightings read the same records; what becomes of an artifact needs no join."""
    incoming, root, parsed = tempfile.mkdtemp(), tempfile.mkdtemp(), spark.sparkContext.accumulator(0)
    drop(incoming, "a", artifact(1, 0, product("1", "Milk", 3.0), product("2", "Cream", 2.0)), artifact(2, 0, payload="oops"),
         artifact(3, 0, source="elsewhere"), artifact(None, 0, product("3", "Rice", 1.0)))
    parse = I.parse_artifacts

    def counted(artifacts):
        def count(frames):
            for frame in frames:
                parsed.add(len(frame))
                yield frame

        records = parse(artifacts)
        return records.mapInPandas(count, records.schema)

    monkeypatch.setattr(I, "parse_artifacts", counted)
    I.ingest_stream(spark, incoming, root).awaitTermination()
    assert parsed.value == 3 == I.ingested_prices(spark, root).count() == I.ingested_products(spark, root).count()
    log = {r.manifest_id: r.parse_status for r in spark.read.parquet(f"{root}/artifacts").collect()}
    assert log == {1: "parsed", 2: "failed", 3: "pending", None: "pending"}


def test_equal_rows_of_a_payload_stay_apart(spark):
    """Two equal rows without sku, and two whose prices differ by which one is null."""
    schema = " ".join(I.ARTIFACT_SCHEMA.split())
    lone = [product(None, "Loose Pear", 3.0), product(None, "Loose Pear", 3.0), product(None, "Plum", None)]
    lone[2]["items"][0]["price"] = {"promo": 3.0}
    lone.append(product(None, "Plum", 3.0))
    artifacts = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(artifact(1, 0, *lone)), json.dumps(artifact(2, 0, payload="oops"))]))
    tables = {n: schemas.empty(spark, n) for n in schemas.DDL if n != "record"}
    out = jobs.normalize(artifacts, tables, F.lit(AT))
    assert out["source_products"].select("source_product_id").distinct().count() == 4
    prices = out["prices"].collect()
    assert len({r.price_id for r in prices}) == len({r.source_product_id for r in prices}) == 4
    # the first of each name founds, the second is linked to it
    methods = sorted((r.raw_name, r.match_method) for r in out["source_products"].collect())
    assert methods == sorted([("Loose Pear", V.METHOD_FUZZY), ("Loose Pear", V.METHOD_SEED), ("Plum", V.METHOD_FUZZY), ("Plum", V.METHOD_NEW)])
    assert {r.resolved_at for r in out["source_products"].collect()} == {AT} == {r.created_at for r in out["canonical_products"].collect()}
    manifest = {r.manifest_id: (r.parse_status, r.parser_version) for r in out["bronze_manifest"].collect()}
    assert manifest[1][0] == "parsed" and manifest[1][1] and manifest[2] == ("failed", None)


def test_founders_follow_arrival(spark):
    """Whichever product came first founds: by sighting, artifact and place, not by any hash."""
    schema = " ".join(I.ARTIFACT_SCHEMA.split())
    names = [f"Brand {c} Olive Oil" for c in "xyzw"]
    rows = [artifact(9 - i, i, product(str(50 - i), names[i], 3.0), product(f"b{i}", f"{names[i]}s", 3.0)) for i in range(4)]
    artifacts = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    tables = {n: schemas.empty(spark, n) for n in schemas.DDL if n != "record"}
    out = jobs.normalize(artifacts, tables)
    seed = out["source_products"].filter(F.col("match_method") == V.METHOD_SEED).collect()
    assert [r.raw_name for r in seed] == [names[0]] and out["canonical_products"].count() == 1


def test_normalize_job(spark):
    schema = " ".join(I.ARTIFACT_SCHEMA.split())
    rows = [artifact(1, 0, product("1", "Whole Milk", 3.0)),
            artifact(2, 0, source="wholefoods", payload=json.dumps(
                {"breadcrumb": [{"label": "Dairy"}], "results": [{"name": "Milk, Whole", "slug": "m", "regularPrice": 4.0, "uom": "ea"}]}))]
    artifacts = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    tables = {n: schemas.empty(spark, n) for n in schemas.DDL if n != "record"}
    out = {**tables, **jobs.normalize(artifacts, tables)}
    assert out["canonical_products"].count() == 1
    gold = jobs.current_gold(out)
    assert sorted((r.source, float(r.price), r.match_confidence) for r in gold.collect()) == [("kroger", 3.0, 1.0), ("wholefoods", 4.0, 1.0)]
    assert B.product_offers(gold).first().n_sources == 2
    assert jobs.rebuild_resolution(out["source_products"]).filter("canonical_id IS NOT NULL").count() == 0


def test_normalize_keeps_what_is_stored(spark):
    schema = " ".join(I.ARTIFACT_SCHEMA.split())
    def read(*rows):
        return spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    tables = {n: schemas.empty(spark, n) for n in schemas.DDL if n != "record"}
    first = artifact(1, 0, product("1", "Milk", 3.0))
    tables |= jobs.normalize(read(first), tables)
    tables |= jobs.normalize(read(first, artifact(2, 168, product("1", "Whole Milk", 3.0)), artifact(3, 168, product("9", "Rice", 2.0)),
                                  artifact(4, 1, product("1", "Milk", 3.0)) | {"store_id": "s2"},
                                  artifact(5, 0, product("7", "Store", 1.0)) | {"request_params": '{"endpoint": "locations"}'}), tables)
    assert sorted((r.source_sku, r.raw_name) for r in tables["source_products"].collect()) == [("1", "Whole Milk"), ("9", "Rice")]
    assert sorted((r.bronze_manifest_id, float(r.price)) for r in tables["prices"].collect()) == [(1, 3.0), (2, 3.0), (3, 2.0), (4, 3.0)]
    assert tables["source_products"].filter("canonical_id IS NULL").isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_plans(spark):
    from checks.roles import Roles

    r = Roles(spark, "/root/testdata/sf0.001")
    gold = plan_of(r.gold)
    assert "WindowGroupLimit" in gold and "Python" not in gold and "CartesianProduct" not in gold
    assert "NestedLoop" not in plan_of(B.verdict(r.sheet)) and "Python" not in plan_of(B.verdict(r.sheet))
    lines = plan_of(r.items)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in lines
    picked = plan_of(r.table("lineitem").filter("l_suppkey = 3").select("l_partkey"))
    assert "EqualTo(l_suppkey,3)" in picked


def test_every_query_has_a_twin():
    from checks import registry, registry_ingest, registry_match  # noqa: F401

    assert set(registry.ORACLE) == set(registry.QUERIES) and len(registry.QUERIES) > 70
