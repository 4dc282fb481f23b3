"""The registered pipeline and queries on the smallest tables."""

import numpy as np

import corpus_pipeline
from cartledger.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.selectExpr("*", "'x' AS kept", "1L AS node")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, SF).columns == extra.columns
        assert stage(spark, extra.limit(0), SF).isEmpty()


def test_run_shards_what_the_stages_keep(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert 0 < out["doc_id"].nunique() < len(ids) and set(out["doc_id"]) <= ids
    sizes = out.groupby("shard").size().reindex(range(24), fill_value=0)
    assert sizes.max() - sizes.min() <= 1


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def told(n, seed):
    return " ".join(np.random.default_rng(seed).choice([f"v{i}" for i in range(300)], n))


def test_stages_tell_rows_apart_by_id_and_text(spark):
    """Null ids, and one id with several texts: every row gets the decision on its own text."""
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    passage = max(items, key=len)
    plain = [told(80, i) for i in range(6)]
    near = " ".join("other" if k == 40 else w for k, w in enumerate(plain[4].split()))
    rejected, leaked = "la " * 200, told(60, 7) + " " + passage
    table = [
        (None, plain[0]), (None, plain[1]), (None, rejected), (None, leaked), (None, ""), (None, None), (None, plain[1]),
        (7, plain[2]), (7, plain[3]), (7, plain[3]), (7, rejected), (7, leaked), (7, near), (8, plain[4]), (9, plain[5]),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in table], "doc_id long, text string, lang string, source string")

    def kept(stage):
        return sorted(((r.doc_id, r.text) for r in stage(spark, docs, SF).collect()), key=repr)

    def want(rows):
        return sorted(rows, key=repr)

    assert kept(corpus_pipeline.keep_quality) == want([r for r in table if r[1] not in (rejected, "", None)])
    one_of_each = {(i, t) for i, t in table} - {(8, plain[4]), (None, rejected), (None, leaked)}
    assert kept(corpus_pipeline.drop_near_duplicates) == want(one_of_each)
    assert kept(corpus_pipeline.drop_contaminated) == want([r for r in table if r[1] != leaked])
    assert sorted({(r.doc_id, r.text) for r in corpus_pipeline.mix_sources(spark, docs, SF).collect()}, key=repr) == want(set(table))
    assert corpus_pipeline.assign_shards(spark, docs, SF).count() == len(table)
