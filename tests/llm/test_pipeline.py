from collections import Counter

import corpus_pipeline
from condoflow.llm.common import staged
from tests.llm import brute


def test_stages_of_awkward_rows(spark, tmp_path):
    data = brute.awkward()
    docs = spark.createDataFrame(data, brute.SCHEMA)
    spark.createDataFrame([(1, 1), (2, 1), (3, 0), (9, 0), (11, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, brute.passage(2, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, str(tmp_path)))
        had, has = (Counter((r.doc_id, r.text) for r in x.collect()) for x in (before, docs))
        assert set(has) <= set(had)
        if name != "sharding":
            assert docs.schema.simpleString() == before.schema.simpleString()
        if name == "near duplicates":
            comp = {(i, t): c for (i, t), (_, _, c, _) in zip([k for k in had], brute.op5(list(had)))}
            words = [k for k in has if brute.WORD.search(k[1] or "")]
            assert all(has[k] == 1 for k in words) and len(words) == len({comp[k] for k in had if brute.WORD.search(k[1] or "")} )
            assert all(has[k] == had[k] for k in had if not brute.WORD.search(k[1] or ""))
        if name == "benchmark decontamination":
            clean = {k for k, r in zip(had, brute.op10(list(had), [(1, brute.passage(2, 30))])) if not r[-1]}
            assert set(has) == clean
        if name == "mixing":
            assert all(has[k] <= 2 * had[k] for k in has)
        if name == "sharding":
            assert has == had


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert rows and len({(r.shard, r.slot) for r in rows}) == len(rows)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], brute.SCHEMA)
    spark.createDataFrame([(1, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, str(tmp_path)))
    assert docs.collect() == []
