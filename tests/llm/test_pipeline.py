"""The stages of the pipeline, each against what it should keep."""

import corpus_pipeline
from tests.llm.data import texts
from tests.llm.test_operators import brute_components, brute_windows

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, SF)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before), name
        if k < 4:
            assert docs.columns == columns
        if k == 1:
            assert set(after) == {c for _, _, c in brute_components(list(before.items()), 5, 80)}
        if k == 2:
            bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {r[0] for r in brute_windows(list(before.items()), bench) if not r[5]}
    assert len(after) > len(texts()) / 2
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in after.values())
