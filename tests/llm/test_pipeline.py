"""Stages one by one: columns, what goes, and that decisions take effect."""

import corpus_pipeline as cp
from issuelab.llm import pii, quality
from issuelab.session import stage

from .awkward import empty_docs
from .test_ngram_join import shingles


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, results = docs.columns, {}
    for name, step in cp.STAGES:
        before = docs
        docs = stage(step(spark, docs, sf), name)
        results[name] = docs
        if name != "packing":
            assert docs.columns == columns and docs.count() <= before.count()
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).where("kept").select("doc_id")
    assert sorted(r[0] for r in results["quality_rules"].select("doc_id").collect()) == sorted(r[0] for r in judged.collect())
    kept = [shingles(r["text"], 5) for r in results["near_duplicates"].collect()]
    for k, s in enumerate(kept):
        assert all(100 * len(s & t) < 80 * len(s | t) for t in kept[:k])
    clean = results["personal_data"].collect()
    assert all(r["n_chars"] == len(r["text"]) for r in clean)
    assert sum(len(pii.base_spans(r["text"])) for r in clean) == 0
    assert {r[0] for r in results["packing"].select("doc_id").distinct().collect()} == {r["doc_id"] for r in clean}


def test_empty_documents(spark, sf):
    docs = empty_docs(spark)
    for name, step in cp.STAGES:
        docs = stage(step(spark, docs, sf), name)
        assert docs.count() == 0
