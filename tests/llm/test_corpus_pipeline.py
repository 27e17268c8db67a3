"""The corpus pipeline against a plain Python version of its stages."""

import corpus_pipeline
from adcredit.llm import toxicity
from adcredit.llm.queries import held_out
from conftest import SF_SMALL

from . import brute
from .test_llm_operators import check_packing


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    lexicon = toxicity.fit(docs, labels, ~held_out())
    bad = {r["doc_id"] for r in toxicity.toxicity(docs, lexicon).filter("predicted = 1").collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in bad)
    seen, exact = set(), []
    for i, t in rows:
        norm = b" ".join((b"\0" + (t or "").encode() + b"\0").split())
        if norm not in seen:
            seen.add(norm)
            exact.append((i, t))
    keep = {i for i, _, c in brute.near_components(exact) if i == c}
    near = [(i, t) for i, t in exact if i in keep]
    items = [brute.shingles(r["text"]) for r in
             spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = [(i, t) for i, t in near if not any(
        s and 100 * len(s & brute.shingles(t)) >= 75 * len(s) for s in items)]
    assert 0 < len(clean) < len(near) < len(exact) < len(rows)
    assert check_packing(corpus_pipeline.run(spark, SF_SMALL).collect(), clean) < 0.004


def test_stages_take_an_empty_table_and_return_document_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF_SMALL)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF_SMALL).count() == 0
