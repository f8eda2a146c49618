"""The pipeline against its stages done by hand on one machine."""

from __future__ import annotations

import corpus_pipeline
from loanproof.llm import packing, quality, secrets, simhash, toxicity
from loanproof.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    labels = table(spark, FOLDER, "labels")
    docs = table(spark, FOLDER, "documents").cache()
    held = docs.collect()
    names = docs.columns
    for (_, stage), kind in zip(corpus_pipeline.STAGES[:4], ("quality", "toxic", "near", "secret")):
        now = spark.createDataFrame(held, docs.schema)
        got = stage(spark, now, FOLDER)
        assert got.columns == names
        if kind == "quality":
            good = {r.doc_id for r in quality.quality_scores(now, labels).collect() if r.predicted == 1}
            want = [r for r in held if r.doc_id in good]
        elif kind == "toxic":
            bad = {r.doc_id for r in toxicity.toxicity_scores(now, labels).collect() if r.predicted == 1}
            want = [r for r in held if r.doc_id not in bad]
        elif kind == "near":
            kept = {r.component_id for r in simhash.near_duplicates(now).collect()}
            want = [r for r in held if r.doc_id in kept]
        else:
            spans = {r.doc_id: r.spans for r in secrets.secret_scan(now).collect()}
            after = {r.doc_id: r.text for r in got.collect()}
            assert all((secrets.MARK in after[i]) == bool(s) for i, s in spans.items())
            want = got.collect()
        held = sorted(got.collect(), key=lambda r: r.doc_id)
        assert held == sorted(want, key=lambda r: r.doc_id) and held
    final = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted({r.doc_id for r in final}) == [r.doc_id for r in held]
    encode = packing.byte_encoder(corpus_pipeline.tokenizer_path("byte_bpe_50k.json"))
    assert sum(r.length for r in final) == sum(len(encode(r.text or "")) + 1 for r in held)
