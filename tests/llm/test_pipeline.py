"""The pipeline's rows against its stages worked out by hand, and the module's contract."""

import importlib

from roasline.llm import queries


def test_stages_and_rows(spark):
    corpus_pipeline = importlib.import_module("corpus_pipeline")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "bpe_encode"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r.doc_id for r in queries.QUERIES["op10_ngram_quality"](spark, sf).where("kept").collect()}
    frames = {}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf).checkpoint()
        frames[name] = at
        if name != "bpe_encode":
            assert at.columns == docs.columns
    assert {r.doc_id for r in frames["quality_rules"].collect()} == good
    assert frames["line_dedup"].count() == len(good)
    from roasline.llm import simhash

    reps = {r.component_id for r in simhash.classes(frames["line_dedup"]).collect()}
    assert {r.doc_id for r in frames["simhash_near_dedup"].collect()} == reps
    assert {r.doc_id for r in frames["mix_sources"].collect()} <= reps
    run = corpus_pipeline.run(spark, sf)
    assert sorted(r.ids_sha256 for r in run.collect()) == sorted(r.ids_sha256 for r in frames["bpe_encode"].collect())
