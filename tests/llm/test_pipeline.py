"""The pipeline: its stages, against plain programs of their decisions."""

import hashlib

import corpus_pipeline
from judgex.llm import decontamination, jaccard, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "mixing sources"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frames[-1], SF)
        path = f"/tmp/checkpoints/judgex/test-{hashlib.md5(name.encode()).hexdigest()}"
        out.write.mode("overwrite").parquet(path)
        frames.append(spark.read.parquet(path))
    assert all(f.columns == docs.columns for f in frames[:5])
    kept = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert {r.doc_id for r in frames[1].collect()} == kept
    first = {r.component_id for r in jaccard.link(frames[1], corpus_pipeline.NEAR).collect()}
    assert {r.doc_id for r in frames[2].collect()} == first
    texts = {r.doc_id: r for r in frames[3].collect()}
    assert set(texts) == first and all(r.n_chars == len(r.text) for r in texts.values())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = {r.doc_id for r in decontamination.scan(frames[3], bench).filter("not contaminated").collect()}
    assert {r.doc_id for r in frames[4].collect()} == clean
    last = frames[5].collect()
    assert {r.doc_id for r in last} == clean and all(r.taken <= 3 * r.size for r in last)
    ran = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.taken) for r in ran) == sorted((r.doc_id, r.taken) for r in last)
