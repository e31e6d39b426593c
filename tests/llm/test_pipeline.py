"""The pipeline's stages against brute force on the smallest tables."""

import math
from collections import Counter

import corpus_pipeline
from laminar.llm import mixing, simhash_dedup, toxicity
from laminar.llm.common import materialise

from test_operators import SF, ascii_lower, brute_matches, check_shards, components


def test_every_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SF), name)
        seen[name] = (before.toPandas(), docs.toPandas())
        assert set(corpus_pipeline.COLUMNS) <= set(docs.columns)
        if name != "sharding":
            assert docs.columns == before.columns
    before, after = seen["toxicity"]
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(spark.read.parquet(f"{SF}/documents.parquet"), model).collect() if r.toxic}
    assert set(before.doc_id) - set(after.doc_id) == toxic
    before, after = seen["simhash_dedup"]
    fps = {d: simhash_dedup.simhash_of(ascii_lower(t).encode().split(), 3) for d, t in zip(before.doc_id, before.text, strict=True)}
    assert sorted(after.doc_id) == sorted(set(components(fps, 2).values()))
    before, after = seen["decontamination"]
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    leaks = {d for d, _ in brute_matches(dict(zip(before.doc_id, before.text, strict=True)), items)}
    assert set(before.doc_id) - set(after.doc_id) == leaks
    before, after = seen["mixing"]
    placed = mixing.positions(spark.createDataFrame(before)).collect()
    assert Counter(after.doc_id) == Counter({r.doc_id: len(r.times) for r in placed if r.times})
    check_shards(seen["sharding"][1].to_dict("records"), 8)
    assert math.isclose(len(seen["sharding"][1]), len(seen["mixing"][1]))
    assert corpus_pipeline.run(spark, SF).count() == len(after)
