"""The pipeline's stages on the smallest tables, each judged on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tilescope.llm import contamination, languages, links

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_rest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "jaccard_join", "decontamination", "mixing", "sharding"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        before, after = {r.doc_id for r in docs.collect()}, [r.doc_id for r in out.collect()]
        assert len(after) == len(set(after)) and set(after) <= before
        if name != "sharding":
            assert out.columns == docs.columns
        gone = before - set(after)
        if name == "language_id":
            bad = {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
            assert gone == bad
        elif name == "jaccard_join":
            classes = links.jaccard_classes(docs).collect()
            assert set(after) == {r.component_id for r in classes}
        elif name == "decontamination":
            found = contamination.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert gone == {r.doc_id for r in found.collect()} and gone
        elif name == "mixing":
            assert not gone
        else:
            assert not gone and set(Counter(r.shard for r in out.collect())) <= set(range(24))
        docs = out
    got = {(r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {(r.doc_id, r.shard, r.slot) for r in docs.collect()}


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_a_document_without_letters_goes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    more = docs.limit(2).selectExpr("doc_id + 1000000 as doc_id", "'12 34 !!' as text", "lang", "source", "n_chars")
    both = docs.unionByName(more)
    left = languages.keep_identified(spark, both, SF)
    assert left.count() == docs.count()
