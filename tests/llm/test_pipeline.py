"""The pipeline's stages take effect, and keep clean documents."""

import corpus_pipeline
from ringside.llm.jaccard import jaccard_components


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen, now = {}, docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, now, sf).cache()
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        seen[name] = (now, out)
        now = out
    before, after = seen["toxicity"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    gone = before.join(after, "doc_id", "left_anti")
    clean = gone.join(labels.where("toxic = 0"), "doc_id").count()
    assert gone.count() > 0 and clean <= 0.01 * labels.count()
    before, after = seen["n-gram Jaccard join"]
    groups = {r.doc_id: r.component_id for r in jaccard_components(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values()))
    before, after = seen["substring dedup"]
    old, new = ({r.doc_id: r.text for r in x.collect()} for x in (before, after))
    assert set(old) == set(new) and 0 < sum(old[d] != new[d] for d in old) < 0.5 * len(old)
    assert all(set(new[d].split()) <= set(old[d].split()) for d in old)
    packed = corpus_pipeline.STAGES[3][1](spark, now, sf).collect()
    assert {r.doc_id for r in packed} == set(new)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, "a b c d e f g", "en", "s", 7), (1, "a b c d e f g", "en", "s", 7), (2, "a b c d e f g", None, None, None), (None, "x", None, None, 1), (None, None, None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    now, sf = docs, "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, sf).cache()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in now.collect()) == [(False, 1, "a b c d e f g"), (False, 3, ""), (False, 4, ""), (True, 0, ""), (True, 0, "x")]
    assert corpus_pipeline.STAGES[3][1](spark, now, sf).count() == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
