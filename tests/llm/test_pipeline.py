"""Each stage of the pipeline on its own input."""

import corpus_pipeline
from zerobill.llm import decontaminate, jaccard, mixing, quality_cnn
from zerobill.llm.common import staged

MID = "/root/testdata/sf0.01"


def test_stages(spark, edge_docs):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = [docs]
    for _, f in corpus_pipeline.STAGES[:4]:
        kept.append(staged(spark, f(spark, kept[-1], MID), "test"))
        assert kept[-1].columns == docs.columns
    ids = [sorted(r["doc_id"] for r in d.select("doc_id").collect()) for d in kept]
    bad = {r["doc_id"] for r in quality_cnn.query(spark, MID).where("predicted = 0").collect()}
    assert ids[1] == [i for i in ids[0] if i not in bad]
    groups = jaccard.join_documents(spark, kept[1], 5, 80, 100).collect()
    assert ids[2] == sorted({r["component_id"] for r in groups})
    leaks = {r["doc_id"] for r in decontaminate.contaminated(spark, kept[2], spark.read.parquet(f"{MID}/benchmark.parquet")).collect()}
    assert ids[3] == [i for i in ids[2] if i not in leaks]
    copies = mixing.mix_documents(spark, kept[3]).collect()
    assert ids[4] == sorted(r["doc_id"] for r in copies for _ in range(r["copies"]))
    last = stages["token-ID / binary output"](spark, kept[4], MID)
    assert sorted(r["doc_id"] for r in last.collect()) == ids[4]
    once = jaccard.keep_one(spark, edge_docs, 5, 80, 100)
    assert once.columns == edge_docs.columns and once.where("doc_id = 2").count() == 0 and once.where("doc_id = 1").count() == 1


def test_columns_of_any_name_pass_through(spark, edge_docs):
    """Extra columns named like what the stages use themselves."""
    odd = edge_docs
    for c in ("row", "place", "worded", "u", "rate", "copies", "__place", "__source"):
        odd = odd.withColumn(c, odd["doc_id"])
    for f in (lambda d: jaccard.keep_one(spark, d, 5, 80, 100), mixing.mixed_rows):
        assert f(odd).columns == odd.columns
        assert sorted(map(repr, f(odd).select(*edge_docs.columns).collect())) == sorted(map(repr, f(edge_docs).collect()))
