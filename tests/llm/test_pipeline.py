"""The pipeline's stages against what the operators say of their own input."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from leadscope.llm import decontam, exact, ngram_join, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clashes"))
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "near_dedup", "decontamination", "bpe_encoding"]
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "quality_classifier":
            want = quality.scored(docs, quality.fit(docs, labels)).filter("predicted = 1")
        elif name == "exact_dedup":
            want = exact.groups(docs).filter("kept")
        elif name == "near_dedup":
            want = ngram_join.joined(docs).filter("doc_id = component_id")
        elif name == "decontamination":
            want = decontam.report(docs, benchmark).filter("NOT contaminated")
        else:
            assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == docs.count()
            return
        assert ids == {r.doc_id for r in want.select("doc_id").collect()} and out.count() == want.count()
        assert out.columns == docs.columns
        docs = out.checkpoint()


def test_empty(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0
