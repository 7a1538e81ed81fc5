"""The pipeline's stages, each against what its operator is tested to say."""

import corpus_pipeline
import pytest
from cases import SF, awkward, documents, empty
from pyspark.sql import functions as F

from codequarry.llm import exact_dedup, pii, quality, simhash
from codequarry.session import written


@pytest.mark.parametrize("source", [documents, awkward])
def test_stages(spark, source):
    docs = source(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = written(stage(spark, docs, SF), "stage")
        ids = sorted(str(r["doc_id"]) for r in out.select("doc_id").collect())
        if k < 4:
            assert out.columns == docs.columns
        if k == 0:
            want = quality.judge(docs).where("kept")
        elif k == 1:
            want = exact_dedup.membership(docs).where("kept")
        elif k == 2:
            want = simhash.membership(docs).where(F.col("doc_id") == F.col("component_id"))
        else:
            want = docs
        if k < 4:
            assert ids == sorted(str(r["doc_id"]) for r in want.select("doc_id").collect())
        else:
            assert set(ids) == {str(r["doc_id"]) for r in docs.select("doc_id").collect()}
            assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
        if k == 3:
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(r["text"] == pii.masked(texts[r["doc_id"]]) for r in out.collect())
        docs = out


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def test_empty_documents(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        assert docs.count() == 0
