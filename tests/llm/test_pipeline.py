"""The pipeline's stages on the smallest tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        assert 0 < after.count() <= before.count()
        assert after.join(before, "doc_id", "left_anti").isEmpty()
        before = after
    assert before.filter(F.col("mix_probability") <= 0).isEmpty()


def test_columns_of_any_name_pass_every_stage(spark, tmp_path):
    names = ["_deduped", "mix_topic", "a.b", "id", "key", "_judged", "_gm_drops", "extra0", "row", "class"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(3))  # repeated rows
    long = docs.limit(1).withColumn("text", F.expr("repeat('a long text of many words that goes on. ', 25000)"))
    docs = docs.unionByName(long.withColumn("doc_id", F.lit(10_000).cast("long")))
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns[: len(docs.columns)] == docs.columns, name
        rows = out.collect()
        assert rows, name
        for row in rows:
            assert all(row[docs.columns.index(c)] == f"{c} of {row.doc_id}" for c in names), name
        if name == "source_mixing":
            assert out.columns[len(docs.columns) :] == ["mix_topic_", "mix_probability"]


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0, name
