"""Repeated rows, shared and null ids through the stages of the corpus pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_one_row_of_each_group_goes_through_all_stages(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    english = [r["text"] for r in given.where("lang = 'en' AND n_chars > 1000").orderBy("doc_id").limit(8).collect()]
    own = [" ".join(f"{w}{i}-{j}" for j, w in enumerate(t.split()[:100])) for i, t in enumerate(english)]
    near = own[1] + " end"
    other = own[3] + " end"
    rows = [(-1, own[0], "en"), (-1, own[0], "en"), (-2, own[1], "en"), (-2, near, "en"), (None, own[2], "en"), (None, own[2], "en")]
    rows += [(None, own[3], "en"), (None, other, "de"), (-3, own[4], "en"), (-3, own[5], "en"), (None, own[6], "en"), (-9, own[6], "en"), (None, " ", "en"), (-4, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    assert corpus_pipeline.language_id(spark, docs, SF).count() == 12
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in kept.collect()))
    assert [key for key, _ in got] == [-9, -4, -3, -3, -2, -1, 0, 0, 0]
    assert {t for _, t in got} >= {own[0], own[2], own[4], own[5], own[6], " ", ""} and {t for _, t in got} & {own[1], near} and {t for _, t in got} & {own[3], other}
    left = corpus_pipeline.benchmark_passages(spark, corpus_pipeline.repeated_passages(spark, kept, SF), SF)
    assert sorted(r["doc_id"] or 0 for r in left.where("length(trim(text)) > 0").collect()) == [-9, -3, -3, -2, -1, 0, 0]
    found = corpus_pipeline.tokens(spark, left, SF)
    assert found.where("n_tokens > 100 AND round_trip").count() == 7
