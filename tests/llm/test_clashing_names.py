"""Columns of any names: those that operators use inside, names of results, and dotted ones."""

from __future__ import annotations

import random

import public_tokenizers

import corpus_pipeline
from sparkmart.llm import neighbours, sharding, substrings, tokenfiles
from sparkmart.llm.queries import TOKENIZER

NAMES = ["_lang_pred", "_lang_score", "pred", "score", "_kept_text", "_key_1", "_found_1", "own_0", "found_0", "text_key_1", "a.b", "kept_0"]


def table(spark):
    rng = random.Random(1)
    words = ["the", "house", "of", "water", "and", "stone", "is", "old"]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(8)] + [None, ""]
    rows = [(i, t, "en", "s", len(t or ""), *NAMES) for i, t in enumerate([*texts, texts[0]])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES))


def test_stages_keep_columns_of_any_names(spark):
    docs = table(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, "/root/testdata/sf0.001")
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert rows and all(r[n] == n for r in rows for n in NAMES), name


def test_passages_with_columns_of_any_names(spark):
    docs = table(spark)
    rows = {r["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    assert rows[0]["text"] == "" and rows[1]["text"] == docs.where("doc_id = 1").first()["text"]
    assert all(r[n] == n for r in rows.values() for n in NAMES)


def test_keys_with_names_of_results(spark):
    docs = table(spark).select("doc_id", "text")
    for name in ("size", "shard", "slot", "a.b"):
        got = sharding.assign(docs.withColumnRenamed("doc_id", name), key=name)
        assert sorted(r[0] for r in got.collect()) == list(range(11))
    file = open(public_tokenizers.path(TOKENIZER), encoding="utf-8").read()
    manifest = tokenfiles.write(docs.withColumnRenamed("doc_id", "a.b"), file, 2, tokenfiles.folder(spark), key="a.b")
    assert sorted(r[0] for r in manifest.collect()) == list(range(11))


def test_vectors_with_columns_of_any_names(spark):
    frame = spark.createDataFrame([(i, [float(i % 7 + 1), 1.0], "x", 2) for i in range(40)], "`vec.id` long, `an embedding` array<double>, found string, query int")
    got = neighbours.nearest(frame, key="vec.id", vector="an embedding").collect()
    assert len(got) == 2 * 20 and got[0].__fields__ == ["query_id", "rank", "vec.id", "score"]
