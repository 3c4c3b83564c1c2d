"""Ranked search against a score of every document, and the statement in SQL."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from compare import connect, difference

from sparkmart.llm import lexical
from sparkmart.llm.queries import ORACLES, QUERIES


def terms(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(docs, items, first):
    counts = [(key, Counter(terms(text))) for key, text in docs]
    n_docs, n_words = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, own in counts:
            n = sum(own.values())
            m = 10 + 90 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 8 * m)) for t in set(terms(text)) if t in own)
            if score > 0:
                scores.append((-score, key is None, key))
        out += [(item, i + 1, key, -score) for i, (score, _, key) in enumerate(sorted(scores)[:first])]
    return sorted(out, key=repr)


def tables(spark):
    rng = random.Random(9)
    names = [f"w{i}" for i in range(60)] + ["É", "漢字", "Mixed", "x" * 400]
    weights = [1 / (i + 1) for i in range(len(names))]
    texts = [" ".join(rng.choices(names, weights, k=rng.choice([0, 1, 3, 30, 300]))) for _ in range(400)]
    texts += [texts[7]] * 60 + [None, "", "!!!", " ".join(rng.choices(names, weights, k=30000)), "w1, w2; w1.w3"]
    docs = [(i, t, "s", 1, 1) for i, t in enumerate(texts)] + [(7, texts[7], "s", 1, 1), (None, texts[8], "s", 1, 1), (None, texts[9], None, None, None)]
    items = [(i, " ".join(rng.sample(names, rng.choice([1, 2, 9, 40])))) for i in range(25)] + [(90, None), (91, ""), (92, "nowhere"), (93, "w1 W1 nowhere")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string, number long, rank int").repartition(5), spark.createDataFrame(items, "item_id long, text string")


def test_equal_to_scores_of_all_documents(spark, monkeypatch):
    docs, items = tables(spark)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    asked = [tuple(r) for r in items.collect()]
    want = brute(pairs, asked, 10)
    assert sorted((tuple(r) for r in lexical.ranked(docs, items).collect()), key=repr) == want
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 40)
    monkeypatch.setattr(lexical.texts, "STEP_BYTES", 2000)
    assert sorted((tuple(r) for r in lexical.ranked(docs.coalesce(1), items, block_terms=60).collect()), key=repr) == want
    assert sorted((tuple(r) for r in lexical.ranked(docs, items, first=3).collect()), key=repr) == brute(pairs, asked, 3)


def test_pair_bounds_set_more_aside():
    """Two terms that never meet bound a document by one of them, so both can be set aside below a score that their sum passes."""
    row = {"n": [10] * 6, "term": [0, 0, 1, 1, 2, 2], "doc": [0, 1, 2, 3, 4, 5], "tf": [1, 1, 1, 1, 5, 5]}
    import numpy as np

    packed = {k: np.array(v, np.int64 if k == "n" else np.uint32).tobytes() for k, v in row.items()}
    pairs = np.array([[0, 1]])
    segment = lexical._Segment(packed, np.array([1000, 1000, 1500]), 6, 60, pairs)
    assert segment.joint.tolist() == [0]
    least = int(segment.most[0]) + 1
    assert least < segment.most[0] + segment.most[1]
    docs, _ = segment.search(np.array([0, 1, 2]), np.array([0]), pairs, least, 1)
    assert docs.tolist() == [4, 5]


def test_tables_without_rows(spark):
    docs, items = tables(spark)
    for d, q in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("text = '!!!'"), items), (docs, items.where("item_id = 91"))):
        found = lexical.ranked(d, q)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and not found.collect()


def test_statement(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op13_ranked_search"](spark, folder), connect(folder), ORACLES["op13_ranked_search"]) is None
