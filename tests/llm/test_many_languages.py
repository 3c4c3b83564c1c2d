"""More languages than one word of a sliced filter has bits."""

from __future__ import annotations

import random

from sparkmart.llm import languages


def test_every_label_is_learned(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(40)]
        # the labels that come later in the order of frequency have fewer rows
        rows += [(f"l{i:03d}", " ".join(rng.choice(words) for _ in range(60))) for _ in range(3 if i < 64 else 2)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    filters = languages.fit(docs)
    assert len(filters.languages) == 300 and len(filters.blocks) == 5
    got = languages.predict(docs, filters).collect()
    assert all(r["lang"] == r["lang_pred"] and r["score"] > 0.5 for r in got)
