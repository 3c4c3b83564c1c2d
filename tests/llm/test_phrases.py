"""Phrase collocations against a count of all phrases, and the statement in SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from compare import connect, difference

from sparkmart.llm import phrases
from sparkmart.llm.queries import ORACLES, QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, first):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {g for g, a in counts.items() if a >= least and len(g) > 1}
        inside = {g[i:j] for g in candidates for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g) and counts[g] >= counts[g[i:j]]}
        found = []
        for g in candidates - inside:
            score, k = min((1000 * counts[g] * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -counts[g], " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:first]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows(spark):
    rng = random.Random(3)
    names = ["a", "B", "é", "x\x01", "Zz", "漢字", "don't", "a" * 300]
    out = []
    for i in range(300):
        size = rng.choice([0, 1, 2, 5, 40, 200])
        text = "".join(rng.choice(names) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ","]) for _ in range(size))
        out.append((i, text, rng.choice(["en", "de", None, "und"]), "p", 1, "k"))
    out += [(1, "same words here again " * 40, "en", "p", 1, "k")] * 30 + [(2, None, None, None, None, None), (3, "", "", "", 0, "")]
    out.append((4, " ".join(rng.choice(names) for _ in range(20000)), "fr", "p", 1, "k"))
    return spark.createDataFrame(out, "doc_id long, text string, lang string, phrase string, n long, key string").repartition(4)


def test_equal_to_a_count_of_all_phrases(spark, monkeypatch):
    docs = rows(spark)
    plain = [(r["lang"], r["text"]) for r in docs.collect()]
    monkeypatch.setattr(phrases, "CHUNK", 700)  # several sorted blocks in a task
    monkeypatch.setattr(phrases, "SAMPLED", 8)
    want = brute(plain, 5, 40)
    assert len({r[0] for r in want}) == 4
    assert sorted(tuple(r) for r in phrases.collocations(docs, least=5, first=40).collect()) == want
    # words beyond the listed ones go by their hashes
    assert sorted(tuple(r) for r in phrases.collocations(docs, least=5, first=40, listed=3).collect()) == want


def test_counts_that_pass_64_bits(spark):
    docs = spark.createDataFrame([(1, "p q", "en")], "doc_id long, text string, lang string")
    assert phrases.collocations(docs, least=1).collect()[0]["score"] == 2000
    big = spark.sql("SELECT (cast(1000 as decimal(4,0)) * cast(4000000000000 as decimal(16,0)) * cast(9000000000000 as decimal(16,0))) div (cast(4000000000000 as decimal(16,0)) * cast(4000000000000 as decimal(16,0))) AS x")
    assert big.first()[0] == 2250


def test_tables_without_words(spark):
    schema = "doc_id long, text string, lang string, rank long"
    for data in ([], [(1, None, None, 1), (2, " .,\n", "en", 2)]):
        found = phrases.collocations(spark.createDataFrame(data, schema))
        assert found.columns == COLUMNS and not found.collect()


def test_statement(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op11_collocations"](spark, folder), connect(folder), ORACLES["op11_collocations"]) is None
