"""Corpus operators against brute force, the public libraries and planted cases, with the odd rows every table may hold."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkmart.llm import bpe, decontaminate, jaccard, languages, licenses, pages, sharding, substrings, tokenfiles, vectors
from sparkmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, ref string, n_words string"
RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefg") for _ in range(RNG.randint(1, 9))) for _ in range(300)]


def prose(n: int, rng: random.Random) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts() -> list[str | None]:
    """Copies, near copies in a large group, shared passages, runs of one word, very short and very long texts."""
    rng = random.Random(7)
    out: list[str | None] = [None, "", "  \t\n ", "a", "A b", "a B", "!!! 123", "worté É漢字 'tis it's \U0001f600"]
    base, passage = prose(150, rng), prose(60, rng)
    out += [base] * 4
    for _ in range(30):
        words = base.split()
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        out.append(" ".join(words))
    out += [prose(40, rng) + " " + passage + "\n" + prose(40, rng) for _ in range(25)]
    out += [" ".join(["same"] * 200), " ".join(["same"] * 90), prose(20000, rng), passage.upper()]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "b", "r", "w") for i, t in enumerate(texts())]
    rows += [(None, "a lone row of some words", None, None, None, None, None, None), (3, "a", "en", "s", 1, "b", "r", "w")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substrings_equal_brute_force(docs, nothing):
    rows = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()]
    count = Counter(tuple(w[i : i + 35]) for _, w in rows for i in range(len(w) - 34))
    want = []
    for key, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if count[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        want.append((key, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    found = substrings.attach(docs.select("doc_id", "text"), substrings.repeated_passages(docs))
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert Counter(got) == Counter(want) and sum(w[2] for w in want) > 1000
    assert substrings.remove_repeats(docs).columns == docs.columns
    assert substrings.repeated_passages(nothing).count() == 0


def shingles(text: str | None) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def roots(n: int, links) -> list[int]:
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_jaccard_equals_brute_force(docs, nothing):
    rows = [(r["doc_id"], shingles(r["text"])) for r in docs.orderBy(F.col("doc_id").asc_nulls_last()).collect()]
    links = [(i, j) for i, (_, a) in enumerate(rows) for j, (_, b) in enumerate(rows[:i]) if a and b and 100 * len(a & b) >= 75 * len(a | b)]
    found = roots(len(rows), links)
    want = Counter((key, len(s), rows[r][0]) for (key, s), r in zip(rows, found, strict=True))
    assert Counter(tuple(r) for r in jaccard.with_components(docs).select("doc_id", "n_shingles", "component_id").collect()) == want
    assert jaccard.with_components(nothing).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 12))
    rows = [(i, (base[i % 40] + (0.1 * rng.normal(size=12) if i % 3 else 0)).tolist()) for i in range(400)]
    rows += [(400, None), (401, [0.0] * 12), (402, [float("nan")] * 12), (403, [1.0, None] + [0.0] * 10), (404, []), (405, [1.0, 2.0]), (406, [2.0, 4.0]), (None, base[0].tolist()), (407, (base[1] * 1e-200).tolist())]
    x = np.array([v if v is not None and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v) else [np.nan] * 12 for _, v in rows], float)
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    close[405, 406] = close[406, 405] = True
    np.fill_diagonal(close, False)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    found = roots(len(rows), [(order.index(a), order.index(b)) for a, b in zip(*np.nonzero(close), strict=True)])
    component = {i: rows[order[found[order.index(i)]]][0] for i in range(len(rows))}
    want = Counter((rows[i][0], int(close[i].sum()), component[i], rows[i][0] == component[i] and rows[i][0] is not None) for i in range(len(rows)))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in vectors.near_vectors(frame).collect()) == want
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_decontamination_equals_brute_force(spark, docs, nothing):
    rx = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    some = texts()
    items = [("7", some[12]), ("10", " ".join(some[40].split()[30:52])), ("b", "a"), ("c", None), ("d", "!!"), (None, "same same same"), ("e", some[8])]
    windows = {}
    for key, text in items:
        w = re.findall(rx, lower(text))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(key or "")
    want = Counter()
    for r in docs.collect():
        w = re.findall(rx, lower(r["text"]))
        hit, found = set(), set()
        for i in range(len(w)):
            for n in {len(k) for k in windows}:
                if ids := windows.get(tuple(w[i : i + n])) if i + n <= len(w) else None:
                    hit.update(range(i, i + n))
                    found |= ids
        want[r["doc_id"], len(w), len(hit), tuple(sorted(found))] += 1
    frame = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.scan(docs, frame)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect()) == want
    assert decontaminate.clean(docs, frame).columns == docs.columns
    assert decontaminate.scan(nothing, frame).count() == 0
    assert decontaminate.scan(docs, frame.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_bpe_equals_the_public_library(docs, nothing):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    for r in bpe.encode(docs, path).collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert r["ids"] == " ".join(map(str, ids)) and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    again = bpe.decode(bpe.encode(docs.select("text"), path), path)
    assert again.where(F.col("decoded") != F.encode(F.coalesce("text", F.lit("")), "UTF-8")).count() == 0
    assert bpe.encode(nothing, path).count() == 0
    known = bpe.vocabulary(path)
    assert sorted(known.perfect(known.keys).tolist()) == list(range(len(known.ranks)))


def test_token_files_equal_the_public_library(spark, docs, nothing):
    from tokenizers import Tokenizer

    file = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    library = Tokenizer.from_str(file)
    manifest = tokenfiles.write(docs, file, 2, tokenfiles.folder(spark))
    got = sorted(((r["start"], r["n_tokens"], r["doc_id"], zlib.crc32(r["ids"])) for r in tokenfiles.read(manifest).collect()), key=lambda r: r[0])
    at = 0
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r))
    for (key, text), (start, n, found, crc) in zip(rows, got, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (found, start, n, crc) == (key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    name = manifest.first()["file"]
    ids, mask = tokenfiles.sequence(tokenfiles.open_file(name), 0)
    assert len(ids) == len(mask) == tokenfiles.LENGTH and not ids.flags.owndata
    assert tokenfiles.read(tokenfiles.write(nothing, file, 2, tokenfiles.folder(spark))).count() == 0


def test_main_text(spark):
    html = (
        '<html><head><title>t</title><script>x="</p>"</script></head><body><header>head</header><nav><ul><li>menu</ul></nav>'
        '<div class="cookie-notice">We use cookies, many of them, on every page that you read here</div>'
        "<article><h1>A&amp;B</h1><p>One   <b>bold</b>\n text of some length that goes on<p>Oh.<p>Another paragraph that is long enough &eacute;</article>"
        '<div id="comments"><p>a reader says a lot of things that nobody asked for</p></div><aside>side</aside><form>f</form><footer>foot</footer></body></html>'
    )
    rows = [(1, "u", html), (2, "u", None), (3, "u", ""), (4, "u", "<p>broken <b>markup"), (5, "u", "plain")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "A&B\nOne bold text of some length that goes on\nOh.\nAnother paragraph that is long enough é"
    assert got == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("broken markup", 13), 5: ("plain", 5)}


def test_pages_keep_every_paragraph(spark):
    for r in QUERIES["op5_main_text"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(pages.lines(b).texts) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)


def test_shards(spark, docs, nothing):
    found = sharding.assign(docs).collect()
    assert len(found) == docs.count()
    for shard in {r["shard"] for r in found}:
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))
    rows = spark.range(40000)
    own, more = (sharding.placed(F.col("id").cast("string"), t) for t in (sharding.tree(40), sharding.grown(sharding.tree(40), 40)))
    got = rows.select(own.alias("a"), more.alias("b")).collect()
    assert all(r["b"] in (r["a"], 40) for r in got)
    sizes = Counter(r["a"] for r in got)
    assert len(sizes) == 40 and min(sizes.values()) > 850 and max(sizes.values()) < 1150
    assert 800 < sum(r["b"] == 40 for r in got) < 1150
    assert sharding.assign(nothing).count() == 0


def test_languages(spark, docs, nothing):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op10_language"](spark, folder).join(truth, "doc_id").where("held_out").collect()
    assert len(got) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    found = languages.predict(docs, languages.fit(docs))
    assert {r["lang_pred"] for r in found.where(~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).collect()} == {"und"}
    assert languages.predict(nothing, languages.fit(nothing)).count() == 0


def test_pipeline_stages(spark, docs, nothing):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "repeated_passages", "benchmark_passages", "tokens"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    for table in (docs, nothing):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, now, SF)
            if name != "tokens":
                assert after.columns == now.columns
            after.write.format("noop").mode("overwrite").save()
            now = after if name == "tokens" else after.select(now.columns)
    got = corpus_pipeline.run(spark, SF)
    assert got.where(~F.col("round_trip")).count() == 0 and set(columns) >= {"doc_id"}
    first = corpus_pipeline.language_id(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    kept = {r[0] for r in corpus_pipeline.near_duplicates(spark, first, SF).select("doc_id").collect()}
    assert kept == {r[0] for r in jaccard.with_components(first).where("doc_id = component_id").select("doc_id").collect()}


def test_digest_of_no_items():
    assert decontaminate.digest([]) == hashlib.sha256(b"").hexdigest()


def test_licences(spark, docs, nothing):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and so on.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    planted = ["Some words.\nLicensed under CC BY-NC 4.0.\nMore words.", "Released under the MIT License. And on.", f"x\n{mit}\ny", "no licence here", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."]
    got = [[name for name, _, _ in licenses.licences(t)] for t in planted]
    assert got == [["CC-BY-NC-4.0"], ["MIT"], ["MIT"], [], ["GPL-3"], ["Apache-2.0"]]
    (_, begin, end), = licenses.licences(planted[0])
    assert planted[0][begin:end].strip() == "Licensed under CC BY-NC 4.0."
    assert licenses.scan(docs).where(F.size("licences") > 0).count() == 0 and licenses.scan(nothing).count() == 0
