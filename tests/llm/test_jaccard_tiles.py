"""The Jaccard join where columns of many documents stay open after their leaders, and its cells one by one."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import jaccard


def _shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def _linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def _texts(seed):
    """Near copies on both sides of the threshold, of several lengths, and texts put together from shared passages."""
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    passages = [dice.choices(vocabulary, k=30) for _ in range(6)]
    out = []
    for n in (12, 40, 90):
        base = dice.choices(vocabulary, k=n)
        for _ in range(60):
            words = list(base)
            for _ in range(dice.randint(0, n // 20 + 1)):
                words[dice.randrange(len(words))] = dice.choice(vocabulary)
            out.append(" ".join(words[: len(words) - dice.randint(0, n // 4)]))
    out += [" ".join(w for i in dice.sample(range(6), 3) for w in passages[i]) for _ in range(90)]
    return [*out, *out[:5], "", None, "a b"]


@pytest.mark.parametrize("block", [4, 1024])
def test_open_columns_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    tiles = []
    product = jaccard._tile_links
    monkeypatch.setattr(jaccard, "_tile_links", lambda found, links, *rest: tiles.append((links, product(found, links, *rest))) or tiles[-1][1])
    texts = _texts(5)
    sets = [_shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if _linked(sets[i], sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.with_components(docs).collect()}
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}
    (before, after), = tiles
    assert after.count() > before.count()  # the tiles joined parts


@pytest.mark.parametrize(("slices", "lookups"), [(4, 1 << 20), (1, 50), (7, 1000)])
def test_asked_cells_equal_brute_force(monkeypatch, slices, lookups):
    monkeypatch.setattr(jaccard, "SLICES", slices)
    monkeypatch.setattr(jaccard, "LOOKUPS", lookups)
    texts = [t or "" for t in _texts(9)]
    one, two = texts[:150], texts[100:]
    dice = random.Random(2)
    x, y = (np.array(v) for v in zip(*[(dice.randrange(len(one)), dice.randrange(len(two))) for _ in range(6000)], strict=True))
    got = jaccard._asked_cells(jaccard.shingle_sets(pa.array(one)), jaccard.shingle_sets(pa.array(two)), x, y, 75)
    sets = [_shingles(t) for t in one], [_shingles(t) for t in two]
    want = [k for k, (i, j) in enumerate(zip(x.tolist(), y.tolist(), strict=True)) if _linked(sets[0][i], sets[1][j])]
    assert got.tolist() == want and want


def test_no_cells_and_empty_blocks():
    nothing = np.zeros(0, np.int64)
    for one, two in (([], []), (["a b"], []), ([""], [""])):
        sets = [jaccard.shingle_sets(pa.array(t, pa.string())) for t in (one, two)]
        assert not len(jaccard._asked_cells(*sets, nothing, nothing, 75))
    empty = jaccard.shingle_sets(pa.array([""]))
    assert not len(jaccard._asked_cells(empty, empty, np.array([0]), np.array([0]), 75))
