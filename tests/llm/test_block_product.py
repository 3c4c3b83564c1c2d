import random

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import jaccard


def _shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


@pytest.mark.parametrize(("dense", "pairs"), [(128, 1 << 22), (0, 100), (10**9, 50)])
def test_block_product_equals_brute_force(monkeypatch, dense, pairs):
    monkeypatch.setattr(jaccard, "DENSE", dense)
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    dice = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [dice.choices(vocabulary, k=dice.randint(20, 80)) for _ in range(30)]
    texts = ["", "a b"]
    for _ in range(300):
        words = list(dice.choice(base))
        for _ in range(dice.randint(0, 3)):
            words[dice.randrange(len(words))] = dice.choice(vocabulary)
        texts.append(" ".join(words))
    one, two = np.arange(200), np.arange(100, len(texts))
    a, b = jaccard._product(pa.array([texts[i] for i in one]), pa.array([texts[i] for i in two]), one, two, 5, 75)
    sets = [_shingles(t) for t in texts]
    expected = {
        (i, j) for i in one.tolist() for j in two.tolist()
        if i != j and sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    }
    assert set(zip(one[a].tolist(), two[b].tolist(), strict=True)) == expected and expected


def test_blocks_without_shared_shingles_have_no_links():
    for texts in ([], ["x"], [""]):
        a, b = jaccard._product(pa.array(texts, pa.string()), pa.array(["a b"]), np.zeros(len(texts), int), np.ones(1, int), 5, 75)
        assert not len(a) and not len(b)
