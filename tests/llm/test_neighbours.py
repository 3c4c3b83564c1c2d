"""Nearest neighbours against products with all vectors: recall, exactness, order and odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from sparkmart.llm import neighbours
from sparkmart.llm.queries import QUERIES

COLUMNS = ["query_id", "rank", "vec_id", "score"]


def brute(rows, every, first):
    """Rows that repeat id and vector count once; null ids come last."""
    rows = {(i, tuple(v)) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    out = {}
    for i, v in rows:
        if i is not None and i % every == 0:
            scores = [(-float((np.array(v) * np.array(w)).sum()), j is None, j or 0) for j, w in rows if j != i and len(w) == len(v)]
            out[i] = [(None if none else j, -s) for s, none, j in sorted(scores)[:first]]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def table(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(6, 8))
    rows = [(i, (base[i % 6] + draw.normal(size=8) * 0.4).tolist()) for i in range(900)]
    rows += [(i, base[0].tolist()) for i in range(900, 1000)]  # copies, queries among them
    rows += [(i, np.eye(8)[i % 8].tolist()) for i in range(1000, 1100)]  # ties
    rows += [(0, rows[0][1]), (None, base[0].tolist()), (None, base[1].tolist())]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [1.0] * 7 + [None]), (2080, [float("nan")] * 8), (2100, [float("inf")] * 8), (2120, [1.0, 2.0]), (2121, [3.0, 1.0]), (2140, [-0.0] * 8)]
    rows += [(2160, [1e150] * 8), (2180, [1e-200] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 1, 1) for i, v in rows], "vec_id long, embedding array<double>, leaf int, rank int, score int")
    return frame.repartition(5), rows


def test_all_leaves_give_exact_neighbours(spark, monkeypatch):
    frame, rows = table(spark)
    monkeypatch.setattr(neighbours, "SPLIT", 20)
    want = brute(rows, 20, 20)
    assert found(neighbours.nearest(frame, recall=1)) == want
    # several parts of a leaf, of vectors and of queries
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 9)
    monkeypatch.setattr(neighbours, "LEAF_QUERIES", 5)
    monkeypatch.setattr(neighbours, "MERGED", 4)
    monkeypatch.setattr(neighbours, "PRODUCTS", 64)
    assert found(neighbours.nearest(frame, recall=1)) == want


def test_recall_is_calibrated(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.select("vec_id", "embedding").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    got = found(QUERIES["op12_nearest"](spark, "/root/testdata/sf0.1"))
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    hits = 0
    for q, near in got.items():
        scores = (x * x[ids == q]).sum(axis=1)
        scores[ids == q] = -np.inf
        best = set(ids[np.lexsort([ids, -scores])[:20]].tolist())
        hits += len(best & {i for i, _ in near})
        assert len(near) == 20 and all(s == scores[ids == i][0] for i, s in near)
    assert hits / (20 * len(got)) >= 0.9


def test_fewer_visits_for_less_recall():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(2000, 6))
    tree = neighbours.Tree(x)
    leaf = tree.leaf_of(x)
    order = tree.visits(x[:50], tree.leaves)
    assert all(sorted(row) == list(range(tree.leaves)) for row in order.tolist())
    truth = np.argsort(-(x[:50] @ x.T), axis=1)[:, :10]
    places = np.array([[row.index(leaf[t]) for t in near] for row, near in zip(order.tolist(), truth, strict=True)])
    # best bins come first: half of the neighbours lie in the first tenth of the leaves
    assert np.median(places) < tree.leaves / 10


@pytest.mark.parametrize("rows", [[], [(20, [0.0, 0.0])], [(1, [1.0, 2.0])], [(20, [1.0, 2.0])]])
def test_tables_without_neighbours(spark, rows):
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert got.columns == COLUMNS and not got.collect()
