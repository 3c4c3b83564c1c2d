"""Leaves that are explained in groups give what each gives alone."""

import numpy as np

from sparkmart.operators import tree_shapley as T


def grown(rng, width, depth):
    """Leaves of random trees over few cuts."""
    def grow(d, ranges):
        if not d or (ranges and rng.random() < 0.1):
            return [ranges]
        f, cut = int(rng.integers(width)), float(rng.integers(1, 9))
        low, high = ranges.get(f, (-np.inf, np.inf))
        if not low < cut < high:
            return grow(d - 1, ranges)
        return grow(d - 1, {**ranges, f: (low, min(high, cut))}) + grow(d - 1, {**ranges, f: (max(low, cut), high)})

    return [r for _ in range(5) for r in grow(depth, {}) if r]


def test_groups_of_leaves_equal_single_leaves(monkeypatch):
    rng = np.random.default_rng(11)
    width, rows = 6, 5000
    columns = rng.integers(0, 10, (width, rows)).astype(float)
    background = rng.integers(0, 10, (width, 30)).astype(float)
    leaves = []
    for r in grown(rng, width, 6):
        features = np.array(list(r))
        low, high = (np.array([b[i] for b in r.values()]) for i in (0, 1))
        other, n = np.unique(T._met(background, features, low, high), return_counts=True)
        leaves.append({"value": float(rng.normal()), "features": features, "low": low, "high": high, "other": other, "n": n})
    want = np.zeros((width, rows))
    for leaf in leaves:
        T._add(want, columns, leaf)
    calls = []
    monkeypatch.setattr(T, "_add", lambda out, c, leaf, add=T._add: calls.append(c.shape[1]) or add(out, c, leaf))
    for states in (1, 64, T.STATES):
        monkeypatch.setattr(T, "STATES", states)
        groups = T._grouped(leaves)
        assert sum(len(members) for members, _ in groups) == len(leaves)
        got = np.zeros((width, rows))
        calls.clear()
        T._add_all(got, columns, groups)
        assert np.allclose(got, want, atol=1e-12)
        assert len(calls) == len(leaves) and sum(calls) < len(leaves) * rows / 2  # rows alike are explained once


def test_rows_of_many_batches_stay_in_their_order(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.range(50).selectExpr("id", "CAST(id AS double) AS x").repartition(1))
    leaves = spark.createDataFrame([(0, float(i), [0], [float(i)], [float("inf")], [0, 1], [1, 1]) for i in range(3)], T.LEAF)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        monkeypatch.setattr(T, "ROWS", 20)
        rows = T.tree_contributions(df, leaves, 1).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # a met leaf gives half its value, as half the background meets it; one that isn't met takes it
    assert sorted(r.id for r in rows) == list(range(50))
    for r in rows:
        assert np.isclose(r.contributions[0], sum(i / 2 if r.x > i else -i / 2 for i in range(3)))


def test_rows_are_explained_once(spark):
    """Exploding the factors infers a filter on them; it stays above the explained rows and their shuffle."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.range(50).selectExpr("id", "CAST(id AS double) AS x"))
    leaves = spark.createDataFrame([(0, 1.0, [0], [3.0], [float("inf")], [0, 1], [1, 1])], T.LEAF)
    rows = T.tree_contributions(df.repartition(3), leaves, 1).select("id", F.posexplode("contributions"))
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
