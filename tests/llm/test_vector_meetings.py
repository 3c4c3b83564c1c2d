"""Near vectors: intervals meet without being shuffled, and vectors aren't copied from table to table."""

import numpy as np

from sparkmart.llm import vectors


def brute(x, cosine):
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = unit @ unit.T >= cosine
    np.fill_diagonal(close, False)
    label = np.arange(len(x))
    while (new := np.array([min(label[i], *label[close[i]]) if close[i].any() else label[i] for i in range(len(x))])).tolist() != label.tolist():
        label = new
    return {i: (int(close[i].sum()), int(label[i])) for i in range(len(x))}


def test_many_intervals_equal_brute_force_and_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(vectors, "INTERVAL", 32)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[200:300] = x[:100] + rng.normal(scale=0.05, size=(100, 8)).astype(np.float32)
    x[300:340] = x[0]
    tables = {}

    def written(frame, name, *parts, original=vectors.written):
        tables[name] = frame
        return original(frame, name, *parts)

    monkeypatch.setattr(vectors, "written", written)
    for kind in ("float", "double"):
        frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], f"vec_id long, embedding array<{kind}>").repartition(5)
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()}
        assert got == brute(x, vectors.COSINE)
        plan = tables["meetings"]._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan
        assert not any("array" in t for name in ("vectors", "distinct_vectors") for _, t in tables[name].dtypes)
        assert tables["intervals"].count() > 10
