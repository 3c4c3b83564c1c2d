"""Metrics, statistics and explanations against brute force."""

from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sparkmart.operators import explain, features, metrics, models, profiling, tree_shapley
from sparkmart.operators.distribution import quantiles_of_counts, running_counts, value_counts
from sparkmart.session import scratch_folder


def average_precision(rows):
    rows = sorted(rows, key=lambda r: -r[1])
    total, ap, seen, hit = sum(r[0] for r in rows), 0.0, 0, 0
    for s in sorted({r[1] for r in rows}, reverse=True):
        group = [r for r in rows if r[1] == s]
        seen, gained = seen + len(group), sum(r[0] for r in group)
        hit += gained
        ap += gained / total * hit / seen if total else 0
    return ap


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20).map(lambda n: n / 20)), min_size=1, max_size=60))
def test_metrics_match_their_definitions(spark, rows):
    df = spark.createDataFrame(rows, "label int, score double")
    got = metrics.evaluate(df).first()
    tp = sum(1 for y, s in rows if y == 1 and s >= 0.5)
    fp = sum(1 for y, s in rows if y == 0 and s >= 0.5)
    fn = sum(1 for y, s in rows if y == 1 and s < 0.5)
    assert got.average_precision == pytest.approx(average_precision(rows))
    assert got.recall_fail == pytest.approx(tp / (tp + fn) if tp + fn else 0)
    assert got.f2_fail == pytest.approx(5 * tp / (5 * tp + 4 * fn + fp) if tp + fn + fp else 0)
    assert got.brier_score == pytest.approx(np.mean([(y - s) ** 2 for y, s in rows]))
    assert got.accuracy == pytest.approx(np.mean([(s >= 0.5) == (y == 1) for y, s in rows]))


def test_running_counts_equal_a_plain_running_sum(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 500, 3000) / 500
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "g int, v double")
    counts = value_counts(df, ["g"], "v")
    got = running_counts(counts, ["g"], "v", F.floor(F.col("v") * 16), ["n"]).collect()
    for r in got:
        assert r.cum_n == sum(1 for i, v in enumerate(values) if i % 2 == r.g and v <= r.v)


def test_quantiles_interpolate(spark):
    values = [1, 1, 2, 10, 30, 31]
    counts = value_counts(spark.createDataFrame([(1, v) for v in values], "g int, v int"), ["g"], "v")
    got = quantiles_of_counts(counts, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.9}).first()
    assert (got.n, got.a, got.b, got.c) == (6, *np.quantile(values, [0.25, 0.5, 0.9]))


def test_thresholds_are_compared_exactly(spark):
    df = spark.createDataFrame([(1, k / 100) for k in range(101)], "label int, score double")
    sweep = {r.threshold: r.recall_fail for r in metrics.threshold_sweep(df).collect()}
    assert all(sweep[k / 100] == pytest.approx((101 - k) / 101) for k in range(1, 100))


def shapley(value, x, background):
    """Average marginal contributions over all feature orders."""
    d = len(x)
    total = np.zeros(d)
    orders = list(permutations(range(d)))
    for order in orders:
        mixed = background.copy()
        before = value(mixed).mean()
        for f in order:
            mixed[:, f] = x[f]
            after = value(mixed).mean()
            total[f] += after - before
            before = after
    return total / len(orders)


@pytest.mark.parametrize(
    "setting", [models.BoostingSetting(iterations=3, leaves=15, leaf_rows=5), models.ForestSetting(trees=3, depth=4)]
)
def test_tree_contributions_are_shapley_values(spark, setting, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)).round(2)
    y = ((x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=300) * 0.3) > 0).astype(float)
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame(
        [(*map(float, r), float(t), 1.0) for r, t in zip(x, y)], "a double, b double, c double, d double, label double, weight double"
    )
    df = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    model = setting.estimator(300).fit(df)
    folder = scratch_folder(spark, "tree-test")
    model.write().save(folder)
    boosted = isinstance(setting, models.BoostingSetting)
    background = x[:8]
    leaves = explain.tree_leaves(spark, folder, background, boosted)
    rows = explain.tree_contributions(df.limit(2), leaves, 4).orderBy("a").collect()
    # a larger model than one broadcast may hold, and leaves of more conditions than a table serves
    monkeypatch.setattr(tree_shapley, "LEAF_BYTES", 1500)
    monkeypatch.setattr(tree_shapley, "TABLED", 1)
    assert tree_shapley._passes(leaves) > 1
    again = explain.tree_contributions(df.limit(2), leaves, 4).orderBy("a").collect()
    assert np.allclose([r.contributions for r in rows], [r.contributions for r in again], atol=1e-12)

    def output(batch):
        from pyspark.ml.linalg import Vectors

        values = [model.predictRaw(Vectors.dense(b)) if boosted else model.predictProbability(Vectors.dense(b)) for b in batch]
        # Log-odds are twice the margin of boosted trees.
        return np.array([2 * v[1] if boosted else v[1] for v in values])

    for r in rows[:2]:
        mine = np.array(r.features.toArray())
        assert np.allclose(r.contributions, shapley(output, mine, background), atol=1e-9)
        added = output([mine])[0] - output(background).mean()
        assert sum(r.contributions) == pytest.approx(added)


def test_streaks_restart_after_an_active_week(spark):
    rows = [(1, w, c) for w, c in enumerate([0, 0, 3, 0, 0, 0, 1, 0], start=2)]
    df = spark.createDataFrame(rows, "e int, w int, c int")
    got = [r.s for r in features.with_inactive_streak(df, "c", ["e"], "w", "s").orderBy("w").collect()]
    assert got == [1, 2, 0, 1, 2, 3, 0, 1]


def test_unknown_and_missing_categories(spark, small):
    train = small.train_frame().filter(F.col("code_presentation") == models.TRAIN)
    fitted = features.fit_preprocessor(train)
    odd = train.limit(1).withColumn("gender", F.lit("X")).withColumn("region", F.lit(None).cast("string"))
    odd = odd.withColumn("imd_band", F.lit("?")).withColumn("age_band", F.lit(None).cast("string"))
    row = fitted.transform(odd).first()
    encoded = [row[n] for n in fitted.names]
    assert all(v is not None for v in encoded)
    assert sum(row[n] for n in fitted.names if n.startswith(("categorical__gender", "categorical__region"))) == 0
    assert row["ordinal__missingindicator_imd_band"] == 1.0
    assert "ordinal__missingindicator_age_band" not in fitted.names


def test_search_spaces_have_their_published_sizes():
    assert len(set(models.logistic_grid())) == 52
    trials = models.boosting_trials()
    assert len(set(trials)) == 100 and trials == models.boosting_trials()


def test_search_ranks_settings_by_f2(small):
    train, validation, _ = models.temporal_split(small.train_frame())
    settings_ = [models.LogisticSetting(0.01, balanced=True), models.LogisticSetting(1.0)]
    found = models.search(train, validation, settings_, parallelism=2)
    assert {s for s, _ in found} == set(settings_) and found[0][1] >= found[1][1]


def test_bad_scores_and_labels_raise(spark):
    for label, score in ((3, 0.5), (1, 1.5), (1, None), (None, 0.5)):
        df = spark.createDataFrame([(0, 0.1), (label, score)], "label int, score double")
        with pytest.raises(Exception, match="missing or out of range"):
            metrics.evaluate(df).collect()


def test_profiles_leave_null_out(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,), (None,), (None,)], "x int")
    row = profiling.describe(df, ["x"]).first()
    assert (row["count"], row["mean"], row["q50"]) == (3, 2.0, 2.0)
    assert sum(r.n for r in profiling.histogram(df, 3, ["x"]).collect()) == 3


@pytest.mark.parametrize("clicks, overdue", [(float("nan"), 1.0), (3.0, float("inf")), (3.0, None)])
def test_features_that_are_not_finite_raise(spark, clicks, overdue):
    columns = "code_module string, code_presentation string, id_student long, week_no int, click_count_week double, coursework_due_count_to_week double, coursework_overdue_count_to_week double"
    rows = [("A", "B", 1, 2, 4.0, 2.0, 1.0), ("A", "B", 1, 3, clicks, 2.0, overdue)]
    good = features.build_features(spark.createDataFrame(rows[:1], columns)).collect()
    assert good[0].coursework_overdue_rate == 0.5
    with pytest.raises(Exception, match="is missing or not finite"):
        features.build_features(spark.createDataFrame(rows, columns)).collect()
