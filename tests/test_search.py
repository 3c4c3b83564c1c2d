"""A search counts F2 at the threshold and runs as many fits as memory holds."""

import pytest

from sparkmart.operators import metrics, models


@pytest.mark.parametrize("threshold", [0.0, 0.35, 0.5, 1.0])
def test_rates_at_a_threshold_equal_those_of_all_metrics(spark, threshold):
    rows = [(float(i * 7 % 3 == 0), (i * 37 % 101) / 100) for i in range(400)]
    df = spark.createDataFrame(rows, "label double, score double")
    for part in (df, df.where("label = 0"), df.limit(0)):
        want, got = metrics.evaluate(part, threshold=threshold).first(), metrics.rates_at(part, threshold).first()
        assert got.asDict() == {c: want[c] for c in got.asDict()}
    with pytest.raises(Exception, match="score is missing or out of range"):
        metrics.rates_at(spark.createDataFrame([(1.0, 1.5)], df.schema)).collect()


def test_no_score_is_ordered_in_a_search(spark):
    plan = metrics.rates_at(spark.createDataFrame([(1.0, 0.5)], "label double, score double"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_fewer_fits_at_a_time_of_more_rows(spark):
    few, many = (models._fits_at_a_time(spark, rows, 27, 8) for rows in (1000, 1 << 40))
    assert (few, many) == (8, 1)
