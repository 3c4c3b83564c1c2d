import pytest
from pyspark.sql import functions as F

from sparkmart.operators import distribution
from sparkmart.operators.checks import GRAIN, serving_report
from sparkmart.operators.distribution import placed_counts, quantiles_of_counts, ranged_counts, split_placed_counts


@pytest.mark.parametrize("split", [4096, 10])
def test_split_groups_are_placed_as_whole_ones(spark, monkeypatch, split):
    monkeypatch.setattr(distribution, "SPLIT_VALUES", split)
    wide = [("a", v, v % 3 + 1) for v in [*range(-50, 50), 10**9, 10**15]]
    rows = [*wide, ("b", 7, 4), (None, 1, 2), (None, 5, 1), ("a", None, 9)]
    counts = spark.createDataFrame(rows, "g string, v long, n long")
    expected = placed_counts(counts.where("v IS NOT NULL"), ["g"], "v")
    columns = ["g", "v", "n", "_cum", "_total"]
    found = split_placed_counts(counts, ["g"], "v").select(columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.select(columns).collect()))


def test_an_outlier_leaves_the_ranges_even(spark, monkeypatch):
    """Ranges follow the values, not their width: 20,000 values, one of them far away, and a group of copies."""
    rows = spark.range(20000).select(F.when(F.col("id") == 7, 10**12).otherwise(F.col("id")).alias("v"), F.lit(1).alias("n"))
    monkeypatch.setattr(distribution, "SPLIT_VALUES", 1000)
    counts = rows.withColumn("g", F.lit("a")).union(spark.createDataFrame([(5, 90, "b"), (6, 1, "b")], "v long, n int, g string"))
    placed = ranged_counts(counts, ["g"], "v")
    sizes = {r["_range"]: r["count"] for r in placed.where("g = 'a'").groupBy("_range").count().collect()}
    assert len(sizes) == distribution.RANGES
    assert max(sizes.values()) < 2 * 20000 / len(sizes)
    assert {(r["v"], r["_range"], r["_total"]) for r in placed.where("g = 'b'").collect()} == {(5, 0, 91), (6, 0, 91)}
    # ranges rise with the value, and without a group the sums are those of the whole table
    ends = placed.where("g = 'a'").groupBy("_range").agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("_range").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ends, ends[1:]))
    assert split_placed_counts(counts.drop("g").where("n = 1"), [], "v").agg(F.max("_cum")).first()[0] == 20001


def test_quantiles_of_an_empty_table(spark):
    counts = spark.createDataFrame([], "g string, v long, n long")
    assert quantiles_of_counts(counts, ["g"], "v", {"m": 0.5}).collect() == []


def test_contract_check_shuffles_only_the_grain(spark, small):
    frame = small.predict_frame()
    found = {r["check"]: r["violations"] for r in serving_report(frame.union(frame.limit(1))).collect()}
    assert found["repeated grain"] == 1 and found["empty frame"] == 0
    plan = serving_report(frame)._jdf.queryExecution().executedPlan().toString()
    per_grain = [line for line in plan.splitlines() if f"HashAggregate(keys=[{GRAIN[0]}#" in line]
    assert per_grain
    assert all("functions=[count(1)]" in line or "functions=[partial_count(1)]" in line for line in per_grain)
