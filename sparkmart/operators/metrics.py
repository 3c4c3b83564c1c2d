"""Classification metrics per slice, from counts per distinct score.

Input rows carry ``label`` (0/1) and ``score``. They are combined to one row
per slice and distinct score first; every metric reads these counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.operators.distribution import running_counts
from sparkmart.schemas import THRESHOLD


def input_problems(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Labels other than 0/1, scores and thresholds outside 0..1."""
    label, score = F.col("label"), F.col("score")
    bad_label = label.isNull() | ~label.isin(0, 1)
    bad_score = score.isNull() | F.isnan(score) | (score < 0) | (score > 1)
    totals = df.agg(F.count_if(bad_label).alias("l"), F.count_if(bad_score).alias("s"))
    bad_threshold = F.lit(0 if 0 <= threshold <= 1 else 1).cast("bigint")
    found = {"label": F.col("l"), "score": F.col("s"), "threshold": bad_threshold}
    rows = [F.struct(F.lit(n).alias("check"), v.alias("violations")) for n, v in found.items()]
    return totals.select(F.inline(F.array(*rows)))


def _checked(column: str, good: Column) -> Column:
    problem = F.raise_error(F.lit(f"{column} is missing or out of range"))
    return F.when(good, F.col(column)).otherwise(problem).alias(column)


def _checked_rows(df: DataFrame, slices: list[str]) -> DataFrame:
    """Label and score; a label other than 0/1 or a score outside 0..1 raises."""
    score = ~F.isnan("score") & F.col("score").between(0, 1)
    return df.select(*slices, _checked("label", F.col("label").isin(0, 1)), _checked("score", score))


def score_counts(df: DataFrame, slices: list[str]) -> DataFrame:
    """Rows and positives per score; a label other than 0/1 or a score outside 0..1 raises."""
    return _checked_rows(df, slices).groupBy(*slices, "score").agg(
        F.count("*").alias("n"), F.sum("label").cast("bigint").alias("pos")
    )


def ranked_scores(df: DataFrame, slices: list[str], descending: bool = True) -> DataFrame:
    """Score counts with running counts from the best (or worst) score on."""
    return running_counts(score_counts(df, slices), slices, "score", None, ["n", "pos"], descending).drop("_total")


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def rates(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Recall, precision, F1 and F2; 0 where undefined."""
    def f_score(beta: int) -> Column:
        b = beta * beta
        return _ratio((1 + b) * tp, (1 + b) * tp + b * fn + fp)

    return {
        "recall_fail": _ratio(tp, tp + fn),
        "precision_fail": _ratio(tp, tp + fp),
        "f1_fail": f_score(1),
        "f2_fail": f_score(2),
    }


def evaluate(
    df: DataFrame, slices: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """All metrics, one row per slice (or one row)."""
    if not 0 <= threshold <= 1:
        raise ValueError(f"threshold {threshold} is outside 0..1")
    slices = slices or []
    ranked = ranked_scores(df, slices)
    alarm = F.col("score") >= threshold
    n, pos, score = F.col("n"), F.col("pos"), F.col("score")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    sums = ranked.groupBy(*slices).agg(
        total(n).alias("n"),
        total(pos).alias("pos"),
        total(F.when(alarm, pos)).alias("tp"),
        total(F.when(alarm, n - pos)).alias("fp"),
        F.sum(pos * F.col("cum_pos") / F.col("cum_n")).alias("precision_sum"),
        F.sum(pos * F.pow(score - 1, F.lit(2)) + (n - pos) * F.pow(score, F.lit(2))).alias("squares"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("pos") - tp
    tn = F.col("n") - tp - fp - fn
    return sums.select(
        *slices,
        F.col("n").alias("sample_count"),
        _ratio(F.col("pos"), F.col("n")).alias("fail_rate"),
        *[c.alias(name) for name, c in rates(tp, fp, fn).items()],
        _ratio(F.col("precision_sum"), F.col("pos")).alias("average_precision"),
        _ratio(tp + tn, F.col("n")).alias("accuracy"),
        _ratio(F.col("squares"), F.col("n")).alias("brier_score"),
    )


def rates_at(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Recall, precision, F1 and F2 as in `evaluate`, in one row, from counts at the threshold: no score is ordered."""
    alarm, label = F.col("score") >= threshold, F.col("label").cast("bigint")
    sums = _checked_rows(df, []).agg(
        *[
            F.coalesce(F.sum(v), F.lit(0)).alias(name)
            for name, v in (("tp", F.when(alarm, label)), ("fp", F.when(alarm, 1 - label)), ("pos", label))
        ]
    )
    tp = F.col("tp")
    return sums.select(*[c.alias(name) for name, c in rates(tp, F.col("fp"), F.col("pos") - tp).items()])


def confusion(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return df.groupBy("label", predicted.alias("predicted")).agg(F.count("*").alias("n"))


def precision_recall_curve(df: DataFrame, slices: list[str] | None = None) -> DataFrame:
    """One point per distinct score, and the end point of recall 0."""
    slices = slices or []
    ranked = ranked_scores(df, [*slices]).withColumn("_all", F.lit(1))
    keys = [*slices, "_all"]
    totals = ranked.groupBy(*keys).agg(F.max("cum_pos").alias("total_pos"))
    # Without slices this is exactly one row; with slices the join stays open to the planner.
    points = ranked.join(totals if slices else F.broadcast(totals), keys).select(
        *slices,
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
        F.when(F.col("total_pos") == 0, 1.0)
        .otherwise(_ratio(F.col("cum_pos"), F.col("total_pos")))
        .alias("recall"),
    )
    ends = totals.select(
        *slices,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(ends)


def calibration(df: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and observed rate in quantile bins; empty bins do not appear."""
    ranked = ranked_scores(df, [], descending=False).withColumn("one", F.lit(1))
    size = ranked.groupBy("one").agg(F.max("cum_n").alias("total"))
    position = {i: (F.col("total") - 1) * F.lit(i / bins) for i in range(1, bins)}
    score, cum = F.col("score"), F.col("cum_n")
    # ``size`` and ``edges`` are aggregates of exactly one row.
    edges = ranked.join(F.broadcast(size), "one").groupBy("one").agg(
        *[F.min(F.when(cum > F.floor(p), score)).alias(f"lo_{i}") for i, p in position.items()],
        *[F.min(F.when(cum > F.ceil(p), score)).alias(f"hi_{i}") for i, p in position.items()],
        F.max("total").alias("total"),
    )
    edge_values = [
        F.col(f"lo_{i}") + (F.col(f"hi_{i}") - F.col(f"lo_{i}")) * (p - F.floor(p))
        for i, p in position.items()
    ]
    placed = ranked.join(
        F.broadcast(edges.select("one", F.array(*edge_values).alias("edges"))), "one"
    )
    below = F.size(F.filter("edges", lambda e: e < score))
    return (
        placed.groupBy(below.alias("bin"))
        .agg(
            F.sum("n").alias("n"),
            (F.sum(score * F.col("n")) / F.sum("n")).alias("mean_score"),
            (F.sum("pos") / F.sum("n")).alias("observed_rate"),
        )
    )


def _steps_passed(score: Column) -> Column:
    """How many of the thresholds 0.01, 0.02, ... a score reaches, exactly."""
    guess = F.floor(score * 100)
    return (
        F.when((guess + 1) / F.lit(100.0) <= score, guess + 1)
        .when(guess / F.lit(100.0) > score, guess - 1)
        .otherwise(guess)
    )


def threshold_sweep(df: DataFrame) -> DataFrame:
    """Rates at the thresholds 0.01 to 0.99.

    Scores fall into at most 100 steps before the shuffle; sums from the top
    give the counts at each threshold.
    """
    spark = df.sparkSession
    steps = df.groupBy(F.least(_steps_passed(F.col("score")), F.lit(99)).alias("step")).agg(
        F.count("*").alias("n"), F.sum("label").cast("bigint").alias("pos")
    )
    above = Window.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    all_steps = spark.range(0, 100).withColumnRenamed("id", "step")
    summed = all_steps.join(steps, "step", "left").select(
        "step",
        F.sum(F.coalesce("n", F.lit(0))).over(above).alias("n"),
        F.sum(F.coalesce("pos", F.lit(0))).over(above).alias("tp"),
        F.sum(F.coalesce("pos", F.lit(0))).over(Window.partitionBy()).alias("total_pos"),
    )
    tp = F.col("tp")
    metrics = rates(tp, F.col("n") - tp, F.col("total_pos") - tp)
    return summed.filter(F.col("step") > 0).select(
        (F.col("step") / F.lit(100.0)).alias("threshold"),
        *[c.alias(name) for name, c in metrics.items()],
    )


def best_threshold(sweep: DataFrame, least_precision: float = 0.5) -> DataFrame:
    """Highest F2, then recall, among thresholds precise enough; ties go to the lower one."""
    return (
        sweep.filter(F.col("precision_fail") >= least_precision)
        .orderBy(F.col("f2_fail").desc(), F.col("recall_fail").desc(), F.col("threshold").asc())
        .limit(1)
    )


def compare(results: dict[str, DataFrame]) -> DataFrame:
    """Metrics of several models or feature sets side by side, one row each."""
    rows = None
    for name, df in results.items():
        part = evaluate(df).withColumn("model", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return rows
