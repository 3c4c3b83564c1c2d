"""Profiles of a feature frame, computed from value counts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.encode import ordinal_code, target_code
from sparkmart.operators.distribution import quantiles_of_counts, split_placed_counts
from sparkmart.schemas import (
    AGE_BANDS,
    CATEGORICALS,
    DISABILITIES,
    EDUCATIONS,
    GENDERS,
    IMD_BANDS,
    PROFILE_NUMERIC,
)
from sparkmart.session import scratch_folder, store


def class_balance(df: DataFrame) -> DataFrame:
    counts = df.groupBy(target_code(F.col("final_result")).alias("label")).agg(
        F.count("*").alias("n")
    )
    return counts.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy()))


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and rate per column."""
    totals = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    rows = F.inline(
        F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in df.columns
        ])
    )
    return totals.select("_rows", rows).select(
        "column_name", "missing", (F.col("missing") / F.col("_rows")).alias("missing_rate")
    )


def long_form(df: DataFrame, columns: list[str], type_name: str) -> DataFrame:
    return df.select(*[F.col(c).cast(type_name).alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    )


def category_counts(df: DataFrame, columns: list[str] = CATEGORICALS) -> DataFrame:
    """Rows per value, NULL included, and distinct values per column."""
    counts = (
        long_form(df, columns, "string").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    )
    values = F.count("*").over(Window.partitionBy("column_name")).alias("cardinality")
    return counts.select("column_name", "value", "n", values)


def numeric_counts(df: DataFrame, columns: list[str] = PROFILE_NUMERIC) -> DataFrame:
    """Rows per value of each column, without NULL."""
    known = long_form(df, columns, "bigint").where(F.col("value").isNotNull())
    return known.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def describe(df: DataFrame, columns: list[str] = PROFILE_NUMERIC) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles per column."""
    counts = numeric_counts(df, columns)
    mean = F.sum(F.col("value") * F.col("n")) / F.sum("n")
    moments = (
        counts.join(counts.groupBy("column_name").agg(mean.alias("mean")), "column_name")
        .groupBy("column_name")
        .agg(
            F.max("mean").alias("mean"),
            F.sqrt(
                F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2)))
                / (F.sum("n") - 1)
            ).alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quartiles = quantiles_of_counts(
        counts, ["column_name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    return moments.join(quartiles, "column_name").select(
        "column_name", F.col("n").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def box_statistics(df: DataFrame, columns: list[str] = PROFILE_NUMERIC) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 IQR, and outliers."""
    counts = numeric_counts(df, columns)
    quartiles = quantiles_of_counts(
        counts, ["column_name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    ).drop("n")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    return (
        counts.join(quartiles, "column_name")
        .groupBy("column_name", "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )


def histogram(df: DataFrame, bins: int = 20, columns: list[str] = PROFILE_NUMERIC) -> DataFrame:
    """Rows per equal-width bin between the extremes of each column; 0-based bins."""
    counts = numeric_counts(df, columns)
    extremes = counts.groupBy("column_name").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    placed = counts.join(extremes, "column_name")
    span = F.col("high") - F.col("low")
    position = F.when(
        span > 0, F.floor((F.col("value") - F.col("low")) * bins / span)
    ).otherwise(0)
    return (
        placed.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
        .groupBy("column_name", "bin")
        .agg(F.sum("n").alias("n"))
    )


# ------------------------------------------------------------------ correlation

ENCODED = {
    "gender": GENDERS,
    "age_band": AGE_BANDS,
    "highest_education": EDUCATIONS,
    "imd_band": IMD_BANDS,
    "disability": DISABILITIES,
}
CORRELATED = ["week_no", *ENCODED, *PROFILE_NUMERIC, "final_result"]
BANDS = [(0.7, "very strong"), (0.5, "strong"), (0.3, "medium"), (0.1, "weak")]


def correlation_frame(df: DataFrame) -> DataFrame:
    """Every correlated column as a whole number; ordered categories by position."""
    encoded = {c: ordinal_code(F.col(c), values) for c, values in ENCODED.items()}
    encoded["final_result"] = target_code(F.col("final_result"))
    return df.select(*[encoded.get(c, F.col(c)).cast("bigint").alias(c) for c in CORRELATED])


def _written_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Centred average rank of every value of every column, scaled by the row count."""
    rank = F.col("_cum") - (F.col("n") - 1) / 2
    total = F.col("_total")
    folder = scratch_folder(df.sparkSession, "ranks")
    ranked = split_placed_counts(numeric_counts(df, columns), ["column_name"], "value")
    store(ranked.select("column_name", "value", ((rank - (total + 1) / 2) / total).alias("rank")), folder)
    return df.sparkSession.read.parquet(folder)


def _rank_correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Correlations of ranks, looked up per column by value."""
    columns = sorted({c for pair in pairs for c in pair})
    ranks = _written_ranks(df, columns)
    joins = "\n".join(
        f"JOIN {{ranks}} r_{c} ON r_{c}.column_name = '{c}' AND r_{c}.value = d.{c}" for c in columns
    )
    squares = [f"sum(r_{c}.rank * r_{c}.rank) AS s_{c}" for c in columns]
    products = [f"sum(r_{a}.rank * r_{b}.rank) AS p_{i}" for i, (a, b) in enumerate(pairs)]
    rows = [
        f"struct('{a}' AS column_1, '{b}' AS column_2, try_divide(p_{i}, sqrt(s_{a} * s_{b})) AS r)"
        for i, (a, b) in enumerate(pairs)
    ]
    statement = f"""
        SELECT inline(array({", ".join(rows)})) FROM (
            SELECT {", ".join(squares + products)} FROM {{d}} d {joins})"""
    return df.sparkSession.sql(statement, d=df, ranks=ranks)


def spearman(df: DataFrame) -> DataFrame:
    """Rank correlation of every column pair (upper triangle).

    Ties get average ranks. A pair with ``imd_band`` uses the rows where it is
    known, with ranks among those rows.
    """
    folder = scratch_folder(df.sparkSession, "correlated")
    store(correlation_frame(df), folder)
    frame = df.sparkSession.read.parquet(folder)
    pairs = list(combinations(CORRELATED, 2))
    partial = [p for p in pairs if "imd_band" in p]
    complete = [p for p in pairs if "imd_band" not in p]
    known = frame.filter(F.col("imd_band").isNotNull())
    return _rank_correlations(frame, complete).unionByName(_rank_correlations(known, partial))


def correlation_bands(matrix: DataFrame, target: str = "final_result") -> DataFrame:
    """Correlations with the target, strongest first, in bands of strength."""
    strength = F.abs("r")
    (limit, name), *rest = BANDS
    band = F.when(strength >= limit, name)
    for limit, name in rest:
        band = band.when(strength >= limit, name)
    other = F.when(F.col("column_1") == target, F.col("column_2")).otherwise(F.col("column_1"))
    return (
        matrix.filter((F.col("column_1") == target) | (F.col("column_2") == target))
        .select(other.alias("column_name"), "r", band.otherwise("very weak").alias("band"))
        .orderBy(F.abs("r").desc_nulls_last(), "column_name")
    )


def strong_pairs(matrix: DataFrame, least: float = 0.7) -> DataFrame:
    """Pairs at or above a strength; 0.9 and more is very strong."""
    strength = F.abs("r")
    return matrix.filter(strength >= least).withColumn(
        "band", F.when(strength >= 0.9, "very strong").otherwise("strong")
    )
