"""Scores with their three strongest factors.

Contributions are Shapley values against a background sample: exact products
for linear models, exact sums over leaves for tree models (`tree_shapley`).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.encode import risk_label
from sparkmart.operators.features import Feature, Preprocessor
from sparkmart.operators.tree_shapley import tree_contributions, tree_leaves
from sparkmart.schemas import THRESHOLD

BACKGROUND_ROWS = 100
DEMO_ROWS = 1000
TOP_FACTORS = 3


def seeded_sample(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` rows (or all), the same for the same keys and seed."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(order, key).limit(rows)


# ------------------------------------------------------------------------ linear


def linear_contributions(
    weights: dict[str, float], background_means: dict[str, float]
) -> dict[str, Column]:
    """Log-odds contribution per feature: weight times distance from the background mean."""
    return {
        name: (F.col(f"`{name}`") - F.lit(background_means[name])) * F.lit(weight)
        for name, weight in weights.items()
    }


def background_means(background: DataFrame, names: list[str]) -> dict[str, float]:
    """Mean of each feature over the (small, fixed-size) background."""
    row = background.agg(*[F.avg(F.col(f"`{n}`")).alias(n) for n in names]).first()
    return {n: row[n] for n in names}


# ----------------------------------------------------------------------- factors


def factor_value(feature: Feature) -> Column:
    """Encoded number of one-hot and indicator inputs, the raw value of others."""
    if feature.group == "categorical" or feature.name.startswith("missingindicator_"):
        return F.col(f"`{feature.full_name}`").cast("int").cast("string")
    return F.col(feature.column).cast("string")


def top_factors(
    features: list[Feature], contributions: list[Column], k: int = TOP_FACTORS
) -> Column:
    """The k strongest factors of a row; ties go to the earlier feature."""
    candidates = [
        F.struct(
            (-F.abs(c)).alias("strength"),
            F.lit(i).alias("position"),
            F.lit(f.name).alias("factor_name"),
            factor_value(f).alias("factor_value"),
            F.round(c, 4).alias("contribution"),
        )
        for i, (f, c) in enumerate(zip(features, contributions))
    ]
    return F.slice(F.array_sort(F.array(*candidates)), 1, k)


def prediction_tables(
    scored: DataFrame, threshold: float = THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """Parent and child rows of scored rows with ``score`` and ``factors``.

    Keys follow from the fact key: one prediction per fact row, ranks 1 to 3.
    """
    key = F.col("module_presentation_student_week_id")
    parent = scored.select(
        key.alias("prediction_id"),
        key,
        F.col("score").cast("decimal(5,4)").alias("risk_probability"),
        risk_label(F.col("score"), threshold).alias("predict_result"),
    )
    child = scored.select(
        key.alias("prediction_id"), F.posexplode("factors").alias("pos", "factor")
    ).select(
        (F.col("prediction_id") * 10 + F.col("pos") + 1).alias("contribution_id"),
        "prediction_id",
        F.col("factor.factor_name").alias("factor_name"),
        F.col("factor.factor_value").alias("factor_value"),
        (F.col("pos") + 1).alias("factor_rank"),
        F.col("factor.contribution").cast("decimal(14,4)").alias("shap_value"),
    )
    return parent, child


def explain_pipeline(
    model: PipelineModel,
    model_folder: str,
    preprocessor: Preprocessor,
    background: DataFrame,
    df: DataFrame,
) -> DataFrame:
    """Score rows with a saved pipeline and add their top factors.

    ``background`` holds feature vectors of a fixed-size sample.
    """
    classifier = model.stages[-1]
    transformed = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    features = list(preprocessor.features)
    sample = np.array([r.features.toArray() for r in background.select("features").collect()])
    if hasattr(classifier, "coefficients"):
        means = sample.mean(axis=0)
        weights = classifier.coefficients.toArray()
        linear = linear_contributions(
            dict(zip(preprocessor.names, map(float, weights))),
            dict(zip(preprocessor.names, map(float, means))),
        )
        columns = [linear[n] for n in preprocessor.names]
    else:
        boosted = "GBT" in type(classifier).__name__
        stage = f"{model_folder}/stages/{len(model.stages) - 1}_{classifier.uid}"
        leaves = tree_leaves(df.sparkSession, stage, sample, boosted)
        # A row costs milliseconds, far more than a shuffle of it: rows are dealt evenly to all tasks first.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        transformed = tree_contributions(transformed.repartition(tasks), leaves, len(features))
        columns = [F.col("contributions")[i] for i in range(len(features))]
    return transformed.withColumn("factors", top_factors(features, columns))
