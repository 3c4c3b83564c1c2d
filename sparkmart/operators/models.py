"""Risk classifiers on preprocessed features, with MLlib."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.encode import target_code
from sparkmart.operators import metrics
from sparkmart.operators.features import FULL, FeatureSet, Preprocessor, fit_preprocessor
from sparkmart.session import jobs_at_a_time, scratch_folder, store

# Presentations of the temporal split and the random seed.
TRAIN, VALIDATION, TEST = "2013B", "2013J", "2014B"
SEED = 42

# Search spaces, and the settings kept after the searches.
PENALTY_STRENGTHS = [0.01, 0.1, 1.0, 10.0, 100.0]
L1_RATIOS = [0.25, 0.5, 0.75]
BOOSTING_SPACE = {
    "learning_rate": [0.03, 0.05, 0.1, 0.2],
    "iterations": [100, 200, 300],
    "leaves": [15, 31, 63],
    "leaf_rows": [20, 50, 100],
    "l2": [0.0, 0.1, 1.0, 10.0],
    "balanced": [False, True],
}
RANDOM_TRIALS = 100


def temporal_split(frame: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows by presentation."""
    return tuple(frame.filter(F.col("code_presentation") == p) for p in (TRAIN, VALIDATION, TEST))


def labelled(frame: DataFrame) -> DataFrame:
    return frame.withColumn("label", target_code(F.col("final_result")).cast("double"))


def class_weights(labels: DataFrame) -> DataFrame:
    """Weight per label so that both classes count the same: n / (2 n_class)."""
    counts = labels.groupBy("label").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.count("*").alias("classes"))
    # One row per label and a single total: both sides are of fixed size.
    return (
        counts.withColumn("one", F.lit(1))
        .join(F.broadcast(total.withColumn("one", F.lit(1))), "one")
        .select("label", (F.col("total") / (F.col("classes") * F.col("n"))).alias("weight"))
    )


def with_weights(df: DataFrame, balanced: bool) -> DataFrame:
    if not balanced:
        return df.withColumn("weight", F.lit(1.0))
    return df.join(F.broadcast(class_weights(df)), "label")


# ------------------------------------------------------------------- settings


@dataclass(frozen=True)
class LogisticSetting:
    """``strength`` is the inverse of the penalty; None fits without one."""

    strength: float | None = 1.0
    l1_ratio: float = 0.0
    balanced: bool = False
    max_iterations: int = 1000

    def estimator(self, rows: int) -> Estimator:
        penalty = 0.0 if self.strength is None else 1.0 / (self.strength * rows)
        return LogisticRegression(
            featuresCol="features",
            labelCol="label",
            weightCol="weight",
            regParam=penalty,
            elasticNetParam=self.l1_ratio,
            standardization=False,
            maxIter=self.max_iterations,
            tol=1e-4,
        )


@dataclass(frozen=True)
class ForestSetting:
    trees: int = 100
    depth: int = 10
    balanced: bool = False

    def estimator(self, rows: int) -> Estimator:
        return RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight",
            numTrees=self.trees, maxDepth=self.depth, seed=SEED,
        )


@dataclass(frozen=True)
class BoostingSetting:
    """Boosted trees. MLlib limits depth, not leaves, and has no leaf penalty."""

    learning_rate: float = 0.1
    iterations: int = 100
    leaves: int = 31
    leaf_rows: int = 20
    l2: float = 0.0
    balanced: bool = False

    def estimator(self, rows: int) -> Estimator:
        return GBTClassifier(
            featuresCol="features", labelCol="label", weightCol="weight",
            stepSize=self.learning_rate, maxIter=self.iterations,
            maxDepth=self.leaves.bit_length(), minInstancesPerNode=self.leaf_rows,
            maxBins=255, seed=SEED,
        )


Setting = LogisticSetting | ForestSetting | BoostingSetting

LOGISTIC_TUNED = LogisticSetting(strength=0.01, balanced=True, max_iterations=2000)
BOOSTING_TUNED = BoostingSetting(
    learning_rate=0.03, iterations=200, leaves=15, leaf_rows=50, balanced=True
)


def logistic_grid() -> list[LogisticSetting]:
    """52 settings: ridge, lasso, three mixtures and no penalty, plain and balanced."""
    penalised = [
        LogisticSetting(strength, ratio, balanced, 2000)
        for ratio in (0.0, 1.0, *L1_RATIOS)
        for strength, balanced in product(PENALTY_STRENGTHS, (False, True))
    ]
    return penalised + [LogisticSetting(None, 0.0, b, 2000) for b in (False, True)]


def boosting_trials(trials: int = RANDOM_TRIALS, seed: int = SEED) -> list[BoostingSetting]:
    """Different random settings out of the 864 of the space."""
    space = [
        BoostingSetting(**dict(zip(BOOSTING_SPACE, values)))
        for values in product(*BOOSTING_SPACE.values())
    ]
    return random.Random(seed).sample(space, trials)


# -------------------------------------------------------------------- fitting


def _assembler(preprocessor: Preprocessor) -> VectorAssembler:
    return VectorAssembler(inputCols=preprocessor.names, outputCol="features")


def vectors(df: DataFrame, preprocessor: Preprocessor) -> DataFrame:
    """Label, slice columns and the feature vector."""
    keys = [c for c in ("label", "week_no", "code_module", "code_presentation") if c in df.columns]
    return _assembler(preprocessor).transform(preprocessor.transform(df)).select(*keys, "features")


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = scratch_folder(df.sparkSession, name)
    store(df, folder)
    return df.sparkSession.read.parquet(folder)


def fit(train: DataFrame, setting: Setting, features: FeatureSet = FULL) -> PipelineModel:
    """Preprocessing and model as one pipeline that can be saved.

    The prepared vectors are written first, so that no pass of the fit repeats
    the joins behind the frame.
    """
    train = labelled(train)
    preprocessor = fit_preprocessor(train, features)
    stages = [SQLTransformer(statement=preprocessor.statement()), _assembler(preprocessor)]
    prepared = PipelineModel(stages=stages).transform(with_weights(train, setting.balanced))
    stored = _written(prepared.select("label", "weight", "features"), "training")
    model = setting.estimator(stored.count()).fit(stored)
    return PipelineModel(stages=[*stages, model])


def scored(model: PipelineModel | Model, df: DataFrame) -> DataFrame:
    """Add the probability of failing as ``score``."""
    drop = [c for c in ("rawPrediction", "probability", "prediction") if c not in df.columns]
    result = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return result.drop(*drop)


def most_frequent(train: DataFrame, other: DataFrame) -> DataFrame:
    """Baseline: score every row by the most frequent label of the training rows."""
    mode = (
        labelled(train).groupBy("label").count()
        .orderBy(F.col("count").desc(), "label").limit(1)
        .select(F.col("label").alias("score"), F.lit(1).alias("one"))
    )
    # ``mode`` is exactly one row.
    return labelled(other).withColumn("one", F.lit(1)).join(F.broadcast(mode), "one").drop("one")


# --------------------------------------------------------------------- tuning


def _fits_at_a_time(spark: SparkSession, rows: int, width: int, most: int) -> int:
    """Fits that fit into half the executors' memory together; each keeps all values, label and weight as doubles.

    Each also runs hundreds of jobs, so on the driver it counts as two.
    """
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus()
    memory = sorted(m._1() for m in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(status).values())
    # of a cluster, one is the driver's
    kept = sum(memory[1:] or memory) // 2
    return max(1, min(most, jobs_at_a_time() // 2, kept // max(1, rows * (width + 2) * 8)))


def search(
    train: DataFrame,
    validation: DataFrame,
    settings: Iterable[Setting],
    parallelism: int = 4,
) -> list[tuple[Setting, float]]:
    """F2 on the fixed validation split for every setting, best first.

    Inputs are prepared once and written; each fit is a distributed job. As
    many settings run at the same time as can keep their rows in the executors'
    memory, up to ``parallelism``; F2 is counted without ordering the scores.
    """
    train, validation = labelled(train), labelled(validation)
    preprocessor = fit_preprocessor(train)
    rows = train.count()
    prepared = {
        balanced: _written(
            with_weights(vectors(train, preprocessor), balanced), f"search-{balanced}"
        )
        for balanced in {s.balanced for s in settings}
    }
    held_out = _written(vectors(validation, preprocessor), "search-validation")

    def f2(setting: Setting) -> tuple[Setting, float]:
        model = setting.estimator(rows).fit(prepared[setting.balanced])
        result = metrics.rates_at(scored(model, held_out).select("label", "score")).first()
        return setting, result["f2_fail"]

    with ThreadPoolExecutor(_fits_at_a_time(train.sparkSession, rows, len(preprocessor.names), parallelism)) as pool:
        results = list(pool.map(f2, settings))
    return sorted(results, key=lambda r: -r[1])


def overfit_table(
    models: dict[str, Callable[[DataFrame], DataFrame]], splits: dict[str, DataFrame]
) -> DataFrame:
    """Average precision, F1 and Brier score per model and split."""
    rows = None
    for name, score in models.items():
        for split, df in splits.items():
            part = metrics.evaluate(score(df)).select(
                F.lit(name).alias("model"), F.lit(split).alias("split"),
                "average_precision", "f1_fail", "brier_score",
            )
            rows = part if rows is None else rows.unionByName(part)
    return rows
