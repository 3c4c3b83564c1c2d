"""The runs a user starts: load and build, train, predict, or all of them."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators import checks, explain, mart, metrics, models, serving
from sparkmart.operators import validate as V
from sparkmart.operators.features import Feature, Preprocessor, fit_preprocessor
from sparkmart.operators.rules import reference_levels, referenced_tables
from sparkmart.session import configure, in_parallel
from sparkmart.sources.csv_source import read_all_sources
from sparkmart.sources.publish import (
    Snapshot,
    create_empty_zones,
    current_snapshot,
    new_snapshot,
    publish,
    require_rows,
)


def init_zones(spark: SparkSession, out: str) -> Snapshot:
    return create_empty_zones(configure(spark), out)


def _validate_table(snapshot: Snapshot, table: str) -> None:
    """Annotate once, route twice, and stop the run unless the counts add up."""
    raw = snapshot.read("raw", table)
    clean = {t: snapshot.read("clean", t) for t in referenced_tables(table)}
    validated = snapshot.write("validated", table, V.validate(raw, table, clean))
    kept = snapshot.write("clean", table, V.route_clean(validated, table))
    rejected = snapshot.write("quarantine", table, V.route_quarantine(validated, table))
    counts = V.reconcile(raw, kept, rejected, table).first()
    if not counts.is_reconciled:
        raise checks.ContractError(f"{table} does not reconcile: {counts.asDict()}")


def _build_mart(snapshot: Snapshot, table: str) -> None:
    build, inputs = mart.BUILDERS[table]
    tables = [snapshot.read(zone, name) for zone, name in inputs]
    if table in mart.PARTITIONED:
        column = mart.PARTITIONED[table]
        written = snapshot.write("mart", table, build(*tables, stored=True), [column])
    else:
        written = snapshot.write("mart", table, build(*tables))
    require_rows(written, table)


def build_marts(snapshot: Snapshot) -> dict[str, DataFrame]:
    """Dimensions in order, then the facts, which do not depend on each other."""
    facts = [t for t in mart.BUILDERS if t.startswith("fact")]
    for table in mart.BUILDERS:
        if table not in facts:
            _build_mart(snapshot, table)
    in_parallel([partial(_build_mart, snapshot, t) for t in facts])
    return marts_of(snapshot)


def marts_of(snapshot: Snapshot) -> dict[str, DataFrame]:
    return {t: snapshot.read("mart", t) for t in S.MART_TYPES}


def run_pipeline(spark: SparkSession, src: str, out: str) -> Snapshot:
    """Read, validate and transform a source folder; publish only if all checks pass."""
    configure(spark)
    snapshot = new_snapshot(spark, out)
    scans = read_all_sources(spark, src)
    in_parallel([partial(snapshot.write, "raw", table, scan) for table, scan in scans.items()])
    for level in reference_levels():
        in_parallel([partial(_validate_table, snapshot, table) for table in level])
    marts = build_marts(snapshot)
    checks.require_clean(checks.constraint_report(marts))
    checks.validate_serving(serving.predict_frame(marts))
    publish(snapshot)
    return snapshot


# ------------------------------------------------------------------ artifact


@dataclass(frozen=True)
class Trained:
    """What predictions need to know of a model, and how it did on the test presentation."""

    threshold: float
    processed_features: list[str]
    test_metrics: dict


def save_artifact(
    spark: SparkSession,
    folder: str,
    model: PipelineModel,
    preprocessor: Preprocessor,
    background: DataFrame,
    metadata: dict,
) -> None:
    """Write an artifact of its own run; it becomes the current one when all of it is there."""
    snapshot = new_snapshot(spark, folder)
    model.write().save(snapshot.path("artifact", "model"))
    snapshot.write("artifact", "background", background)
    features = [(f.group, f.name, f.column, f.sql) for f in preprocessor.features]
    row = [(json.dumps({"run_id": snapshot.run_id, **metadata}), json.dumps(features))]
    about = spark.createDataFrame(row, "metadata string, features string")
    snapshot.write("artifact", "metadata", about)
    publish(snapshot)


def load_artifact(spark: SparkSession, folder: str) -> dict:
    """The artifact published last."""
    snapshot = current_snapshot(spark, folder)
    about = snapshot.read("artifact", "metadata").first()
    model_folder = snapshot.path("artifact", "model")
    return {
        "model": PipelineModel.load(model_folder),
        "model_folder": model_folder,
        "background": snapshot.read("artifact", "background"),
        "metadata": json.loads(about.metadata),
        "preprocessor": Preprocessor(tuple(Feature(*f) for f in json.loads(about.features))),
    }


def train(
    spark: SparkSession, out: str, setting: models.Setting = models.BOOSTING_TUNED
) -> dict:
    """Fit the chosen model on train and validation, test it and save the artifact."""
    configure(spark)
    frame = serving.train_frame(marts_of(current_snapshot(spark, out)))
    checks.validate_serving(frame, train=True)
    used = frame.filter(F.col("code_presentation").isin(models.TRAIN, models.VALIDATION))
    test = frame.filter(F.col("code_presentation") == models.TEST)
    model = models.fit(used, setting)
    result = metrics.evaluate(
        models.scored(model, models.labelled(test)).select("label", "score")
    ).first()
    preprocessor = fit_preprocessor(used)
    sample = explain.seeded_sample(
        used, "module_presentation_student_week_id", explain.BACKGROUND_ROWS, models.SEED
    )
    metadata = asdict(Trained(S.THRESHOLD, preprocessor.names, result.asDict()))
    save_artifact(
        spark, f"{out}/model", model, preprocessor,
        models.vectors(models.labelled(sample), preprocessor), metadata,
    )
    return metadata


def predict(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Score the running presentation; both prediction tables are replaced at once."""
    configure(spark)
    snapshot = current_snapshot(spark, out)
    frame = serving.predict_frame(marts_of(snapshot))
    checks.validate_serving(frame)
    artifact = load_artifact(spark, f"{out}/model")
    result = explain.explain_pipeline(
        artifact["model"], artifact["model_folder"], artifact["preprocessor"],
        artifact["background"], frame,
    )
    needed = result.select("module_presentation_student_week_id", "score", "factors")
    target = new_snapshot(spark, f"{out}/predictions")
    stored = target.write("scored", "student_week", needed)
    parent, child = explain.prediction_tables(stored, artifact["metadata"]["threshold"])
    tables = (
        target.write("prediction", "student_week_prediction", parent),
        target.write("prediction", "prediction_contribution", child),
    )
    publish(target)
    return tables


def run_all(
    spark: SparkSession, src: str, out: str, setting: models.Setting = models.BOOSTING_TUNED
) -> tuple[DataFrame, DataFrame]:
    """Empty zones, pipeline, training and prediction in one go."""
    init_zones(spark, out)
    run_pipeline(spark, src, out)
    train(spark, out, setting)
    return predict(spark, out)
