"""A whole run from CSV files to predictions."""

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators import models
from sparkmart.operators.checks import ContractError
from sparkmart.plans import pipeline
from sparkmart.sources.publish import current_snapshot

SETTING = models.BoostingSetting(iterations=3, leaves=7)


@pytest.fixture(scope="module")
def run(spark, small, tmp_path_factory):
    src, out = tmp_path_factory.mktemp("src"), tmp_path_factory.mktemp("out")
    for table in S.TABLES:
        rows = small.faulted(table).orderBy(S.ROW_NUMBER).drop(S.ROW_NUMBER).toPandas()
        rows.to_csv(src / S.SOURCE_FILES[table], index=False)
    tables = pipeline.run_all(spark, str(src), str(out), SETTING)
    return src, str(out), tables


def test_zones_hold_the_same_as_the_fixture(spark, small, run):
    snapshot = current_snapshot(spark, run[1])
    for table in S.TABLES[:-1]:
        stored = snapshot.read("clean", table)
        assert stored.exceptAll(small.clean(table)).isEmpty(), table
        assert stored.count() == small.clean(table).count()
    raw, clean, quarantine = (snapshot.read(z, "student_vle").count() for z in ("raw", "clean", "quarantine"))
    assert raw == clean + quarantine and quarantine > 0


def test_each_prediction_has_three_ranked_factors(spark, run):
    parent, child = run[2]
    frame = pipeline.serving.predict_frame(pipeline.marts_of(current_snapshot(spark, run[1])))
    assert parent.count() == frame.count() > 0
    ranks = child.groupBy("prediction_id").agg(F.sort_array(F.collect_list("factor_rank")).alias("ranks"))
    assert ranks.filter(F.col("ranks") != F.array(F.lit(1), F.lit(2), F.lit(3))).isEmpty()
    assert child.join(parent, "prediction_id", "left_anti").isEmpty()
    assert parent.filter("risk_probability not between 0 and 1").isEmpty()
    assert dict(parent.dtypes)["risk_probability"] == "decimal(5,4)"


def test_artifact_describes_the_model(spark, run):
    artifact = pipeline.load_artifact(spark, f"{run[1]}/model")
    assert artifact["metadata"]["threshold"] == 0.5
    assert artifact["metadata"]["processed_features"] == artifact["preprocessor"].names
    assert artifact["background"].count() == 100


def test_a_failed_run_leaves_the_published_snapshot(spark, run):
    src, out, _ = run
    before = current_snapshot(spark, out).run_id
    courses = src / "courses.csv"
    text = courses.read_text()
    courses.write_text(text.split("\n")[0] + "\n")
    try:
        with pytest.raises(ContractError):
            pipeline.run_pipeline(spark, str(src), out)
    finally:
        courses.write_text(text)
    assert current_snapshot(spark, out).run_id == before
