"""Shape of the physical plans of the large operators."""

import pytest

from sparkmart import schemas as S
from sparkmart.operators import validate as V


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("table", S.TABLES)
def test_validation_stays_in_the_jvm_and_never_gathers_rows(small, table):
    plan = plan_of(V.validate(small.raw(table), table, small.references(table)))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "BatchEvalPython"):
        assert bad not in plan
    # The only single-partition exchange is over partition sizes of the row numbering.
    assert plan.count("SinglePartition") <= 2


@pytest.mark.parametrize("table", [t for t in S.MART_TYPES if t.startswith("fact")])
def test_facts_have_no_nested_loops(small, table):
    plan = plan_of(small.build_mart(table))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert bad not in plan


def test_student_fact_shuffles_clicks_twice(small):
    """Once to collapse the marks, once on the student for grid, sums and windows."""
    plan = plan_of(small.build_mart("fact_student_module_presentation_week"))
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    on_student = [e for e in exchanges if "REPARTITION_BY_COL" in e]
    assert len(on_student) == 1 and len(exchanges) <= 4


def moved_rows(df):
    """Exchanges of the executed plan apart from broadcasts."""
    df.collect()
    return [line for line in plan_of(df).split("\n") if "Exchange" in line and "Broadcast" not in line and "Reused" not in line]


def test_rows_without_repeated_keys_are_not_moved(spark, small):
    """Only keys are shuffled to find duplicates; full rows stay where they are."""
    rows = V.validate(small.raw("student_vle"), "student_vle", small.references("student_vle"))
    assert not moved_rows(rows)


@pytest.mark.parametrize("sent", [20_000, 0])
def test_only_suspects_are_moved(spark, small, monkeypatch, sent):
    """With repeated keys too many to send, rows outside their slots still pass without a shuffle, and nothing changes."""
    raw, references = small.faulted("student_assessment"), small.references("student_assessment")
    want = sorted(map(str, V.error_codes(V.validate(raw, "student_assessment", references)).collect()))
    assert any("DUPLICATE" in w for w in want)
    monkeypatch.setattr(V, "SENT", sent)
    checked = V.validate(raw, "student_assessment", references)
    assert sorted(map(str, V.error_codes(checked).collect())) == want
    assert checked.count() == raw.count()
    if sent:
        assert not moved_rows(checked)


def test_constraints_read_each_table_once_and_shuffle_once(small):
    from sparkmart.operators import checks

    marts = small.marts()
    report = checks.constraint_report(marts)
    report.collect()
    plan = plan_of(report).split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == len(marts)
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(shuffles) <= 2  # all keys; then one row per check


def test_serving_filter_reaches_the_dimension_scan(small):
    plan = plan_of(small.train_frame())
    assert "PushedFilters: [In(code_presentation" in plan


def test_frames_read_only_their_presentations(small):
    """The fact is stored by presentation, and other presentations are not read."""
    predict, train = small.predict_frame(), small.train_frame()
    for frame in (predict, train):
        filters = [line.split("PartitionFilters: ")[1].split("PushedFilters")[0] for line in plan_of(frame).split("\n") if "PartitionFilters: " in line]
        assert sum("code_presentation" in f for f in filters) == 1
    name = "fact_student_module_presentation_week"
    stored = small.stored_mart(name)
    assert len({f.split("code_presentation=")[1][:5] for f in stored.inputFiles()}) > 1
    assert small.mart(name).columns == [c.split()[0] for c in S.MART_TYPES[name].split(", ")]
