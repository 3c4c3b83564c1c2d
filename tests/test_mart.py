"""Facts on small hand-made zones against direct definitions."""

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators import checks
from sparkmart.operators import mart as M

LENGTH = 30  # five weeks: 2..5, the last ends on day 30


@pytest.fixture(scope="module")
def zone(spark):
    def table(name, rows):
        return spark.createDataFrame(rows, S.CLEAN_TYPES[name])

    student = ("M", "Wales", "HE Qualification", None, "0-35", 0, 60, "N", "Pass")
    clean = {
        "courses": table("courses", [("AAA", "2013B", LENGTH)]),
        "student_info": table(
            "student_info", [("AAA", "2013B", i, *student) for i in (1, 2, 3, 4)]
        ),
        "student_registration": table("student_registration", [
            ("AAA", "2013B", 1, None, None), ("AAA", "2013B", 2, 15, None), ("AAA", "2013B", 3, -5, 21),
            ("AAA", "2013B", 4, 30, None),
        ]),
        "assessments": table("assessments", [
            ("AAA", "2013B", 1, "TMA", 10, None), ("AAA", "2013B", 2, "CMA", 20, None),
            ("AAA", "2013B", 3, "Exam", None, None), ("AAA", "2013B", 4, "TMA", 30, None),
        ]).withColumn("weight", F.lit(1).cast("decimal(5,2)")),
        "student_assessment": table("student_assessment", [
            (1, 1, 9, 0, None), (2, 1, 25, 0, None), (1, 2, -40, 1, None), (2, 2, 35, 0, None),
            (3, 1, 29, 0, None),
        ]),
        "vle": table("vle", [(7, "AAA", "2013B", "url", None, None), (8, "AAA", "2013B", "quiz", None, None)]),
        "student_vle": table("student_vle", [
            ("AAA", "2013B", 1, 7, -3, 4), ("AAA", "2013B", 1, 7, 3, 2), ("AAA", "2013B", 1, 8, 8, 5),
            ("AAA", "2013B", 1, 8, 8, 1), ("AAA", "2013B", 1, 7, 29, 3), ("AAA", "2013B", 1, 7, 30, 100),
            ("AAA", "2013B", 2, 7, 2, 50), ("AAA", "2013B", 2, 8, 22, 6),
        ]),
    }
    modules = M.dim_module_presentation(clean["courses"]).cache()
    students = M.dim_student_module_presentation(
        clean["student_info"], clean["student_registration"], modules
    ).cache()
    assessments = M.dim_assessments(clean["assessments"], modules).cache()
    return clean, modules, students, assessments


def test_weeks_of_a_presentation(zone):
    _, modules, _, _ = zone
    weeks = [tuple(r) for r in M.dim_week(modules).orderBy("week_no").collect()]
    assert weeks == [(1, 2, 7, 14), (2, 3, 14, 21), (3, 4, 21, 28), (4, 5, 28, 35)]


def test_due_week_of_undated_exam_is_the_last(zone):
    *_, assessments = zone
    got = {r.assessment_no: r.effective_due_week for r in assessments.collect()}
    assert got == {1: 2, 2: 3, 3: 5, 4: 5}


def test_grid_needs_enrolment_at_week_end(zone):
    _, modules, students, _ = zone
    got = sorted((r.id_student, r.week_no) for r in M.student_weeks(students, modules).collect())
    assert got == [(1, 2), (1, 3), (1, 4), (1, 5), (2, 3), (2, 4), (2, 5), (3, 2), (3, 3)]


def test_student_fact(zone):
    clean, modules, students, assessments = zone
    fact = M.fact_student_week(
        clean["student_vle"], clean["vle"], clean["student_assessment"], assessments, students, modules
    ).join(students.select("student_module_presentation_id", "id_student"), "student_module_presentation_id")
    got = {
        (r.id_student, r.week_id + 1): (
            r.click_count_week, r.click_count_to_week, r.active_day_count_week, r.active_day_count_to_week,
            r.site_count_to_week, r.activity_type_count_to_week, r.coursework_due_count_to_week,
            r.coursework_submitted_count_week, r.coursework_submitted_count_to_week,
            r.coursework_late_count_to_week, r.coursework_overdue_count_to_week,
        )
        for r in fact.collect()
    }
    # Student 1: early clicks only add to the totals; day 30 is after the end.
    assert got[1, 2] == (6, 12, 1, 3, 2, 2, 1, 1, 1, 0, 0)
    assert got[1, 3] == (0, 12, 0, 3, 2, 2, 2, 0, 1, 0, 1)
    assert got[1, 4] == (0, 12, 0, 3, 2, 2, 2, 1, 2, 1, 0)
    assert got[1, 5] == (3, 15, 1, 4, 2, 2, 2, 0, 2, 1, 0)
    # Student 2 starts in week 3: what came before is lost, banked work counts as done.
    assert got[2, 3] == (0, 0, 0, 0, 0, 0, 2, 0, 0, 0, 1)
    assert got[2, 4] == (6, 6, 1, 1, 1, 1, 2, 0, 0, 0, 1)
    # Work handed in after the end never counts.
    assert got[2, 5] == (0, 6, 0, 1, 1, 1, 2, 0, 0, 0, 1)
    assert got[3, 3] == (0, 0, 0, 0, 0, 0, 2, 0, 0, 0, 2)
    assert len(got) == 9


def test_assessment_fact(zone):
    clean, modules, students, assessments = zone
    fact = M.fact_assessment_week(clean["student_assessment"], assessments, students, modules).join(
        assessments.select("assessment_id", "assessment_no"), "assessment_id"
    )
    got = {
        (r.assessment_no, r.week_id + 1): (
            r.submitted_student_count_week, r.submitted_student_count_to_week, r.late_student_count_week,
            r.late_student_count_to_week, r.overdue_unsubmitted_student_count_at_week_end,
        )
        for r in fact.collect()
    }
    assert got[1, 2] == (1, 1, 0, 0, 1)   # student 3 has not submitted, 2 is not there yet
    assert got[1, 3] == (0, 1, 0, 0, 1)
    assert got[1, 4] == (0, 1, 0, 0, 0)   # student 3 left
    assert got[2, 3] == (0, 0, 0, 0, 3)
    assert got[2, 4] == (1, 1, 1, 1, 1)
    assert got[2, 5] == (0, 1, 0, 1, 1)
    assert {a for a, _ in got} == {1, 2, 4} and len(got) == 12


def test_activity_fact_keeps_idle_weeks(zone):
    clean, modules, _, _ = zone
    fact = M.fact_activity_type_week(clean["student_vle"], clean["vle"], modules)
    got = {
        (r.activity_type, r.week_id + 1): (
            r.click_count_week, r.click_count_to_week,
            r.median_student_click_count_week and float(r.median_student_click_count_week),
            r.active_student_count_week, r.accessed_site_count_week,
        )
        for r in fact.collect()
    }
    assert got["quiz", 2] == (6, 6, 6.0, 1, 1)
    assert got["quiz", 3] == (0, 6, None, 0, 0)
    assert got["url", 2] == (0, 56, None, 0, 0)   # days before week 2 only add up
    assert got["url", 5] == (3, 59, 3.0, 1, 1)
    assert len(got) == 8


def test_constraints_hold_and_breaks_are_found(small):
    report = checks.constraint_report(small.marts())
    checks.require_clean(report)
    broken = dict(small.marts())
    dim = broken["dim_assessments"]
    broken["dim_assessments"] = dim.filter("assessment_id > 1").unionByName(dim.filter("assessment_id = 2"))
    found = {r.check: r.violations for r in checks.constraint_report(broken).collect() if r.violations}
    assert found["dim_assessments: primary key"] == 1 and found["dim_assessments: unique key"] == 1
    assert found["fact_module_presentation_assessments_week: assessment_id"] > 0


def test_running_sums_end_at_the_totals(small):
    fact = small.mart("fact_student_module_presentation_week")
    last = fact.groupBy("student_module_presentation_id").agg(
        F.max_by("click_count_to_week", "week_id").alias("last"), F.max("click_count_to_week").alias("most"),
        F.sum("click_count_week").alias("weekly"),
    )
    assert last.filter("last <> most OR weekly > last").isEmpty()


def test_serving_contract_finds_breaks(small):
    frame = small.predict_frame()
    checks.validate_serving(frame)
    checks.validate_serving(small.train_frame(), train=True)
    with pytest.raises(checks.ContractError, match="repeated grain"):
        checks.validate_serving(frame.unionByName(frame.limit(1)))
    with pytest.raises(checks.ContractError, match="another type"):
        checks.validate_serving(frame.withColumn("week_no", F.col("week_no").cast("int")))
    with pytest.raises(checks.ContractError, match="missing"):
        checks.validate_serving(frame.drop("region"))
    with pytest.raises(checks.ContractError, match="target missing"):
        checks.validate_serving(frame, train=True)
    with pytest.raises(checks.ContractError, match="empty"):
        checks.validate_serving(frame.filter("false"))


def test_fact_keys_stay_apart_beyond_a_thousand_weeks(spark):
    df = spark.createDataFrame([(1, 1005), (2, 5)], "entity int, week int")
    keys = [r[0] for r in df.select(M.fact_key(F.col("entity"), F.col("week"))).collect()]
    assert len(set(keys)) == 2
