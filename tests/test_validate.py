import pytest
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators import validate as V

CLEAN = {
    "courses": [("AAA", "2013B", 240)],
    "student_info": [
        ("AAA", "2013B", 5, "M", "Wales", "HE Qualification", None, "0-35", 0, 60, "N", "Pass"),
        ("AAA", "2013B", 6, "F", "Wales", "HE Qualification", None, "0-35", 0, 60, "N", "Fail"),
    ],
    "assessments": [("AAA", "2013B", 1, "TMA", 20, None), ("BBB", "2013J", 2, "TMA", 20, None)],
    "vle": [(9, "AAA", "2013B", "url", None, None)],
}


@pytest.fixture(scope="module")
def clean(spark):
    return {t: spark.createDataFrame(rows, S.CLEAN_TYPES[t]) for t, rows in CLEAN.items()}


def run(spark, table, rows, clean):
    schema = ", ".join([f"{S.ROW_NUMBER} bigint", *[f"{c} string" for c in S.SOURCE_COLUMNS[table]]])
    raw = spark.createDataFrame([(i, *r) for i, r in enumerate(rows, start=2)], schema)
    validated = V.validate(raw, table, clean).cache()
    codes = {r[S.ROW_NUMBER]: [(e.column, e.code) for e in r.errors] for r in validated.collect()}
    assert len(codes) == len(rows)
    return [codes[i] for i in range(2, len(rows) + 2)], validated


STUDENT = ("AAA", "2013B", "5", "M", "Wales", "HE Qualification", "", "0-35", "0", "60", "N", "Pass")


def student(**changes):
    return tuple({**dict(zip(S.SOURCE_COLUMNS["student_info"], STUDENT)), **changes}.values())


@pytest.mark.parametrize(
    "column, value, code",
    [
        ("code_module", " ", "REQUIRED"),
        ("code_module", "AAAA", "TOO_LONG"),
        ("code_presentation", None, "REQUIRED"),
        ("code_presentation", "2013BX", "TOO_LONG"),
        ("id_student", "", "REQUIRED"),
        ("id_student", "12\n", "INVALID_INTEGER"),
        ("id_student", "\t5", "INVALID_INTEGER"),
        ("id_student", "9" * 19, "BIGINT_OUT_OF_RANGE"),
        ("id_student", "0" * 20, "BIGINT_OUT_OF_RANGE"),
        ("id_student", "0", "NOT_POSITIVE"),
        ("gender", "X", "INVALID_VALUE"),
        ("region", None, "REQUIRED"),
        ("imd_band", "10-30%", "INVALID_VALUE"),
        ("num_of_prev_attempts", "00000000005", "INTEGER_OUT_OF_RANGE"),
        ("num_of_prev_attempts", "9999999999", "INTEGER_OUT_OF_RANGE"),
        ("num_of_prev_attempts", "-1", "NEGATIVE"),
        ("studied_credits", "0", "NOT_POSITIVE"),
        ("disability", "n", "INVALID_VALUE"),
        ("final_result", "", "REQUIRED"),
    ],
)
def test_student_rules(spark, clean, column, value, code):
    codes, _ = run(spark, "student_info", [student(**{column: value})], clean)
    assert codes == [[(column, code)]]


def test_errors_of_several_columns_keep_the_declared_order(spark, clean):
    codes, _ = run(spark, "student_info", [student(gender="", studied_credits="x", code_module="")], clean)
    assert codes == [[
        ("code_module", "REQUIRED"), ("gender", "REQUIRED"), ("studied_credits", "INVALID_INTEGER"),
    ]]


def test_references_are_only_checked_on_valid_rows(spark, clean):
    codes, _ = run(spark, "student_info", [student(code_module="ZZZ"), student(code_module="ZZZ", gender="")], clean)
    assert codes == [[("code_module, code_presentation", "COURSE_NOT_FOUND")], [("gender", "REQUIRED")]]


def test_first_valid_row_wins_and_keys_compare_as_numbers(spark, clean):
    label = "code_module, code_presentation, id_student"
    rows = [
        student(gender="?"),            # invalid, so not the first
        student(id_student="+5"),
        student(id_student="05"),
        student(id_student="5", imd_band="10-20"),
        student(id_student=" 5 ", region=" Wales "),
    ]
    codes, validated = run(spark, "student_info", rows, clean)
    assert codes == [
        [("gender", "INVALID_VALUE")], [], [(label, "EXACT_DUPLICATE")],
        [(label, "CONFLICTING_DUPLICATE")], [(label, "EXACT_DUPLICATE")],
    ]
    kept = V.route_clean(validated, "student_info").collect()
    assert [(r.id_student, r.imd_band) for r in kept] == [(5, None)]


def test_imd_spelling_is_canonical_before_comparing(spark, clean):
    codes, validated = run(
        spark, "student_info", [student(imd_band="10-20"), student(imd_band="10-20%")], clean
    )
    assert codes[1][0][1] == "EXACT_DUPLICATE"
    assert V.route_clean(validated, "student_info").first().imd_band == "10-20%"


def test_quarantine_keeps_raw_text(spark, clean):
    _, validated = run(spark, "student_info", [student(gender=" ? ")], clean)
    row = V.route_quarantine(validated, "student_info").first()
    assert (row.gender, row.source_file, row[S.ROW_NUMBER]) == (" ? ", "studentInfo.csv", 2)
    assert row.detected_at is not None and row.error_details[0].message


def test_registration_dates(spark, clean):
    rows = [
        ("AAA", "2013B", "5", "10", "5"), ("AAA", "2013B", "5", "10", ""), ("AAA", "2013B", "77", "", ""),
        ("AAA", "2013B", "6", "1.0", "x"),
    ]
    codes, _ = run(spark, "student_registration", rows, clean)
    assert codes == [
        [("date_registration, date_unregistration", "INVALID_DATE_ORDER")],
        [],
        [("code_module, code_presentation, id_student", "STUDENT_NOT_FOUND")],
        [("date_registration", "INVALID_INTEGER"), ("date_unregistration", "INVALID_INTEGER")],
    ]


def test_assessment_dates_and_weights(spark, clean):
    rows = [
        ("AAA", "2013B", "1", "TMA", "", "10"), ("AAA", "2013B", "2", "Exam", "", "100.00"),
        ("AAA", "2013B", "3", "CMA", "-1", "100.01"), ("AAA", "2013B", "4", "CMA", "5", "1.234"),
        ("AAA", "2013B", "5", "CMA", "5", "0" * 21), ("AAA", "2013B", "6", "CMA", "5", "1.0"),
        ("AAA", "2013B", "6", "CMA", "5", "1.00"),
    ]
    codes, _ = run(spark, "assessments", rows, clean)
    assert codes == [
        [("date", "REQUIRED_FOR_COURSEWORK")], [],
        [("date", "NEGATIVE"), ("weight", "OUT_OF_RANGE")],
        [("weight", "INVALID_DECIMAL")], [("weight", "OUT_OF_RANGE")], [],
        [("id_assessment", "EXACT_DUPLICATE")],
    ]


def test_results_need_their_assessment_and_student(spark, clean):
    rows = [
        ("1", "5", "-3", "0", ""), ("7", "5", "3", "0", "5"), ("2", "5", "3", "0", "5"),
        ("1", "6", "3", "2", "101"), ("1", "6", "3", "99999", "5"), ("1", "5", "-3", "0", "7"),
    ]
    codes, _ = run(spark, "student_assessment", rows, clean)
    assert codes == [
        [], [("id_assessment", "ASSESSMENT_NOT_FOUND")],
        [("id_assessment, id_student", "STUDENT_NOT_FOUND_FOR_ASSESSMENT")],
        [("is_banked", "INVALID_VALUE"), ("score", "OUT_OF_RANGE")],
        [("is_banked", "SMALLINT_OUT_OF_RANGE")],
        [("id_assessment, id_student", "CONFLICTING_DUPLICATE")],
    ]


def test_site_weeks(spark, clean):
    rows = [
        ("1", "AAA", "2013B", "url", "3", ""), ("2", "AAA", "2013B", "url", "3", "2"),
        ("3", "AAA", "2013B", "quiz", "", ""), ("4", "AAA", "2013B", "blog", "1", "2"),
    ]
    codes, _ = run(spark, "vle", rows, clean)
    assert codes == [
        [("week_from, week_to", "INCOMPLETE_WEEK_RANGE")], [("week_from, week_to", "INVALID_WEEK_ORDER")],
        [], [("activity_type", "INVALID_VALUE")],
    ]


def test_clicks_report_both_references_and_only_full_repeats(spark, clean):
    rows = [
        ("AAA", "2013B", "77", "88", "1", "2"), ("AAA", "2013B", "5", "9", "1", "2"),
        ("AAA", "2013B", "5", "9", "1", "3"), ("AAA", "2013B", "+5", "09", "1", "2"),
        ("AAA", "2013B", "5", "9", "1", "0"),
    ]
    codes, _ = run(spark, "student_vle", rows, clean)
    assert codes == [
        [
            ("code_module, code_presentation, id_student", "STUDENT_NOT_FOUND"),
            ("id_site, code_module, code_presentation", "SITE_NOT_FOUND"),
        ],
        [], [],
        [("code_module, code_presentation, id_student, id_site, date, sum_click", "EXACT_DUPLICATE")],
        [("sum_click", "NOT_POSITIVE")],
    ]


def test_many_copies_of_one_row(spark, clean):
    """A third of the rows is one row: every copy but the first is found."""
    copies = spark.range(2, 3002).select(
        F.col("id").alias(S.ROW_NUMBER), F.lit("AAA").alias("code_module"), F.lit("2013B").alias("code_presentation"),
        F.lit("5").alias("id_student"), F.lit("9").alias("id_site"),
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("date"),
        F.lit("2").alias("sum_click"),
    )
    validated = V.validate(copies, "student_vle", clean)
    rejected = V.error_codes(validated).agg(F.count("*").alias("n"), F.min(S.ROW_NUMBER).alias("first")).first()
    assert (rejected.n, rejected.first) == (999, 6)


def test_copies_of_valid_rows_leave_the_clean_zone_unchanged(small):
    for table in S.TABLES[:-1]:
        again = V.route_clean(small.validated_with_faults(table), table)
        base = small.clean(table)
        assert again.exceptAll(base).isEmpty() and base.exceptAll(again).isEmpty(), table
