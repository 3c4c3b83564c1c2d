"""Star schema: four dimensions and three weekly cumulative facts.

Each fact turns its inputs into small per-week deltas and sums them along the
week grid, so no operator joins every week with every event. Running sums see
at most one row per entity and week.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import calendar as C
from sparkmart.operators.distribution import placed_counts, quantile
from sparkmart.schemas import ACTIVITY_TYPES, COURSEWORK_TYPES, MART_TYPES
from sparkmart.sources.numbering import number_rows

COURSE = ["code_module", "code_presentation"]
STUDENT = ["module_presentation_id", "id_student"]

# Fact keys are computed from dimension keys: entity * 10^9 + week. Lengths are
# 32-bit days, so weeks stay below 307 million; larger entities than a key holds raise.
WEEKS_PER_KEY = 1_000_000_000


def week_id(week_no: Column) -> Column:
    return (week_no - (C.FIRST_WEEK - 1)).cast("bigint")


def fact_key(entity: Column, week_no: Column) -> Column:
    return (entity.cast("bigint") * F.lit(WEEKS_PER_KEY) + week_no).cast("bigint")


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


# ---------------------------------------------------------------- dimensions


def dim_module_presentation(courses: DataFrame) -> DataFrame:
    return number_rows(courses, COURSE, name="module_presentation_id")


def dim_week(modules: DataFrame) -> DataFrame:
    """Weeks from 2 to the last week of the longest presentation; none if all are shorter."""
    week = F.col("week_no")
    longest = modules.agg(F.max("module_presentation_length").alias("length"))
    return longest.select(
        F.explode(C.week_numbers(C.week_count(F.col("length")))).alias("week_no")
    ).select(
        week_id(week).alias("week_id"),
        "week_no",
        (7 * (week - 1)).alias("start_day"),
        (7 * week).alias("end_day"),
    )


def dim_assessments(assessments: DataFrame, modules: DataFrame) -> DataFrame:
    df = assessments.join(modules, COURSE).select(
        F.col("id_assessment").alias("assessment_no"),
        "module_presentation_id",
        "assessment_type",
        F.col("date").alias("due_date"),
        "weight",
        C.effective_due_week(
            F.col("date"), F.col("assessment_type"), F.col("module_presentation_length")
        ).alias("effective_due_week"),
    )
    return number_rows(df, ["assessment_no"], name="assessment_id")


def dim_student_module_presentation(
    students: DataFrame, registrations: DataFrame, modules: DataFrame
) -> DataFrame:
    """Students joined to their module presentation, with dates where registered."""
    df = (
        students.join(modules.drop("module_presentation_length"), COURSE)
        .join(registrations, [*COURSE, "id_student"], "left")
        .select(
            "id_student", "module_presentation_id", "gender", "region", "highest_education",
            "imd_band", "age_band", "disability", "num_of_prev_attempts", "studied_credits",
            "date_registration", "date_unregistration", "final_result",
        )
    )
    return number_rows(
        df, ["id_student", "module_presentation_id"], name="student_module_presentation_id"
    )


# --------------------------------------------------------------------- grids


def module_weeks(modules: DataFrame) -> DataFrame:
    """One row per module presentation and week that starts before its end."""
    length = F.col("module_presentation_length")
    return modules.select(
        "*", F.explode(C.week_numbers(C.week_count(length))).alias("week_no")
    ).withColumn("week_end_day_exclusive", C.week_end(F.col("week_no"), length))


def enrolment(students: DataFrame, modules: DataFrame) -> DataFrame:
    """First and last week at whose end a student is enrolled, where there is one.

    Both limits follow from the dates, as week ends only grow.
    """
    length = F.col("module_presentation_length")
    return (
        students.join(
            modules.select("module_presentation_id", "module_presentation_length"),
            "module_presentation_id",
        )
        .withColumn("enrolled_from", C.enrolled_from(F.col("date_registration"), length))
        .withColumn("enrolled_until", C.enrolled_until(F.col("date_unregistration"), length))
        .filter(F.col("enrolled_from") <= F.col("enrolled_until"))
    )


def student_weeks(students: DataFrame, modules: DataFrame) -> DataFrame:
    """Student-week grid: the weeks at whose end the student is enrolled."""
    return enrolment(students, modules).select(
        "student_module_presentation_id",
        *STUDENT,
        F.explode(F.sequence("enrolled_from", "enrolled_until")).alias("week_no"),
    )


# -------------------------------------------------------------------- inputs


def click_events(clicks: DataFrame, sites: DataFrame, modules: DataFrame) -> DataFrame:
    """Clicks before the end of the presentation, with activity type and week."""
    return (
        clicks.join(modules, COURSE)
        .filter(F.col("date") < F.col("module_presentation_length"))
        .join(sites.select("id_site", *COURSE, "activity_type"), ["id_site", *COURSE])
        .select(
            *STUDENT,
            "id_site",
            "activity_type",
            F.col("date").alias("click_date"),
            C.week_of(F.col("date")).alias("event_week_no"),
            "sum_click",
        )
    )


def coursework(assessments: DataFrame) -> DataFrame:
    return assessments.filter(F.col("assessment_type").isin(COURSEWORK_TYPES))


def coursework_results(
    results: DataFrame, assessments: DataFrame, modules: DataFrame
) -> DataFrame:
    """Results of coursework with its due date and the length of its presentation."""
    return (
        results.withColumnRenamed("id_assessment", "assessment_no")
        .join(coursework(assessments), "assessment_no")
        .join(
            modules.select("module_presentation_id", "module_presentation_length"),
            "module_presentation_id",
        )
        .select(
            "assessment_id", *STUDENT, "date_submitted", "is_banked", "due_date",
            "module_presentation_length",
        )
    )


def submissions(results: DataFrame) -> DataFrame:
    """Real submissions before the end of the presentation."""
    return results.filter(
        (F.col("is_banked") == 0)
        & (F.col("date_submitted") < F.col("module_presentation_length"))
    ).withColumn("submit_week", C.week_of(F.col("date_submitted")))


def settled_results(results: DataFrame) -> DataFrame:
    """Results that end an overdue state, with the week from which they do.

    A result counts from the week in which its work is due and it is banked
    or submitted. Results after the last week end never count.
    """
    length = F.col("module_presentation_length")
    done = F.when(F.col("is_banked") == 1, F.lit(C.FIRST_WEEK)).otherwise(
        C.first_week_after(F.col("date_submitted"), length)
    )
    return (
        results.withColumn("due_week", C.first_week_after(F.col("due_date"), length))
        .withColumn("done_week", done)
        .filter(F.col("due_week").isNotNull() & F.col("done_week").isNotNull())
        .withColumn("settled_week", F.greatest("due_week", "done_week"))
    )


# ----------------------------------------------------- fact: student x week


def click_deltas(events: DataFrame) -> DataFrame:
    """Clicks, active days and first-seen sites and types per student and week.

    Every event leaves three marks (its day, site and type). One aggregate
    keeps a mark once per student with its first week, so a student's repeats
    collapse before the shuffle and running distinct counts become sums.
    """
    no_item, no_type = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    def mark(kind: str, item: Column, label: Column, clicks: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            item.cast("bigint").alias("item"),
            label.alias("label"),
            clicks.cast("bigint").alias("clicks"),
        )

    marks = events.select(
        *STUDENT,
        "event_week_no",
        F.inline(
            F.array(
                mark("day", F.col("click_date"), no_type, F.col("sum_click")),
                mark("site", F.col("id_site"), no_type, F.lit(0)),
                mark("type", no_item, F.col("activity_type"), F.lit(0)),
            )
        ),
    )
    seen = marks.groupBy(*STUDENT, "kind", "item", "label").agg(
        F.min("event_week_no").alias("first_week"), F.sum("clicks").alias("clicks")
    )
    week = F.col("first_week")
    day, counted = F.col("kind") == "day", week >= C.FIRST_WEEK
    return seen.select(
        *STUDENT,
        C.mart_week(week).alias("week_no"),
        F.when(day & counted, F.col("clicks")).alias("clicks_week"),
        F.when(day, F.col("clicks")).alias("clicks_added"),
        F.when(day & counted, 1).alias("days_week"),
        F.when(day, 1).alias("days_added"),
        F.when(F.col("kind") == "site", 1).alias("sites_added"),
        F.when(F.col("kind") == "type", 1).alias("types_added"),
    )


def submission_deltas(results: DataFrame) -> DataFrame:
    week = F.col("submit_week")
    return submissions(results).select(
        *STUDENT,
        C.mart_week(week).alias("week_no"),
        F.when(week >= C.FIRST_WEEK, 1).alias("submitted_week"),
        F.lit(1).alias("submitted_added"),
        F.when(C.is_late(F.col("date_submitted"), F.col("due_date")), 1).alias("late_added"),
    )


def settled_deltas(results: DataFrame) -> DataFrame:
    return settled_results(results).select(
        *STUDENT, F.col("settled_week").alias("week_no"), F.lit(1).alias("settled_added")
    )


def due_by_week(assessments: DataFrame, modules: DataFrame) -> DataFrame:
    """Coursework due before each week end, per module presentation."""
    due = (
        coursework(assessments)
        .join(modules, "module_presentation_id")
        .select(
            "module_presentation_id",
            C.first_week_after(F.col("due_date"), F.col("module_presentation_length")).alias("week_no"),
        )
        .groupBy("module_presentation_id", "week_no")
        .agg(F.count("*").alias("due_added"))
    )
    upto = Window.partitionBy("module_presentation_id").orderBy("week_no")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    return (
        module_weeks(modules)
        .select("module_presentation_id", "week_no")
        .join(due, ["module_presentation_id", "week_no"], "left")
        .select(
            "module_presentation_id",
            "week_no",
            F.sum(_zero(F.col("due_added"))).over(upto).alias("coursework_due_count_to_week"),
        )
    )


def fact_student_week(
    clicks: DataFrame,
    sites: DataFrame,
    results: DataFrame,
    assessments: DataFrame,
    students: DataFrame,
    modules: DataFrame,
    stored: bool = False,
) -> DataFrame:
    """Eleven weekly and cumulative measures per enrolled student and week.

    With ``stored`` the presentation follows, by which the table is partitioned.

    Grid and deltas travel together: one exchange on the student serves the
    weekly sums and the running sums. Sums to the week count deltas of grid
    weeks only; settled work counts from any earlier week, because due and
    overdue describe the state at the week end.
    """
    work = coursework_results(results, assessments, modules)
    rows = student_weeks(students, modules)
    for deltas in (
        click_deltas(click_events(clicks, sites, modules)),
        submission_deltas(work),
        settled_deltas(work),
    ):
        rows = rows.unionByName(deltas, allowMissingColumns=True)
    added = [c for c in rows.columns if c.endswith(("_week", "_added"))]
    weekly = (
        rows.repartition(*STUDENT)
        .groupBy(*STUDENT, "week_no")
        .agg(
            F.max("student_module_presentation_id").alias("student_module_presentation_id"),
            *[_zero(F.sum(c)).alias(c) for c in added],
        )
    )
    in_grid = F.col("student_module_presentation_id").isNotNull()
    upto = Window.partitionBy(*STUDENT).orderBy("week_no")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)

    def to_week(column: str) -> Column:
        return F.sum(F.when(in_grid, F.col(column)).otherwise(0)).over(upto)

    summed = weekly.select(
        "student_module_presentation_id",
        "module_presentation_id",
        "week_no",
        "clicks_week", "days_week", "submitted_week",
        to_week("clicks_added").alias("clicks_to_week"),
        to_week("days_added").alias("days_to_week"),
        to_week("sites_added").alias("sites_to_week"),
        to_week("types_added").alias("types_to_week"),
        to_week("submitted_added").alias("submitted_to_week"),
        to_week("late_added").alias("late_to_week"),
        F.sum("settled_added").over(upto).alias("settled_to_week"),
    ).filter(in_grid)
    due = F.col("coursework_due_count_to_week")
    week, entity = F.col("week_no"), F.col("student_module_presentation_id")
    joined = summed.join(
        due_by_week(assessments, modules), ["module_presentation_id", "week_no"], "left"
    )
    if stored:
        joined = joined.join(modules.select("module_presentation_id", PRESENTATION), "module_presentation_id")
    return joined.select(
        fact_key(entity, week).alias("student_week_id"),
        entity,
        week_id(week).alias("week_id"),
        F.col("clicks_week").cast("bigint").alias("click_count_week"),
        F.col("clicks_to_week").cast("bigint").alias("click_count_to_week"),
        F.col("days_week").cast("int").alias("active_day_count_week"),
        F.col("days_to_week").cast("int").alias("active_day_count_to_week"),
        F.col("sites_to_week").cast("int").alias("site_count_to_week"),
        F.col("types_to_week").cast("int").alias("activity_type_count_to_week"),
        due.cast("int").alias("coursework_due_count_to_week"),
        F.col("submitted_week").cast("int").alias("coursework_submitted_count_week"),
        F.col("submitted_to_week").cast("int").alias("coursework_submitted_count_to_week"),
        F.col("late_to_week").cast("int").alias("coursework_late_count_to_week"),
        (due - F.col("settled_to_week")).cast("int").alias("coursework_overdue_count_to_week"),
        *([PRESENTATION] if stored else []),
    )


# -------------------------------------------------- fact: assessment x week


def submitted_by_week(results: DataFrame) -> DataFrame:
    week = F.col("submit_week")
    late = C.is_late(F.col("date_submitted"), F.col("due_date"))
    counted = week >= C.FIRST_WEEK
    return (
        submissions(results)
        .groupBy("assessment_id", C.mart_week(week).alias("week_no"))
        .agg(
            F.count_if(counted).alias("submitted_week"),
            F.count("*").alias("submitted_added"),
            F.count_if(counted & late).alias("late_week"),
            F.count_if(late).alias("late_added"),
        )
    )


def enrolled_changes(enrolled: DataFrame, key: str) -> DataFrame:
    """+1 in the first and -1 after the last week, summed per key and week."""
    return (
        enrolled.select(
            key,
            F.inline(
                F.array(
                    F.struct(F.col("enrolled_from").alias("week_no"), F.lit(1).alias("change")),
                    F.struct((F.col("enrolled_until") + 1).alias("week_no"), F.lit(-1).alias("change")),
                )
            ),
        )
        .groupBy(key, "week_no")
        .agg(F.sum("change").alias("change"))
    )


def fact_assessment_week(
    results: DataFrame, assessments: DataFrame, students: DataFrame, modules: DataFrame
) -> DataFrame:
    """Submitted, late and overdue students per coursework and week.

    Overdue at a week end = enrolled then, less those enrolled whose result
    already counts. Both are changes over weeks, so students are never joined
    with weeks.
    """
    work = coursework_results(results, assessments, modules)
    enrolled = enrolment(students, modules)
    settled = (
        settled_results(work)
        .join(enrolled.select(*STUDENT, "enrolled_from", "enrolled_until"), STUDENT)
        .withColumn("enrolled_from", F.greatest("settled_week", "enrolled_from"))
        .filter(F.col("enrolled_from") <= F.col("enrolled_until"))
    )
    enrolled_change = enrolled_changes(enrolled, "module_presentation_id")
    settled_change = enrolled_changes(settled, "assessment_id")
    grid = coursework(assessments).join(module_weeks(modules), "module_presentation_id")
    joined = (
        grid.join(submitted_by_week(work), ["assessment_id", "week_no"], "left")
        .join(
            enrolled_change.withColumnRenamed("change", "enrolled_change"),
            ["module_presentation_id", "week_no"],
            "left",
        )
        .join(
            settled_change.withColumnRenamed("change", "settled_change"),
            ["assessment_id", "week_no"],
            "left",
        )
    )
    upto = Window.partitionBy("assessment_id").orderBy("week_no")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)

    def to_week(column: str) -> Column:
        return F.sum(_zero(F.col(column))).over(upto)

    overdue = F.when(
        F.col("due_date") < F.col("week_end_day_exclusive"),
        to_week("enrolled_change") - to_week("settled_change"),
    ).otherwise(0)
    entity, week = F.col("assessment_id"), F.col("week_no")
    return joined.select(
        fact_key(entity, week).alias("assessments_week_id"),
        entity,
        week_id(week).alias("week_id"),
        _zero(F.col("submitted_week")).alias("submitted_student_count_week"),
        to_week("submitted_added").alias("submitted_student_count_to_week"),
        _zero(F.col("late_week")).alias("late_student_count_week"),
        to_week("late_added").alias("late_student_count_to_week"),
        overdue.cast("bigint").alias("overdue_unsubmitted_student_count_at_week_end"),
    )


# ----------------------------------------------- fact: activity type x week


def activity_marks(events: DataFrame) -> DataFrame:
    """Clicks per student, and each accessed site once, per activity type and week."""

    def mark(kind: str, item: Column, clicks: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), item.alias("item"), clicks.cast("bigint").alias("clicks")
        )

    return (
        events.select(
            "module_presentation_id",
            "activity_type",
            F.col("event_week_no").alias("week_no"),
            F.inline(
                F.array(
                    mark("student", F.col("id_student"), F.col("sum_click")),
                    mark("site", F.col("id_site"), F.lit(0)),
                )
            ),
        )
        .groupBy("module_presentation_id", "activity_type", "week_no", "kind", "item")
        .agg(F.sum("clicks").alias("clicks"))
    )


def activity_key(module: Column, activity_type: Column, week: Column) -> Column:
    known = F.array(*[F.lit(t) for t in ACTIVITY_TYPES])
    return fact_key(module * 100 + F.array_position(known, activity_type), week)


def fact_activity_type_week(
    clicks: DataFrame, sites: DataFrame, modules: DataFrame
) -> DataFrame:
    """Clicks, their median per student, students and sites per activity type and week."""
    entity = ["module_presentation_id", "activity_type"]
    marks = activity_marks(click_events(clicks, sites, modules))
    # One row per distinct click total of a week; sums and median read the same rows.
    counts = marks.groupBy(*entity, "week_no", "kind", "clicks").agg(F.count("*").alias("n"))
    student = F.col("kind") == "student"
    weekly = (
        placed_counts(counts, [*entity, "week_no", "kind"], "clicks")
        .groupBy(*entity, "week_no")
        .agg(
            F.sum(F.col("clicks") * F.col("n")).alias("clicks"),
            F.sum(F.when(student, F.col("n"))).alias("students"),
            F.sum(F.when(~student, F.col("n"))).alias("sites"),
            quantile(F.col("clicks"), 0.5, where=student).alias("median_clicks"),
        )
    )
    # Weeks before the second only add to the running clicks.
    counted = F.col("week_no") >= C.FIRST_WEEK
    folded = weekly.groupBy(*entity, C.mart_week(F.col("week_no")).alias("week_no")).agg(
        F.sum("clicks").alias("clicks_added"),
        *[
            F.max(F.when(counted, F.col(c))).alias(f"{c}_week")
            for c in ("clicks", "students", "sites", "median_clicks")
        ],
    )
    grid = (
        module_weeks(modules)
        .join(sites.select(*COURSE, "activity_type").distinct(), COURSE)
        .select(*entity, "week_no")
    )
    upto = Window.partitionBy(*entity).orderBy("week_no")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    week = F.col("week_no")
    return (
        grid.join(folded, [*entity, "week_no"], "left")
        .select(
            activity_key(
                F.col("module_presentation_id"), F.col("activity_type"), week
            ).alias("activity_type_week_id"),
            "module_presentation_id",
            week_id(week).alias("week_id"),
            "activity_type",
            _zero(F.col("clicks_week")).cast("bigint").alias("click_count_week"),
            F.sum(_zero(F.col("clicks_added"))).over(upto).cast("bigint").alias("click_count_to_week"),
            F.col("median_clicks_week").cast("decimal(12,2)").alias("median_student_click_count_week"),
            _zero(F.col("students_week")).cast("bigint").alias("active_student_count_week"),
            _zero(F.col("sites_week")).cast("int").alias("accessed_site_count_week"),
        )
    )


# Tables stored in a folder per value of a column that they have only there: frames read few presentations.
PRESENTATION = "code_presentation"
PARTITIONED = {"fact_student_module_presentation_week": PRESENTATION}


def stored_columns(table: str) -> str:
    """Declared columns and types of a mart table as stored."""
    return MART_TYPES[table] + (f", {PARTITIONED[table]} string" if table in PARTITIONED else "")


# Function and inputs (zone, table) of every mart table; dimensions come first.
BUILDERS = {
    "dim_module_presentation": (dim_module_presentation, [("clean", "courses")]),
    "dim_week": (dim_week, [("mart", "dim_module_presentation")]),
    "dim_assessments": (
        dim_assessments, [("clean", "assessments"), ("mart", "dim_module_presentation")]
    ),
    "dim_student_module_presentation": (
        dim_student_module_presentation,
        [
            ("clean", "student_info"),
            ("clean", "student_registration"),
            ("mart", "dim_module_presentation"),
        ],
    ),
    "fact_module_presentation_assessments_week": (
        fact_assessment_week,
        [
            ("clean", "student_assessment"),
            ("mart", "dim_assessments"),
            ("mart", "dim_student_module_presentation"),
            ("mart", "dim_module_presentation"),
        ],
    ),
    "fact_module_presentation_activity_type_week": (
        fact_activity_type_week,
        [("clean", "student_vle"), ("clean", "vle"), ("mart", "dim_module_presentation")],
    ),
    "fact_student_module_presentation_week": (
        fact_student_week,
        [
            ("clean", "student_vle"),
            ("clean", "vle"),
            ("clean", "student_assessment"),
            ("mart", "dim_assessments"),
            ("mart", "dim_student_module_presentation"),
            ("mart", "dim_module_presentation"),
        ],
    ),
}
