"""Queries on dimensions, facts, their building blocks and the serving checks."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.functions import calendar as C
from sparkmart.operators import checks, serving
from sparkmart.operators import mart as M
from sparkmart.operators.distribution import quantiles_of_counts, value_counts
from sparkmart.operators.features import change_from_previous, with_inactive_streak
from sparkmart.plans import pipeline
from sparkmart.plans.catalogue import VIEWS, register
from sparkmart.plans.workspace import Workspace
from sparkmart.session import in_parallel, scratch_folder
from sparkmart.sources.csv_source import write_source
from sparkmart.sources.publish import current_snapshot

MODULES = "dim_module_presentation"
STUDENTS = "dim_student_module_presentation"
ASSESSMENTS = "dim_assessments"
COURSE = ["code_module", "code_presentation"]


def modules(w: Workspace) -> DataFrame:
    return w.mart(MODULES)


def events(w: Workspace) -> DataFrame:
    return M.click_events(w.clean("student_vle"), w.clean("vle"), modules(w))


def work(w: Workspace) -> DataFrame:
    return M.coursework_results(w.clean("student_assessment"), w.mart(ASSESSMENTS), modules(w))


# ------------------------------------------------------------------ mart tables

_IDS = {
    "dim_module_presentation": "m01", "dim_week": "m02", "dim_assessments": "m03",
    "dim_student_module_presentation": "m04",
    "fact_module_presentation_activity_type_week": "m05",
    "fact_module_presentation_assessments_week": "m06",
    "fact_student_module_presentation_week": "m07",
}
for _table, _id in _IDS.items():
    # Built from the clean zone on every call, not read from a stored mart.
    register(f"{_id}_{_table}", lambda w, t=_table: w.build_mart(t), f"SELECT * FROM {_table}")

register(
    "m07a_student_week_grid",
    lambda w: M.student_weeks(w.mart(STUDENTS), modules(w)),
    "SELECT smp AS student_module_presentation_id, module_presentation_id, id_student, week_no FROM student_week",
)
register(
    "m07b_click_events",
    events,
    """SELECT module_presentation_id, id_student, id_site, activity_type, click_date, event_week_no, sum_click
       FROM click_event""",
)


def _deltas(w: Workspace, columns: list[str]) -> DataFrame:
    return (
        M.click_deltas(events(w))
        .groupBy(*M.STUDENT, "week_no")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns])
    )


register(
    "m07c_weekly_click_deltas",
    lambda w: _deltas(w, ["clicks_week", "clicks_added", "days_week", "days_added"]),
    """SELECT module_presentation_id, id_student, greatest(event_week_no, 2) AS week_no,
         CAST(coalesce(sum(sum_click) FILTER (event_week_no >= 2), 0) AS BIGINT) AS clicks_week,
         CAST(sum(sum_click) AS BIGINT) AS clicks_added,
         count(DISTINCT click_date) FILTER (event_week_no >= 2) AS days_week,
         count(DISTINCT click_date) AS days_added
       FROM click_event GROUP BY ALL""",
)


def _first_seen(w: Workspace) -> DataFrame:
    deltas = _deltas(w, ["sites_added", "types_added"])
    return deltas.filter((F.col("sites_added") > 0) | (F.col("types_added") > 0))


_FIRST_SEEN_SQL = """
SELECT module_presentation_id, id_student, first_seen AS week_no,
       count(*) FILTER (kind = 'site') AS sites_added, count(*) FILTER (kind = 'type') AS types_added
FROM (SELECT module_presentation_id, id_student, first_seen, 'site' AS kind FROM first_site
      UNION ALL SELECT module_presentation_id, id_student, first_seen, 'type' FROM first_type)
GROUP BY ALL"""
register("m07d_first_seen_sites_and_types", _first_seen, _FIRST_SEEN_SQL)
register(
    "m07e_submission_deltas",
    lambda w: M.submission_deltas(work(w)).groupBy(*M.STUDENT, "week_no").agg(
        F.count("submitted_week").alias("submitted_week"),
        F.count("submitted_added").alias("submitted_added"),
        F.count("late_added").alias("late_added"),
    ),
    """SELECT module_presentation_id, id_student, greatest(submit_week, 2) AS week_no,
         count(*) FILTER (submit_week >= 2) AS submitted_week, count(*) AS submitted_added,
         count(*) FILTER (is_late) AS late_added
       FROM coursework_submission GROUP BY ALL""",
)


def _due_state(w: Workspace) -> DataFrame:
    return w.mart("fact_student_module_presentation_week").select(
        "student_module_presentation_id", "week_id",
        F.col("coursework_due_count_to_week").alias("due"),
        F.col("coursework_overdue_count_to_week").alias("overdue"),
    )


_DUE_SQL = """
SELECT g.smp AS student_module_presentation_id, g.week_id, CAST(coalesce(due_to_week, 0) AS INTEGER) AS due,
       CAST(coalesce(overdue_to_week, 0) AS INTEGER) AS overdue
FROM student_week g LEFT JOIN student_week_due d ON d.smp = g.smp AND d.week_no = g.week_no"""
register("m07f_due_and_overdue", _due_state, _DUE_SQL)
register("a09_conditional_counts_of_left_join", _due_state, _DUE_SQL)


def _table_sizes(w: Workspace) -> DataFrame:
    parts = [
        w.mart(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t in S.MART_TYPES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


register(
    "s11_mart_row_counts",
    _table_sizes,
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in S.MART_TYPES),
)
register(
    "s12_surrogate_keys",
    lambda w: w.mart("fact_student_module_presentation_week")
    .join(w.mart(STUDENTS), "student_module_presentation_id")
    .select("student_week_id", "student_module_presentation_id", "id_student", "module_presentation_id"),
    """SELECT student_week_id, student_module_presentation_id, id_student, module_presentation_id
       FROM fact_student_module_presentation_week
       JOIN dim_student_module_presentation USING (student_module_presentation_id)""",
)



def _published_run(w: Workspace) -> DataFrame:
    """A whole run from CSV sources to a published snapshot: rows per zone and table."""
    source, out = scratch_folder(w.spark, "source"), scratch_folder(w.spark, "out")
    in_parallel([partial(write_source, w.raw(t), source, t) for t in S.TABLES])
    pipeline.run_pipeline(w.spark, source, out)
    snapshot = current_snapshot(w.spark, out)
    tables = [(z, t) for z in ("raw", "clean", "quarantine") for t in S.TABLES]
    parts = [
        snapshot.read(z, t).agg(
            F.lit(z).alias("zone"), F.lit(t).alias("table_name"), F.count("*").alias("n")
        )
        for z, t in [*tables, *[("mart", t) for t in S.MART_TYPES]]
    ]
    return reduce(DataFrame.unionByName, parts)


register(
    "s07_s08_published_run",
    _published_run,
    " UNION ALL ".join(
        [f"SELECT 'raw' AS zone, '{t}' AS table_name, count(*) AS n FROM raw_{t}" for t in S.TABLES]
        + [f"SELECT 'clean', '{t}', count(*) FROM clean_{t}" for t in S.TABLES]
        + [
            f"SELECT 'quarantine', '{t}', count(*) FROM validated_raw_{t} WHERE len(errors) > 0"
            for t in S.TABLES
        ]
        + [f"SELECT 'mart', '{t}', count(*) FROM {t}" for t in S.MART_TYPES]
    ),
)

# ------------------------------------------------------- scalar functions in use

register(
    "p15_zero_after_outer_join",
    lambda w: w.mart(STUDENTS).join(
        M.submissions(work(w)).groupBy(*M.STUDENT).agg(F.count("*").alias("n")), M.STUDENT, "left"
    ).select("student_module_presentation_id", F.coalesce("n", F.lit(0)).alias("submitted")),
    """SELECT student_module_presentation_id, count(s.id_student) AS submitted
       FROM dim_student_module_presentation d LEFT JOIN coursework_submission s
         ON s.id_student = d.id_student AND s.module_presentation_id = d.module_presentation_id
       GROUP BY 1""",
)
register(
    "p16_week_end_and_mart_week",
    lambda w: M.module_weeks(modules(w)).select(
        "module_presentation_id", "week_no", "week_end_day_exclusive",
        C.mart_week(F.col("week_no") - 3).alias("folded_week"),
    ),
    """SELECT module_presentation_id, week_no, end_day AS week_end_day_exclusive,
         greatest(week_no - 3, 2) AS folded_week FROM module_week""",
)
register(
    "p17_week_of_day",
    lambda w: w.clean("student_vle").groupBy("date").agg(F.count("*").alias("n"))
    .select("date", C.week_of(F.col("date")).alias("week_no"), "n"),
    """SELECT date, CAST(floor(date / 7.0) AS INTEGER) + 1 AS week_no, count(*) AS n
       FROM clean_student_vle GROUP BY date""",
)
register(
    "p18_week_count",
    lambda w: w.clean("courses").select(
        *COURSE, C.week_count(F.col("module_presentation_length")).alias("weeks")
    ),
    """SELECT code_module, code_presentation, CAST(ceil(module_presentation_length / 7.0) AS INTEGER) AS weeks
       FROM clean_courses""",
)
register(
    "p19_effective_due_week",
    lambda w: w.clean("assessments").join(modules(w), COURSE).select(
        "id_assessment",
        C.effective_due_week(
            F.col("date"), F.col("assessment_type"), F.col("module_presentation_length")
        ).alias("due_week"),
    ),
    "SELECT assessment_no AS id_assessment, effective_due_week AS due_week FROM dim_assessments",
)
register(
    "p20_late_results",
    lambda w: w.clean("student_assessment").join(w.clean("assessments"), "id_assessment").select(
        "id_assessment", "id_student", C.is_late(F.col("date_submitted"), F.col("date")).alias("is_late")
    ),
    """SELECT id_assessment, id_student, date_submitted > date AS is_late
       FROM clean_student_assessment JOIN clean_assessments USING (id_assessment)""",
)


def _enrolment_flags(w: Workspace) -> DataFrame:
    """Whether each student is enrolled at each week end of the presentation."""
    weeks = M.module_weeks(modules(w)).select(
        "module_presentation_id", "week_no", "week_end_day_exclusive"
    )
    flag = C.enrolled_at(
        F.col("date_registration"), F.col("date_unregistration"), F.col("week_end_day_exclusive")
    )
    return w.mart(STUDENTS).join(weeks, "module_presentation_id").select(
        "student_module_presentation_id", "week_no", flag.alias("enrolled")
    )


register(
    "p21_enrolled_at_week_end",
    _enrolment_flags,
    """SELECT student_module_presentation_id, week_no,
         coalesce(date_registration < end_day, true) AND coalesce(date_unregistration >= end_day, true) AS enrolled
       FROM dim_student_module_presentation s JOIN module_week m
         ON m.module_presentation_id = s.module_presentation_id""",
)
register(
    "p22_presentation_and_result_filters",
    lambda w: w.train_frame().groupBy("code_presentation", "final_result").agg(F.count("*").alias("n")),
    "SELECT code_presentation, final_result, count(*) AS n FROM train GROUP BY ALL",
)

# ------------------------------------------------------------------------ joins

register(
    "j05_rejected_raw_rows",
    lambda w: w.quarantine("student_vle").drop("error_details", "detected_at", "source_file"),
    f"""SELECT source_row_number, {', '.join(S.SOURCE_COLUMNS['student_vle'])} FROM raw_student_vle
        WHERE source_row_number IN
          (SELECT source_row_number FROM validated_raw_student_vle WHERE len(errors) > 0)""",
)
register(
    "j06_dimension_lookup",
    lambda w: w.clean("vle").join(modules(w), COURSE).select("id_site", "module_presentation_id"),
    """SELECT id_site, module_presentation_id
       FROM clean_vle JOIN dim_module_presentation USING (code_module, code_presentation)""",
)
register(
    "j07_optional_registration",
    lambda w: w.clean("student_info").join(w.clean("student_registration"), S.ENTITY, "left").select(
        *S.ENTITY, "date_registration", "date_unregistration"
    ),
    """SELECT code_module, code_presentation, id_student, date_registration, date_unregistration
       FROM clean_student_info LEFT JOIN clean_student_registration
       USING (code_module, code_presentation, id_student)""",
)
register(
    "j08_week_expansion",
    lambda w: M.module_weeks(modules(w)).select("module_presentation_id", "week_no"),
    """SELECT module_presentation_id, week_no FROM dim_module_presentation
       JOIN dim_week ON start_day < module_presentation_length""",
)
register(
    "j09_events_with_student_and_site",
    lambda w: events(w).join(w.mart(STUDENTS), M.STUDENT).select(
        "student_module_presentation_id", "id_site", "activity_type", "click_date", "sum_click"
    ),
    """SELECT student_module_presentation_id, id_site, activity_type, click_date, sum_click
       FROM click_event JOIN dim_student_module_presentation USING (module_presentation_id, id_student)""",
)
register(
    "j10_submissions_with_dimensions",
    lambda w: M.submissions(work(w)).select(
        "assessment_id", *M.STUDENT, "date_submitted", "due_date", "submit_week"
    ),
    """SELECT assessment_id, module_presentation_id, id_student, date_submitted, due_date, submit_week
       FROM coursework_submission""",
)


def _coursework_state(w: Workspace) -> DataFrame:
    """Every coursework of every student with the result, where there is one."""
    results = work(w).select("assessment_id", "id_student", "is_banked", "date_submitted")
    return (
        w.mart(STUDENTS)
        .join(M.coursework(w.mart(ASSESSMENTS)), "module_presentation_id", "left")
        .join(results, ["assessment_id", "id_student"], "left")
        .select("student_module_presentation_id", "assessment_id", "is_banked", "date_submitted")
    )


register(
    "j11_students_coursework_results",
    _coursework_state,
    """SELECT student_module_presentation_id, assessment_id, is_banked, date_submitted
       FROM dim_student_module_presentation s
       LEFT JOIN dim_assessments a ON a.module_presentation_id = s.module_presentation_id
         AND assessment_type IN ('TMA', 'CMA')
       LEFT JOIN clean_student_assessment r ON r.id_assessment = a.assessment_no AND r.id_student = s.id_student""",
)
register(
    "j12_overdue_without_result",
    lambda w: w.mart("fact_module_presentation_assessments_week").select(
        "assessment_id", "week_id", F.col("overdue_unsubmitted_student_count_at_week_end").alias("overdue")
    ).filter("overdue > 0"),
    """SELECT assessment_id, week_id, overdue FROM assessment_week_overdue
       JOIN (SELECT week_id, week_no FROM dim_week) USING (week_no)""",
)


def _enrolled_counts(w: Workspace) -> DataFrame:
    """Enrolled students per module presentation and week, by changes instead of a range join."""
    change = M.enrolled_changes(M.enrolment(w.mart(STUDENTS), modules(w)), "module_presentation_id")
    upto = Window.partitionBy("module_presentation_id").orderBy("week_no")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    return (
        M.module_weeks(modules(w))
        .join(change, ["module_presentation_id", "week_no"], "left")
        .select(
            "module_presentation_id", "week_no",
            F.sum(F.coalesce("change", F.lit(0))).over(upto).alias("enrolled"),
        )
    )


register(
    "j13_enrolled_students_per_week",
    _enrolled_counts,
    """SELECT m.module_presentation_id, m.week_no, count(s.smp) AS enrolled
       FROM module_week m LEFT JOIN student_week s
         ON s.module_presentation_id = m.module_presentation_id AND s.week_no = m.week_no
       GROUP BY ALL""",
)
register(
    "j14_grid_with_weekly_aggregates",
    lambda w: M.coursework(w.mart(ASSESSMENTS)).join(M.module_weeks(modules(w)), "module_presentation_id")
    .join(M.submitted_by_week(work(w)), ["assessment_id", "week_no"], "left")
    .select("assessment_id", "week_no", F.coalesce("submitted_week", F.lit(0)).alias("submitted"),
            F.coalesce("late_week", F.lit(0)).alias("late")),
    """SELECT g.assessment_id, g.week_no, count(s.id_student) AS submitted, count(*) FILTER (is_late) AS late
       FROM assessment_week g LEFT JOIN coursework_submission s
         ON s.assessment_id = g.assessment_id AND s.submit_week = g.week_no
       GROUP BY ALL""",
)
register(
    "j15_serving_star",
    lambda w: serving.star(w.marts(), [*S.TRAIN_PRESENTATIONS, S.PREDICT_PRESENTATION]).select(
        "module_presentation_student_week_id", *COURSE, "week_no", "final_result"
    ),
    """SELECT module_presentation_student_week_id, code_module, code_presentation, week_no, final_result
       FROM serving""",
)

# ----------------------------------------------------------------- aggregations

register(
    "a01_clicks_by_activity_type",
    lambda w: events(w).groupBy("module_presentation_id", "activity_type").agg(
        F.sum("sum_click").alias("clicks")
    ),
    """SELECT module_presentation_id, activity_type, CAST(sum(sum_click) AS BIGINT) AS clicks
       FROM click_event GROUP BY ALL""",
)
register(
    "a02_filtered_counts",
    lambda w: M.submitted_by_week(work(w)),
    """SELECT assessment_id, greatest(submit_week, 2) AS week_no, count(*) FILTER (submit_week >= 2) AS submitted_week,
         count(*) AS submitted_added, count(*) FILTER (submit_week >= 2 AND is_late) AS late_week,
         count(*) FILTER (is_late) AS late_added
       FROM coursework_submission GROUP BY assessment_id, greatest(submit_week, 2)""",
)
register(
    "a03_active_days",
    lambda w: _deltas(w, ["days_week", "days_added"]),
    """SELECT module_presentation_id, id_student, greatest(event_week_no, 2) AS week_no,
         count(DISTINCT click_date) FILTER (event_week_no >= 2) AS days_week,
         count(DISTINCT click_date) AS days_added
       FROM click_event GROUP BY ALL""",
)
register(
    "a04_accessed_sites",
    lambda w: M.activity_marks(events(w)).filter(F.col("kind") == "site")
    .groupBy("module_presentation_id", "activity_type", "week_no").agg(F.count("*").alias("sites")),
    "SELECT module_presentation_id, activity_type, week_no, sites FROM type_week_sites",
)


def _median_clicks(w: Workspace) -> DataFrame:
    entity = ["module_presentation_id", "activity_type", "week_no"]
    students = M.activity_marks(events(w)).filter(F.col("kind") == "student")
    counts = value_counts(students, entity, "clicks")
    return quantiles_of_counts(counts, entity, "clicks", {"median": 0.5}).select(
        *entity, F.col("n").alias("students"), F.col("median").cast("decimal(12,2)").alias("median_clicks")
    )


register(
    "a05_median_clicks_per_student",
    _median_clicks,
    """SELECT module_presentation_id, activity_type, week_no, students,
         CAST(median_clicks AS DECIMAL(12,2)) AS median_clicks FROM type_week""",
)
register(
    "a06_first_seen_counts",
    _first_seen,
    _FIRST_SEEN_SQL,
)
register(
    "a07_student_then_type_totals",
    lambda w: M.activity_marks(events(w)).filter(F.col("kind") == "student")
    .groupBy("module_presentation_id", "activity_type", "week_no")
    .agg(F.count("*").alias("students"), F.sum("clicks").alias("clicks"), F.max("clicks").alias("most_clicks")),
    """SELECT module_presentation_id, activity_type, week_no, count(*) AS students,
         CAST(sum(clicks) AS BIGINT) AS clicks, CAST(max(clicks) AS BIGINT) AS most_clicks
       FROM student_type_week GROUP BY ALL""",
)
register(
    "a08_longest_presentation",
    lambda w: modules(w).agg(F.max("module_presentation_length").alias("days")).select(
        "days", C.week_count(F.col("days")).alias("weeks")
    ),
    """SELECT max(module_presentation_length) AS days, CAST(ceil(max(module_presentation_length) / 7.0) AS INTEGER) AS weeks
       FROM dim_module_presentation""",
)
register(
    "a11_group_by_week_expression",
    lambda w: events(w).groupBy(C.mart_week(F.col("event_week_no")).alias("week_no")).agg(
        F.sum("sum_click").alias("clicks"), F.count("*").alias("n")
    ),
    """SELECT greatest(event_week_no, 2) AS week_no, CAST(sum(sum_click) AS BIGINT) AS clicks, count(*) AS n
       FROM click_event GROUP BY 1""",
)

# ----------------------------------- the same operators on the event stream table


def _event_days(w: Workspace) -> DataFrame:
    """Value in cents per user and day of the events table."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    day = F.to_date("ts").cast("string")
    return (
        w.spark.read.parquet(f"{w.source}/events.parquet")
        .groupBy("user_id", day.alias("day"))
        .agg(F.sum(cents).alias("cents"), F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    )


VIEWS["event_day"] = """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
       count(*) FILTER (event_type = 'purchase') AS purchases
FROM events GROUP BY ALL"""


def _running(w: Workspace) -> DataFrame:
    upto = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return _event_days(w).withColumn("cents_to_day", F.sum("cents").over(upto))


register(
    "w03_running_sum_of_events",
    _running,
    """SELECT *, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS cents_to_day FROM event_day""",
)
register(
    "w03_running_sums_of_clicks",
    lambda w: w.mart("fact_student_module_presentation_week").select(
        "student_module_presentation_id", "week_id", "click_count_to_week", "active_day_count_to_week",
        "site_count_to_week",
    ),
    """SELECT student_module_presentation_id, week_id, click_count_to_week, active_day_count_to_week,
         site_count_to_week FROM fact_student_module_presentation_week""",
)
register(
    "w04_change_of_events",
    lambda w: _event_days(w).select(
        "user_id", "day", change_from_previous("cents", ["user_id"], "day").alias("change")
    ),
    """SELECT user_id, day, CAST(coalesce(cents - lag(cents) OVER (PARTITION BY user_id ORDER BY day), 0) AS DOUBLE)
         AS change FROM event_day""",
)
register(
    "w05_streak_of_events",
    lambda w: with_inactive_streak(_event_days(w), "purchases", ["user_id"], "day", "streak").select(
        "user_id", "day", F.col("streak").cast("bigint").alias("streak")
    ),
    """SELECT user_id, day, row_number() OVER (PARTITION BY user_id, block ORDER BY day)
         - CASE WHEN block > 0 THEN 1 ELSE 0 END AS streak
       FROM (SELECT *, sum(CASE WHEN purchases > 0 THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS block FROM event_day)""",
)


def _median_event_value(w: Workspace) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint").alias("cents")
    rows = w.spark.read.parquet(f"{w.source}/events.parquet").select("event_type", cents)
    counts = value_counts(rows.filter(F.col("cents").isNotNull()), ["event_type"], "cents")
    return quantiles_of_counts(counts, ["event_type"], "cents", {"median_cents": 0.5})


register(
    "a05_median_event_value",
    _median_event_value,
    """SELECT event_type, count(cents) AS n, quantile_cont(CAST(cents AS DOUBLE), 0.5) AS median_cents
       FROM (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events) WHERE cents IS NOT NULL
       GROUP BY event_type""",
)


def _first_event_types(w: Workspace) -> DataFrame:
    first = (
        w.spark.read.parquet(f"{w.source}/events.parquet")
        .groupBy("user_id", "event_type")
        .agg(F.min(F.to_date("ts")).cast("string").alias("day"))
    )
    return first.groupBy("user_id", "day").agg(F.count("*").alias("new_types"))


register(
    "a06_first_seen_event_types",
    _first_event_types,
    """SELECT user_id, day, count(*) AS new_types
       FROM (SELECT user_id, event_type, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS day FROM events GROUP BY ALL)
       GROUP BY ALL""",
)

# -------------------------------------------------------- sets and generators

register(
    "o04_distinct_activity_types",
    lambda w: w.clean("vle").select(*COURSE, "activity_type").distinct(),
    "SELECT DISTINCT code_module, code_presentation, activity_type FROM clean_vle",
)
register(
    "o06_union_of_train_and_validation",
    lambda w: w.train_frame().filter(F.col("code_presentation").isin("2013B", "2013J")).select(
        "module_presentation_student_week_id", "code_presentation"
    ),
    """SELECT module_presentation_student_week_id, code_presentation FROM train WHERE code_presentation = '2013B'
       UNION ALL
       SELECT module_presentation_student_week_id, code_presentation FROM train WHERE code_presentation = '2013J'""",
)
register(
    "o07_students_without_clicks",
    lambda w: w.clean("student_info").select(*S.ENTITY).join(
        w.clean("student_vle").select(*S.ENTITY).distinct(), S.ENTITY, "left_anti"
    ),
    """SELECT code_module, code_presentation, id_student FROM clean_student_info
       EXCEPT SELECT code_module, code_presentation, id_student FROM clean_student_vle""",
)
register(
    "o08_week_series",
    lambda w: modules(w).select(
        "module_presentation_id",
        F.explode(C.week_numbers(F.pmod(F.col("module_presentation_length"), F.lit(4)).cast("int"))).alias("week_no"),
    ),
    """SELECT module_presentation_id, CAST(unnest(generate_series(2, module_presentation_length % 4)) AS INTEGER) AS week_no
       FROM dim_module_presentation""",
)
register(
    "o10_temporal_split",
    lambda w: w.train_frame().groupBy(
        F.when(F.col("code_presentation") == "2013B", "train").when(F.col("code_presentation") == "2013J", "validation")
        .otherwise("test").alias("split")
    ).agg(F.count("*").alias("n")),
    """SELECT CASE code_presentation WHEN '2013B' THEN 'train' WHEN '2013J' THEN 'validation' ELSE 'test' END AS split,
         count(*) AS n FROM train GROUP BY 1""",
)

# --------------------------------------------------------- serving and checks

register("m08_train_frame", lambda w: w.train_frame(), "SELECT * FROM train")
register("m09_predict_frame", lambda w: w.predict_frame(), "SELECT * FROM predict")
register(
    "s13_serving_rows",
    lambda w: w.train_frame().drop("final_result").unionByName(w.predict_frame())
    .groupBy(*COURSE).agg(F.count("*").alias("n"), F.sum("click_count_week").alias("clicks")),
    """SELECT code_module, code_presentation, count(*) AS n, CAST(sum(click_count_week) AS BIGINT) AS clicks
       FROM (SELECT * EXCLUDE (final_result) FROM train UNION ALL SELECT * FROM predict) GROUP BY ALL""",
)


def _numeric_columns() -> list[str]:
    return [c for c, t in S.FEATURE_TYPES.items() if t == "bigint"]


def _report_sql(view: str, train: bool) -> str:
    columns = [*S.FEATURE_TYPES, *(["final_result"] if train else [])]
    found = {
        "empty frame": f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {view}",
        "repeated grain": f"""SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {view}
            GROUP BY code_presentation, code_module, id_student, week_no)""",
        "week before the second": f"SELECT count(*) FROM {view} WHERE week_no < 2",
        "columns missing": "SELECT 0",
        "columns extra": "SELECT 0",
        "columns of another type": "SELECT 0",
    }
    if train:
        found["target missing"] = "SELECT 0"
    for c in columns:
        if c != "imd_band":
            found[f"null in {c}"] = f"SELECT count(*) FROM {view} WHERE {c} IS NULL"
    for c in _numeric_columns():
        found[f"negative {c}"] = f"SELECT count(*) FROM {view} WHERE {c} < 0"
    for weekly, total in checks.WEEKLY_AND_CUMULATIVE:
        found[f"{weekly} above {total}"] = f"SELECT count(*) FROM {view} WHERE {weekly} > {total}"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", CAST(({sql}) AS BIGINT) AS violations""" for name, sql in found.items()
    )


register(
    "c01_c07_predict_contract", lambda w: checks.serving_report(w.predict_frame()), _report_sql("predict", False)
)
register(
    "c08_train_contract", lambda w: checks.serving_report(w.train_frame(), train=True), _report_sql("train", True)
)


def _broken_frame(w: Workspace) -> DataFrame:
    """The predict frame with every eleventh row broken and every thirteenth repeated."""
    frame = w.predict_frame()
    key = F.col("module_presentation_student_week_id")
    hit = key % 11 == 0
    broken = {
        "region": F.when(hit, None).otherwise(F.col("region")),
        "week_no": F.when(hit, -F.col("week_no")).otherwise(F.col("week_no")),
        "click_count_week": F.when(hit, F.col("click_count_to_week") + 1).otherwise(F.col("click_count_week")),
    }
    altered = frame.select(*[broken.get(c, F.col(c)).alias(c) for c in frame.columns])
    return altered.unionByName(altered.filter(key % 13 == 0))


VIEWS["broken_predict"] = """
WITH a AS (SELECT * REPLACE (CASE WHEN module_presentation_student_week_id % 11 = 0 THEN NULL ELSE region END AS region,
    CASE WHEN module_presentation_student_week_id % 11 = 0 THEN -week_no ELSE week_no END AS week_no,
    CASE WHEN module_presentation_student_week_id % 11 = 0 THEN click_count_to_week + 1 ELSE click_count_week END
      AS click_count_week) FROM predict)
SELECT * FROM a UNION ALL SELECT * FROM a WHERE module_presentation_student_week_id % 13 = 0"""
register(
    "c03_c07_broken_frame", lambda w: checks.serving_report(_broken_frame(w)), _report_sql("broken_predict", False)
)

_INVARIANTS = {
    "negative number": " OR ".join(f"{c} < 0" for c in S.PROFILE_NUMERIC),
    "week before the second": "week_no < 2",
    "more than seven active days": "active_day_count_week > 7",
    "weekly clicks above total": "click_count_week > click_count_to_week",
    "weekly days above total": "active_day_count_week > active_day_count_to_week",
    "weekly submissions above total": "coursework_submitted_count_week > coursework_submitted_count_to_week",
    "late above submitted": "coursework_late_count_to_week > coursework_submitted_count_to_week",
    "overdue above due": "coursework_overdue_count_to_week > coursework_due_count_to_week",
}
register(
    "c09_training_invariants",
    lambda w: checks.invariants(w.train_frame()),
    " UNION ALL ".join(
        f"""SELECT '{n}' AS "check", count(*) FILTER ({c}) AS violations FROM train""" for n, c in _INVARIANTS.items()
    ),
)


def _constraint_sql() -> str:
    parts = []
    for table, (primary, unique, foreign) in checks.CONSTRAINTS.items():
        required = [c.split()[0] for c in S.MART_TYPES[table].split(", ")]
        required = [c for c in required if c not in checks.MART_NULLABLE]
        found = {
            "primary key": f"SELECT count(*) - count(DISTINCT {primary}) FROM {table}",
            "unique key": f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(unique)} FROM {table})) FROM {table}",
            "not null": f"SELECT count(*) FROM {table} WHERE {' OR '.join(f'{c} IS NULL' for c in required)}",
            "not empty": f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {table}",
        }
        for column, parent in foreign.items():
            found[column] = f"SELECT count(*) FROM {table} WHERE {column} NOT IN (SELECT {column} FROM {parent})"
        parts += [
            f"""SELECT '{table}: {n}' AS "check", CAST(({q}) AS BIGINT) AS violations""" for n, q in found.items()
        ]
    return " UNION ALL ".join(parts)


register("c11_mart_constraints", lambda w: checks.constraint_report(w.marts()), _constraint_sql())
register(
    "c10_empty_tables",
    lambda w: checks.constraint_report(w.marts()).filter(F.col("check").endswith("not empty")),
    " UNION ALL ".join(
        f"""SELECT '{t}: not empty' AS "check", CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations
            FROM {t}""" for t in S.MART_TYPES
    ),
)

