"""DuckDB views of the fixture, the validated zones and the marts.

Written from the meaning of each table, apart from the Spark operators: marts
are stated by direct range joins instead of deltas, duplicates by windows.
``with_views`` puts the views a query needs in front of it.
"""

from __future__ import annotations

import re

from sparkmart.schemas import (
    ACTIVITY_TYPES,
    AGE_BANDS,
    ASSESSMENT_TYPES,
    DISABILITIES,
    EDUCATIONS,
    GENDERS,
    IMD_BANDS,
    REGIONS,
    RESULTS,
    SOURCE_COLUMNS,
    TABLES,
)
from sparkmart.sources.fixtures import COPY_OFFSET, DEFAULT_FAULT_PERIOD, FAULT_PERIOD, FAULTS


def sql_list(values: list) -> str:
    return ", ".join("'" + v + "'" if isinstance(v, str) else str(v) for v in values)


def pick(values: list[str], index: str) -> str:
    return f"([{sql_list(values)}])[1 + ({index})]"


def course_key(nation: str) -> str:
    return (
        f"{pick(['AAA', 'BBB', 'CCC', 'DDD', 'EEE'], f'{nation} % 5')} AS code_module, "
        f"{pick(['2013B', '2013J', '2014B', '2014J'], f'{nation} % 4')} AS code_presentation"
    )


VIEWS: dict[str, str] = {}

# ------------------------------------------------------------------ raw zone

VIEWS["raw_courses"] = f"""
SELECT row_number() OVER (ORDER BY n_nationkey) + 1 AS source_row_number, {course_key('n_nationkey')},
       CAST(234 + 2 * (n_nationkey % 20) + CASE WHEN n_nationkey = 24 THEN 1 ELSE 0 END AS VARCHAR)
           AS module_presentation_length
FROM nation"""

VIEWS["raw_student_info"] = f"""
SELECT row_number() OVER (ORDER BY c_custkey) + 1 AS source_row_number, {course_key('c_nationkey')},
       CAST(c_custkey AS VARCHAR) AS id_student,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       {pick(REGIONS, 'c_nationkey % 13')} AS region,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'No Formal quals' WHEN 'BUILDING' THEN 'Lower Than A Level'
           WHEN 'FURNITURE' THEN 'A Level or Equivalent' WHEN 'HOUSEHOLD' THEN 'HE Qualification'
           WHEN 'MACHINERY' THEN 'Post Graduate Qualification' END AS highest_education,
       CASE WHEN c_custkey % 22 = 1 THEN '10-20' WHEN c_custkey % 11 = 10 THEN ''
           ELSE {pick(IMD_BANDS, 'c_custkey % 11')} END AS imd_band,
       {pick(AGE_BANDS, 'c_custkey % 3')} AS age_band,
       CAST(c_custkey % 4 AS VARCHAR) AS num_of_prev_attempts,
       CAST(30 * (1 + c_custkey % 4) AS VARCHAR) AS studied_credits,
       CASE WHEN c_custkey % 10 = 0 THEN 'Y' ELSE 'N' END AS disability,
       CASE WHEN c_acctbal < 0 THEN 'Withdrawn' WHEN c_acctbal < 3000 THEN 'Fail'
           WHEN c_acctbal < 8000 THEN 'Pass' ELSE 'Distinction' END AS final_result
FROM customer"""

VIEWS["raw_student_registration"] = f"""
SELECT row_number() OVER (ORDER BY c_custkey) + 1 AS source_row_number, {course_key('c_nationkey')},
       CAST(c_custkey AS VARCHAR) AS id_student,
       CASE WHEN c_custkey % 50 = 7 THEN '' ELSE CAST(c_custkey * 37 % 200 - 150 AS VARCHAR) END
           AS date_registration,
       CASE WHEN c_custkey % 9 = 4 THEN CAST(20 + c_custkey * 11 % 200 AS VARCHAR) ELSE '' END
           AS date_unregistration
FROM customer"""

VIEWS["raw_assessments"] = f"""
SELECT row_number() OVER (ORDER BY n_nationkey, a) + 1 AS source_row_number, {course_key('n_nationkey')},
       CAST(n_nationkey * 8 + a + 1 AS VARCHAR) AS id_assessment,
       CASE WHEN a = 7 THEN 'Exam' WHEN a % 3 = 0 THEN 'CMA' ELSE 'TMA' END AS assessment_type,
       CASE WHEN a = 7 AND n_nationkey % 2 = 0 THEN '' ELSE CAST(19 + a * 30 AS VARCHAR) END AS date,
       CAST(a * 10 AS VARCHAR) || '.5' AS weight
FROM nation, range(8) AS r(a)"""

VIEWS["raw_student_assessment"] = """
SELECT row_number() OVER (ORDER BY c_custkey, a) + 1 AS source_row_number,
       CAST(c_nationkey * 8 + a + 1 AS VARCHAR) AS id_assessment,
       CAST(c_custkey AS VARCHAR) AS id_student,
       CAST(19 + a * 30 + (c_custkey * 13 + a * 5) % 25 - 12 AS VARCHAR) AS date_submitted,
       CASE WHEN c_custkey % 40 = 3 THEN '1' ELSE '0' END AS is_banked,
       CASE WHEN (c_custkey * a) % 17 = 0 THEN '' ELSE CAST((c_custkey * a) % 101 AS VARCHAR) END AS score
FROM customer, range(8) AS r(a)
WHERE (c_custkey * 7 + a) % 4 <> 0"""

VIEWS["raw_vle"] = f"""
SELECT row_number() OVER (ORDER BY p_partkey) + 1 AS source_row_number,
       CAST(p_partkey AS VARCHAR) AS id_site, {course_key('(p_partkey % 25)')},
       {pick(ACTIVITY_TYPES, '(p_partkey // 25) % 20')} AS activity_type,
       CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size % 20 AS VARCHAR) END AS week_from,
       CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size % 20 + p_size % 5 AS VARCHAR) END AS week_to
FROM part"""

VIEWS["raw_student_vle"] = f"""
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                                   l_extendedprice) + 1 AS source_row_number,
       {course_key('c_nationkey')},
       CAST(o_custkey AS VARCHAR) AS id_student,
       CAST(l_partkey - l_partkey % 25 + c_nationkey AS VARCHAR) AS id_site,
       CAST((l_partkey * 7 + l_suppkey * 3 + l_orderkey) % 300 - 28 AS VARCHAR) AS date,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sum_click
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""


def _faulted(table: str) -> str:
    columns = SOURCE_COLUMNS[table]
    period = FAULT_PERIOD.get(table, DEFAULT_FAULT_PERIOD)
    chosen = f"(source_row_number // {period}) % {len(columns)}"
    applies, values = [], []
    for i, column in enumerate(columns):
        kinds = FAULTS[table][column]
        applies.append(f"({chosen} = {i} AND source_row_number % {period} IN ({sql_list(list(kinds))}))")
        whens = ""
        for kind, literal in kinds.items():
            if literal == "pad":
                whens += f" WHEN {kind} THEN ' ' || coalesce({column}, '') || ' '"
            elif literal is not None:
                whens += f" WHEN {kind} THEN '{literal}'"
        values.append(
            f"CASE WHEN {chosen} = {i} THEN CASE source_row_number % {period}{whens} ELSE {column} END "
            f"ELSE {column} END AS {column}"
        )
    names = ", ".join(columns)
    return f"""
SELECT source_row_number, {names} FROM raw_{table}
UNION ALL
SELECT source_row_number + {COPY_OFFSET}, {', '.join(values)} FROM raw_{table}
WHERE {' OR '.join(applies)}"""


for _t in TABLES:
    VIEWS[f"faulted_{_t}"] = _faulted(_t)

# ---------------------------------------------------------------- row checks


def trimmed(column: str) -> str:
    return f"nullif(trim({column}, ' '), '')"


def _case(label: str, checks: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN {condition} THEN '{label}:{code}'" for code, condition in checks)
    return f"CASE {whens} END"


def text_check(column: str, longest: int) -> str:
    t = f"t_{column}"
    return _case(column, [("REQUIRED", f"{t} IS NULL"), ("TOO_LONG", f"length({t}) > {longest}")])


def choice_check(column: str, allowed: list[str], required: bool = True) -> str:
    t = f"t_{column}"
    checks = [("REQUIRED", f"{t} IS NULL")] if required else []
    return _case(column, [*checks, ("INVALID_VALUE", f"{t} NOT IN ({sql_list(allowed)})")])


INTEGER_TEXT = "regexp_full_match({t}, '[+-]?[0-9]+')"
DECIMAL_TEXT = "regexp_full_match({t}, '[+-]?[0-9]+(\\.[0-9]{{1,2}})?')"
WIDTHS = {
    "smallint": (5, "SMALLINT_OUT_OF_RANGE", -32768, 32767),
    "int": (10, "INTEGER_OUT_OF_RANGE", -2147483648, 2147483647),
    "bigint": (19, "BIGINT_OUT_OF_RANGE", -9223372036854775808, 9223372036854775807),
}


def whole_number(t: str, digits: int) -> str:
    return (
        f"CASE WHEN {INTEGER_TEXT.format(t=t)} AND length(ltrim({t}, '+-')) <= {digits} "
        f"THEN CAST({t} AS HUGEINT) END"
    )


def integer_check(
    column: str, width: str = "int", required: bool = True, sign: str = "", extra: str = ""
) -> str:
    t, (digits, beyond, low, high) = f"t_{column}", WIDTHS[width]
    number = f"({whole_number(t, digits)})"
    checks = [("REQUIRED", f"{t} IS NULL")] if required else []
    if extra:
        checks.append(("REQUIRED_FOR_COURSEWORK", f"{t} IS NULL AND {extra}"))
    checks += [
        ("INVALID_INTEGER", f"NOT {INTEGER_TEXT.format(t=t)}"),
        (
            beyond,
            f"{t} IS NOT NULL AND (length(ltrim({t}, '+-')) > {digits} "
            f"OR {number} NOT BETWEEN {low} AND {high})",
        ),
    ]
    if sign == "positive":
        checks.append(("NOT_POSITIVE", f"{number} <= 0"))
    if sign == "not negative":
        checks.append(("NEGATIVE", f"{number} < 0"))
    if sign == "flag":
        checks.append(("INVALID_VALUE", f"{number} NOT IN (0, 1)"))
    return _case(column, checks)


def decimal_check(column: str, required: bool = True) -> str:
    t = f"t_{column}"
    matches = DECIMAL_TEXT.format(t=t)
    checks = [("REQUIRED", f"{t} IS NULL")] if required else []
    checks += [
        ("INVALID_DECIMAL", f"NOT {matches}"),
        (
            "OUT_OF_RANGE",
            f"{t} IS NOT NULL AND (length(ltrim({t}, '+-')) > 20 OR "
            f"CASE WHEN {matches} AND length(ltrim({t}, '+-')) <= 20 THEN CAST({t} AS DECIMAL(38,2)) END "
            "NOT BETWEEN 0 AND 100)",
        ),
    ]
    return _case(column, checks)


def typed_integer(column: str, width: str = "int") -> str:
    digits = WIDTHS[width][0]
    return f"TRY_CAST(({whole_number('t_' + column, digits)}) AS {width.upper()})"


def typed_decimal(column: str) -> str:
    t = f"t_{column}"
    return (
        f"CASE WHEN {DECIMAL_TEXT.format(t=t)} AND length(ltrim({t}, '+-')) <= 20 "
        f"THEN TRY_CAST({t} AS DECIMAL(5,2)) END"
    )


TYPED = {
    "courses": {"module_presentation_length": typed_integer("module_presentation_length")},
    "student_info": {
        "id_student": typed_integer("id_student", "bigint"),
        "num_of_prev_attempts": typed_integer("num_of_prev_attempts"),
        "studied_credits": typed_integer("studied_credits"),
    },
    "student_registration": {
        "id_student": typed_integer("id_student", "bigint"),
        "date_registration": typed_integer("date_registration"),
        "date_unregistration": typed_integer("date_unregistration"),
    },
    "assessments": {
        "id_assessment": typed_integer("id_assessment", "bigint"),
        "date": typed_integer("date"),
        "weight": typed_decimal("weight"),
    },
    "student_assessment": {
        "id_assessment": typed_integer("id_assessment", "bigint"),
        "id_student": typed_integer("id_student", "bigint"),
        "date_submitted": typed_integer("date_submitted"),
        "is_banked": typed_integer("is_banked", "smallint"),
        "score": typed_decimal("score"),
    },
    "vle": {
        "id_site": typed_integer("id_site", "bigint"),
        "week_from": typed_integer("week_from"),
        "week_to": typed_integer("week_to"),
    },
    "student_vle": {
        "id_student": typed_integer("id_student", "bigint"),
        "id_site": typed_integer("id_site", "bigint"),
        "date": typed_integer("date"),
        "sum_click": typed_integer("sum_click"),
    },
}

_COURSE_CHECKS = [text_check("code_module", 3), text_check("code_presentation", 5)]

ROW_CHECKS = {
    "courses": [
        *_COURSE_CHECKS, integer_check("module_presentation_length", sign="positive")
    ],
    "student_info": [
        *_COURSE_CHECKS,
        integer_check("id_student", "bigint", sign="positive"),
        choice_check("gender", GENDERS),
        choice_check("region", REGIONS),
        choice_check("highest_education", EDUCATIONS),
        choice_check("imd_band", IMD_BANDS, required=False),
        choice_check("age_band", AGE_BANDS),
        integer_check("num_of_prev_attempts", sign="not negative"),
        integer_check("studied_credits", sign="positive"),
        choice_check("disability", DISABILITIES),
        choice_check("final_result", RESULTS),
    ],
    "student_registration": [
        *_COURSE_CHECKS,
        integer_check("id_student", "bigint", sign="positive"),
        integer_check("date_registration", required=False),
        integer_check("date_unregistration", required=False),
        _case(
            "date_registration, date_unregistration",
            [(
                "INVALID_DATE_ORDER",
                f"{typed_integer('date_unregistration')} < {typed_integer('date_registration')}",
            )],
        ),
    ],
    "assessments": [
        *_COURSE_CHECKS,
        integer_check("id_assessment", "bigint", sign="positive"),
        choice_check("assessment_type", ASSESSMENT_TYPES),
        integer_check(
            "date", required=False, sign="not negative", extra="t_assessment_type IN ('CMA', 'TMA')"
        ),
        decimal_check("weight"),
    ],
    "student_assessment": [
        integer_check("id_assessment", "bigint", sign="positive"),
        integer_check("id_student", "bigint", sign="positive"),
        integer_check("date_submitted"),
        integer_check("is_banked", "smallint", sign="flag"),
        decimal_check("score", required=False),
    ],
    "vle": [
        integer_check("id_site", "bigint", sign="positive"),
        *_COURSE_CHECKS,
        choice_check("activity_type", ACTIVITY_TYPES),
        integer_check("week_from", required=False),
        integer_check("week_to", required=False),
        _case(
            "week_from, week_to",
            [
                ("INCOMPLETE_WEEK_RANGE", "(t_week_from IS NULL) <> (t_week_to IS NULL)"),
                ("INVALID_WEEK_ORDER", f"{typed_integer('week_to')} < {typed_integer('week_from')}"),
            ],
        ),
    ],
    "student_vle": [
        *_COURSE_CHECKS,
        integer_check("id_student", "bigint", sign="positive"),
        integer_check("id_site", "bigint", sign="positive"),
        integer_check("date"),
        integer_check("sum_click", sign="positive"),
    ],
}

# Missing references as SQL over alias c; one inner list is one pass.
_NO_COURSE = (
    "code_module, code_presentation:COURSE_NOT_FOUND",
    "NOT EXISTS (SELECT 1 FROM clean_courses r WHERE r.code_module = c.v_code_module "
    "AND r.code_presentation = c.v_code_presentation)",
)
_NO_STUDENT = (
    "code_module, code_presentation, id_student:STUDENT_NOT_FOUND",
    "NOT EXISTS (SELECT 1 FROM clean_student_info r WHERE r.code_module = c.v_code_module "
    "AND r.code_presentation = c.v_code_presentation AND r.id_student = c.v_id_student)",
)
REFERENCE_CHECKS = {
    "courses": [],
    "student_info": [[_NO_COURSE]],
    "student_registration": [[_NO_STUDENT]],
    "assessments": [[_NO_COURSE]],
    "student_assessment": [
        [(
            "id_assessment:ASSESSMENT_NOT_FOUND",
            "NOT EXISTS (SELECT 1 FROM clean_assessments r WHERE r.id_assessment = c.v_id_assessment)",
        )],
        [(
            "id_assessment, id_student:STUDENT_NOT_FOUND_FOR_ASSESSMENT",
            "NOT EXISTS (SELECT 1 FROM clean_assessments a JOIN clean_student_info s "
            "USING (code_module, code_presentation) "
            "WHERE a.id_assessment = c.v_id_assessment AND s.id_student = c.v_id_student)",
        )],
    ],
    "vle": [[_NO_COURSE]],
    "student_vle": [[
        _NO_STUDENT,
        (
            "id_site, code_module, code_presentation:SITE_NOT_FOUND",
            "NOT EXISTS (SELECT 1 FROM clean_vle r WHERE r.code_module = c.v_code_module "
            "AND r.code_presentation = c.v_code_presentation AND r.id_site = c.v_id_site)",
        ),
    ]],
}

DUPLICATE_KEYS = {
    "courses": (["code_module", "code_presentation"], ["module_presentation_length"]),
    "student_info": (
        ["code_module", "code_presentation", "id_student"], SOURCE_COLUMNS["student_info"][3:]
    ),
    "student_registration": (
        ["code_module", "code_presentation", "id_student"],
        ["date_registration", "date_unregistration"],
    ),
    "assessments": (
        ["id_assessment"],
        ["code_module", "code_presentation", "assessment_type", "date", "weight"],
    ),
    "student_assessment": (
        ["id_assessment", "id_student"], ["date_submitted", "is_banked", "score"]
    ),
    "vle": (
        ["id_site"],
        ["code_module", "code_presentation", "activity_type", "week_from", "week_to"],
    ),
    "student_vle": (SOURCE_COLUMNS["student_vle"], []),
}


def _text_sql(table: str, column: str) -> str:
    if (table, column) == ("student_info", "imd_band"):
        return f"CASE {trimmed(column)} WHEN '10-20' THEN '10-20%' ELSE {trimmed(column)} END"
    return trimmed(column)


def _validation_views(table: str, source: str) -> None:
    """Views named <source>_..._<table> for source raw or faulted."""
    columns = SOURCE_COLUMNS[table]
    texts = ", ".join(f"{_text_sql(table, c)} AS t_{c}" for c in columns)
    VIEWS[f"text_{source}_{table}"] = f"SELECT *, {texts} FROM {source}_{table}"
    values = ", ".join(f"{TYPED[table].get(c, 't_' + c)} AS v_{c}" for c in columns)
    checks = ", ".join(ROW_CHECKS[table])
    VIEWS[f"checked_{source}_{table}"] = (
        f"SELECT *, {values}, list_filter([{checks}], lambda e: e IS NOT NULL) AS errors "
        f"FROM text_{source}_{table}"
    )
    last = f"checked_{source}_{table}"
    for i, group in enumerate(REFERENCE_CHECKS[table]):
        found = ", ".join(f"CASE WHEN {missing} THEN '{label}' END" for label, missing in group)
        name = f"referenced{i}_{source}_{table}"
        VIEWS[name] = (
            f"SELECT c.* EXCLUDE (errors), CASE WHEN len(errors) > 0 THEN errors "
            f"ELSE list_filter([{found}], lambda e: e IS NOT NULL) END AS errors FROM {last} c"
        )
        last = name
    VIEWS[f"referenced_{source}_{table}"] = f"SELECT * FROM {last}"
    keys, signature = DUPLICATE_KEYS[table]
    key_list = ", ".join(f"v_{k}" for k in keys)
    parts = ", ".join(f"coalesce(CAST(v_{c} AS VARCHAR), '~')" for c in signature) or "''"
    label = ", ".join(keys)
    VIEWS[f"ranked_{source}_{table}"] = f"""
SELECT source_row_number, row_number() OVER w AS valid_rank,
       signature = first_value(signature) OVER w AS same_signature
FROM (SELECT *, concat_ws('|', {parts}) AS signature FROM referenced_{source}_{table} WHERE len(errors) = 0)
WINDOW w AS (PARTITION BY {key_list} ORDER BY source_row_number)"""
    VIEWS[f"validated_{source}_{table}"] = f"""
SELECT c.* EXCLUDE (errors),
       CASE WHEN d.valid_rank > 1 AND d.same_signature THEN ['{label}:EXACT_DUPLICATE']
            WHEN d.valid_rank > 1 THEN ['{label}:CONFLICTING_DUPLICATE'] ELSE errors END AS errors
FROM referenced_{source}_{table} c LEFT JOIN ranked_{source}_{table} d USING (source_row_number)"""


for _t in TABLES:
    for _s in ("raw", "faulted"):
        _validation_views(_t, _s)
    _clean = ", ".join(f"v_{c} AS {c}" for c in SOURCE_COLUMNS[_t])
    VIEWS[f"clean_{_t}"] = f"SELECT {_clean} FROM validated_raw_{_t} WHERE len(errors) = 0"

# ----------------------------------------------------------------- dimensions

VIEWS["dim_module_presentation"] = """
SELECT row_number() OVER (ORDER BY code_module, code_presentation) AS module_presentation_id,
       code_module, code_presentation, module_presentation_length
FROM clean_courses"""

VIEWS["dim_week"] = """
SELECT w - 1 AS week_id, CAST(w AS INTEGER) AS week_no, CAST(7 * (w - 1) AS INTEGER) AS start_day,
       CAST(7 * w AS INTEGER) AS end_day
FROM (SELECT unnest(generate_series(2, (SELECT CAST(ceil(max(module_presentation_length) / 7.0) AS BIGINT)
                                        FROM dim_module_presentation))) AS w)"""

VIEWS["dim_assessments"] = """
SELECT row_number() OVER (ORDER BY id_assessment) AS assessment_id, id_assessment AS assessment_no,
       module_presentation_id, assessment_type, date AS due_date, weight,
       CAST(CASE WHEN date IS NOT NULL THEN floor(date / 7.0) + 1
                 WHEN assessment_type = 'Exam' THEN ceil(module_presentation_length / 7.0) END AS INTEGER)
           AS effective_due_week
FROM clean_assessments JOIN dim_module_presentation USING (code_module, code_presentation)"""

VIEWS["dim_student_module_presentation"] = """
SELECT row_number() OVER (ORDER BY s.id_student, module_presentation_id) AS student_module_presentation_id,
       s.id_student, module_presentation_id, gender, region, highest_education, imd_band, age_band,
       disability, num_of_prev_attempts, studied_credits, date_registration, date_unregistration, final_result
FROM clean_student_info s
JOIN dim_module_presentation USING (code_module, code_presentation)
LEFT JOIN clean_student_registration r
  ON r.id_student = s.id_student AND r.code_module = s.code_module AND r.code_presentation = s.code_presentation"""

# ----------------------------------------------------------------------- facts

VIEWS["module_week"] = """
SELECT m.*, week_id, week_no, start_day, least(end_day, module_presentation_length) AS end_day
FROM dim_module_presentation m JOIN dim_week w ON w.start_day < m.module_presentation_length"""

VIEWS["student_week"] = """
SELECT student_module_presentation_id AS smp, id_student, s.module_presentation_id, code_module,
       code_presentation, module_presentation_length AS length, week_id, week_no, end_day,
       min(week_no) OVER (PARTITION BY student_module_presentation_id) AS first_week
FROM dim_student_module_presentation s JOIN module_week m ON m.module_presentation_id = s.module_presentation_id
WHERE coalesce(date_registration, -1000000) < end_day AND coalesce(date_unregistration, 1000000) >= end_day"""

VIEWS["click_event"] = """
SELECT module_presentation_id, id_student, id_site, activity_type, date AS click_date, sum_click,
       CAST(floor(date / 7.0) AS INTEGER) + 1 AS event_week_no
FROM clean_student_vle JOIN dim_module_presentation USING (code_module, code_presentation)
JOIN clean_vle USING (id_site, code_module, code_presentation)
WHERE date < module_presentation_length"""

VIEWS["coursework_submission"] = """
SELECT assessment_id, a.module_presentation_id, id_student, date_submitted, due_date,
       date_submitted > due_date AS is_late, CAST(floor(date_submitted / 7.0) AS INTEGER) + 1 AS submit_week
FROM clean_student_assessment JOIN dim_assessments a ON assessment_no = id_assessment
JOIN dim_module_presentation USING (module_presentation_id)
WHERE assessment_type <> 'Exam' AND is_banked = 0 AND date_submitted < module_presentation_length"""

# Everything a student did in a grid week or, folded, before week 2.
VIEWS["student_week_clicks"] = """
SELECT g.smp, g.week_no,
       sum(CASE WHEN e.event_week_no = g.week_no THEN sum_click END) AS clicks_week,
       sum(sum_click) AS clicks_to_week,
       count(DISTINCT CASE WHEN e.event_week_no = g.week_no THEN click_date END) AS days_week,
       count(DISTINCT click_date) AS days_to_week
FROM student_week g JOIN click_event e ON e.id_student = g.id_student
 AND e.module_presentation_id = g.module_presentation_id
 AND greatest(e.event_week_no, 2) BETWEEN g.first_week AND g.week_no
GROUP BY g.smp, g.week_no"""

VIEWS["first_site"] = """
SELECT module_presentation_id, id_student, id_site AS item, greatest(min(event_week_no), 2) AS first_seen
FROM click_event GROUP BY ALL"""

VIEWS["first_type"] = """
SELECT module_presentation_id, id_student, activity_type AS item, greatest(min(event_week_no), 2) AS first_seen
FROM click_event GROUP BY ALL"""

for _name in ("site", "type"):
    VIEWS[f"student_week_{_name}s"] = f"""
SELECT g.smp, g.week_no, count(*) AS {_name}s_to_week
FROM student_week g JOIN first_{_name} f ON f.id_student = g.id_student
 AND f.module_presentation_id = g.module_presentation_id AND f.first_seen BETWEEN g.first_week AND g.week_no
GROUP BY g.smp, g.week_no"""

VIEWS["student_week_submissions"] = """
SELECT g.smp, g.week_no, count(*) FILTER (submit_week = g.week_no) AS submitted_week,
       count(*) AS submitted_to_week, count(*) FILTER (is_late) AS late_to_week
FROM student_week g JOIN coursework_submission s ON s.id_student = g.id_student
 AND s.module_presentation_id = g.module_presentation_id
 AND greatest(submit_week, 2) BETWEEN g.first_week AND g.week_no
GROUP BY g.smp, g.week_no"""

VIEWS["student_week_due"] = """
SELECT g.smp, g.week_no, count(*) AS due_to_week,
       count(*) FILTER (r.id_assessment IS NULL OR (r.is_banked = 0 AND r.date_submitted >= g.end_day))
           AS overdue_to_week
FROM student_week g
JOIN dim_assessments a ON a.module_presentation_id = g.module_presentation_id
 AND assessment_type <> 'Exam' AND due_date < g.end_day
LEFT JOIN clean_student_assessment r ON r.id_assessment = a.assessment_no AND r.id_student = g.id_student
GROUP BY g.smp, g.week_no"""

VIEWS["fact_student_module_presentation_week"] = """
SELECT CAST(smp AS BIGINT) * 1000000000 + week_no AS student_week_id, smp AS student_module_presentation_id, week_id,
       CAST(coalesce(clicks_week, 0) AS BIGINT) AS click_count_week,
       CAST(coalesce(clicks_to_week, 0) AS BIGINT) AS click_count_to_week,
       CAST(coalesce(days_week, 0) AS INTEGER) AS active_day_count_week,
       CAST(coalesce(days_to_week, 0) AS INTEGER) AS active_day_count_to_week,
       CAST(coalesce(sites_to_week, 0) AS INTEGER) AS site_count_to_week,
       CAST(coalesce(types_to_week, 0) AS INTEGER) AS activity_type_count_to_week,
       CAST(coalesce(due_to_week, 0) AS INTEGER) AS coursework_due_count_to_week,
       CAST(coalesce(submitted_week, 0) AS INTEGER) AS coursework_submitted_count_week,
       CAST(coalesce(submitted_to_week, 0) AS INTEGER) AS coursework_submitted_count_to_week,
       CAST(coalesce(late_to_week, 0) AS INTEGER) AS coursework_late_count_to_week,
       CAST(coalesce(overdue_to_week, 0) AS INTEGER) AS coursework_overdue_count_to_week
FROM student_week
LEFT JOIN student_week_clicks USING (smp, week_no)
LEFT JOIN student_week_sites USING (smp, week_no)
LEFT JOIN student_week_types USING (smp, week_no)
LEFT JOIN student_week_submissions USING (smp, week_no)
LEFT JOIN student_week_due USING (smp, week_no)"""

VIEWS["assessment_week"] = """
SELECT assessment_id, assessment_no, a.module_presentation_id, due_date, week_id, week_no, end_day
FROM dim_assessments a JOIN module_week m ON m.module_presentation_id = a.module_presentation_id
WHERE assessment_type <> 'Exam'"""

VIEWS["assessment_week_overdue"] = """
SELECT g.assessment_id, g.week_no, count(*) AS overdue
FROM assessment_week g JOIN student_week s
  ON s.module_presentation_id = g.module_presentation_id AND s.week_no = g.week_no
WHERE g.due_date < g.end_day
  AND NOT EXISTS (SELECT 1 FROM clean_student_assessment r WHERE r.id_assessment = g.assessment_no
                  AND r.id_student = s.id_student AND (r.is_banked = 1 OR r.date_submitted < g.end_day))
GROUP BY g.assessment_id, g.week_no"""

VIEWS["fact_module_presentation_assessments_week"] = """
SELECT CAST(g.assessment_id AS BIGINT) * 1000000000 + g.week_no AS assessments_week_id, g.assessment_id, g.week_id,
       count(*) FILTER (submit_week = g.week_no) AS submitted_student_count_week,
       count(submit_week) AS submitted_student_count_to_week,
       count(*) FILTER (submit_week = g.week_no AND is_late) AS late_student_count_week,
       count(*) FILTER (is_late) AS late_student_count_to_week,
       coalesce(max(overdue), 0) AS overdue_unsubmitted_student_count_at_week_end
FROM assessment_week g
LEFT JOIN coursework_submission s ON s.assessment_id = g.assessment_id AND greatest(submit_week, 2) <= g.week_no
LEFT JOIN assessment_week_overdue o ON o.assessment_id = g.assessment_id AND o.week_no = g.week_no
GROUP BY g.assessment_id, g.week_no, g.week_id"""

VIEWS["student_type_week"] = """
SELECT module_presentation_id, activity_type, event_week_no AS week_no, id_student, sum(sum_click) AS clicks
FROM click_event GROUP BY ALL"""

VIEWS["type_week"] = """
SELECT module_presentation_id, activity_type, week_no, count(*) AS students,
       quantile_cont(CAST(clicks AS DOUBLE), 0.5) AS median_clicks
FROM student_type_week GROUP BY ALL"""

VIEWS["type_week_sites"] = """
SELECT module_presentation_id, activity_type, event_week_no AS week_no, count(DISTINCT id_site) AS sites
FROM click_event GROUP BY ALL"""

VIEWS["fact_module_presentation_activity_type_week"] = f"""
SELECT CAST((g.module_presentation_id * 100 + list_position([{sql_list(ACTIVITY_TYPES)}], g.activity_type)) * 1000000000
            + g.week_no AS BIGINT) AS activity_type_week_id,
       g.module_presentation_id, g.week_id, g.activity_type,
       CAST(coalesce((SELECT sum(clicks) FROM student_type_week s WHERE s.week_no = g.week_no
             AND s.activity_type = g.activity_type
             AND s.module_presentation_id = g.module_presentation_id), 0) AS BIGINT) AS click_count_week,
       CAST(coalesce((SELECT sum(clicks) FROM student_type_week s WHERE s.week_no <= g.week_no
             AND s.activity_type = g.activity_type
             AND s.module_presentation_id = g.module_presentation_id), 0) AS BIGINT) AS click_count_to_week,
       CAST(median_clicks AS DECIMAL(12,2)) AS median_student_click_count_week,
       coalesce(students, 0) AS active_student_count_week,
       CAST(coalesce(sites, 0) AS INTEGER) AS accessed_site_count_week
FROM (SELECT DISTINCT m.module_presentation_id, week_id, week_no, activity_type
      FROM module_week m JOIN clean_vle USING (code_module, code_presentation)) g
LEFT JOIN type_week USING (module_presentation_id, activity_type, week_no)
LEFT JOIN type_week_sites USING (module_presentation_id, activity_type, week_no)"""

# --------------------------------------------------------------------- serving

VIEWS["serving"] = """
SELECT student_week_id AS module_presentation_student_week_id, id_student, code_module, code_presentation,
       CAST(week_no AS BIGINT) AS week_no, gender, region, highest_education, imd_band, age_band, disability,
       CAST(num_of_prev_attempts AS BIGINT) AS num_of_prev_attempts,
       CAST(studied_credits AS BIGINT) AS studied_credits,
       click_count_week, click_count_to_week,
       CAST(active_day_count_week AS BIGINT) AS active_day_count_week,
       CAST(active_day_count_to_week AS BIGINT) AS active_day_count_to_week,
       CAST(site_count_to_week AS BIGINT) AS site_count_to_week,
       CAST(activity_type_count_to_week AS BIGINT) AS activity_type_count_to_week,
       CAST(coursework_due_count_to_week AS BIGINT) AS coursework_due_count_to_week,
       CAST(coursework_submitted_count_week AS BIGINT) AS coursework_submitted_count_week,
       CAST(coursework_submitted_count_to_week AS BIGINT) AS coursework_submitted_count_to_week,
       CAST(coursework_late_count_to_week AS BIGINT) AS coursework_late_count_to_week,
       CAST(coursework_overdue_count_to_week AS BIGINT) AS coursework_overdue_count_to_week,
       final_result
FROM fact_student_module_presentation_week
JOIN dim_student_module_presentation USING (student_module_presentation_id)
JOIN dim_module_presentation USING (module_presentation_id)
JOIN dim_week USING (week_id)"""

VIEWS["train"] = """
SELECT * FROM serving WHERE code_presentation IN ('2013B', '2013J', '2014B') AND final_result <> 'Withdrawn'"""

VIEWS["predict"] = """
SELECT * EXCLUDE (final_result) FROM serving WHERE code_presentation = '2014J'"""

# ------------------------------------------------------------------ assembling

_WORD = re.compile(r"[a-z][a-z0-9_]*")


def with_views(query: str, more: dict[str, str] | None = None) -> str:
    """The query behind the views it names, directly or through other views."""
    known = {**VIEWS, **(more or {})}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for word in _WORD.findall(sql):
            if word in known and word not in ordered and word not in pending:
                pending.add(word)
                visit(known[word])
                ordered.append(word)

    pending: set[str] = set()
    visit(query)
    if not ordered:
        return query
    views = ",\n".join(f"{name} AS MATERIALIZED ({known[name]})" for name in ordered)
    return f"WITH {views}\n{query}"
