"""Declared shape of every zone. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# They must equal the published source contract.
# --------------------------------------------------------------------------
SOURCE_COLUMNS = {
    "courses": ["code_module", "code_presentation", "module_presentation_length"],
    "student_info": [
        "code_module", "code_presentation", "id_student", "gender", "region",
        "highest_education", "imd_band", "age_band", "num_of_prev_attempts",
        "studied_credits", "disability", "final_result",
    ],
    "student_registration": [
        "code_module", "code_presentation", "id_student",
        "date_registration", "date_unregistration",
    ],
    "assessments": [
        "code_module", "code_presentation", "id_assessment",
        "assessment_type", "date", "weight",
    ],
    "student_assessment": [
        "id_assessment", "id_student", "date_submitted", "is_banked", "score",
    ],
    "vle": [
        "id_site", "code_module", "code_presentation",
        "activity_type", "week_from", "week_to",
    ],
    "student_vle": [
        "code_module", "code_presentation", "id_student", "id_site", "date", "sum_click",
    ],
}

SOURCE_FILES = {
    "courses": "courses.csv",
    "student_info": "studentInfo.csv",
    "student_registration": "studentRegistration.csv",
    "assessments": "assessments.csv",
    "student_assessment": "studentAssessment.csv",
    "vle": "vle.csv",
    "student_vle": "studentVle.csv",
}

GENDERS = ["F", "M"]
REGIONS = [
    "East Anglian Region", "East Midlands Region", "Ireland", "London Region",
    "North Region", "North Western Region", "Scotland", "South East Region",
    "South Region", "South West Region", "Wales", "West Midlands Region",
    "Yorkshire Region",
]
EDUCATIONS = [
    "No Formal quals", "Lower Than A Level", "A Level or Equivalent",
    "HE Qualification", "Post Graduate Qualification",
]
IMD_BANDS = [
    "0-10%", "10-20%", "20-30%", "30-40%", "40-50%",
    "50-60%", "60-70%", "70-80%", "80-90%", "90-100%",
]
IMD_CANONICAL = {"10-20": "10-20%"}
AGE_BANDS = ["0-35", "35-55", "55<="]
DISABILITIES = ["N", "Y"]
RESULTS = ["Distinction", "Pass", "Fail", "Withdrawn"]
ASSESSMENT_TYPES = ["CMA", "TMA", "Exam"]
COURSEWORK_TYPES = ["CMA", "TMA"]
ACTIVITY_TYPES = [
    "dataplus", "dualpane", "externalquiz", "folder", "forumng", "glossary",
    "homepage", "htmlactivity", "oucollaborate", "oucontent", "ouelluminate",
    "ouwiki", "page", "questionnaire", "quiz", "repeatactivity", "resource",
    "sharedsubpage", "subpage", "url",
]
TRAIN_PRESENTATIONS = ["2013B", "2013J", "2014B"]
PREDICT_PRESENTATION = "2014J"
TARGET_CODES = {"Fail": 1, "Pass": 0, "Distinction": 0}
THRESHOLD = 0.5

# Serving frame: column name -> contract type, in serving order.
FEATURE_TYPES = {
    "module_presentation_student_week_id": "bigint",
    "id_student": "bigint",
    "code_module": "string",
    "code_presentation": "string",
    "week_no": "bigint",
    "gender": "string",
    "region": "string",
    "highest_education": "string",
    "imd_band": "string",
    "age_band": "string",
    "disability": "string",
    "num_of_prev_attempts": "bigint",
    "studied_credits": "bigint",
    "click_count_week": "bigint",
    "click_count_to_week": "bigint",
    "active_day_count_week": "bigint",
    "active_day_count_to_week": "bigint",
    "site_count_to_week": "bigint",
    "activity_type_count_to_week": "bigint",
    "coursework_due_count_to_week": "bigint",
    "coursework_submitted_count_week": "bigint",
    "coursework_submitted_count_to_week": "bigint",
    "coursework_late_count_to_week": "bigint",
    "coursework_overdue_count_to_week": "bigint",
}

# --------------------------------------------------------------------------
# Derived from the fixed values above
# --------------------------------------------------------------------------
TABLES = list(SOURCE_COLUMNS)

MEASURES = list(FEATURE_TYPES)[13:]
PROFILE_NUMERIC = ["num_of_prev_attempts", "studied_credits", *MEASURES]
CATEGORICALS = ["gender", "region", "highest_education", "imd_band", "age_band", "disability"]
NOMINALS = ["gender", "region", "disability"]
ORDINALS = {
    "highest_education": EDUCATIONS,
    "imd_band": IMD_BANDS,
    "age_band": AGE_BANDS,
}
MODEL_NUMERIC = ["week_no", *PROFILE_NUMERIC]
ENGINEERED = ["click_delta_1w", "inactive_streak_weeks", "coursework_overdue_rate"]

ROW_NUMBER = "source_row_number"
ENTITY = ["code_module", "code_presentation", "id_student"]

ERRORS_TYPE = T.ArrayType(
    T.StructType([
        T.StructField("column", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("message", T.StringType()),
    ])
)


def raw_schema(table: str) -> T.StructType:
    """Every source column as text, in declared order."""
    return T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS[table]])


CLEAN_TYPES = {
    "courses": "code_module string, code_presentation string, module_presentation_length int",
    "student_info": (
        "code_module string, code_presentation string, id_student bigint, gender string, "
        "region string, highest_education string, imd_band string, age_band string, "
        "num_of_prev_attempts int, studied_credits int, disability string, final_result string"
    ),
    "student_registration": (
        "code_module string, code_presentation string, id_student bigint, "
        "date_registration int, date_unregistration int"
    ),
    "assessments": (
        "code_module string, code_presentation string, id_assessment bigint, "
        "assessment_type string, date int, weight decimal(5,2)"
    ),
    "student_assessment": (
        "id_assessment bigint, id_student bigint, date_submitted int, is_banked smallint, "
        "score decimal(5,2)"
    ),
    "vle": (
        "id_site bigint, code_module string, code_presentation string, "
        "activity_type string, week_from int, week_to int"
    ),
    "student_vle": (
        "code_module string, code_presentation string, id_student bigint, id_site bigint, "
        "date int, sum_click int"
    ),
}

MART_TYPES = {
    "dim_week": "week_id bigint, week_no int, start_day int, end_day int",
    "dim_module_presentation": (
        "module_presentation_id bigint, code_module string, code_presentation string, "
        "module_presentation_length int"
    ),
    "dim_assessments": (
        "assessment_id bigint, assessment_no bigint, module_presentation_id bigint, "
        "assessment_type string, due_date int, weight decimal(5,2), effective_due_week int"
    ),
    "dim_student_module_presentation": (
        "student_module_presentation_id bigint, id_student bigint, module_presentation_id bigint, "
        "gender string, region string, highest_education string, imd_band string, "
        "age_band string, disability string, num_of_prev_attempts int, studied_credits int, "
        "date_registration int, date_unregistration int, final_result string"
    ),
    "fact_module_presentation_assessments_week": (
        "assessments_week_id bigint, assessment_id bigint, week_id bigint, "
        "submitted_student_count_week bigint, submitted_student_count_to_week bigint, "
        "late_student_count_week bigint, late_student_count_to_week bigint, "
        "overdue_unsubmitted_student_count_at_week_end bigint"
    ),
    "fact_module_presentation_activity_type_week": (
        "activity_type_week_id bigint, module_presentation_id bigint, week_id bigint, "
        "activity_type string, click_count_week bigint, click_count_to_week bigint, "
        "median_student_click_count_week decimal(12,2), active_student_count_week bigint, "
        "accessed_site_count_week int"
    ),
    "fact_student_module_presentation_week": (
        "student_week_id bigint, student_module_presentation_id bigint, week_id bigint, "
        "click_count_week bigint, click_count_to_week bigint, active_day_count_week int, "
        "active_day_count_to_week int, site_count_to_week int, activity_type_count_to_week int, "
        "coursework_due_count_to_week int, coursework_submitted_count_week int, "
        "coursework_submitted_count_to_week int, coursework_late_count_to_week int, "
        "coursework_overdue_count_to_week int"
    ),
}

PREDICTION_TYPES = {
    "student_week_prediction": (
        "prediction_id bigint, module_presentation_student_week_id bigint, "
        "risk_probability decimal(5,4), predict_result string"
    ),
    "prediction_contribution": (
        "contribution_id bigint, prediction_id bigint, factor_name string, "
        "factor_value string, factor_rank int, shap_value decimal(14,4)"
    ),
}


def quarantine_schema(table: str) -> T.StructType:
    """Raw text of a rejected row with its errors and where it came from."""
    return T.StructType(
        [
            T.StructField("source_file", T.StringType()),
            T.StructField(ROW_NUMBER, T.LongType()),
            *raw_schema(table).fields,
            T.StructField("error_details", ERRORS_TYPE),
            T.StructField("detected_at", T.TimestampType()),
        ]
    )


def zone_tables() -> dict[str, dict[str, object]]:
    """Schema of every table by zone, for creating empty zones and checking sinks."""
    return {
        "raw": {
            t: T.StructType([T.StructField(ROW_NUMBER, T.LongType()), *raw_schema(t).fields])
            for t in TABLES
        },
        "clean": dict(CLEAN_TYPES),
        "quarantine": {t: quarantine_schema(t) for t in TABLES},
        "mart": dict(MART_TYPES),
        "prediction": dict(PREDICTION_TYPES),
    }
