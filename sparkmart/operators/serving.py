"""Feature frames served to training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.schemas import FEATURE_TYPES, MEASURES, PREDICT_PRESENTATION, TRAIN_PRESENTATIONS

_STUDENT_COLUMNS = [
    "gender", "region", "highest_education", "imd_band", "age_band", "disability",
    "num_of_prev_attempts", "studied_credits",
]


def star(marts: dict[str, DataFrame], presentations: list[str]) -> DataFrame:
    """Student-week facts with their dimensions, for some presentations."""
    modules = marts["dim_module_presentation"].filter(
        F.col("code_presentation").isin(presentations)
    )
    facts = marts["fact_student_module_presentation_week"]
    if "code_presentation" in facts.columns:
        # Stored by presentation: folders of others are not read.
        facts = facts.filter(F.col("code_presentation").isin(presentations)).drop("code_presentation")
    # Students of the wanted presentations first, so that fewer reach the fact join.
    students = marts["dim_student_module_presentation"].join(modules, "module_presentation_id")
    return (
        facts.join(students, "student_module_presentation_id")
        .join(marts["dim_week"], "week_id")
        .select(
            F.col("student_week_id").cast("bigint").alias("module_presentation_student_week_id"),
            "id_student",
            "code_module",
            "code_presentation",
            F.col("week_no").cast("bigint").alias("week_no"),
            *[F.col(c).cast(FEATURE_TYPES[c]).alias(c) for c in (*_STUDENT_COLUMNS, *MEASURES)],
            "final_result",
        )
    )


def train_frame(marts: dict[str, DataFrame]) -> DataFrame:
    """Closed presentations without withdrawn students, with the result."""
    return star(marts, TRAIN_PRESENTATIONS).filter(
        F.col("final_result").isin("Fail", "Pass", "Distinction")
    )


def predict_frame(marts: dict[str, DataFrame]) -> DataFrame:
    """The running presentation, withdrawn students included, without the result."""
    return star(marts, [PREDICT_PRESENTATION]).drop("final_result")
