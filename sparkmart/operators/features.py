"""Engineered features and the fitted preprocessing of model inputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.encode import ordinal_code, ratio_or_zero
from sparkmart.operators.checks import ContractError
from sparkmart.schemas import ENGINEERED, ENTITY, MODEL_NUMERIC, NOMINALS, ORDINALS

# ---------------------------------------------------------------- engineered


def change_from_previous(value: str, entity: list[str], step: str) -> Column:
    """Difference to the previous step; 0 at the first."""
    ordered = Window.partitionBy(*entity).orderBy(step)
    return F.coalesce(F.col(value) - F.lag(value).over(ordered), F.lit(0)).cast("double")


def with_inactive_streak(
    df: DataFrame, value: str, entity: list[str], step: str, name: str = "inactive_streak_weeks"
) -> DataFrame:
    """Consecutive steps up to here in which the value was 0."""
    upto = Window.partitionBy(*entity).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    active = F.when(F.col(value) != 0, 1).otherwise(0)
    blocks = df.withColumn("_block", F.sum(active).over(upto))
    within = Window.partitionBy(*entity, "_block").orderBy(step)
    within = within.rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn(name, F.sum(1 - active).over(within)).drop("_block")


def build_features(frame: DataFrame) -> DataFrame:
    """Add click change, inactive streak and overdue rate per student and week.

    One row per student and week goes in, so a window never exceeds the weeks
    of one student. A feature that is missing or not finite raises when it is read.
    """
    needed = {
        *ENTITY, "week_no", "click_count_week", "coursework_due_count_to_week",
        "coursework_overdue_count_to_week",
    }
    missing = sorted(needed - set(frame.columns))
    if missing:
        raise ContractError(f"columns missing for features: {missing}")
    overdue, due = F.col("coursework_overdue_count_to_week"), F.col("coursework_due_count_to_week")
    changed = frame.withColumn(
        "click_delta_1w", change_from_previous("click_count_week", ENTITY, "week_no")
    )
    built = with_inactive_streak(changed, "click_count_week", ENTITY, "week_no").withColumn(
        "coursework_overdue_rate", ratio_or_zero(overdue, due)
    )
    return built.withColumns({c: _finite(c) for c in ENGINEERED})


def _not_finite(c: str) -> Column:
    v = F.col(c).cast("double")
    return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))


def _finite(c: str) -> Column:
    problem = F.raise_error(F.lit(f"{c} is missing or not finite"))
    return F.when(_not_finite(c), problem).otherwise(F.col(c))


def not_finite(df: DataFrame, columns: list[str] = ENGINEERED) -> DataFrame:
    """Rows per engineered column that are NULL, NaN or infinite."""
    totals = df.agg(*[F.count_if(_not_finite(c)).alias(c) for c in columns])
    rows = [
        F.struct(F.lit(f"{c} not finite").alias("check"), F.col(c).alias("violations"))
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))


# ------------------------------------------------------------- preprocessing


@dataclass(frozen=True)
class FeatureSet:
    nominal: tuple[str, ...]
    ordinal: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [*self.nominal, *self.ordinal, *self.numeric]


FULL = FeatureSet(tuple(NOMINALS), tuple(ORDINALS), tuple(MODEL_NUMERIC))
EXTENDED = FeatureSet(tuple(NOMINALS), tuple(ORDINALS), (*MODEL_NUMERIC, *ENGINEERED))
BASIC = FeatureSet(
    tuple(NOMINALS), tuple(ORDINALS), ("week_no", "num_of_prev_attempts", "studied_credits")
)


@dataclass(frozen=True)
class Feature:
    """One model input: its name, the source column and the SQL that computes it."""

    group: str
    name: str
    column: str
    sql: str

    @property
    def full_name(self) -> str:
        return f"{self.group}__{self.name}"


@dataclass(frozen=True)
class Preprocessor:
    """Model inputs in order, with everything learned at fit time in their SQL."""

    features: tuple[Feature, ...]

    @property
    def names(self) -> list[str]:
        return [f.full_name for f in self.features]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[F.expr(f.sql).alias(f.full_name) for f in self.features])

    def statement(self) -> str:
        """The same as one SQL statement, for a saved pipeline."""
        inputs = ", ".join(f"{f.sql} AS `{f.full_name}`" for f in self.features)
        return f"SELECT *, {inputs} FROM __THIS__"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ordinal_sql(column: str) -> str:
    whens = " ".join(f"WHEN {_quoted(v)} THEN {i}D" for i, v in enumerate(ORDINALS[column]))
    return f"CASE {column} {whens} END"


def fit_preprocessor(df: DataFrame, features: FeatureSet = FULL) -> Preprocessor:
    """Learn categories, means and deviations in one aggregate over the frame.

    What comes back is one row per fit. Categories are bounded by the allowed
    values of the clean zone.
    """
    learned = df.agg(
        *[F.sort_array(F.collect_set(c)).alias(f"cat_{c}") for c in features.nominal],
        *[F.avg(ordinal_code(F.col(c), ORDINALS[c])).alias(f"avg_{c}") for c in features.ordinal],
        *[
            F.count_if(ordinal_code(F.col(c), ORDINALS[c]).isNull()).alias(f"null_{c}")
            for c in features.ordinal
        ],
        *[F.avg(c).alias(f"avg_{c}") for c in features.numeric],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in features.numeric],
    ).first()
    inputs: list[Feature] = []
    for c in features.nominal:
        categories = learned[f"cat_{c}"]
        kept = categories[1:] if len(categories) == 2 else categories
        inputs += [
            Feature("categorical", f"{c}_{v}", c, f"IF({c} <=> {_quoted(v)}, 1D, 0D)") for v in kept
        ]
    for c in features.ordinal:
        mean = learned[f"avg_{c}"] or 0.0
        inputs.append(Feature("ordinal", c, c, f"COALESCE({_ordinal_sql(c)}, {mean!r}D)"))
    for c in features.ordinal:
        if learned[f"null_{c}"]:
            sql = f"IF({_ordinal_sql(c)} IS NULL, 1D, 0D)"
            inputs.append(Feature("ordinal", f"missingindicator_{c}", c, sql))
    for c in features.numeric:
        std = learned[f"std_{c}"] or 1.0
        inputs.append(Feature("numeric", c, c, f"({c} - {learned[f'avg_{c}']!r}D) / {std!r}D"))
    return Preprocessor(tuple(inputs))
