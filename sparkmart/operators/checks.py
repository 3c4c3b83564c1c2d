"""Contract and constraint checks. Each gives (check, violations) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.schemas import FEATURE_TYPES, MART_TYPES, PROFILE_NUMERIC

GRAIN = ["code_presentation", "code_module", "id_student", "week_no"]
NULLABLE = {"imd_band"}
WEEKLY_AND_CUMULATIVE = [
    ("click_count_week", "click_count_to_week"),
    ("active_day_count_week", "active_day_count_to_week"),
    ("coursework_submitted_count_week", "coursework_submitted_count_to_week"),
]


class ContractError(ValueError):
    """A frame or table breaks its contract."""


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _numbers(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("int", "bigint", "smallint", "double")]


def column_problems(df: DataFrame, train: bool = False) -> dict[str, int]:
    """Missing, extra and wrongly typed columns; needs no data."""
    actual = dict(df.dtypes)
    allowed = {*FEATURE_TYPES, "final_result"}
    problems = {
        "columns missing": len(set(FEATURE_TYPES) - set(actual)),
        "columns extra": len(set(actual) - allowed),
        "columns of another type": sum(
            actual[c] != t for c, t in FEATURE_TYPES.items() if c in actual
        ),
    }
    if train:
        problems["target missing"] = int("final_result" not in actual)
    return problems


def row_problems(df: DataFrame) -> dict[str, Column]:
    """Condition of a violating row per check."""
    problems = {f"null in {c}": F.col(c).isNull() for c in df.columns if c not in NULLABLE}
    problems["week before the second"] = F.col("week_no") < 2
    for c in _numbers(df):
        problems[f"negative {c}"] = F.col(c) < 0
    for weekly, cumulative in WEEKLY_AND_CUMULATIVE:
        problems[f"{weekly} above {cumulative}"] = F.col(weekly) > F.col(cumulative)
    return problems


def _as_rows(totals: DataFrame, names: list[str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(n).alias("check"), F.col(f"_{i}").alias("violations"))
        for i, n in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*pairs)))


def serving_report(df: DataFrame, train: bool = False) -> DataFrame:
    """All contract checks of a serving frame.

    Counters are summed before anything is shuffled; only the columns of the
    grain go to the check for repeated ones.
    """
    structure = column_problems(df, train)
    rows = row_problems(df)
    values = [*[F.count_if(c) for c in rows.values()], *[F.lit(n) for n in structure.values()]]
    totals = df.agg(*[v.cast("bigint").alias(f"_{i}") for i, v in enumerate(values)])
    grains = df.groupBy(*GRAIN).agg(F.count("*").alias("rows")).agg(
        F.when(F.sum("rows").isNull(), 1).otherwise(0).cast("bigint").alias("_0"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint").alias("_1"),
    )
    return _as_rows(grains, ["empty frame", "repeated grain"]).unionByName(
        _as_rows(totals, [*rows, *structure])
    )


def require_clean(report: DataFrame) -> None:
    """Raise if any check of a report has violations."""
    broken = report.filter(F.col("violations") > 0).collect()
    if broken:
        raise ContractError("; ".join(f"{r.check}: {r.violations}" for r in broken))


def validate_serving(df: DataFrame, train: bool = False) -> None:
    structure = {n: v for n, v in column_problems(df, train).items() if v}
    if structure:
        raise ContractError("; ".join(f"{n}: {v}" for n, v in structure.items()))
    require_clean(serving_report(df, train))


def invariants(df: DataFrame) -> DataFrame:
    """Eight business invariants of the training frame."""
    c = F.col
    checks = {
        "negative number": _any([c(n) < 0 for n in PROFILE_NUMERIC]),
        "week before the second": c("week_no") < 2,
        "more than seven active days": c("active_day_count_week") > 7,
        "weekly clicks above total": c("click_count_week") > c("click_count_to_week"),
        "weekly days above total": c("active_day_count_week") > c("active_day_count_to_week"),
        "weekly submissions above total": (
            c("coursework_submitted_count_week") > c("coursework_submitted_count_to_week")
        ),
        "late above submitted": (
            c("coursework_late_count_to_week") > c("coursework_submitted_count_to_week")
        ),
        "overdue above due": (
            c("coursework_overdue_count_to_week") > c("coursework_due_count_to_week")
        ),
    }
    totals = df.agg(*[F.count_if(v).alias(f"_{i}") for i, v in enumerate(checks.values())])
    return _as_rows(totals, list(checks))


# ------------------------------------------------------------ mart constraints

# Primary key, unique key and foreign keys of each mart table.
CONSTRAINTS = {
    "dim_week": ("week_id", ["week_no"], {}),
    "dim_module_presentation": (
        "module_presentation_id", ["code_module", "code_presentation"], {}
    ),
    "dim_assessments": (
        "assessment_id",
        ["assessment_no"],
        {"module_presentation_id": "dim_module_presentation"},
    ),
    "dim_student_module_presentation": (
        "student_module_presentation_id",
        ["id_student", "module_presentation_id"],
        {"module_presentation_id": "dim_module_presentation"},
    ),
    "fact_module_presentation_assessments_week": (
        "assessments_week_id",
        ["assessment_id", "week_id"],
        {"assessment_id": "dim_assessments", "week_id": "dim_week"},
    ),
    "fact_module_presentation_activity_type_week": (
        "activity_type_week_id",
        ["module_presentation_id", "activity_type", "week_id"],
        {"module_presentation_id": "dim_module_presentation", "week_id": "dim_week"},
    ),
    "fact_student_module_presentation_week": (
        "student_week_id",
        ["student_module_presentation_id", "week_id"],
        {
            "student_module_presentation_id": "dim_student_module_presentation",
            "week_id": "dim_week",
        },
    ),
}
MART_NULLABLE = {
    "due_date", "imd_band", "date_registration", "date_unregistration",
    "median_student_click_count_week",
}


#: Columns that hold the values of any key: whole numbers and text.
_NUMBERS, _TEXTS = 2, 2
_KEY = [*[f"k{i}" for i in range(_NUMBERS)], *[f"t{i}" for i in range(_TEXTS)]]


def _tagged(check: str, df: DataFrame, keys: list[str], rows: Column, parent: bool = False) -> Column:
    """One key of a row: whose check it is for, its values by kind, and the rows it stands for."""
    types = dict(df.dtypes)
    numbers = [F.col(k).cast("bigint") for k in keys if types[k] in ("int", "bigint", "smallint")]
    others = [F.col(k).cast("string") for k in keys if types[k] not in ("int", "bigint", "smallint")]
    if len(numbers) > _NUMBERS or len(others) > _TEXTS:
        raise ValueError(f"{check}: too many key columns")
    numbers += [F.lit(None).cast("bigint")] * (_NUMBERS - len(numbers))
    others += [F.lit(None).cast("string")] * (_TEXTS - len(others))
    values = [v.alias(name) for v, name in zip([*numbers, *others], _KEY, strict=True)]
    return F.struct(
        F.lit(check).alias("check"), *values, rows.cast("bigint").alias("rows"), F.lit(int(parent)).alias("parents")
    )


def constraint_report(marts: dict[str, DataFrame]) -> DataFrame:
    """Key, reference and NOT NULL violations of every mart table, and empty tables.

    Each table is read once. A row gives its values of all keys, as child and
    as parent; one aggregate over all tables counts them, combined before the
    shuffle, and its result has all violations.
    """
    names: list[tuple[str, str]] = []
    parts = []
    one = F.lit(1)
    for table in MART_TYPES:
        df = marts[table]
        primary, unique, foreign = CONSTRAINTS[table]
        required = [F.col(c).isNull() for c in df.columns if c not in MART_NULLABLE]
        tags = [
            _tagged(f"{table}: primary key", df, [primary], one),
            _tagged(f"{table}: unique key", df, unique, one),
            _tagged(f"{table}: not null", df, [], _any(required).cast("int")),
            _tagged(f"{table}: not empty", df, [], one),
        ]
        names += [(f"{table}: {kind}", kind) for kind in ("primary key", "unique key", "not null", "not empty")]
        for column in foreign:
            # a key without a value needs no parent
            tags.append(F.when(F.col(column).isNotNull(), _tagged(f"{table}: {column}", df, [column], one)))
            names.append((f"{table}: {column}", "parent"))
        for child, (_, _, others) in CONSTRAINTS.items():
            for column in (c for c, parent in others.items() if parent == table):
                tags.append(_tagged(f"{child}: {column}", df, [column], F.lit(0), parent=True))
        parts.append(df.select(F.inline(F.array_compact(F.array(*tags)))))
    counts = reduce(DataFrame.unionByName, parts).groupBy("check", *_KEY).agg(
        F.sum("rows").alias("rows"), F.max("parents").alias("parents")
    )
    sums = counts.groupBy("check").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") - 1).alias("repeated"),
        F.sum(F.when(F.col("parents") == 0, F.col("rows")).otherwise(0)).alias("orphans"),
    )
    checks = marts["dim_week"].sparkSession.createDataFrame(names, "check string, kind string")
    kind = F.col("kind")
    violations = (
        F.when(kind == "not empty", F.when(F.col("rows").isNull(), 1).otherwise(0))
        .when(kind == "not null", F.col("rows"))
        .when(kind == "parent", F.col("orphans"))
        .otherwise(F.col("repeated"))
    )
    return checks.join(sums, "check", "left").select(
        "check", F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")
    )
