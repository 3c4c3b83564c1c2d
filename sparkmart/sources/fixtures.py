"""Course-shaped text tables derived from the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.schemas import (
    ACTIVITY_TYPES,
    AGE_BANDS,
    EDUCATIONS,
    IMD_BANDS,
    REGIONS,
    ROW_NUMBER,
    SOURCE_COLUMNS,
)

PRESENTATIONS = ["2013B", "2013J", "2014B", "2014J"]
MODULES = ["AAA", "BBB", "CCC", "DDD", "EEE"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# Copies of base rows are numbered after every base row.
COPY_OFFSET = 10**12


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(value: Column) -> Column:
    return value.cast("string")


def _blank_when(condition: Column, value: Column) -> Column:
    return F.when(condition, F.lit("")).otherwise(_text(value))


def _course_key(nation: Column) -> list[Column]:
    return [
        _pick(MODULES, nation % 5).alias("code_module"),
        _pick(PRESENTATIONS, nation % 4).alias("code_presentation"),
    ]


def courses(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    n = F.col("n_nationkey")
    length = F.lit(234) + 2 * (n % 20) + F.when(n == 24, 1).otherwise(0)
    df = _table(spark, folder, "nation").select(
        *_course_key(n), _text(length).alias("module_presentation_length"), n.alias("_o1")
    )
    return df, ["_o1"]


def student_info(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    k, balance = F.col("c_custkey"), F.col("c_acctbal")
    segment = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment"))
    imd = (
        F.when(k % 22 == 1, F.lit("10-20"))
        .when(k % 11 == 10, F.lit(""))
        .otherwise(_pick([*IMD_BANDS, ""], k % 11))
    )
    result = (
        F.when(balance < 0, "Withdrawn")
        .when(balance < 3000, "Fail")
        .when(balance < 8000, "Pass")
        .otherwise("Distinction")
    )
    df = _table(spark, folder, "customer").select(
        *_course_key(F.col("c_nationkey")),
        _text(k).alias("id_student"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        _pick(REGIONS, F.col("c_nationkey") % 13).alias("region"),
        _pick(EDUCATIONS, segment - 1).alias("highest_education"),
        imd.alias("imd_band"),
        _pick(AGE_BANDS, k % 3).alias("age_band"),
        _text(k % 4).alias("num_of_prev_attempts"),
        _text(30 * (1 + k % 4)).alias("studied_credits"),
        F.when(k % 10 == 0, "Y").otherwise("N").alias("disability"),
        result.alias("final_result"),
        k.alias("_o1"),
    )
    return df, ["_o1"]


def student_registration(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    k = F.col("c_custkey")
    df = _table(spark, folder, "customer").select(
        *_course_key(F.col("c_nationkey")),
        _text(k).alias("id_student"),
        _blank_when(k % 50 == 7, k * 37 % 200 - 150).alias("date_registration"),
        _blank_when(k % 9 != 4, 20 + k * 11 % 200).alias("date_unregistration"),
        k.alias("_o1"),
    )
    return df, ["_o1"]


def assessments(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    n, a = F.col("n_nationkey"), F.col("a")
    kind = F.when(a == 7, "Exam").when(a % 3 == 0, "CMA").otherwise("TMA")
    df = (
        _table(spark, folder, "nation")
        .select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("a"))
        .select(
            *_course_key(n),
            _text(n * 8 + a + 1).alias("id_assessment"),
            kind.alias("assessment_type"),
            _blank_when((a == 7) & (n % 2 == 0), 19 + a * 30).alias("date"),
            F.concat(_text(a * 10), F.lit(".5")).alias("weight"),
            n.alias("_o1"),
            a.alias("_o2"),
        )
    )
    return df, ["_o1", "_o2"]


def student_assessment(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    k, a = F.col("c_custkey"), F.col("a")
    df = (
        _table(spark, folder, "customer")
        .select("c_custkey", "c_nationkey", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("a"))
        .filter((k * 7 + a) % 4 != 0)
        .select(
            _text(F.col("c_nationkey") * 8 + a + 1).alias("id_assessment"),
            _text(k).alias("id_student"),
            _text(19 + a * 30 + (k * 13 + a * 5) % 25 - 12).alias("date_submitted"),
            F.when(k % 40 == 3, "1").otherwise("0").alias("is_banked"),
            _blank_when((k * a) % 17 == 0, (k * a) % 101).alias("score"),
            k.alias("_o1"),
            a.alias("_o2"),
        )
    )
    return df, ["_o1", "_o2"]


def vle(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    p, size = F.col("p_partkey"), F.col("p_size")
    df = _table(spark, folder, "part").select(
        _text(p).alias("id_site"),
        *_course_key(p % 25),
        _pick(ACTIVITY_TYPES, F.expr("p_partkey div 25") % 20).alias("activity_type"),
        _blank_when(size % 3 == 0, size % 20).alias("week_from"),
        _blank_when(size % 3 == 0, size % 20 + size % 5).alias("week_to"),
        p.alias("_o1"),
    )
    return df, ["_o1"]


def student_vle(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = _table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    part, nation = F.col("l_partkey"), F.col("c_nationkey")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    df = (
        lines.select(*order)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            *_course_key(nation),
            _text(F.col("o_custkey")).alias("id_student"),
            _text(part - part % 25 + nation).alias("id_site"),
            _text((part * 7 + F.col("l_suppkey") * 3 + F.col("l_orderkey")) % 300 - 28).alias("date"),
            _text(F.col("l_quantity").cast("int")).alias("sum_click"),
            *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order, start=1)],
        )
    )
    return df, [f"_o{i}" for i in range(1, len(order) + 1)]


BUILDERS = {
    "courses": courses,
    "student_info": student_info,
    "student_registration": student_registration,
    "assessments": assessments,
    "student_assessment": student_assessment,
    "vle": vle,
    "student_vle": student_vle,
}

# --------------------------------------------------------------------------
# Fault injection: altered copies of base rows. Kind = row % period, column =
# (row div period) % number of columns; None keeps the value, "pad" surrounds
# it with spaces. A kind that a column does not list makes no copy.
# --------------------------------------------------------------------------
FAULT_PERIOD = {"courses": 12, "assessments": 25}
DEFAULT_FAULT_PERIOD = 200

_ANY = {0: "pad", 1: "", 8: None}
_INT32 = {2: "12x", 3: "00000000005", 4: "9999999999"}
_ID = {2: "12x", 4: "9" * 19, 5: "-1"}
_CODE_REF = {7: "ZZZ"}
_LONG = {7: "TOOLONG"}
_ENUM = {6: "ZZ"}

FAULTS: dict[str, dict[str, dict[int, str | None]]] = {
    "courses": {
        "code_module": {**_ANY, **_LONG},
        "code_presentation": {**_ANY, **_LONG},
        "module_presentation_length": {**_ANY, **_INT32, 5: "-1", 9: "999"},
    },
    "student_info": {
        "code_module": {**_ANY, **_CODE_REF},
        "code_presentation": {**_ANY, **_LONG},
        "id_student": {**_ANY, **_ID},
        "gender": {**_ANY, **_ENUM, 9: "M"},
        "region": {**_ANY, **_ENUM, 9: "Wales"},
        "highest_education": {**_ANY, **_ENUM, 9: "HE Qualification"},
        "imd_band": {**_ANY, **_ENUM, 9: "90-100%"},
        "age_band": {**_ANY, **_ENUM, 9: "55<="},
        "num_of_prev_attempts": {**_ANY, **_INT32, 5: "-1", 9: "9"},
        "studied_credits": {**_ANY, **_INT32, 5: "-1", 9: "77"},
        "disability": {**_ANY, **_ENUM, 9: "Y"},
        "final_result": {**_ANY, **_ENUM, 9: "Pass"},
    },
    "student_registration": {
        "code_module": {**_ANY, **_CODE_REF},
        "code_presentation": {**_ANY, **_LONG},
        "id_student": {**_ANY, **_ID, 7: "888888888"},
        "date_registration": {**_ANY, **_INT32, 9: "-200"},
        "date_unregistration": {**_ANY, **_INT32, 5: "-9999", 9: "299"},
    },
    "assessments": {
        "code_module": {**_ANY, **_CODE_REF},
        "code_presentation": {**_ANY, **_LONG},
        "id_assessment": {**_ANY, **_ID},
        "assessment_type": {**_ANY, **_ENUM, 9: "TMA"},
        "date": {**_ANY, **_INT32, 5: "-1", 9: "7"},
        "weight": {**_ANY, 2: "12x", 4: "101", 5: "-1", 9: "99.99"},
    },
    "student_assessment": {
        "id_assessment": {**_ANY, **_ID, 7: "999999999"},
        "id_student": {**_ANY, **_ID, 7: "888888888"},
        "date_submitted": {**_ANY, **_INT32, 9: "5"},
        "is_banked": {**_ANY, 2: "12x", 4: "99999", 6: "2", 9: "1"},
        "score": {**_ANY, 2: "12x", 4: "101", 5: "-1", 9: "100.00"},
    },
    "vle": {
        "id_site": {**_ANY, **_ID},
        "code_module": {**_ANY, **_CODE_REF},
        "code_presentation": {**_ANY, **_LONG},
        "activity_type": {**_ANY, **_ENUM, 9: "url"},
        "week_from": {**_ANY, **_INT32, 9: "0"},
        "week_to": {**_ANY, **_INT32, 5: "-9999", 9: "60"},
    },
    "student_vle": {
        "code_module": {**_ANY, **_CODE_REF},
        "code_presentation": {**_ANY, **_LONG},
        "id_student": {**_ANY, **_ID, 7: "888888888"},
        "id_site": {**_ANY, **_ID, 7: "777777777"},
        "date": {**_ANY, **_INT32},
        "sum_click": {**_ANY, **_INT32, 5: "-1", 9: "777"},
    },
}


def inject_faults(raw: DataFrame, table: str) -> DataFrame:
    """Base rows plus altered copies that exercise every rule."""
    columns = SOURCE_COLUMNS[table]
    period = FAULT_PERIOD.get(table, DEFAULT_FAULT_PERIOD)
    kind = F.col("_kind")

    def altered(position: int, column: str) -> Column:
        value = F.col(column)
        changed = value
        for code, literal in FAULTS[table][column].items():
            if literal == "pad":
                target = F.concat(F.lit(" "), F.coalesce(value, F.lit("")), F.lit(" "))
            else:
                target = value if literal is None else F.lit(literal)
            changed = F.when(kind == code, target).otherwise(changed)
        return F.when(F.col("_column") == position, changed).otherwise(value).alias(column)

    applies = F.lit(False)
    for position, column in enumerate(columns):
        codes = list(FAULTS[table][column])
        applies = applies | ((F.col("_column") == position) & kind.isin(codes))

    copies = (
        raw.withColumn("_kind", F.col(ROW_NUMBER) % period)
        .withColumn("_column", F.floor(F.col(ROW_NUMBER) / period) % len(columns))
        .filter(applies)
        .select(
            (F.col(ROW_NUMBER) + COPY_OFFSET).alias(ROW_NUMBER),
            *[altered(i, c) for i, c in enumerate(columns)],
        )
    )
    return raw.select(ROW_NUMBER, *columns).unionByName(copies)
