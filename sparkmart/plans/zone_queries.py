"""Queries on sources, scalar functions, validation and reference joins."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.functions import encode as N
from sparkmart.functions import text as X
from sparkmart.operators import validate as V
from sparkmart.plans.catalogue import register
from sparkmart.plans.oracle_base import sql_list, trimmed, typed_integer, whole_number
from sparkmart.plans.workspace import Workspace
from sparkmart.session import in_parallel, scratch_folder
from sparkmart.sources.csv_source import read_source, write_source

ROW = S.ROW_NUMBER
BLOCK_BYTES = "spark.sql.files.maxPartitionBytes"


def columns_of(table: str) -> str:
    return ", ".join(S.SOURCE_COLUMNS[table])


# -------------------------------------------------------------------- sources


def csv_round_trip(w: Workspace, table: str) -> DataFrame:
    """Write the raw zone as part files in row order and read it as a source."""
    folder = scratch_folder(w.spark, "csv")
    write_source(w.raw(table), folder, table)
    return read_source(w.spark, folder, table)


for _t in ("student_info", "student_vle"):
    _nulled = ", ".join(f"nullif({c}, '') AS {c}" for c in S.SOURCE_COLUMNS[_t])
    register(
        f"s03_csv_scan_{_t}",
        lambda w, t=_t: csv_round_trip(w, t),
        f"SELECT source_row_number, {_nulled} FROM raw_{_t}",
    )


#: Bytes of a block that cuts through records, and blocks of a source from which on they are larger.
SMALL_BLOCK, SMALL_BLOCKS = 100_000, 500


def cutting_block_bytes(spark: SparkSession, path: str) -> int:
    """Small blocks, so that many records are cut; a large source has larger ones, up to the session's, as each costs a task in every pass."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    session = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BLOCK_BYTES))
    return max(SMALL_BLOCK, min(size // SMALL_BLOCKS, session))


def csv_line_breaks(w: Workspace) -> DataFrame:
    """The clicks as a source whose quoted values hold line breaks and quotes, read in blocks that cut through records."""
    spark = w.spark
    text = F.concat("code_presentation", F.lit('\n"'), "id_site", F.lit('"\r\n,'))
    folder = scratch_folder(spark, "csv")
    write_source(w.raw("student_vle").withColumn("code_presentation", text), folder, "student_vle")
    found = scratch_folder(spark, "csv_read")
    before = spark.conf.get(BLOCK_BYTES)
    spark.conf.set(BLOCK_BYTES, str(cutting_block_bytes(spark, f"{folder}/{S.SOURCE_FILES['student_vle']}")))
    try:
        read_source(spark, folder, "student_vle").write.parquet(found)
    finally:
        spark.conf.set(BLOCK_BYTES, before)
    return spark.read.parquet(found)


_broken = """code_presentation || chr(10) || '"' || id_site || '"' || chr(13) || chr(10) || ',' AS code_presentation"""
_nulled = ", ".join(
    _broken if c == "code_presentation" else f"nullif({c}, '') AS {c}" for c in S.SOURCE_COLUMNS["student_vle"]
)
register("s03_csv_line_breaks", csv_line_breaks, f"SELECT source_row_number, {_nulled} FROM raw_student_vle")

for _t in S.TABLES:
    register(
        f"s05_row_numbers_{_t}",
        lambda w, t=_t: w.raw(t),
        f"SELECT source_row_number, {columns_of(_t)} FROM raw_{_t}",
    )


def loaded_counts(w: Workspace) -> DataFrame:
    parts = [
        w.raw(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n"), F.max(ROW).alias("last_row"))
        for t in S.TABLES
    ]
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


register(
    "s04_load_all_sources",
    loaded_counts,
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n, max(source_row_number) AS last_row FROM raw_{t}"
        for t in S.TABLES
    ),
)


def _quarantine(w: Workspace, table: str) -> DataFrame:
    rejected = V.route_quarantine(w.validated_with_faults(table), table)
    return rejected.drop("detected_at").withColumn("error_details", _codes(F.col("error_details")))


def _codes(errors: Column) -> Column:
    return F.array_join(F.transform(errors, lambda e: F.concat_ws(":", e["column"], e["code"])), ";")


for _t in S.TABLES:
    register(
        f"s09_quarantine_{_t}",
        lambda w, t=_t: _quarantine(w, t),
        f"SELECT '{S.SOURCE_FILES[_t]}' AS source_file, source_row_number, {columns_of(_t)}, "
        f"array_to_string(errors, ';') AS error_details FROM validated_faulted_{_t} WHERE len(errors) > 0",
    )
    register(f"s10_clean_{_t}", lambda w, t=_t: w.clean(t), f"SELECT * FROM clean_{_t}")

# ----------------------------------------------------------- scalar functions

_INFO_TEXT = ["id_student", "region", "imd_band", "final_result"]
register(
    "p01_blank_to_null",
    lambda w: w.faulted("student_info").select(
        ROW, *[X.blank_to_null(F.col(c)).alias(c) for c in _INFO_TEXT]
    ),
    f"SELECT source_row_number, {', '.join(f'{trimmed(c)} AS {c}' for c in _INFO_TEXT)} "
    "FROM faulted_student_info",
)

_CLICK_NUMBERS = ["id_student", "id_site", "date", "sum_click"]
register(
    "p02_integer_text",
    lambda w: w.faulted("student_vle").select(
        ROW, *[X.is_integer_text(X.blank_to_null(F.col(c))).alias(c) for c in _CLICK_NUMBERS]
    ),
    "SELECT source_row_number, "
    + ", ".join(f"regexp_full_match({trimmed(c)}, '[+-]?[0-9]+') AS {c}" for c in _CLICK_NUMBERS)
    + " FROM faulted_student_vle",
)
register(
    "p03_decimal_text",
    lambda w: w.faulted("assessments").select(
        ROW, *[X.is_decimal_text(X.blank_to_null(F.col(c))).alias(c) for c in ("weight", "date")]
    ),
    "SELECT source_row_number, "
    + ", ".join(
        f"regexp_full_match({trimmed(c)}, '[+-]?[0-9]+([.][0-9]{{1,2}})?') AS {c}" for c in ("weight", "date")
    )
    + " FROM faulted_assessments",
)
register(
    "p04_digit_width",
    lambda w: w.faulted("student_assessment").select(
        ROW, *[X.digit_width(X.blank_to_null(F.col(c))).cast("bigint").alias(c)
               for c in S.SOURCE_COLUMNS["student_assessment"]]
    ),
    "SELECT source_row_number, "
    + ", ".join(
        f"length(ltrim({trimmed(c)}, '+-')) AS {c}" for c in S.SOURCE_COLUMNS["student_assessment"]
    )
    + " FROM faulted_student_assessment",
)
_DATES = ["date_registration", "date_unregistration"]
register(
    "p05_guarded_parse",
    lambda w: w.faulted("student_registration").select(
        ROW, *[X.parse_integer(X.blank_to_null(F.col(c))).cast("string").alias(c) for c in _DATES]
    ),
    "SELECT source_row_number, "
    + ", ".join(f"CAST({whole_number('t_' + c, 10)} AS VARCHAR) AS {c}" for c in _DATES)
    + " FROM text_faulted_student_registration",
)
register(
    "p06_narrow_numbers",
    lambda w: V.check_rows(w.faulted("student_vle"), "student_vle").select(
        ROW, *[F.col(f"v_{c}").alias(c) for c in _CLICK_NUMBERS]
    ),
    "SELECT source_row_number, "
    + ", ".join(
        f"{typed_integer(c, 'bigint' if c.startswith('id') else 'int')} AS {c}" for c in _CLICK_NUMBERS
    )
    + " FROM text_faulted_student_vle",
)


def _ranges(w: Workspace) -> DataFrame:
    credits = X.parse_integer(X.blank_to_null(F.col("studied_credits")))
    attempts = X.parse_integer(X.blank_to_null(F.col("num_of_prev_attempts")))
    return w.faulted("student_info").select(
        ROW,
        X.within_width(credits, "int").alias("credits_fit"),
        X.within_width(credits, "smallint").alias("credits_fit_16"),
        (credits <= 0).alias("credits_not_positive"),
        (attempts < 0).alias("attempts_negative"),
        credits.between(0, 100).alias("credits_0_100"),
    )


_CREDITS, _ATTEMPTS = whole_number("t_studied_credits", 10), whole_number("t_num_of_prev_attempts", 10)
register(
    "p07_range_tests",
    _ranges,
    f"""SELECT source_row_number, ({_CREDITS}) BETWEEN -2147483648 AND 2147483647 AS credits_fit,
        ({_CREDITS}) BETWEEN -32768 AND 32767 AS credits_fit_16, ({_CREDITS}) <= 0 AS credits_not_positive,
        ({_ATTEMPTS}) < 0 AS attempts_negative, ({_CREDITS}) BETWEEN 0 AND 100 AS credits_0_100
        FROM text_faulted_student_info""",
)
_DOMAINS = {
    "gender": S.GENDERS, "region": S.REGIONS, "highest_education": S.EDUCATIONS, "age_band": S.AGE_BANDS,
    "disability": S.DISABILITIES, "final_result": S.RESULTS,
}
register(
    "p08_allowed_values",
    lambda w: w.faulted("student_info").select(
        ROW, *[X.blank_to_null(F.col(c)).isin(v).alias(c) for c, v in _DOMAINS.items()]
    ),
    "SELECT source_row_number, "
    + ", ".join(f"t_{c} IN ({sql_list(v)}) AS {c}" for c, v in _DOMAINS.items())
    + " FROM text_faulted_student_info",
)
register(
    "p08_allowed_activity_types",
    lambda w: w.faulted("vle").select(
        ROW, X.blank_to_null(F.col("activity_type")).isin(S.ACTIVITY_TYPES).alias("known")
    ),
    f"SELECT source_row_number, t_activity_type IN ({sql_list(S.ACTIVITY_TYPES)}) AS known FROM text_faulted_vle",
)
register(
    "p09_canonical_imd_band",
    lambda w: w.faulted("student_info").select(
        ROW, X.canonical(X.blank_to_null(F.col("imd_band")), S.IMD_CANONICAL).alias("imd_band")
    ),
    "SELECT source_row_number, t_imd_band AS imd_band FROM text_faulted_student_info",
)


def _first_error_of(w: Workspace, table: str, column: str) -> DataFrame:
    found = F.filter("errors", lambda e: e["column"] == column)
    return V.check_rows(w.faulted(table), table).select(ROW, F.get(found, F.lit(0))["code"].alias("code"))


register(
    "p10_first_error_per_column",
    lambda w: _first_error_of(w, "student_assessment", "is_banked"),
    """SELECT source_row_number, split_part(list_filter(errors, lambda e: e LIKE 'is_banked:%')[1], ':', 2) AS code
       FROM checked_faulted_student_assessment""",
)
register(
    "p11_error_objects",
    lambda w: V.check_rows(w.faulted("student_info"), "student_info")
    .select(ROW, F.explode("errors").alias("e"))
    .select(ROW, F.col("e.column").alias("column_name"), F.col("e.code").alias("code")),
    """SELECT source_row_number, split_part(e, ':', 1) AS column_name, split_part(e, ':', 2) AS code
       FROM (SELECT source_row_number, unnest(errors) AS e FROM checked_faulted_student_info)""",
)
register(
    "p12_collected_errors",
    lambda w: V.error_codes(V.check_rows(w.faulted("student_vle"), "student_vle")),
    """SELECT source_row_number, array_to_string(errors, ';') AS errors FROM checked_faulted_student_vle
       WHERE len(errors) > 0""",
)
register(
    "p13_error_counts",
    lambda w: w.validated_with_faults("student_vle").select(
        ROW, F.size("errors").cast("bigint").alias("error_count")
    ),
    "SELECT source_row_number, len(errors) AS error_count FROM validated_faulted_student_vle",
)


def _duplicates(w: Workspace, table: str) -> DataFrame:
    code = F.get("errors", F.lit(0))["code"]
    exact, conflicting = "EXACT_DUPLICATE", "CONFLICTING_DUPLICATE"
    return (
        w.validated_with_faults(table)
        .filter(code.isin(exact, conflicting))
        .select(ROW, (code == exact).alias("same_signature"))
    )


for _name, _t in (
    ("p14_row_signature", "student_info"),
    ("w01_rows_after_first", "student_vle"),
    ("w02_first_value", "courses"),
    ("w02_first_signature", "student_assessment"),
):
    register(
        _name,
        lambda w, t=_t: _duplicates(w, t),
        f"SELECT source_row_number, same_signature FROM ranked_faulted_{_t} WHERE valid_rank > 1",
    )

register(
    "p23_target_code",
    lambda w: w.clean("student_info").select(
        *S.ENTITY, N.target_code(F.col("final_result")).alias("label")
    ),
    """SELECT code_module, code_presentation, id_student,
       CASE final_result WHEN 'Fail' THEN 1 WHEN 'Pass' THEN 0 WHEN 'Distinction' THEN 0 END AS label
       FROM clean_student_info""",
)
_CODED = {
    "gender": S.GENDERS, "age_band": S.AGE_BANDS, "highest_education": S.EDUCATIONS,
    "imd_band": S.IMD_BANDS, "disability": S.DISABILITIES,
}
register(
    "p24_ordinal_codes",
    lambda w: w.clean("student_info").select(
        *S.ENTITY, *[N.ordinal_code(F.col(c), v).alias(c) for c, v in _CODED.items()]
    ),
    "SELECT code_module, code_presentation, id_student, "
    + ", ".join(
        f"CAST(nullif(list_position([{sql_list(v)}], {c}), 0) - 1 AS INTEGER) AS {c}" for c, v in _CODED.items()
    )
    + " FROM clean_student_info",
)

# ------------------------------------------------------- validation and joins

for _i, _t in enumerate(S.TABLES, start=1):
    register(
        f"v{_i:02d}_{_t}_errors",
        lambda w, t=_t: V.error_codes(w.validated_with_faults(t)),
        f"SELECT source_row_number, array_to_string(errors, ';') AS errors FROM validated_faulted_{_t} "
        "WHERE len(errors) > 0",
    )


def _code_counts(w: Workspace, table: str) -> DataFrame:
    return (
        w.validated_with_faults(table)
        .select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.column").alias("column_name"), F.col("e.code").alias("code"))
        .agg(F.count("*").alias("n"))
        .withColumn("table_name", F.lit(table))
    )


register(
    "v00_error_code_counts",
    lambda w: _union(in_parallel([partial(_code_counts, w, t) for t in S.TABLES])),
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, split_part(e, ':', 1) AS column_name, split_part(e, ':', 2) AS code,
            count(*) AS n FROM (SELECT unnest(errors) AS e FROM validated_faulted_{t}) GROUP BY ALL"""
        for t in S.TABLES
    ),
)


def _clean_of_faulted(w: Workspace, table: str) -> DataFrame:
    return V.route_clean(w.validated_with_faults(table), table)


for _t in S.TABLES:
    _valid = ", ".join(f"v_{c} AS {c}" for c in S.SOURCE_COLUMNS[_t])
    register(
        f"v08_routed_clean_{_t}",
        lambda w, t=_t: _clean_of_faulted(w, t),
        f"SELECT {_valid} FROM validated_faulted_{_t} WHERE len(errors) = 0",
    )

_RECONCILE_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM raw_{t}) AS raw_count,
        count(*) FILTER (len(errors) = 0) AS clean_count, count(*) FILTER (len(errors) > 0) AS quarantine_count,
        (SELECT count(*) FROM raw_{t}) = count(*) AS is_reconciled FROM validated_raw_{t}"""
    for t in S.TABLES
)
register(
    "v09_reconcile",
    lambda w: _union([V.reconcile(w.raw(t), w.clean(t), w.quarantine(t), t) for t in S.TABLES]),
    _RECONCILE_SQL,
)


def _single_pass_counts(w: Workspace, table: str) -> DataFrame:
    """Clean and quarantined rows from one pass over the annotated table."""
    valid = F.size("errors") == 0
    return w.validated(table).agg(
        F.lit(table).alias("table_name"),
        F.count("*").alias("raw_count"),
        F.count_if(valid).alias("clean_count"),
        F.count_if(~valid).alias("quarantine_count"),
    )


register(
    "a10_route_counts",
    lambda w: _union([_single_pass_counts(w, t) for t in S.TABLES]),
    f"SELECT * EXCLUDE (is_reconciled) FROM ({_RECONCILE_SQL})",
)


def _with_code(w: Workspace, table: str, code: str) -> DataFrame:
    has = F.exists("errors", lambda e: e["code"] == code)
    return w.validated_with_faults(table).filter(has).select(ROW)


for _name, _t, _code in (
    ("j01_missing_course_of_student", "student_info", "COURSE_NOT_FOUND"),
    ("j01_missing_course_of_assessment", "assessments", "COURSE_NOT_FOUND"),
    ("j01_missing_course_of_site", "vle", "COURSE_NOT_FOUND"),
    ("j01_missing_student_of_registration", "student_registration", "STUDENT_NOT_FOUND"),
    ("j01_missing_assessment_of_result", "student_assessment", "ASSESSMENT_NOT_FOUND"),
    ("j02_missing_student_of_result", "student_assessment", "STUDENT_NOT_FOUND_FOR_ASSESSMENT"),
):
    register(
        _name,
        lambda w, t=_t, c=_code: _with_code(w, t, c),
        f"SELECT source_row_number FROM validated_faulted_{_t} "
        f"WHERE len(list_filter(errors, lambda e: e LIKE '%:{_code}')) > 0",
    )


def _two_lookups(w: Workspace) -> DataFrame:
    def missing(code: str) -> Column:
        return F.exists("errors", lambda e: e["code"] == code)

    rows = w.validated_with_faults("student_vle").select(
        ROW, missing("STUDENT_NOT_FOUND").alias("no_student"), missing("SITE_NOT_FOUND").alias("no_site")
    )
    return rows.filter(F.col("no_student") | F.col("no_site"))


register(
    "j03_two_lookups_in_one_pass",
    _two_lookups,
    """SELECT * FROM (SELECT source_row_number,
         len(list_filter(errors, lambda e: e LIKE '%:STUDENT_NOT_FOUND')) > 0 AS no_student,
         len(list_filter(errors, lambda e: e LIKE '%:SITE_NOT_FOUND')) > 0 AS no_site
       FROM validated_faulted_student_vle) WHERE no_student OR no_site""",
)


def _errors_by_stage(w: Workspace) -> DataFrame:
    """Errors of the row, reference and duplicate stages of the click table, appended."""
    code = F.col("e.code")
    stage = (
        F.when(code.like("%NOT_FOUND%"), "reference").when(code.like("%DUPLICATE"), "duplicate").otherwise("row")
    )
    return (
        w.validated_with_faults("student_vle")
        .select(ROW, F.explode("errors").alias("e"))
        .groupBy(stage.alias("stage"))
        .agg(F.count("*").alias("errors"), F.countDistinct(ROW).alias("rows"))
    )


register(
    "o05_errors_by_stage",
    _errors_by_stage,
    """SELECT CASE WHEN e LIKE '%NOT_FOUND%' THEN 'reference' WHEN e LIKE '%DUPLICATE' THEN 'duplicate' ELSE 'row' END
         AS stage, count(*) AS errors, count(DISTINCT source_row_number) AS rows
       FROM (SELECT source_row_number, unnest(errors) AS e FROM validated_faulted_student_vle) GROUP BY 1""",
)


def _idempotent(w: Workspace, table: str) -> DataFrame:
    """Rows a second validation of the clean rows would reject: none."""
    text = w.clean(table).select(
        F.monotonically_increasing_id().alias(ROW), *[F.col(c).cast("string") for c in S.SOURCE_COLUMNS[table]]
    )
    again = V.validate(text, table, w.references(table))
    return again.filter(F.size("errors") > 0).agg(F.lit(table).alias("table_name"), F.count("*").alias("rejected"))


register(
    "v08_clean_rows_stay_clean",
    lambda w: _union([_idempotent(w, t) for t in S.TABLES]),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS rejected" for t in S.TABLES
    ),
)

