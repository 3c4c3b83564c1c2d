"""Contract-checked CSV sources read as text."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.schemas import ROW_NUMBER, SOURCE_COLUMNS, SOURCE_FILES, TABLES, raw_schema
from sparkmart.sources.csv_records import records_of_blocks
from sparkmart.sources.numbering import LOOKED_UP, look_up

#: Characters of a first line that are compared with the header; different header lines that are looked at.
HEADER_LENGTH, HEADERS = 4096, 1000
#: Files with records over block ends that a filter names; with more of them, all files are read for pieces.
CROSSED = 1000


class SourceContractError(ValueError):
    """The source folder or a file header differs from the contract."""


def source_file_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the CSV files in a folder; empty files count, content is not read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return {name for f in files if (name := f.getPath().getName()).endswith(".csv")}


def source_set_problems(found: set[str]) -> list[str]:
    """Declared files that are missing and files that are not declared."""
    declared = set(SOURCE_FILES.values())
    missing = [f"missing: {name}" for name in sorted(declared - found)]
    return missing + [f"unexpected: {name}" for name in sorted(found - declared)]


def header_problem(spark: SparkSession, folder: str, table: str) -> str | None:
    """Why the header of a file breaks the contract, or None."""
    file_name = SOURCE_FILES[table]
    first = spark.read.text(f"{folder}/{file_name}").limit(1).collect()
    if not first:
        return f"{file_name} is empty"
    return _header_line_problem(first[0].value, table)


def check_sources(spark: SparkSession, folder: str) -> None:
    """Raise unless the folder holds exactly the declared files and headers."""
    problems = source_set_problems(source_file_names(spark, folder))
    if problems:
        raise SourceContractError("; ".join(problems))
    problems = [p for t in TABLES if (p := header_problem(spark, folder, t))]
    if problems:
        raise SourceContractError("; ".join(problems))


def read_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Every column as text, empty (quoted or not) as NULL, with its row number.

    The header is row 1, so the first record is row 2. Values in quotes may hold
    line breaks, which stay as they are. The file stays splittable: its lines
    are read block by block, and one row per block tells how many records come
    before it and whether it begins inside quotes. A source may also be a folder
    of part files, each with a header, numbered in the order of their part
    numbers. Blank records, quotes that are never closed and headers other than
    the declared one raise `SourceContractError` at once; a line outside the
    counted blocks or a record with too few or too many values raises when it is
    read. Lines end with LF or CRLF.
    """
    path = f"{folder}/{SOURCE_FILES[table]}"
    blocks = _blocks(spark, path).persist()
    try:
        _check_headers(blocks, table)
        if not blocks.filter("odd_lines > 0").isEmpty():
            return _parsed(_long_records(spark, path, blocks, table), table)
        if blocks.filter("blank > 0").head(1):
            raise SourceContractError(f"blank records in {SOURCE_FILES[table]}")
        offsets = _offsets(blocks.withColumn("records", F.col("lines")))
        lines = look_up(_lines(spark, path), offsets, ["file", "block"])
        place = F.col("id") - F.col("first_id")
        records = lines.select(
            (F.col("opens") & (place == 0)).alias("header"),
            (F.col("offset") + place).alias("number"),
            _without_cr(F.col("value")).alias("record"),
        )
        return _parsed(records, table)
    finally:
        blocks.unpersist()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, block and order; CR stays, as it may belong to a quoted value."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )


def _without_cr(line: Column) -> Column:
    return F.when(F.endswith(line, F.lit("\r")), F.substring(line, 1, F.length(line) - 1)).otherwise(line)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per block: its lines, blank and odd ones (by their number of quotes), quotes, and first line."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return (
        _lines(spark, path)
        .groupBy("file", "block")
        .agg(
            F.count("*").alias("lines"),
            F.count_if(F.col("value").isin("", "\r")).alias("blank"),
            F.count_if(quotes % 2 == 1).alias("odd_lines"),
            F.min("id").alias("first_id"),
            F.min_by(F.left("value", F.lit(HEADER_LENGTH)), "id").alias("first_line"),
        )
    )


def _check_headers(blocks: DataFrame, table: str) -> None:
    first = blocks.groupBy("file").agg(F.min_by("first_line", "block").alias("line"))
    for row in first.select("line").distinct().limit(HEADERS).collect():
        if problem := _header_line_problem(row.line, table):
            raise SourceContractError(problem)


def _header_line_problem(line: str, table: str) -> str | None:
    header = next(csv.reader([line.removeprefix("﻿").removesuffix("\r")]), [])
    if header != SOURCE_COLUMNS[table]:
        return f"{SOURCE_FILES[table]} has columns {header}, expected {SOURCE_COLUMNS[table]}"
    return None


def _in_order() -> list[Column]:
    # part-100000 comes after part-99999
    part = F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).try_cast("bigint")
    return [part, F.col("file")]


def _offsets(blocks: DataFrame) -> DataFrame:
    """`offset`: the row number of the first record that begins in a block; `opens`: it is the header of its file."""
    files = Window.orderBy(*_in_order(), "block")
    opens = F.row_number().over(Window.partitionBy("file").orderBy("block")) == 1
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    marked = blocks.withColumn("opens", opens)
    # headers have no number of their own: each file's takes that of the record before it
    before = F.coalesce(F.sum("records").over(earlier), F.lit(0))
    headers = F.coalesce(F.sum(F.col("opens").cast("int")).over(earlier), F.lit(0))
    offset = before - headers + F.when(F.col("opens"), 1).otherwise(2)
    columns = [c for c in blocks.columns if c in ("first_id", "inside")]
    return marked.select("file", "block", "opens", offset.alias("offset"), *columns)


def _parsed(records: DataFrame, table: str) -> DataFrame:
    """The values of `record` under the declared names; headers are left out."""
    schema = raw_schema(table)
    options = {"escape": '"', "nullValue": "", "mode": "FAILFAST", "multiLine": "true"}
    values = F.from_csv("record", ", ".join(f"`{f.name}` string" for f in schema.fields), options)
    number = F.when(F.col("number").isNotNull(), F.col("number")).otherwise(
        F.raise_error(F.lit("line outside the counted file blocks")).cast("bigint")
    )
    found = records.filter(F.col("header").isNull() | ~F.col("header"))
    return found.select(number.cast("bigint").alias(ROW_NUMBER), values.alias("v")).select(ROW_NUMBER, "v.*")


def _long_records(spark: SparkSession, path: str, blocks: DataFrame, table: str) -> DataFrame:
    """`header`, `number` and `record` of a source in which records reach over lines.

    The quotes of all earlier blocks of a file tell whether a block begins
    inside quotes. Each block then counts the records that begin in it; the
    counts give the offsets by which its records are numbered. Records inside a
    block are put together where they are read. Only pieces of records that
    reach over the end of a block move.
    """
    file_name = SOURCE_FILES[table]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd_lines").over(earlier), F.lit(0)) % 2
    begun = blocks.withColumn("inside", inside.cast("int"))
    if not begun.groupBy("file").agg(F.sum("odd_lines").alias("odd")).filter("odd % 2 = 1").isEmpty():
        raise SourceContractError(f"{file_name} ends inside quotes")
    lines, order = _lines(spark, path), ["id"]
    keys = ["file", "block"]
    looked_up = look_up(lines, begun.select(*keys, "inside"), keys, order)
    counts = looked_up.select(*keys, "inside", "value").mapInArrow(
        records_of_blocks("counts"), "file string, block long, records long, blank long"
    )
    counted = counts.groupBy(*keys).agg(F.sum("records").alias("records"), F.sum("blank").alias("blank"))
    counted = counted.persist()
    try:
        if counted.filter("blank > 0").head(1):
            raise SourceContractError(f"blank records in {file_name}")
        offsets = _offsets(counted.join(begun.select(*keys, "inside"), keys))
        columns = [*keys, "inside", "opens", "offset", "value"]
        looked_up = look_up(lines, offsets, keys, order).select(*columns)
        kind = "file string, block long, header boolean, number long, record string"
        whole = looked_up.mapInArrow(records_of_blocks("whole"), kind).select("header", "number", "record")
        crossed = [r.file for r in begun.filter("inside = 1").select("file").distinct().limit(LOOKED_UP + 1).collect()]
    finally:
        counted.unpersist()
    if not crossed:
        return whole
    again = looked_up if len(crossed) > CROSSED else looked_up.filter(F.col("file").isin(crossed))
    pieces = again.mapInArrow(records_of_blocks("pieces"), kind)
    glued = pieces.groupBy("file", "number").agg(
        F.bool_or("header").alias("header"),
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("pieces"),
    )
    return whole.unionByName(glued.select("header", "number", F.array_join("pieces.record", "\n").alias("record")))


def read_all_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Check the contract, then read every declared file; a blank record breaks it."""
    check_sources(spark, folder)
    return {table: read_source(spark, folder, table) for table in TABLES}


def write_source(raw: DataFrame, folder: str, table: str) -> None:
    """Write a raw table as a source in row order, as a folder of part files."""
    (
        raw.orderBy(ROW_NUMBER)
        .select(*SOURCE_COLUMNS[table])
        .write.options(header=True, escape='"', emptyValue="")
        .csv(f"{folder}/{SOURCE_FILES[table]}")
    )
