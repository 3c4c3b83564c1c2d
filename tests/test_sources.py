import csv
import random

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.sources import csv_source as C
from sparkmart.sources import numbering as N
from sparkmart.sources.numbering import number_rows


@pytest.fixture
def folder(tmp_path):
    for table in S.TABLES:
        (tmp_path / S.SOURCE_FILES[table]).write_text(",".join(S.SOURCE_COLUMNS[table]) + "\n")
    return tmp_path


def test_the_declared_set_passes(spark, folder):
    C.check_sources(spark, str(folder))


def test_unexpected_and_missing_files_are_both_reported(spark, tmp_path):
    for table in S.TABLES[1:]:
        (tmp_path / S.SOURCE_FILES[table]).write_text(",".join(S.SOURCE_COLUMNS[table]) + "\n")
    (tmp_path / "other.csv").write_text("a\n1\n")
    with pytest.raises(C.SourceContractError, match="missing: courses.csv; unexpected: other.csv"):
        C.check_sources(spark, str(tmp_path))


def test_header_order_counts_and_a_mark_is_tolerated(spark, folder):
    courses = folder / "courses.csv"
    courses.write_text("﻿" + ",".join(S.SOURCE_COLUMNS["courses"]) + "\nAAA,2013B,240\n", encoding="utf-8")
    C.check_sources(spark, str(folder))
    assert [tuple(r) for r in C.read_source(spark, str(folder), "courses").collect()] == [(2, "AAA", "2013B", "240")]
    courses.write_text("code_presentation,code_module,module_presentation_length\n")
    with pytest.raises(C.SourceContractError, match="courses.csv has columns"):
        C.check_sources(spark, str(folder))
    courses.write_text("")
    with pytest.raises(C.SourceContractError, match="courses.csv is empty"):
        C.check_sources(spark, str(folder))


def test_empty_values_are_null_and_quotes_are_unfolded(spark, folder):
    (folder / "courses.csv").write_text(
        "code_module,code_presentation,module_presentation_length\n" 'AAA,"",\n"B,""B", 2013B ,7\n'
    )
    rows = C.read_source(spark, str(folder), "courses").orderBy(S.ROW_NUMBER).collect()
    assert [tuple(r) for r in rows] == [(2, "AAA", None, None), (3, 'B,"B', " 2013B ", "7")]


def test_short_and_blank_records_fail(spark, folder):
    courses = folder / "courses.csv"
    header = "code_module,code_presentation,module_presentation_length\n"
    for text in ("AAA,2013B,1\n\nBBB,2013B,2\n", "AAA,2013B,1\r\n\r\n", 'AAA,"20\n13B",1\n\n', '"A\n\nA",2013B,1\n\n'):
        courses.write_text(header + text, newline="")
        with pytest.raises(C.SourceContractError, match="blank records in courses.csv"):
            C.read_all_sources(spark, str(folder))
    for text in ("AAA,2013B\n", "AAA,2013B,1,2\n", '"A\nA",2013B\n'):
        courses.write_text(header + text)
        with pytest.raises(Exception, match="(?i)malformed"):
            C.read_source(spark, str(folder), "courses").collect()


def test_line_breaks_in_quotes_belong_to_values(spark, folder):
    (folder / "courses.csv").write_text(
        "code_module,code_presentation,module_presentation_length\r\n"
        '"A\r\nA\n\n",2013B,1\r\n' 'B,"x ""y""\n""",2\r\n' '"","\n",3\r\n' "C,2013B,\r\n" '"D\rD","2013B","4"\r\n',
        newline="",
    )
    rows = C.read_source(spark, str(folder), "courses").orderBy(S.ROW_NUMBER).collect()
    assert [tuple(r) for r in rows] == [
        (2, "A\r\nA\n\n", "2013B", "1"), (3, "B", 'x "y"\n"', "2"), (4, None, "\n", "3"),
        (5, "C", "2013B", None), (6, "D\rD", "2013B", "4"),
    ]


def test_quotes_that_are_never_closed_fail(spark, folder):
    (folder / "courses.csv").write_text('code_module,code_presentation,module_presentation_length\nA,"2013B,1\nB,2013B,2\n')
    with pytest.raises(C.SourceContractError, match="courses.csv ends inside quotes"):
        C.read_source(spark, str(folder), "courses")


@pytest.mark.parametrize("lookup", [1 << 18, 3])
def test_long_records_over_many_blocks(spark, folder, monkeypatch, lookup):
    """Records that end in another block, that fill whole blocks, and part files, read as the csv module reads them."""
    rng = random.Random(8)
    parts = folder / "vle.csv"
    parts.unlink()
    parts.mkdir()
    want, columns = [], S.SOURCE_COLUMNS["vle"]
    for part in (7, 10):
        rows = []
        for i in range(700):
            size = 30_000 if i == 300 else rng.choice([0, 1, 5, 400])
            text = "".join(rng.choice(['"', "\n", "\r\n", ",", "a", "é", " "]) for _ in range(size))
            rows.append([f"{part}-{i}", text, *["v"] * (len(columns) - 2)])
        with (parts / f"part-{part}.csv").open("w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\r\n" if part == 7 else "\n")
            writer.writerows([columns, *rows])
        want += rows
    monkeypatch.setattr(N, "LOOKED_UP", lookup)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = C.read_source(spark, str(folder), "vle").orderBy(S.ROW_NUMBER).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[0] for r in got] == list(range(2, 1402))
    assert [[v or "" for v in tuple(r)[1:]] for r in got] == want


def test_every_part_file_has_the_header(spark, folder):
    (folder / "courses.csv").unlink()
    (folder / "courses.csv").mkdir()
    header = ",".join(S.SOURCE_COLUMNS["courses"])
    (folder / "courses.csv" / "part-1.csv").write_text(header + "\nAAA,2013B,1\n")
    (folder / "courses.csv" / "part-2.csv").write_text("AAA,2013B,1\n")
    with pytest.raises(C.SourceContractError, match="courses.csv has columns"):
        C.read_source(spark, str(folder), "courses")


def test_rows_keep_their_places_without_a_shuffle(spark, folder):
    """Neither the scan of a source nor dense numbering moves rows."""
    (folder / "courses.csv").write_text(",".join(S.SOURCE_COLUMNS["courses"]) + "\nAAA,2013B,1\n")
    for df in (C.read_source(spark, str(folder), "courses"), number_rows(spark.range(50).toDF("a"), ["a"])):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.split("\n") if "Exchange" in line and "BroadcastExchange" not in line]
        assert not moved


def test_row_numbers_follow_the_file_across_splits(spark, folder):
    lines = [f"AAA,2013B,{i},{i * 7},3,{'9' * (i % 40)}" for i in range(2, 20002)]
    header = ",".join(S.SOURCE_COLUMNS["student_vle"])
    (folder / "studentVle.csv").write_text("\n".join([header, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        df = C.read_source(spark, str(folder), "student_vle")
        wrong = df.filter(F.col(S.ROW_NUMBER) != F.col("id_student").cast("bigint"))
        assert df.count() == 20000 and wrong.isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_numbering_is_dense_with_one_frequent_leading_value(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")
    )
    numbered = number_rows(df, ["a", "b"], first=2, name="n")
    from pyspark.sql import Window

    wrong = numbered.withColumn("e", F.row_number().over(Window.orderBy("a", "b")) + 1).filter("n <> e")
    assert numbered.count() == 9000 and wrong.isEmpty()


def test_part_files_are_numbered_by_their_part_number(spark, tmp_path):
    parts = tmp_path / "courses.csv"
    parts.mkdir()
    for i in (99999, 100000):
        (parts / f"part-{i}.csv").write_text(",".join(S.SOURCE_COLUMNS["courses"]) + f"\nAAA,2013B,{i}\n")
    rows = C.read_source(spark, str(tmp_path), "courses").orderBy(S.ROW_NUMBER).collect()
    assert [(r[0], r[3]) for r in rows] == [(2, "99999"), (3, "100000")]
