from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmart.functions import calendar as C
from sparkmart.functions import text as X


def column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in rows.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def test_only_spaces_are_trimmed(spark):
    values = ["  a ", "   ", "", None, "\ta", "a\n"]
    assert column(spark, values, X.blank_to_null) == ["a", None, None, None, "\ta", "a\n"]


def test_number_texts(spark):
    values = ["5", "+5", "-05", "12\n", "1.5", "1.234", "", "x", None]
    assert column(spark, values, X.is_integer_text) == [
        True, True, True, False, False, False, False, False, None,
    ]
    assert column(spark, values, X.is_decimal_text) == [
        True, True, True, False, True, False, False, False, None,
    ]


def test_leading_zeros_count_towards_the_width(spark):
    values = ["00000000005", "0000000005", "+5", "2147483648", "-2147483648"]
    assert column(spark, values, X.parse_integer) == [
        None, Decimal(5), Decimal(5), Decimal(2147483648), Decimal(-2147483648),
    ]
    fits = column(spark, values, lambda v: X.within_width(X.parse_integer(v), "int"))
    assert fits == [None, True, True, False, True]


def test_nineteen_nines_parse_but_do_not_fit(spark):
    values = ["9" * 19, "9" * 20, str(2**63 - 1)]
    assert column(spark, values, lambda v: X.narrow(X.parse_integer(v, "bigint"), "bigint")) == [
        None, None, 2**63 - 1,
    ]


@pytest.mark.parametrize("length", [0, 6, 13, 14, 15, 240, 269])
def test_week_limits_match_their_definition(spark, length):
    """First and last enrolled weeks against testing every week end."""
    days = [None, *range(-10, length + 12, 3)]
    pairs = [(a, b) for a in days for b in days]
    rows = spark.createDataFrame(pairs, "reg int, unreg int").select(
        "*",
        C.enrolled_from(F.col("reg"), F.lit(length)).alias("first"),
        C.enrolled_until(F.col("unreg"), F.lit(length)).alias("last"),
    )
    weeks = [w for w in range(2, 60) if 7 * (w - 1) < length]
    for r in rows.collect():
        expected = [
            w for w in weeks
            if (r.reg is None or r.reg < min(7 * w, length))
            and (r.unreg is None or r.unreg >= min(7 * w, length))
        ]
        got = [w for w in weeks if r.first is not None and r.first <= w <= r.last]
        assert got == expected, r


def test_short_presentations_have_no_weeks(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3)], "n int")
    got = [r.w for r in df.orderBy("n").select(C.week_numbers(F.col("n")).alias("w")).collect()]
    assert got == [[], [], [2], [2, 3]]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+- .x\n", max_size=24), min_size=1, max_size=30))
def test_parsing_never_fails(spark, values):
    parsed = column(spark, values, lambda v: X.parse_integer(X.blank_to_null(v)))
    for value, number in zip(values, parsed):
        if number is not None:
            assert int(value.strip(" ")) == number
