"""Week arithmetic on integer day offsets from the start of a presentation.

Weeks are numbered from 1, the mart starts at week 2, and a week ends before
day ``7 * week_no`` or at the end of the presentation, whichever is first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_WEEK = 2


def week_of(day: Column) -> Column:
    """Week number of a day; days before the start floor downwards."""
    return (F.floor(day / F.lit(7.0)) + 1).cast("int")


def week_count(length: Column) -> Column:
    return F.ceil(length / F.lit(7.0)).cast("int")


def mart_week(week: Column) -> Column:
    """Weeks before the first mart week are folded into it."""
    return F.greatest(week, F.lit(FIRST_WEEK))


def week_end(week: Column, length: Column) -> Column:
    """First day after the week, never beyond the presentation."""
    return F.least(week * 7, length)


def week_numbers(last: Column) -> Column:
    """Mart weeks up to ``last``; empty where the presentation is too short.

    ``sequence(2, 1)`` counts down, so short presentations need the guard.
    """
    empty = F.array().cast("array<int>")
    return F.when(last >= FIRST_WEEK, F.sequence(F.lit(FIRST_WEEK), last)).otherwise(empty)


def first_week_after(day: Column, length: Column) -> Column:
    """First mart week whose end lies after ``day``; NULL when none does."""
    return F.when(day < length, mart_week(week_of(day)))


def enrolled_from(registration: Column, length: Column) -> Column:
    """First mart week at whose end the student was registered; NULL when none."""
    return F.when(registration.isNull(), F.lit(FIRST_WEEK)).otherwise(
        first_week_after(registration, length)
    )


def enrolled_until(unregistration: Column, length: Column) -> Column:
    """Last mart week at whose end the student had not unregistered."""
    left_early = unregistration < length
    return F.when(left_early, F.floor(unregistration / F.lit(7.0)).cast("int")).otherwise(
        week_count(length)
    )


def enrolled_at(registration: Column, unregistration: Column, end_day: Column) -> Column:
    """Registered before ``end_day`` and not unregistered before it."""
    return (registration.isNull() | (registration < end_day)) & (
        unregistration.isNull() | (unregistration >= end_day)
    )


def effective_due_week(due: Column, assessment_type: Column, length: Column) -> Column:
    """Week of the due date; an undated exam is due in the last week."""
    return F.when(due.isNotNull(), week_of(due)).when(
        assessment_type == "Exam", week_count(length)
    )


def is_late(submitted: Column, due: Column) -> Column:
    return submitted > due
