"""Codes of targets and categories, and safe ratios."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.schemas import TARGET_CODES, THRESHOLD


def lookup(value: Column, codes: dict[str, int]) -> Column:
    """Code of a value by a literal map; NULL for other values."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in codes.items())
    return F.try_element_at(F.create_map(*pairs), value)


def target_code(result: Column) -> Column:
    return lookup(result, TARGET_CODES)


def ordinal_code(value: Column, ordered: list[str]) -> Column:
    return lookup(value, {v: i for i, v in enumerate(ordered)})


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def risk_label(probability: Column, threshold: float = THRESHOLD) -> Column:
    return F.when(probability >= threshold, "Fail").otherwise("Not Fail")
