"""Null, zero and blank handling."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(0.0))


def coalesce_zero(first: Column | str, second: Column | str) -> Column:
    """First of the two that is neither null nor zero, else zero."""
    first, second = as_column(first), as_column(second)
    return F.coalesce(F.nullif(first, F.lit(0)), F.nullif(second, F.lit(0)), F.lit(0.0))


def is_blank(value: Column | str) -> Column:
    """True for null, empty and spaces; never null."""
    return F.trim(F.coalesce(as_column(value), F.lit(""))) == ""


def non_blank(value: Column | str) -> Column:
    return ~is_blank(value)


def blank_to_null(value: Column | str) -> Column:
    value = as_column(value)
    return F.when(non_blank(value), value)


def coalesce_blank(first: Column | str, second: Column | str) -> Column:
    """The first value, or the second where the first is null or blank."""
    return F.when(is_blank(first), as_column(second)).otherwise(as_column(first))


def sum_null_safe(*parts: Column | str) -> Column:
    """Sum with nulls as zero."""
    return reduce(add, [zero_if_null(p) for p in parts])
