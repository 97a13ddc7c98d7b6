"""Dates, periods and labels. Every function takes the day it counts from."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import SERIAL_DAY_ZERO
from .nulls import as_column


def day(value: Column | str) -> Column:
    """A date from a date literal text, or the column itself."""
    if isinstance(value, str):
        return F.lit(value).cast("date")
    return value.cast("date")


def serial_day(value: Column | str) -> Column:
    """Spreadsheet day number."""
    return F.datediff(as_column(value), day(SERIAL_DAY_ZERO))


def month_start(value: Column) -> Column:
    return F.trunc(value, "month")


def month_after(as_of: Column | str, months: int) -> Column:
    """First day of the month that lies so many months after a day."""
    return F.trunc(F.add_months(day(as_of), months), "month")


def quarter_label(value: Column | str) -> Column:
    """Year and quarter, as in 2024Q3."""
    value = as_column(value)
    return F.concat(F.year(value).cast("string"), F.lit("Q"), F.quarter(value).cast("string"))


def next_quarter_label(label: Column) -> Column:
    """The label one quarter on; 2024Q4 gives 2025Q1."""
    year = F.substring(label, 1, 4).cast("int")
    quarter = F.substring(label, 6, 1).cast("int")
    last = quarter == 4
    return F.concat(
        F.when(last, year + 1).otherwise(year).cast("string"),
        F.lit("Q"),
        F.when(last, F.lit(1)).otherwise(quarter + 1).cast("string"),
    )


def fiscal_year(label: Column | str) -> Column:
    """2024 from a label such as FY24."""
    return F.concat(F.lit("20"), F.substring(as_column(label), 3, 2)).try_cast("int")


def parsed_date(value: Column | str, pattern: str) -> Column:
    """Date from text; null when the text does not fit the pattern."""
    return F.try_to_date(as_column(value), pattern)


def day_from_parts(year: Column | str, month: Column | str, dom: Column | str) -> Column:
    return F.try_to_date(
        F.concat_ws("-", *[as_column(p).cast("string") for p in (year, month, dom)]),
        "yyyy-M-d",
    )
