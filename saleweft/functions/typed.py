"""Attribute values that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .nulls import as_column


def typed_value(value: Column | str, kind: Column | str) -> Column:
    """Bring a text to the normal form of its kind, still as text.

    Numbers and dates that cannot be read become null; lists change their
    separator from ``~`` to ``; ``; any other kind is left as it is.
    """
    value, kind = as_column(value), as_column(kind)
    return (
        F.when(kind == "Number", value.try_cast("double").cast("string"))
        .when(kind == "Date", value.try_cast("date").cast("string"))
        .when(kind == "Array", F.replace(value, F.lit("~"), F.lit("; ")))
        .otherwise(value)
    )


def list_items(value: Column | str, separator: str = "~") -> Column:
    """The members of a text list as an array."""
    return F.split(as_column(value), separator)
