"""Sorted and limited results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def newest_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The row that is newest by several columns; a top-1, never a full sort."""
    return df.orderBy(*[F.col(c).desc() for c in columns]).limit(1)


def by_count_desc(df: DataFrame, count: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(count).desc(), *ties)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def sample_rows(df: DataFrame, count: int, *order: str) -> DataFrame:
    """A few rows to show; with an order always the same ones."""
    return (df.orderBy(*order) if order else df).limit(count)
