"""Row filters and gates, each one predicate that can reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.nulls import as_column, non_blank


def filter_language(df: DataFrame, column: str, language: str = "EN") -> DataFrame:
    return df.where(F.col(column) == language)


def keep_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop the listed values. A null is dropped too, as in any ``NOT IN``."""
    return df.where(~F.col(column).isin(list(values)))


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(reduce(and_, [non_blank(c) for c in columns]))


def division_gate(
    df: DataFrame,
    source: str = "source",
    division: str = "division",
    erp: str = fixed.ERP,
    legacy: str = fixed.LEGACY,
    kept: str = fixed.FINISHED_GOODS,
) -> DataFrame:
    """Every legacy row, and the ERP rows of one division."""
    return df.where(
        (F.col(source) == legacy) | ((F.col(source) == erp) & (F.col(division) == kept))
    )


def any_nonzero(df: DataFrame, measures: Sequence[Column | str]) -> DataFrame:
    return df.where(reduce(or_, [as_column(m) != 0 for m in measures]))


def report_gate(
    df: DataFrame,
    network: str = "network",
    product_type: str = "product_type_code",
    networks: Sequence[int] = tuple(fixed.EXCLUDED_NETWORKS),
) -> DataFrame:
    """Without some networks, and only products whose type code is above zero."""
    return df.where(
        ~F.col(network).try_cast("int").isin(list(networks))
        & (F.coalesce(F.col(product_type).try_cast("int"), F.lit(0)) > 0)
    )


def future_months(df: DataFrame, month: str, extracted: str) -> DataFrame:
    """Forecast months after the month of extraction (``yyyyMMdd`` text)."""
    return df.where(
        F.col(month).try_cast("int") > F.substring(F.col(extracted), 5, 2).try_cast("int")
    )
