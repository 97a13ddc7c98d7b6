"""Grouped results, pivots and roll-ups.

All of them combine on the map side first, so a hot key reaches the shuffle as
one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import MONTHS
from ..functions.dates import month_after
from ..functions.nulls import as_column
from .columns import quoted


def sum_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*map(quoted, keys)).agg(*[F.sum(quoted(c)).alias(c) for c in columns])


def first_date(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(F.col(column).cast("date")).alias(name))


def latest_by_counter(df: DataFrame, keys: Sequence[str], counter: str) -> DataFrame:
    """The rows that carry the highest counter of their key (all of them on a tie)."""
    return df.join(df.groupBy(*keys).agg(F.max(counter).alias(counter)), [*keys, counter],
                   "leftsemi")


def global_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))


def collect_text(
    df: DataFrame, keys: Sequence[str], value: Column | str, separator: str, name: str
) -> DataFrame:
    """The distinct values of a key as one sorted text; empty when all are null."""
    members = F.array_sort(F.collect_set(as_column(value).cast("string")))
    return df.groupBy(*keys).agg(F.array_join(members, separator).alias(name))


@dataclass(frozen=True)
class Condition:
    """A measure that is read off the row that carries one of some codes.

    ``repeats`` allows several rows as long as they all give the same value.
    """

    name: str
    codes: Sequence[str]
    value: Column
    repeats: bool = False


def condition_pivot(
    df: DataFrame, keys: Sequence[str], code: str, conditions: Sequence[Condition]
) -> DataFrame:
    """One row per key with one column per condition, in a single pass.

    Keys without any of the codes stay, with nulls. A second row for a condition
    fails the job, as a join to that condition would repeat the key.
    """
    columns = []
    for c in conditions:
        hit = F.col(code).isin(list(c.codes))
        value = F.when(hit, c.value)
        clash = F.min(value) != F.max(value) if c.repeats else F.count(F.when(hit, 1)) > 1
        twice = F.concat_ws(" ", F.lit(f"condition {c.name} occurs more than once:"),
                            *[F.col(k) for k in keys])
        columns.append(F.when(clash, F.raise_error(twice)).otherwise(F.max(value)).alias(c.name))
    return df.groupBy(*keys).agg(*columns)


def _pivot(df, keys, label, value, labels, function):
    """Wide by listed labels in one grouped pass.

    Spark's own pivot first groups by key and label: a second shuffle, whose groups are as many as the
    rows where labels do not repeat under a key.
    """
    labels = list(labels)
    if not labels:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[
        function(F.when(as_column(label) == F.lit(name), as_column(value))).alias(str(name)) for name in labels])


def pivot_max(
    df: DataFrame, keys: Sequence[str], label: str, value: str, labels: Sequence[str]
) -> DataFrame:
    """Wide by label with the highest value; the labels are listed, not searched for."""
    return _pivot(df, keys, label, value, labels, F.max)


def pivot_sum(
    df: DataFrame, keys: Sequence[str], label: str, value: str, labels: Sequence[str]
) -> DataFrame:
    return _pivot(df, keys, label, value, labels, F.sum)


def eav_pivot(
    df: DataFrame, keys: Sequence[str], key: str, value: str, labels: Sequence[str]
) -> DataFrame:
    """Attribute rows to one wide row per entity, lowest value on a repeat."""
    return _pivot(df, keys, key, value, labels, F.min)


def characteristic_pivot(
    values: DataFrame, definitions: DataFrame, names: Mapping[str, str]
) -> DataFrame:
    """Chosen characteristics of a product as columns.

    ``values`` has product_code, characteristic_id, characteristic_value;
    ``definitions`` has characteristic_id, characteristic.
    """
    chosen = definitions.where(F.col("characteristic").isin(list(names)))
    rows = values.join(chosen, ["characteristic_id"], "inner")
    aggregates = [F.min(F.when(F.col("characteristic") == code, F.col("characteristic_value")))
                  .alias(name) for code, name in names.items()]
    return rows.groupBy("product_code").agg(*aggregates)


def unpivot_months(
    df: DataFrame, keys: Sequence[str], value: str, months: Sequence[str] = MONTHS
) -> DataFrame:
    """Twelve month columns to rows of (month 1-12, value)."""
    cells = F.array(*[F.struct(F.lit(i + 1).alias("month"), quoted(m).cast("double").alias(value))
                      for i, m in enumerate(months)])
    return df.select(*map(quoted, keys), F.inline(cells))


def month_offset_sums(
    df: DataFrame, keys: Sequence[str], month: str, columns: Sequence[str], as_of: str, count: int
) -> DataFrame:
    """Sums for the month of a day and the months after it, as ``column_<offset>``."""
    starts = [month_after(as_of, i) for i in range(count)]
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(month) == start, F.col(c))).alias(f"{c}_{i}")
        for c in columns for i, start in enumerate(starts)
    ])


def rollup_report(
    df: DataFrame, keys: Mapping[str, Column], sums: Sequence[str]
) -> DataFrame:
    """A report by named key expressions with the sum of every measure.

    The keys are grouped as one value: with dozens of key columns the code that Spark makes for the
    grouping gets too long to be compiled.
    """
    totals = [F.sum(quoted(s)).alias(s) for s in sums]
    if not keys:
        return df.groupBy().agg(*totals)
    grouped = df.groupBy(F.struct(*[k.alias(n) for n, k in keys.items()]).alias("__keys")).agg(*totals)
    return grouped.select(*[F.col("__keys").getField(n).alias(n) for n in keys], *map(quoted, sums))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def version_dates(df: DataFrame, key: str, date: str, modified: str) -> DataFrame:
    """How many extraction dates a key has, and which, as sorted JSON."""
    pairs = F.array_sort(F.collect_set(F.struct(date, modified)))
    return df.groupBy(key).agg(
        F.count_distinct(F.col(date)).alias("cnt"), F.to_json(pairs).alias("dates"))


def multi_class(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Keys with more than one distinct member, with the members sorted."""
    members = F.array_sort(F.collect_set(column)).alias(column)
    return df.groupBy(*keys).agg(members).where(F.size(column) > 1)


def prefer_definitive(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """For each name: the definitive figure, else the indicative one."""
    return df.withColumns({
        n: F.coalesce(F.col(f"{n}_definitive"), F.col(f"{n}_indicative")) for n in names})


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)
