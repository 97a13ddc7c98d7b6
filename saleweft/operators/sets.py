"""Stacking frames and repeating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import next_quarter_label


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: Mapping[str, DataFrame], source: str = "source") -> DataFrame:
    """Stack the frames of several systems, each row tagged with its system."""
    return union_all([f.withColumn(source, F.lit(tag)) for tag, f in frames.items()])


def explode_segments(df: DataFrame, rules: Mapping[str, Column], name: str) -> DataFrame:
    """Repeat each row for every segment whose rule it meets, in one pass."""
    labels = F.array(*[F.when(rule, F.lit(label)) for label, rule in rules.items()])
    return df.withColumn(name, F.explode(F.array_compact(labels)))


def add_all_member(df: DataFrame, name: str, member: Column, total: str = "ALL") -> DataFrame:
    """Every row twice: under its own member and under the total."""
    return df.withColumn(name, F.explode(F.array(member, F.lit(total))))


def add_unknown_member(df: DataFrame, key: str, label: str) -> DataFrame:
    """One more row that stands for "unknown", null in all other columns."""
    unknown = df.sparkSession.createDataFrame([(label,)], f"`{key}` string")
    return df.unionByName(unknown, allowMissingColumns=True)


def carry_forward_quarter(df: DataFrame, label: str) -> DataFrame:
    """Repeat the rows of the last quarter under the label of the next one."""
    last = df.join(df.agg(F.max(label).alias(label)), [label], "leftsemi")
    return df.unionByName(last.withColumn(label, next_quarter_label(F.col(label))))
