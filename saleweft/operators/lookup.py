"""Lookups through two-column maps."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import as_column
from ..functions.rates import inverse_rate
from .columns import quoted

_KEY, _VALUE = "__lookup_key", "__lookup_value"


def _kept_or_raise(keys: list[str], kept: Column, what: str) -> Column:
    """The first row of a key, or an error when there is a second one."""
    described = F.concat(F.lit(f"{what}: key occurs more than once: "),
                         F.to_json(F.struct(*[quoted(k) for k in keys])))
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(described)).otherwise(F.first(kept))


ONCE = "__once"
"""True for a key that occurs once. A filter that reads it keeps the check in the plan, see ``held``."""


def unique_values(mapping: DataFrame, keys: list[str], values: list[str], what: str) -> DataFrame:
    """One row per key with its values; a repeated key fails the job when it runs.

    The check is part of the aggregate that prepares the map, so it costs no
    extra pass and no action while the plan is put together.
    """
    kept = F.struct(*[quoted(v) for v in values]) if values else F.lit(True)
    return mapping.groupBy(*[quoted(k) for k in keys]).agg(
        _kept_or_raise(keys, kept, what).alias("__kept"),
        _kept_or_raise(keys, F.lit(True), what).alias(ONCE))


def unique_rows(side: DataFrame, keys: list[str], what: str) -> DataFrame:
    """The rows of a side that has to be unique by key, with the flag ``ONCE``."""
    values = [c for c in side.columns if c not in keys]
    return unique_values(side, keys, values, what).select(
        *[quoted(k) for k in keys], *[F.col("__kept")[v].alias(v) for v in values], ONCE)


def held(joined: DataFrame) -> DataFrame:
    """Read the flag of a checked side after a join, so that the check runs whatever else is read.

    Spark drops a left join whose columns nothing reads, and with it a check inside them;
    a filter stays. Rows that found nothing have no flag and pass.
    """
    return joined.where(F.coalesce(F.col(ONCE), F.lit(True))).drop(ONCE)


def unique_join(df: DataFrame, side: DataFrame, on: list[str], what: str) -> DataFrame:
    """Left join to a side by columns both have; a key that repeats in the side fails the job."""
    return held(df.join(unique_rows(side, on, what), on, "left"))


def spread_join(
    df: DataFrame,
    side: DataFrame,
    pairs: Mapping[str, Column],
    how: str = "left",
    extra: Column | None = None,
    blank: bool = False,
) -> DataFrame:
    """Join a side prepared by key (column of ``side``: key of ``df``) without a hot task.

    Rows whose key is null, and with ``blank`` also empty, match nothing; they get a
    number from their first eight columns as a second key and so are dealt out evenly; more
    columns would be carried along for it alone. The second key is 0 for all others and for the side. As the side was aggregated by the
    first key alone, both inputs are shuffled for the join itself, which lets adaptive
    execution split the partitions of a hot key. A side measured as small is broadcast.
    """
    missing = [key.isNull() | (key.cast("string") == "") if blank else key.isNull() for key in pairs.values()]
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)][:8]
    number = F.lit(1) + F.pmod(F.xxhash64(*[quoted(c) for c in plain]), F.lit(1_000_000))
    spread = F.when(reduce(or_, missing), number).otherwise(F.lit(0).cast("long"))
    # always 0, but not a constant, which would be folded out of the keys
    zero = F.pmod(F.xxhash64(*[quoted(c) for c in pairs]), F.lit(1).cast("long"))
    match = F.col("__spread") == F.col("__zero")
    for name, key in pairs.items():
        match = match & (key == quoted(name))
    if extra is not None:
        match = match & extra
    return df.withColumn("__spread", spread).join(
        side.withColumn("__zero", zero), match, how).drop("__spread", "__zero")


def checked_lookup(
    df: DataFrame,
    mapping: DataFrame,
    source: Column | str,
    dest: str,
    default: Column | None = None,
    name: str = "lookup",
) -> DataFrame:
    """Add ``dest`` from a map whose first column is the key, second the value.

    * the default is for absent keys only: a null found in the map stays null;
    * a null source key never matches, so it takes the default;
    * a key that repeats in the map fails the job.

    A small map is broadcast by its measured size; with a large one null keys are
    spread and hot keys split, see `spread_join`. The check runs whether or not the
    looked-up column is read, see `held`.
    """
    key, value = mapping.columns
    hits = mapping.groupBy(quoted(key).alias(_KEY)).agg(
        _kept_or_raise([key], quoted(value), name).alias(_VALUE),
        _kept_or_raise([key], F.lit(True), name).alias(ONCE))
    found = F.col(_VALUE)
    if default is not None:
        found = F.when(F.col(ONCE).isNull(), default).otherwise(found)
    return held(spread_join(df, hits, {_KEY: as_column(source)}).withColumn(dest, found)).drop(_KEY, _VALUE)


def constant_lookup(mapping: DataFrame, key_value: Column, default: Column | None = None) -> Column:
    """Look up one fixed key, such as the run date: a scalar subquery, no join.

    A repeated key fails the job, as a scalar cannot have two rows.
    """
    key, value = mapping.columns
    hit = mapping.where(quoted(key) == key_value).select(F.struct(quoted(value).alias("v"))).scalar()
    found = hit["v"]
    return found if default is None else F.when(hit.isNull(), default).otherwise(found)


def literal_lookup(
    source: Column | str, pairs: Mapping[str, object], default: Column | None = None
) -> Column:
    """The same for a short fixed table: a map literal, no join at all."""
    table = F.expr("map(" + ", ".join(_sql_literal(x) for p in pairs.items() for x in p) + ")")
    found = F.element_at(table, as_column(source))
    return found if default is None else F.coalesce(found, default)


def _sql_literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def two_step_lookup(
    df: DataFrame,
    first: DataFrame,
    second: DataFrame,
    source: Column | str,
    dest: str,
    default: Column | None = None,
    name: str = "lookup",
) -> DataFrame:
    """The value of one map is the key of the next."""
    return (
        df.transform(checked_lookup, first, source, "__step", default, f"{name}, first step")
        .transform(checked_lookup, second, "__step", dest, default, f"{name}, second step")
        .drop("__step")
    )


def inverse_rates(rates: DataFrame) -> DataFrame:
    """A rate map turned around, for going back from euro to local currency."""
    key, value = rates.columns
    return rates.select(quoted(key), inverse_rate(quoted(value)).alias(value))
