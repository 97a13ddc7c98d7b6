"""Checks: some fail the job, others report rows in one uniform error table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed_values as fixed
from ..fixed_values import ENDED_STATES, NO_DATE, OLDEST_DATE
from ..functions.dates import day
from ..functions.nulls import is_blank
from ..session import settle
from .aggregate import any_of, duplicate_keys, multi_class
from .columns import quoted
from .windows import backward_steps, count_over_key, dedup_ordered

SAMPLE = 10


class DataError(RuntimeError):
    """Rows that break a rule, with a few of them as a sample."""


def _fail_on(rows: DataFrame, what: str) -> None:
    sample = rows.limit(SAMPLE).collect()
    if sample:
        raise DataError(f"{what}: " + "; ".join(str(r.asDict()) for r in sample))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return the frame, or fail with a sample of repeated keys. Runs one job."""
    _fail_on(duplicate_keys(df, keys), f"duplicate keys on {', '.join(keys)}")
    return df


def settle_unique(df: DataFrame, keys: Sequence[str], name: str = "settled") -> DataFrame:
    """Write a result to the shared folder once, and fail unless its key is unique there.

    Only the key columns are read again for the check, so a wide plan does not run twice.
    """
    return assert_unique(settle(df, name), keys)


def assert_not_null(df: DataFrame, *columns: str) -> DataFrame:
    _fail_on(df.where(any_of([quoted(c).isNull() for c in columns])), "null values")
    return df


def assert_not_blank(df: DataFrame, *columns: str) -> DataFrame:
    _fail_on(df.where(any_of([is_blank(quoted(c)) for c in columns])), "null or blank values")
    return df


def key_text(keys: Sequence[str]) -> Column:
    """The key of a row as text: ``a=1, b=2``; null when a part is null."""
    named = F.array(*[F.concat(F.lit(f"{k}="), quoted(k).cast("string")) for k in keys])
    return F.when(~F.exists(named, lambda part: part.isNull()), F.array_join(named, ", "))


def _problem(message: Column, column: str | None = None) -> Column:
    """One problem of a row; without a column it concerns the whole row."""
    name, value = (F.lit(column), quoted(column)) if column else (F.lit(None), F.lit(None))
    return F.struct(message.alias("error_message"), name.cast("string").alias("error_column"),
                    value.cast("string").alias("error_value"))


def _error_rows(df: DataFrame, problems: Column, keys: Sequence[str], file: str) -> DataFrame:
    """One row per problem; the names are those of the error table."""
    key, source = fixed.ERROR_KEY, fixed.ERROR_FILE
    return df.select(key_text(keys).alias(key), F.inline(problems), quoted(file).alias(source))


def duplicate_errors(
    df: DataFrame, keys: Sequence[str], file: str = "input_file_name"
) -> DataFrame:
    """One error per row whose key occurs more than once."""
    times = F.concat(F.lit("key stands "), F.col("__count").cast("string"), F.lit(" times"))
    repeated = count_over_key(df, keys, "__count").where("__count > 1")
    return _error_rows(repeated, F.array(_problem(times)), keys, file)


def _columns_of(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _found(checks: dict[str, tuple[Column, str]]) -> Column:
    """The problems of one row from (condition, message) per column."""
    return F.array_compact(F.array(*[
        F.when(condition, _problem(F.lit(message), c)) for c, (condition, message) in checks.items()]))


def old_date_check(
    df: DataFrame, keys: Sequence[str], file: str = "input_file_name",
    limit: str = OLDEST_DATE, replacement: str = NO_DATE,
) -> tuple[DataFrame, DataFrame | None]:
    """Dates before a limit: the frame with them replaced, and the errors.

    All date and time columns are checked in one pass over the rows that have at
    least one old value. No such columns, no error frame.
    """
    names = _columns_of(df, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not names:
        return df, None
    old = {c: quoted(c) < day(limit) for c in names}
    message = f"before {limit}, replaced by {replacement}"
    found = _found({c: (bad, message) for c, bad in old.items()})
    errors = _error_rows(df.where(any_of(list(old.values()))), found, keys, file)
    replaced = df.withColumns({
        c: F.when(bad, day(replacement).cast(df.schema[c].dataType)).otherwise(quoted(c))
        for c, bad in old.items()
    })
    return replaced, errors


def null_text_check(
    df: DataFrame, keys: Sequence[str], file: str = "input_file_name"
) -> DataFrame | None:
    """Texts that read "null" in any case are reported; the rows keep them."""
    names = _columns_of(df, T.StringType)
    if not names:
        return None
    bad = {c: F.lower(quoted(c)) == "null" for c in names}
    found = _found({c: (hit, "reads null as a word") for c, hit in bad.items()})
    return _error_rows(df.where(any_of(list(bad.values()))), found, keys, file)


def error_table(
    errors: Sequence[DataFrame | None], table: str, run_time: str, run_id: str
) -> DataFrame | None:
    """All error frames of a run as one table."""
    found = [e for e in errors if e is not None]
    if not found:
        return None
    return reduce(DataFrame.unionByName, found).withColumns({
        "output_table_name": F.lit(table),
        "ingestion_timestamp": F.lit(run_time).cast("timestamp"),
        "ingestion_id": F.lit(run_id),
    })


def referential_gaps(
    left: DataFrame, right: DataFrame, on: Sequence[str], keys: Sequence[str], date: str
) -> DataFrame:
    """Keys of one frame without any row in the other, each with its newest date."""
    missing = left.select(*keys, date).join(right.select(*on), list(on), "leftanti")
    return missing.groupBy(*keys).agg(F.max(date).alias(date))


def inverted_dates(df: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """Keys whose modification date goes back in time; the newest case of each."""
    steps = backward_steps(df, key, order, column)
    return dedup_ordered(steps, [key], [F.col(order).desc()])


def class_conflicts(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return multi_class(df, keys, column)


def status_check(
    df: DataFrame, column: str, patterns: Sequence[str] = tuple(ENDED_STATES)
) -> DataFrame:
    """Distinct rows whose state, trimmed and in capitals, holds one of the words."""
    state = F.trim(F.upper(F.col(column)))
    return (df.withColumn(column, state)
            .where(any_of([F.col(column).contains(p) for p in patterns])).distinct())


def tree_members(df: DataFrame, trees: Sequence[str], separator: str = "~") -> DataFrame:
    """Distinct (class id, tree) pairs from text lists, one column per tree."""
    pairs = F.array(*[F.struct(F.split(quoted(t), separator).alias("ids"),
                               F.lit(t).alias("tree")) for t in trees])
    lists = df.select(F.inline(pairs)).where("ids is not null")
    return lists.select(F.explode("ids").alias("class_id"), "tree").distinct()


def tree_conflicts(df: DataFrame, trees: Sequence[str]) -> DataFrame:
    """Class ids that occur in more than one tree."""
    return duplicate_keys(tree_members(df, trees), ["class_id"])
