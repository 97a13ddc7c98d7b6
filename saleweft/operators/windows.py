"""Ordered work within a key.

``row_number = 1`` filters are kept directly on top of the window: Spark then
cuts each task down to one row per key before the shuffle, so a hot key costs
nothing extra. Fills and steps run on frames with one row per key and period,
whose groups are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import day
from ..functions.nulls import as_column
from .columns import quoted
from .joins import period_map


def dedup_ordered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """The first row of each key in the given order; any row without an order."""
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*[as_column(o) for o in order])
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def latest_version(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row with the highest counter or date, nulls last."""
    return dedup_ordered(df, keys, [F.col(o).desc_nulls_last() for o in order])


def nulls_last(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def count_over_key(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Add how many rows share the key.

    Counts are combined before the shuffle and joined back, so the rows of a hot
    key need not meet in one task. Null keys count as equal, as in a window.
    """
    names = [f"__key_{i}" for i in range(len(keys))]
    counts = (df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias(name))
              .toDF(*names, name))
    match = F.lit(True)
    for k, n in zip(keys, names):
        match = match & quoted(k).eqNullSafe(F.col(n))
    return df.join(counts, match, "inner").drop(*names)


def fill_forward(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]
) -> DataFrame:
    """Each null takes the last known value before it. One row per key and period."""
    window = (Window.partitionBy(*keys).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})


def fill_both_ways(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]
) -> DataFrame:
    """Fill forward; what is still null takes the first known value after it.

    Only a leading gap is still null then, so that value is the first known one
    of the whole key: one sort and two linear passes.
    """
    base = Window.partitionBy(*keys).orderBy(order)
    before = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(before),
                      F.first(c, ignorenulls=True).over(whole))
        for c in columns
    })


def intervals_from_cutoffs(df: DataFrame, cutoff: str, first: str) -> DataFrame:
    """Add the start of each interval: the day after the cut-off before it.

    The frame is a calendar with one row per period, so a single ordered pass
    over it is bounded.
    """
    before = F.lag(cutoff).over(Window.orderBy(cutoff))
    return df.withColumn("start_date", F.coalesce(F.date_add(before, 1), day(first)))


def backward_steps(df: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """Rows whose value is lower than that of the row before them under their key."""
    window = Window.partitionBy(key).orderBy(order)
    steps = df.select(key, order, column).distinct()
    return (steps.withColumn(f"prev_{column}", F.lag(column).over(window))
            .where(F.col(column) < F.col(f"prev_{column}")))


def release_number(
    df: DataFrame, year: str, month: str, dom: str, prefix: str, name: str = "version"
) -> DataFrame:
    """Label each release day with its place in the month, as in ``W.2024-05.2``.

    The days of a month, 31 at most, are looked up in one map of months; rows with a null
    in their day are left out.
    """
    days = period_map(df, [year, month], F.sort_array(F.collect_set(F.col(dom))))
    label = F.concat(F.lit(f"{prefix}."), F.col(year), F.lit("-"), F.col(month), F.lit("."),
                     F.array_position(days, F.col(dom)).cast("string"))
    return df.withColumn(name, label).where(F.col(name).isNotNull())


def flag_newest(df: DataFrame, date: str, kind: str, name: str) -> DataFrame:
    """Flag the rows of the newest date; on a tie those of the first kind.

    One maximum over the frame takes the place of a rank over all of it.
    """
    newest = df.groupBy(date, kind).agg(F.lit(True).alias(name)).orderBy(
        F.col(date).desc_nulls_last(), F.col(kind).asc_nulls_last()).limit(1)
    names = ["__date", "__kind", name]
    match = F.col(date).eqNullSafe(F.col("__date")) & F.col(kind).eqNullSafe(F.col("__kind"))
    return (df.join(newest.toDF(*names), match, "left")
            .withColumn(name, F.coalesce(name, F.lit(False))).drop("__date", "__kind"))


def merge_by_priority(
    frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """One row per key from stacked frames; earlier frames win.

    An order, where given, decides before the place of the frame does.
    """
    stacked = None
    for place, frame in enumerate(frames):
        tagged = frame.withColumn("__priority", F.lit(place))
        stacked = tagged if stacked is None else stacked.unionByName(
            tagged, allowMissingColumns=True)
    return dedup_ordered(stacked, keys, [*order, F.col("__priority")]).drop("__priority")
