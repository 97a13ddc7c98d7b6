"""Incremental loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .joins import anti, drop_superseded, latest_per_period, semi
from .windows import dedup_ordered, latest_version

INGESTED = "ingestion_timestamp"


def high_water_mark(df: DataFrame, column: str = INGESTED) -> DataFrame:
    """One row: the newest ingestion time, or 1970-01-01 for an empty table."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return df.agg(F.coalesce(F.max(F.col(column).cast("timestamp")), epoch).alias(column))


def folder_of(path: Column, levels: int = 2) -> Column:
    """The folder so many levels above a file; loads land in one folder per run."""
    return F.regexp_replace(path, "(/[^/]*){%d}$" % levels, "")


def files_of(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Path and time of every file below a folder, listed by Spark, not opened."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(path)
        .select("path", "modificationTime")
    )


def files_since(
    files: DataFrame, mode: Literal["Full", "Delta"], mark: DataFrame | None = None,
    levels: int = 2,
) -> DataFrame:
    """The folders to read: those with files after the mark, or only the newest."""
    folders = files.withColumn("folder", folder_of(F.col("path"), levels))
    if mode == "Full":
        newest = folders.orderBy(F.col("modificationTime").desc(), F.col("path").desc()).limit(1)
        return newest.select("folder")
    return folders.where(F.col("modificationTime") > mark.scalar()).select("folder").distinct()


def mark_text(mark: DataFrame) -> str:
    """A one-row mark as the text that file readers take, in the session's time zone."""
    return mark.select(F.date_format(mark.columns[0], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).first()[0]


def read_since(spark: SparkSession, path: str, mark: DataFrame) -> DataFrame | None:
    """The rows of all files changed after the mark, chosen in the scan; None without such files."""
    after = mark_text(mark)
    files = files_of(spark, path).where(F.col("modificationTime") > F.lit(after).cast("timestamp"))
    if files.isEmpty():
        return None
    return (
        spark.read.option("modifiedAfter", after).option("recursiveFileLookup", True)
        .option("mergeSchema", True).option("datetimeRebaseMode", "LEGACY").parquet(path)
    )


def newest_first(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def upsert(
    new: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    stored_is_unique: bool = False,
) -> DataFrame:
    """New and stored rows as one table with one row per key, the newest.

    Columns that only one side has are kept and null on the other. The order is
    the incremental fields, then the ingestion time, newest first, nulls last.

    With ``stored_is_unique`` (true for a table this function wrote) stored rows
    whose key is not in the batch pass through as they are: only the batch and
    the rows it touches are shuffled, however large the stored table is.
    """
    by = newest_first([*order, INGESTED])
    if not stored_is_unique:
        return dedup_ordered(new.unionByName(stored, allowMissingColumns=True), keys, by)
    batch_keys = new.select(*keys).distinct()
    touched = semi(stored, batch_keys, keys)
    untouched = anti(stored, batch_keys, keys)
    merged = dedup_ordered(new.unionByName(touched, allowMissingColumns=True), keys, by)
    return merged.unionByName(untouched, allowMissingColumns=True)


def unloaded_partitions(source: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The partitions of the source that the stored table does not have yet."""
    return anti(source.select(*columns).distinct(), stored.select(*columns).distinct(), columns)


def partitions_of(spark: SparkSession, path: str, types: Mapping[str, T.DataType]) -> DataFrame:
    """The partitions of a dataset by the paths of its files, none of which is opened; none without a folder."""
    schema = T.StructType([T.StructField(c, t) for c, t in types.items()])
    try:
        files = files_of(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return files.select(*[
        F.regexp_extract("path", f"/{c}=([^/]+)/", 1).cast(t).alias(c) for c, t in types.items()]).distinct()


def rows_of_new_partitions(source: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of a frame whose partition is not stored yet; for a dataset of files see ``load_new_partitions``."""
    return anti(source, stored.select(*columns).distinct(), columns)


def load_new_partitions(
    spark: SparkSession, path: str, stored_path: str, columns: Sequence[str]
) -> DataFrame:
    """The source rows of partitions that are not stored yet.

    Partitions are compared by their paths. Those to load, at most one per day of the
    calendar, become a filter on the partition columns, so other files are not opened.
    """
    source = spark.read.parquet(path)
    types = {c: source.schema[c].dataType for c in columns}
    new = unloaded_partitions(partitions_of(spark, path, types), partitions_of(spark, stored_path, types), columns)

    def name() -> Column:
        return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])

    return source.where(name().isin([r[0] for r in new.select(name()).collect()]))


def current_state(
    delta: DataFrame, bulk: DataFrame, keys: Sequence[str], date: str
) -> tuple[DataFrame, DataFrame]:
    """The latest delta row per key, and the bulk rows no delta has overtaken."""
    current = latest_version(delta, keys, date)
    return current, drop_superseded(bulk, current, keys, date)


def latest_extract(df: DataFrame, keys: Sequence[str], column: str = "ingestion_date") -> DataFrame:
    """A later extraction replaces all earlier ones of the same period (years, quarters, months)."""
    return latest_per_period(df, keys, column)


def backfill_ranges(
    spark: SparkSession, start: str, end: str, unit: Literal["day", "month"], step: int
) -> DataFrame:
    """Half-open ranges that cover a span, the last one cut at its end."""
    if unit not in ("day", "month"):
        raise ValueError("unit has to be 'day' or 'month'")
    if step <= 0:
        raise ValueError("step has to be above zero")
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    starts = F.sequence(first, last, F.expr(f"interval {step} {unit}"))
    following = F.date_add(F.col("range_start"), step) if unit == "day" else F.add_months(
        F.col("range_start"), step)
    return (
        spark.range(1).select(F.explode(starts).alias("range_start"))
        .where(F.col("range_start") < last)
        .select("range_start", F.least(following, last).alias("range_end"))
    )
