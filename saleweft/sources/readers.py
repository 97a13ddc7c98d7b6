"""Readers. Files are listed and read by Spark; the driver opens none of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import zero_padded
from ..operators.columns import drop_unnamed_columns
from ..operators.incremental import files_of
from ..operators.ordering import newest_row

PARTS = ("year", "month", "day")


def read_table(
    spark: SparkSession, table: str, jdbc: Mapping[str, str] | None = None
) -> DataFrame:
    """A catalog table, or a warehouse table over JDBC when its options are given.

    For a large JDBC table give ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` so that many tasks read it.
    """
    if jdbc is None:
        return spark.table(table)
    return spark.read.format("jdbc").options(**jdbc, dbtable=table).load()


def read_table_or_empty(
    spark: SparkSession, table: str, schema: T.StructType | str
) -> DataFrame:
    """The table, or an empty frame of the schema when there is no such table.

    Any other problem with the table is raised.
    """
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return empty_table(spark, schema)


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short table written down in the job."""
    return spark.createDataFrame(list(rows), schema)


def read_parquet(
    spark: SparkSession,
    *paths: str,
    recursive: bool = False,
    merge_schema: bool = True,
    legacy_dates: bool = False,
) -> DataFrame:
    """One frame from parquet folders; schemas of older files are merged in."""
    reader = spark.read.option("recursiveFileLookup", recursive).option("mergeSchema", merge_schema)
    if legacy_dates:
        reader = reader.option("datetimeRebaseMode", "LEGACY")
    return reader.parquet(*paths)


def read_csv(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    recursive: bool = False,
    pattern: str | None = None,
    schema: T.StructType | str | None = None,
    base_path: str | None = None,
) -> DataFrame:
    """Text columns from headed CSV; ``key=value`` folders become columns.

    Spark reads folder values such as ``month=03`` as numbers; `padded_parts`
    gives them their zeros back. A pattern limits the files by name. A schema
    saves the look into the files for their header. Below ``base_path`` folders become
    columns even if only one of them is read.
    """
    reader = (
        spark.read.option("header", True).option("sep", separator)
        .option("recursiveFileLookup", recursive)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if schema is not None:
        reader = reader.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.csv(path)


def read_wide_csv(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``||`` separated files whose lines end in a separator."""
    return drop_unnamed_columns(read_csv(spark, path, separator="||", pattern=pattern))


def read_list(spark: SparkSession, path: str, name: str = "Key") -> DataFrame:
    """A file with one value per line and no header; blank lines are left out."""
    lines = spark.read.schema(f"`{name}` string").csv(path)
    return lines.select(F.trim(F.col(name)).alias(name)).where(F.length(name) > 0)


def padded_parts(df: DataFrame) -> DataFrame:
    """Year, month and day of a partitioned source as padded text."""
    return df.withColumns({
        p: zero_padded(p, 4 if p == "year" else 2) for p in PARTS
    })


def newest_partition(df: DataFrame) -> DataFrame:
    """One row: the newest (year, month, day) of a partitioned source."""
    return newest_row(padded_parts(df).select(*PARTS).distinct(), PARTS)


def read_newest_partition(
    spark: SparkSession, path: str, separator: str = ";", pattern: str | None = None
) -> DataFrame:
    """The files of the newest day only.

    The newest day is taken from the paths of the files, none of which is opened for
    it. Then its folder alone is read, so the columns are those of its own files.
    """
    files = files_of(spark, path, pattern or "*.csv")
    parts = files.select(F.regexp_extract("path", "^(.*)/", 1).alias("folder"), *[
        F.regexp_extract("path", f"/{p}=([0-9]+)/", 1).cast("int").alias(p) for p in PARTS])
    newest = newest_row(parts, PARTS).first()
    if newest is None:
        return read_csv(spark, path, separator=separator, pattern=pattern)
    return read_csv(spark, newest["folder"], separator=separator, pattern=pattern, base_path=path)


class NotReady(RuntimeError):
    """A delivery of files that is not complete."""


def assert_ready(
    spark: SparkSession, path: str, marker: str = "EndFile", overview: str = "_Overview"
) -> None:
    """Fail unless a folder has exactly one end marker and at most one overview."""
    names = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"))
    )
    counts = names.agg(
        F.count_if(F.col("name").contains(marker)).alias("markers"),
        F.count_if(F.col("name").contains(overview)).alias("overviews"),
    ).first()
    if counts["markers"] != 1:
        raise NotReady(f"{path}: {counts['markers']} end markers, data is not ready")
    if counts["overviews"] > 1:
        raise NotReady(f"{path}: {counts['overviews']} overview files")
