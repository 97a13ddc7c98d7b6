"""Writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.columns import decimals_to_double, lower_columns, quoted
from ..operators.lookup import literal_lookup


def save_table(
    df: DataFrame,
    table: str,
    truncate: bool = True,
    preactions: Sequence[str] = (),
    postactions: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Replace or append to a table, with SQL statements before and after.

    Statements before the load take the place of the truncation, so asking for
    both is an error. Returns the frame for chaining.
    """
    if preactions and truncate:
        raise ValueError("preactions take the place of truncate; give only one of them")
    spark = df.sparkSession
    for statement in preactions:
        spark.sql(statement)
    writer = df.write.mode("overwrite" if truncate else "append").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    for statement in postactions:
        spark.sql(statement)
    return df


def save_parquet(
    df: DataFrame,
    path: str,
    lower_names: bool = True,
    doubles: bool = True,
    rebase: str | None = "LEGACY",
) -> DataFrame:
    """Overwrite a folder; names in lower case and decimals as double by default.

    Returns the frame as it was written.
    """
    if lower_names:
        df = lower_columns(df)
    if doubles:
        df = decimals_to_double(df)
    writer = df.write.mode("overwrite")
    if rebase is not None:
        writer = writer.option("datetimeRebaseMode", rebase)
    writer.parquet(path)
    return df


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Overwrite only the partitions that the frame has rows for.

    Rebalancing brings the rows of a partition together and lets adaptive
    execution split a partition that is too large for one task.
    """
    (
        df.hint("rebalance", *map(quoted, columns))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns).parquet(path)
    )


def write_fact_family(
    facts: Mapping[str, DataFrame], path: str, name: str = "fact_type"
) -> None:
    """Each fact to its own folder below one dataset, replacing only that folder."""
    for kind, df in facts.items():
        save_parquet(df, f"{path}/{name}={kind}")


def read_fact_family(spark: SparkSession, path: str) -> DataFrame:
    """All facts of a family as one frame, their kind as a column."""
    return spark.read.option("mergeSchema", True).parquet(path)


def publish_union_view(
    spark: SparkSession, name: str, tables: Mapping[str, str], source: str = "source"
) -> DataFrame:
    """A persistent view over the tables of several systems, rows tagged by system.

    Columns are matched by name; one that a table lacks is null there.
    """
    types = {c: kind for table in tables.values() for c, kind in spark.table(table).dtypes}
    selects = []
    for tag, table in tables.items():
        own = set(spark.table(table).columns)
        listed = [f"`{c}`" if c in own else f"cast(null as {kind}) as `{c}`" for c, kind in types.items()]
        selects.append(f"select {', '.join(listed)}, '{tag}' as {source} from {table}")
    spark.sql(f"create or replace view {name} as " + " union all ".join(selects))
    return spark.table(name)


def write_attribute_tables(
    df: DataFrame, names: Mapping[str, str], path: str
) -> DataFrame:
    """One table per listed attribute, all written by a single job.

    ``names`` maps attributes to table names. Returns the dataset, partitioned by
    table, in the long form (product_code, value).
    """
    tables = df.where(F.col("std_key").isin(list(names))).select(
        literal_lookup("std_key", names).alias("table"),
        F.col("sku").alias("product_code"),
        F.explode(F.split("value", "; ")).alias("value"),
    ).where("value is not null")
    write_partitioned(tables, path, ["table"])
    return df.sparkSession.read.parquet(path)
