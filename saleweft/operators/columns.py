"""Column shape: names, casts, missing columns, fact and dimension sides."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import standard_name


def _present(df: DataFrame) -> dict[str, str]:
    """Lower-case name to the name as it stands in the frame."""
    return {c.lower(): c for c in df.columns}


def quoted(name: str) -> Column:
    """A column by its plain name, also with dots, spaces or signs in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_select(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the listed columns under their business names (old to new)."""
    return df.select([quoted(old).alias(new) for old, new in names.items()])


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select([
        quoted(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else quoted(f.name)
        for f in df.schema.fields
    ])


def cast_columns(
    df: DataFrame,
    ints: Iterable[str] = (),
    doubles: Iterable[str] = (),
    dates: Iterable[str] = (),
    strings: Iterable[str] = (),
) -> DataFrame:
    """Cast the named columns that are there; text that cannot be read gives null.

    Decimals that no list names become double, and names come out in lower case.
    """
    target: dict[str, str] = {}
    for names, kind in ((ints, "int"), (doubles, "double"), (dates, "date"), (strings, "string")):
        target.update({n.lower(): kind for n in names})

    def one(field: T.StructField) -> Column:
        kind = target.get(field.name.lower())
        if kind is None and isinstance(field.dataType, T.DecimalType):
            kind = "double"
        column = quoted(field.name)
        return (column.try_cast(kind) if kind else column).alias(field.name.lower())

    return df.select([one(f) for f in df.schema.fields])


def standardize_columns(df: DataFrame, keep_brackets: bool = False) -> DataFrame:
    return df.toDF(*[standard_name(c, keep_brackets) for c in df.columns])


def drop_unnamed_columns(df: DataFrame) -> DataFrame:
    """Drop the ``_c<n>`` columns a trailing separator leaves behind."""
    return df.select([quoted(c) for c in df.columns if not c.startswith("_c")])


def add_missing_columns(
    df: DataFrame, names: Iterable[str], default: Column | None = None
) -> DataFrame:
    """Add the columns that are not there yet; names are compared without case."""
    default = F.lit(None).cast("double") if default is None else default
    have = _present(df)
    missing = {n: default for n in names if n.lower() not in have}
    return df.withColumns(missing) if missing else df


def conform_to(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Exactly the columns of a schema: cast what is there, null for the rest."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    have = _present(df)
    return df.select([
        (quoted(have[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def split_fact_dim(
    df: DataFrame, fact_columns: Sequence[str], key: str
) -> tuple[DataFrame, DataFrame]:
    """The named columns as the fact, all others plus the key as its dimension side."""
    named = {c.lower() for c in fact_columns}
    rest = [c for c in df.columns if c.lower() not in named]
    return df.select(*map(quoted, fact_columns)), df.select(*map(quoted, rest), quoted(key))


def drop_shared(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Drop what another frame has as well, but not the key."""
    shared = set(_present(df)) & set(_present(other)) - {key.lower()}
    return df.drop(*[_present(df)[c] for c in shared])


def stamp_lineage(df: DataFrame, run_time: str, run_id: str) -> DataFrame:
    """Add file, time and id of the run; the frame must come straight from files."""
    return df.withColumns({
        "input_file_name": F.col("_metadata.file_path"),
        "ingestion_timestamp": F.lit(run_time).cast("timestamp"),
        "ingestion_id": F.lit(run_id),
    })


def fix_values(df: DataFrame, column: str, fixes: Mapping[str, str]) -> DataFrame:
    """Replace known bad values of one column."""
    return df.replace(dict(fixes), subset=[column]) if fixes else df
