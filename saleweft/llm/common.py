"""Shared steps: written intermediates, exact ranks without one big sort, batches of rows."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from saleweft.session import settle

from .words import raw_texts, text_chunks

__all__ = ["add_score", "bucket_count", "distributed_rank", "held_out", "labelled_sample", "list_rows",
           "plane_bytes", "plane_values", "settle", "small_batches", "spread_key", "sorted_bytes", "sorted_values", "worker_memory"]


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound what Python workers and the JVM hold of a table of long texts at a time."""
    for key, value in (("maxRecordsPerBatch", "1000"), ("maxBytesPerBatch", str(4 << 20))):
        name = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept out of training: crc32 of the id's text, mod 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def spread_key(seed: int, *columns: str) -> Column:
    """An evenly spread value from 0 to 2**63."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def worker_memory(key: tuple, make: Callable[[], object]) -> object:
    """One object per key and worker process. Functions travel by value, so it is kept in a module of its own."""
    store = vars(sys.modules.setdefault("_saleweft_worker", types.ModuleType("_saleweft_worker")))
    if key not in store:
        store[key] = make()
    return store[key]


def bucket_count(rows: int, each: int) -> int:
    """Buckets of about ``each`` rows."""
    return max(1, -(-rows // each))


def distributed_rank(df: DataFrame, group: list[str], order: Column, out: str, rows: int,
                     each: int = 5_000) -> DataFrame:
    """Exact 0-based rank of each row in its group by an evenly spread 64-bit key.

    The key's value range is cut into as many slices as the rows need, so a hot
    group is spread over all tasks: a row's rank is its place in its slice plus
    the rows of earlier slices, which come from a small count table. ``order`` is
    a struct whose first field ``u`` is the spread key, from 0 to 2**63; later fields break
    ties. Adds ``out`` and ``out`` + ``_of``, the group's row count.
    """
    slices = bucket_count(rows, each)
    bound = 2 ** 32
    top = F.shiftright(F.col("__order.u"), 31)
    df = df.withColumn("__order", order).withColumn(
        "__slice", F.floor(top * F.lit(slices) / F.lit(bound)).cast("int"))
    keys = [*group, "__slice"]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    counts = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                           F.sum("__n").over(whole).alias(f"{out}_of"))
    here = F.row_number().over(Window.partitionBy(*keys).orderBy("__order")) - 1
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    joined = df.withColumn("__here", here).join(counts, on=same)
    return joined.withColumn(out, F.col("__before") + F.col("__here")).drop(
        "__order", "__slice", "__here", "__before", *[f"__k{i}" for i in range(len(keys))])


def plane_bytes(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: all lowest bytes, then the next, and so on."""
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def plane_values(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def sorted_bytes(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as compressed steps."""
    return plane_bytes(np.diff(values, prepend=values.dtype.type(0)))


def sorted_values(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(plane_values(data, kind), dtype=kind)


def list_rows(struct: pa.StructArray) -> pa.ListArray:
    """All rows of a struct column as one list value."""
    return pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct)


def add_score(docs: DataFrame, text_col: str, out: str, scorer: Callable[[list[bytes | None]], np.ndarray]) -> DataFrame:
    """``docs`` and a double column that ``scorer`` computes from chunks of whole texts; its name must be new."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {out} already; choose another name with out=")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(batch.schema.get_field_index(text_col)))
            scores = [scorer(texts[part]) for part in text_chunks(texts)]
            column = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            yield pa.record_batch([*batch.columns, column], names=schema.names)

    return docs.mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[list[bytes], np.ndarray]:
    """At most ``most`` labelled texts for fitting, drawn by a hash of the id.

    Rows kept out of training, null labels, null ids and null texts are left out; an id
    with several labels counts as 1 if one of them is. The drawn ids are few, so they
    are broadcast and the documents are not shuffled.
    """
    drawn = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .groupBy(id_col).agg(F.max(label).cast("int").alias("__label"))
             .orderBy(F.xxhash64(F.lit(11), id_col), id_col).limit(most))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where("__text is not null")
    rows = (texts.join(F.broadcast(drawn), F.col("__id") == F.col(id_col))
            .select("__id", "__text", "__label").toArrow().sort_by("__id"))
    return raw_texts(rows.column("__text").combine_chunks()), rows.column("__label").to_numpy()
