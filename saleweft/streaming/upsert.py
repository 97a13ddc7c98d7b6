"""Keyed upsert as an available-now stream into a keyed store.

A micro-batch is checked, reduced to one row per key and added to the store under its
batch id, its errors to an error table under the same id. A batch that is replayed after
a failure writes the same folders again, so neither table changes. A batch costs its own
rows only; from time to time the buckets that gathered many batches are folded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import KeyedStore
from ..sources.writers import write_partitioned

Check = Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]


def write_batch(batch: DataFrame, batch_id: int, store: KeyedStore, check: Check | None = None,
                errors: str | None = None, fold_above: int | None = None) -> None:
    """One micro-batch: its errors, its rows, and then the folding of crowded buckets."""
    batch = batch.persist()
    try:
        if check is not None:
            batch, found = check(batch)
            if found is not None and errors is not None:
                write_partitioned(found.withColumn("batch", F.lit(batch_id)), errors, ["batch"])
        store.add(batch, batch_id)
    finally:
        batch.unpersist()
    if fold_above is not None:
        store.fold(batch.sparkSession, fold_above)


def stream_upsert(
    source: DataFrame,
    store: KeyedStore,
    checkpoint: str,
    check: Check | None = None,
    errors: str | None = None,
    fold_above: int | None = None,
) -> StreamingQuery:
    """Merge all that is available on a streaming source, then stop.

    ``check`` returns the batch to store and the errors found in it, which are kept in the
    folder ``errors``. Buckets with more than ``fold_above`` batches are folded after each batch.
    """
    return (
        source.writeStream
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, store, check, errors, fold_above))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_errors(spark: SparkSession, errors: str) -> DataFrame:
    """All errors, with the batch each was found in."""
    return spark.read.option("mergeSchema", True).parquet(errors)
