"""Shards by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; rank over row count is
a row's fractional rank. Sorted by it, every source is spread evenly over the whole
order, so any run of it has the mixture of the table. The order is cut into runs whose
row counts differ by one at most. A source's ranks start at an offset of its own between
two rows, so that many small sources do not all fall on the same places.

Both ranks are exact and neither needs a source, or the whole table, in one task: see
``distributed_rank``. Only the columns named in ``carry`` are moved, never the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import distributed_rank, spread_key

_ONE = 2 ** 62


def interleave(docs: DataFrame, shards: int, source_col: str = "source", id_col: str = "doc_id",
               carry: list[str] | None = None, seed: int = 2) -> DataFrame:
    """``id_col``, the ``carry`` columns, ``shard`` (from 0) and ``slot`` (gapless from 0).

    Row counts of shards differ by one at most, and each source's count in a shard follows
    its share. The same rows give the same shards whatever their order or partitioning.
    Null sources are a source of their own, null ids are kept, rows that agree in id and
    carried columns are alike and take neighbouring places. Fewer rows than shards leave
    shards empty; an empty table gives an empty table. Other columns are not read.
    """
    carry = carry or []
    slim = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"),
                       *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)])
    kept = [f"__c{i}" for i in range(len(carry))]
    rows = docs.count()
    shuffled = F.struct(spread_key(seed, "__id", *kept).alias("u"), "__id", *kept)
    ranked = distributed_rank(slim, ["__source"], shuffled, "__rank", rows)
    offset = spread_key(seed, "__source") / F.lit(float(2 ** 63))
    share = (F.col("__rank") + offset) / F.col("__rank_of")
    placed = ranked.withColumn("__place", F.least((share * _ONE).cast("long"), F.lit(_ONE - 1)) * 2)
    order = F.struct(F.col("__place").alias("u"), "__source", "__rank")
    placed = distributed_rank(placed.withColumn("__all", F.lit(0)), ["__all"], order, "__at", rows)
    shard = F.expr(f"__at * {shards} div __at_of")
    first = F.expr(f"(__shard * __at_of + {shards - 1}) div {shards}")
    return placed.withColumn("__shard", shard).select(
        F.col("__id").alias(id_col), *[F.col(k).alias(c) for k, c in zip(kept, carry)],
        F.col("__shard").cast("int").alias("shard"), (F.col("__at") - first).alias("slot"))
