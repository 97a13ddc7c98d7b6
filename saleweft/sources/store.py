"""A table with one row per key, kept in buckets of its keys' hash.

Two levels of folders: ``level=0/bucket=B/batch=N`` holds what batch N brought for bucket
B, ``level=1/bucket=B/batch=N`` the whole bucket as it stood after batch N. A bucket is
its newest level-1 folder and the level-0 folders of later batches; anything older
is superseded and never read. Which folders those are follows from the list of files, at most
one row per bucket, and goes into the scan as a partition filter.

* ``add`` writes a batch and reads nothing of the table.
* ``upsert`` reads, merges and replaces the buckets that a batch has keys in, no others.
* ``fold`` merges single buckets that have gathered many batches.

A write replaces whole folders of its own batch number (dynamic partition overwrite), so
a batch that is written again changes nothing, also after its bucket was folded.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators.columns import quoted
from ..operators.incremental import INGESTED, files_of, newest_first
from ..operators.windows import dedup_ordered

PLACE = ["level", "bucket", "batch"]
_BEFORE_ALL = -(1 << 62)


@dataclass(frozen=True)
class BucketState:
    """The newest whole copy of a bucket, the batches after it, and the newest of all."""

    base: int
    waiting: int
    last: int


@dataclass(frozen=True)
class KeyedStore:
    """Rows of one key: the newest by ``order`` (descending, nulls last), then ingestion time, then batch.

    The number of buckets belongs to a store for good. A few hundred megabytes a bucket
    are a good size; a bucket that is larger is still written and read by many tasks.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = 64

    def bucket(self) -> Column:
        """The bucket of a row's key; a key is told by its text, so a widened type stays in its bucket."""
        number = F.pmod(F.xxhash64(*[quoted(k).cast("string") for k in self.keys]), F.lit(self.buckets))
        return F.concat(number.cast("string"), F.lit(f"of{self.buckets}"))

    def state(self, spark: SparkSession) -> dict[str, BucketState]:
        """What the files say of each bucket that has any. No file is opened."""
        try:
            files = files_of(spark, self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        parts = files.select(*[F.regexp_extract("path", f"/{c}=([^/]+)/", 1).alias(c) for c in PLACE]).withColumn(
            "batch", F.col("batch").cast("long"))
        whole = F.coalesce(F.max(F.when(F.col("level") == "1", F.col("batch"))), F.lit(_BEFORE_ALL))
        by_bucket = parts.groupBy("bucket").agg(whole.alias("base"), F.max("batch").alias("last"), F.collect_set(
            F.when(F.col("level") == "0", F.col("batch"))).alias("brought"))
        rows = by_bucket.select("bucket", "base", "last", F.size(
            F.filter("brought", lambda b: b > F.col("base"))).alias("waiting")).collect()
        others = [r.bucket for r in rows if not r.bucket.endswith(f"of{self.buckets}")]
        if others:
            raise ValueError(f"{self.path} has other buckets than {self.buckets}: {others[0]}")
        return {r.bucket: BucketState(r.base, r.waiting, r.last) for r in rows}

    def rows(self, spark: SparkSession, state: dict[str, BucketState]) -> DataFrame:
        """The rows of the given buckets' live folders, several of a key where batches wait."""
        base = F.create_map(*[F.lit(v) for b, s in state.items() for v in (b, s.base)])[F.col("bucket")]
        whole = (F.col("level") == 1) & (F.col("batch") == base)
        later = (F.col("level") == 0) & (F.col("batch") > base)
        stored = spark.read.option("mergeSchema", True).parquet(self.path)
        return stored.where(F.col("bucket").isin(list(state)) & (whole | later))

    def read(self, spark: SparkSession, buckets: Iterable[str] | None = None) -> DataFrame:
        """The table, or some of its buckets: only buckets with waiting batches are shuffled."""
        state = self.state(spark)
        if buckets is not None:
            state = {b: state[b] for b in buckets if b in state}
        if not state:
            raise ValueError(f"{self.path}: nothing is stored there")
        folded = {b: s for b, s in state.items() if not s.waiting}
        waiting = {b: s for b, s in state.items() if s.waiting}
        merged = [self.newest(self.rows(spark, waiting))] if waiting else []
        plain = [self.rows(spark, folded)] if folded else []
        frames = [df.drop(*PLACE) for df in [*plain, *merged]]
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def count(self, spark: SparkSession, state: dict[str, BucketState]) -> int:
        """Rows of the given buckets; of folded ones the footers of their files tell."""
        return self.read(spark, state).count() if state else 0

    def newest(self, df: DataFrame) -> DataFrame:
        """One row per key."""
        ties = [c for c in (INGESTED, "batch") if c in df.columns and c not in self.order]
        keys = [*(["bucket"] if "bucket" in df.columns else []), *self.keys]
        return dedup_ordered(df, keys, newest_first([*self.order, *ties]))

    def add(self, batch: DataFrame, number: int, observed: Observation | None = None) -> None:
        """Write a batch as it is, one row per key; the table is neither read nor rewritten."""
        self._write(self.newest(batch).withColumn("bucket", self.bucket()), 0, F.lit(number), observed)

    def upsert(self, batch: DataFrame, number: int, observed: Observation | None = None) -> list[str]:
        """Merge a batch into the buckets it has keys in and replace those. Returns the buckets."""
        spark = batch.sparkSession
        placed = batch.withColumn("bucket", self.bucket())
        touched = sorted(r.bucket for r in placed.select("bucket").distinct().collect())
        state = self.state(spark)
        state = {b: state[b] for b in touched if b in state}
        placed = placed.withColumn("batch", F.lit(number).cast("long"))
        if state:
            placed = placed.unionByName(self.rows(spark, state).drop("level"), allowMissingColumns=True)
        if touched:
            self._write(self.newest(placed).drop("batch"), 1, F.lit(number), observed)
        return touched

    def replace(self, df: DataFrame, number: int = 0, observed: Observation | None = None) -> None:
        """Replace the whole table. ``df`` must not read from it."""
        self._write(self.newest(df).withColumn("bucket", self.bucket()), 1, F.lit(number), observed, "static")

    def fold(self, spark: SparkSession, most: int = 0) -> list[str]:
        """Merge the buckets that more than ``most`` batches wait for; others are not read. Returns them."""
        state = {b: s for b, s in self.state(spark).items() if s.waiting > most}
        if state:
            last = F.create_map(*[F.lit(v) for b, s in state.items() for v in (b, s.last)])[F.col("bucket")]
            merged = self.newest(self.rows(spark, state))
            self._write(merged.drop("level", "batch"), 1, last, None)
        return sorted(state)

    def forget(self, spark: SparkSession) -> int:
        """Delete superseded folders, which no reader that starts now needs. Returns how many."""
        state = self.state(spark)
        folders = files_of(spark, self.path).select(F.regexp_extract("path", "^(.*)/", 1).alias("folder")).distinct()
        base = F.create_map(*[F.lit(v) for b, s in state.items() for v in (b, s.base)])[
            F.regexp_extract("folder", "/bucket=([^/]+)", 1)]
        batch = F.regexp_extract("folder", "/batch=([^/]+)", 1).cast("long")
        old = (batch < base) | (F.col("folder").contains("/level=0/") & (batch == base))
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        count = 0
        for r in folders.where(old).toLocalIterator():
            path = hadoop.Path(r.folder)
            count += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return count

    def _write(self, df: DataFrame, level: int, batch: Column, observed: Observation | None,
               mode: str = "dynamic") -> None:
        df = df.withColumn("level", F.lit(level)).withColumn("batch", batch.cast("long"))
        df = df.hint("rebalance", *PLACE)  # the rows of a folder together; a large one is split
        if observed is not None:
            df = df.observe(observed, F.count(F.lit(1)).alias("rows"))  # in the writing tasks themselves
        df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*PLACE).parquet(self.path)
