"""One ingestion run: new files to a checked, merged table with its logs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import incremental as inc
from ..operators import quality as q
from ..operators.columns import stamp_lineage
from ..operators.ordering import distinct_sorted
from ..session import settle
from ..sources.readers import read_parquet
from ..sources.store import KeyedStore

SKIPPED = "no data detected after last_insertion_timestamp: ingestion skipped"
AUDIT = (
    "output_table_name string, ingestion_id string, mode string, "
    "incremental_field string, begin_datetime string, p_key string, message string, "
    "last_insertion_timestamp timestamp, count_loaded_rows bigint, errors_count bigint, "
    "count_before_update bigint, count_after_update bigint, cleaning_steps string, "
    "loaded_paths string"
)


@dataclass(frozen=True)
class Run:
    """What is loaded, and how."""

    table: str
    keys: Sequence[str]
    order: Sequence[str]
    mode: Literal["Full", "Delta"]
    run_id: str
    run_time: str
    levels: int = 1


@dataclass(frozen=True)
class Loaded:
    """Results of a run; only the audit row when there was nothing to load.

    ``files`` lists every file read. It can be long, so it is a frame of its own
    and the audit row names the folders only.
    """

    audit: DataFrame
    table: DataFrame | None = None
    errors: DataFrame | None = None
    files: DataFrame | None = None


def new_rows(spark: SparkSession, path: str, run: Run, stored: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows to load and the mark they were chosen by, one row.

    A full load reads the newest folder, a delta load the files changed after the mark.
    """
    if run.mode == "Full":
        newest = inc.files_since(inc.files_of(spark, path), "Full", levels=run.levels).first()
        return (None if newest is None else read_parquet(spark, newest[0], recursive=True, legacy_dates=True)), None
    mark = inc.high_water_mark(stored if stored is not None else spark.createDataFrame([], f"{inc.INGESTED} timestamp"))
    return inc.read_since(spark, path, mark), mark


def check(batch: DataFrame, run: Run) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """The batch with old dates replaced, all errors found, and the steps done."""
    errors: list[DataFrame | None] = []
    steps = []
    if run.mode == "Full":
        errors.append(q.duplicate_errors(batch, run.keys))
        steps.append("duplicates_on_pkey")
    fixed, old = q.old_date_check(batch, run.keys)
    if old is not None:
        steps.append("fix_date_before_limit")
    texts = q.null_text_check(batch, run.keys)
    if texts is not None:
        steps.append("log_null_as_string")
    table = q.error_table([*errors, old, texts], run.table, run.run_time, run.run_id)
    return fixed, table, steps


def audit_row(spark: SparkSession, run: Run, **metrics: object) -> DataFrame:
    """One row of the load log; what was not measured is null."""
    values = {
        "output_table_name": run.table, "ingestion_id": run.run_id, "mode": run.mode,
        "incremental_field": " ; ".join(run.order), "begin_datetime": run.run_time,
        "p_key": ", ".join(run.keys), **metrics,
    }
    names = [part.strip().split(" ")[0] for part in AUDIT.split(",")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], AUDIT)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A frame written to the shared folder, and its rows as the write itself counted them."""
    seen = Observation()
    out = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return out, seen.get.get("rows", 0)


def ingest(spark: SparkSession, path: str, run: Run, store: KeyedStore) -> Loaded:
    """Load what is new below a path into a keyed store.

    A delta run reads and replaces the buckets it has keys in, a full run all. The batch, the
    errors and the merged rows are each written by one job, which counts them on the way;
    untouched buckets are counted from the footers of their files.
    """
    state = store.state(spark)
    raw, mark = new_rows(spark, path, run, store.read(spark) if state else None)
    marked = None if mark is None else mark.first()[0]
    if raw is None:
        return Loaded(audit_row(spark, run, message=SKIPPED, last_insertion_timestamp=marked))
    batch, loaded = counted(stamp_lineage(raw, run.run_time, run.run_id), "batch")
    fixed, errors, steps = check(batch, run)
    errors, bad = (None, 0) if errors is None else counted(errors, "errors")
    written, number = Observation(), max((s.last for s in state.values()), default=-1) + 1
    if run.mode == "Full":
        before, kept = None, 0
        store.replace(fixed, number, written)
    else:
        before = store.count(spark, state)
        touched = store.upsert(fixed, number, written)
        kept = store.count(spark, {b: s for b, s in state.items() if b not in touched})
    files = distinct_sorted(batch, "input_file_name")
    audit = audit_row(
        spark, run, last_insertion_timestamp=marked, count_loaded_rows=loaded, errors_count=bad,
        count_before_update=before, count_after_update=kept + written.get.get("rows", 0),
        cleaning_steps=" ; ".join(steps))
    # the folders become one text in the row and do not pass through the driver
    folders = files.select(inc.folder_of(F.col("input_file_name"), run.levels).alias("folder"))
    folders = folders.agg(F.array_join(F.sort_array(F.collect_set("folder")), " ; ").alias("loaded_paths"))
    audit = audit.withColumn("loaded_paths", folders.scalar())
    return Loaded(audit, store.read(spark), errors, files)
