"""Incremental loads, the stream, and data quality."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from saleweft.operators import incremental as inc
from saleweft.operators import quality as q
from saleweft.plans.ingest import SKIPPED, Run, ingest
from saleweft.session import scratch_path
from saleweft.sources.store import KeyedStore

SCHEMA = "k int, v int, ingestion_timestamp string"


def stamped(df):
    return df.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp"))


def upserted(new, stored, unique=False):
    return inc.upsert(stamped(new), stamped(stored), ["k"], ["v"], unique)


@pytest.mark.parametrize("unique", [False, True])
def test_upsert_keeps_the_newest(frame, rows, unique):
    stored = frame(SCHEMA, (1, 5, "2024-01-01"), (2, 5, "2024-01-01"), (3, None, "2024-01-01"))
    new = frame(SCHEMA, (1, 6, "2024-01-02"), (2, 4, "2024-01-02"), (3, None, "2024-01-02"),
                (4, 1, "2024-01-02"), (4, 2, "2024-01-02"))
    out = upserted(new, stored, unique).withColumn("day", F.dayofmonth("ingestion_timestamp"))
    assert rows(out, "k", "v", "day") == [(1, 6, 2), (2, 5, 1), (3, None, 2), (4, 2, 2)]


@pytest.mark.parametrize("unique", [False, True])
def test_upsert_evolves_the_schema(frame, rows, unique):
    stored = frame("k int, v int, old string, ingestion_timestamp string",
                   (1, 1, "o", "2024-01-01"), (2, 1, "o", "2024-01-01"))
    new = frame("k int, v int, fresh string, ingestion_timestamp string", (1, 2, "f", "2024-01-02"))
    assert rows(upserted(new, stored, unique), "k", "v", "old", "fresh") == [
        (1, 2, None, "f"), (2, 1, "o", None)]


@pytest.mark.parametrize("unique", [False, True])
def test_upsert_with_an_empty_side(frame, rows, unique):
    some, none = frame(SCHEMA, (1, 1, "2024-01-01")), frame(SCHEMA)
    assert rows(upserted(some, none, unique), "k", "v") == [(1, 1)]
    assert rows(upserted(none, some, unique), "k", "v") == [(1, 1)]


def test_upsert_twice_changes_nothing(frame, rows):
    stored = frame(SCHEMA, (1, 1, "2024-01-01"))
    new = stamped(frame(SCHEMA, (1, 2, "2024-01-02"), (2, 1, "2024-01-02")))
    once = inc.upsert(new, stamped(stored), ["k"], ["v"])
    assert rows(inc.upsert(new, once, ["k"], ["v"])) == rows(once)


def test_backfill_ranges_cover_the_span_once(spark, rows):
    out = inc.backfill_ranges(spark, "2024-01-01", "2024-01-08", "day", 3)
    text = [F.col(c).cast("string") for c in ("range_start", "range_end")]
    assert rows(out.select(*text)) == [
        ("2024-01-01", "2024-01-04"), ("2024-01-04", "2024-01-07"), ("2024-01-07", "2024-01-08")]
    with pytest.raises(ValueError):
        inc.backfill_ranges(spark, "2024-01-01", "2024-01-08", "week", 1)
    with pytest.raises(ValueError):
        inc.backfill_ranges(spark, "2024-01-01", "2024-01-08", "day", 0)


def test_full_mode_reads_the_newest_load_only(spark, frame, rows):
    files = frame("path string, modificationTime string",
                  ("s/t/load=1/a.parquet", "2024-01-01"), ("s/t/load=2/b.parquet", "2024-01-03"),
                  ("s/t/load=3/c.parquet", "2024-01-02")).withColumn(
        "modificationTime", F.col("modificationTime").cast("timestamp"))
    assert rows(inc.files_since(files, "Full", levels=1)) == [("s/t/load=2",)]
    mark = frame("m string", ("2024-01-01",)).select(F.col("m").cast("timestamp"))
    assert rows(inc.files_since(files, "Delta", mark, levels=1)) == [("s/t/load=2",), ("s/t/load=3",)]
    assert rows(inc.files_since(files, "Full", levels=2)) == [("s/t",)]


def test_run_checks_merges_and_logs(spark, frame, rows):
    path = scratch_path(spark, "landing")
    frame("k int, name string, day date").unionByName(
        frame("k int, name string, day string", (1, "Null", "0001-01-01"), (1, "b", "2024-01-01"),
              (2, "c", "1970-01-01")).withColumn("day", F.col("day").cast("date"))
    ).write.parquet(f"{path}/load=1")
    store = KeyedStore(scratch_path(spark, "store"), ["k"], ["name"], buckets=4)
    run = Run("t", ["k"], ["name"], "Full", "r1", "2999-01-01 00:00:00")
    out = ingest(spark, path, run, store)
    assert rows(out.table.select("k", "name", F.col("day").cast("string"))) == [
        (1, "b", "2024-01-01"), (2, "c", "1970-01-01")]
    assert rows(out.errors.groupBy("error_column").count()) == sorted(
        [("day", 1), ("name", 1), (None, 2)], key=repr)
    audit = out.audit.first()
    assert (audit.count_loaded_rows, audit.errors_count, audit.count_after_update) == (3, 4, 2)
    assert audit.loaded_paths.endswith("/landing") or "landing-" in audit.loaded_paths
    again = ingest(spark, path, Run("t", ["k"], ["name"], "Delta", "r2", "2999-01-02 00:00:00"), store)
    assert again.table is None and again.audit.first().message == SKIPPED


def test_delta_runs_read_new_files_only_and_count_all(spark, frame, rows):
    path, store = scratch_path(spark, "landing"), KeyedStore(scratch_path(spark, "store"), ["k"], ["v"], buckets=4)
    frame("k int, v int", *[(k, 0) for k in range(40)]).write.parquet(f"{path}/load=1")
    first = ingest(spark, path, Run("t", ["k"], ["v"], "Delta", "r1", "2020-01-01 00:00:00"), store)
    audit = first.audit.first()
    assert (audit.count_before_update, audit.count_loaded_rows, audit.count_after_update) == (0, 40, 40)
    # the mark is the first run's time, so both loads are newer and the first is merged once more
    frame("k int, v int, fresh string", (1, 7, "f"), (100, 1, "g")).write.parquet(f"{path}/load=2")
    second = ingest(spark, path, Run("t", ["k"], ["v"], "Delta", "r2", "2999-01-01 00:00:00"), store)
    audit = second.audit.first()
    assert (audit.count_before_update, audit.count_loaded_rows, audit.count_after_update) == (40, 42, 41)
    assert audit.loaded_paths.count(" ; ") in (0, 1) and second.table.count() == 41
    assert rows(second.table.where("fresh is not null").select("k", "v", "fresh")) == [(1, 7, "f"), (100, 1, "g")]


def test_asserts_fail_with_a_sample(frame):
    df = frame("a int, b string", (1, "x"), (1, "y"), (2, " "), (3, None))
    with pytest.raises(q.DataError, match="'a': 1"):
        q.assert_unique(df, ["a"])
    with pytest.raises(q.DataError):
        q.assert_not_null(df, "b")
    with pytest.raises(q.DataError):
        q.assert_not_blank(df.where("b is not null"), "b")
    assert q.assert_unique(df, ["a", "b"]) is df


def test_old_dates_with_nulls_and_the_limit_itself(frame, rows):
    df = frame("k int, d string, input_file_name string", (1, "1969-12-31", "f"),
               (2, "1970-01-01", "f"), (3, None, "f"), (4, "0001-01-01", "f")).withColumn(
        "d", F.col("d").cast("date"))
    fixed, errors = q.old_date_check(df, ["k"])
    assert rows(fixed.select("k", F.col("d").cast("string"))) == [
        (1, "1900-01-01"), (2, "1970-01-01"), (3, None), (4, "1900-01-01")]
    assert rows(errors, "pkey_value", "error_value") == [
        ("k=1", "1969-12-31"), ("k=4", "0001-01-01")]
    assert q.old_date_check(df.drop("d"), ["k"])[1] is None


def test_null_texts_are_reported_and_kept(frame, rows):
    df = frame("k int, a string, input_file_name string", (1, "null", "f"), (2, "NULL", "f"),
               (3, "", "f"), (4, " ", "f"), (5, None, "f"))
    assert rows(q.null_text_check(df, ["k"]), "error_column", "error_value") == [
        ("a", "NULL"), ("a", "null")]
    assert q.error_table([None, None], "t", "2024-01-01", "r") is None


def test_duplicate_errors_treat_null_keys_by_column(frame):
    df = frame("a string, b string, input_file_name string", ("x", None, "f"), ("y", None, "f"))
    assert q.duplicate_errors(df, ["a", "b"]).count() == 0


def test_tree_conflicts(frame, rows):
    df = frame("`MKT Tree` string, `R&D Tree` string", ("a~b", "c"), ("b", "a"), (None, None))
    assert rows(q.tree_conflicts(df, ["MKT Tree", "R&D Tree"])) == [("a", 2)]
