"""The keyed store: batches, folding, replays, and what a plan reads."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Observation, functions as F

from saleweft.operators import incremental as inc
from saleweft.operators.quality import old_date_check
from saleweft.session import scratch_path
from saleweft.sources.store import KeyedStore
from saleweft.sources.writers import write_partitioned
from saleweft.streaming.upsert import read_errors, stream_upsert, write_batch


def store_of(spark, buckets=4, **options):
    return KeyedStore(scratch_path(spark, "store"), options.get("keys", ["k"]), options.get("order", ["v"]), buckets)


def newest(batches):
    """Key to value: the largest, later batches win ties; None is the least."""
    out = {}
    for batch in batches:
        for k, v, note in batch:
            if k not in out or (v is not None and (out[k][0] is None or v >= out[k][0])) or (v is None and out[k][0] is None):
                out[k] = (v, note)
    return sorted(((k, *x) for k, x in out.items()), key=repr)


SCHEMA = "k int, v int, note string"


def batches_of(rng, n=5):
    out = []
    for b in range(n):
        keys = rng.sample(range(30), 12)
        out.append([(k if k else None, rng.choice([None, 1, 2, 3]), f"{b}") for k in keys])
    return out


@pytest.mark.parametrize("seed", range(2))
def test_adding_upserting_and_folding_give_the_newest(spark, frame, rows, seed):
    rng = random.Random(seed)
    batches, store = batches_of(rng), store_of(spark)
    for n, batch in enumerate(batches):
        (store.upsert if n % 2 else store.add)(frame(SCHEMA, *batch), n)
        assert rows(store.read(spark)) == newest(batches[:n + 1])
        if n == 2:
            store.fold(spark)
            assert rows(store.read(spark)) == newest(batches[:n + 1])


def test_a_replay_and_a_folding_in_between_change_nothing(spark, frame, rows):
    batches, store = batches_of(random.Random(7), 4), store_of(spark)
    for n, batch in enumerate(batches):
        store.add(frame(SCHEMA, *batch), n)
    expected = newest(batches)
    assert rows(store.read(spark)) == expected
    assert store.fold(spark, most=1) and rows(store.read(spark)) == expected
    store.add(frame(SCHEMA, *batches[1]), 1)
    store.add(frame(SCHEMA, *batches[3]), 3)
    assert rows(store.read(spark)) == expected
    store.fold(spark)
    store.upsert(frame(SCHEMA, *batches[3]), 3)
    assert rows(store.read(spark)) == expected
    assert store.fold(spark) == [] and store.forget(spark) > 0 and rows(store.read(spark)) == expected
    assert store.forget(spark) == 0


def test_an_upsert_reads_and_replaces_its_own_buckets_only(spark, frame, rows):
    store = store_of(spark, buckets=16)
    store.replace(frame(SCHEMA, *[(k, 1, "old") for k in range(500)]))
    before = store.state(spark)
    touched = store.upsert(frame(SCHEMA, (3, 2, "new"), (1000, 2, "new")), 1)
    after = store.state(spark)
    assert 1 <= len(touched) <= 2
    assert {b for b in after if after[b] != before[b]} == set(touched)
    assert store.read(spark).count() == 501 and store.count(spark, after) == 501
    # the scan names the partitions it reads; nothing but the chosen buckets is opened
    scan = store.rows(spark, {b: after[b] for b in touched})
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    files = {r[0] for r in scan.select(F.regexp_extract(F.col("_metadata.file_path"), "bucket=([^/]+)", 1)).distinct().collect()}
    assert files == set(touched)


def test_folded_buckets_are_read_without_a_shuffle(spark, frame):
    store = store_of(spark)
    store.replace(frame(SCHEMA, *[(k, 1, "old") for k in range(50)]))
    assert "Exchange" not in store.read(spark)._jdf.queryExecution().executedPlan().toString()


def test_columns_evolve_and_a_wider_key_stays_in_its_bucket(spark, frame, rows):
    store = store_of(spark)
    store.replace(frame("k string, v int, old string", ("1", 1, "o"), ("2", 1, "o")))
    store.upsert(frame("k string, v int, fresh string", ("1", 2, "f")), 1)
    assert rows(store.read(spark), "k", "v", "old", "fresh") == [("1", 2, None, "f"), ("2", 1, "o", None)]
    assert store.bucket  # an int 7 and a long 7 share a bucket
    one = frame("k int", (7,)).select(store.bucket().alias("b")).first().b
    assert frame("k long", (7,)).select(store.bucket().alias("b")).first().b == one


def test_writes_count_their_rows(spark, frame):
    store, seen = store_of(spark), Observation()
    store.replace(frame(SCHEMA, (1, 1, "a"), (1, 2, "b"), (2, 1, "c")), 0, seen)
    assert seen.get["rows"] == 2
    seen = Observation()
    store.upsert(frame(SCHEMA, (1, 3, "d")), 1, seen)
    assert seen.get["rows"] in (1, 2)


def test_an_empty_store_and_another_number_of_buckets(spark, frame):
    store = store_of(spark)
    assert store.state(spark) == {}
    with pytest.raises(ValueError, match="nothing is stored"):
        store.read(spark)
    assert store.upsert(frame(SCHEMA), 0) == []
    store.add(frame(SCHEMA, (1, 1, "a")), 0)
    with pytest.raises(ValueError, match="other buckets"):
        KeyedStore(store.path, ["k"], ["v"], 8).state(spark)


def test_stream_equals_batch_with_checks_replays_and_folding(spark, frame, rows):
    landing, state, errors = (scratch_path(spark, n) for n in ("landing", "checkpoint", "errors"))
    store, schema = store_of(spark), "k int, v int, day date, input_file_name string"
    parts = [[(1, 1, "2024-01-01"), (2, 5, "1900-01-01"), (1, 3, "2024-01-03")], [(1, 2, "2024-01-01"), (3, None, "0001-01-01"), (3, 0, None)]]
    batches = [frame("k int, v int, day string", *p).selectExpr("k", "v", "cast(day as date) as day", "'f' as input_file_name") for p in parts]

    def check(batch):
        return old_date_check(batch, ["k"])

    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(landing)
        source = spark.readStream.schema(schema).parquet(landing)
        stream_upsert(source, store, state, check, errors, fold_above=1).awaitTermination()
    expected = [(1, 3, "2024-01-03"), (2, 5, "1900-01-01"), (3, 0, None)]

    def table():
        return rows(store.read(spark).select("k", "v", F.col("day").cast("string")))

    found = [("k=2", "1900-01-01", 0), ("k=3", "0001-01-01", 1)]
    assert table() == expected and rows(read_errors(spark, errors), "pkey_value", "error_value", "batch") == found
    write_batch(batches[0], 0, store, check, errors)
    assert table() == expected and rows(read_errors(spark, errors), "pkey_value", "error_value", "batch") == found


def test_new_partitions_are_chosen_by_path(spark, frame, rows):
    source, stored = scratch_path(spark, "source"), scratch_path(spark, "stored")
    write_partitioned(frame("y int, m int, x int", (2024, 1, 1), (2024, 2, 2), (2024, 11, 3), (2023, 2, 4)), source, ["y", "m"])
    assert inc.load_new_partitions(spark, source, stored, ["y", "m"]).count() == 4
    write_partitioned(frame("y int, m int, x int", (2024, 2, 9), (2023, 11, 9)), stored, ["y", "m"])
    new = inc.load_new_partitions(spark, source, stored, ["y", "m"])
    assert rows(new, "y", "m", "x") == [(2023, 2, 4), (2024, 1, 1), (2024, 11, 3)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws" in plan
