"""Ordered work within a key."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from saleweft.operators import windows as w


def test_dedup_keeps_the_first_row_nulls_last(frame, rows):
    df = frame("k string, d int, v int", ("a", None, 1), ("a", 5, 2), ("a", 7, 3), ("b", None, 4))
    assert rows(w.latest_version(df, ["k"], "d")) == [("a", 7, 3), ("b", None, 4)]
    assert rows(w.dedup_ordered(df, ["k"], w.nulls_last("d"))) == [("a", 5, 2), ("b", None, 4)]
    assert w.dedup_ordered(df, ["k"]).count() == 2


def test_dedup_cuts_each_task_down_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = w.dedup_ordered(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("Final"), plan.index("Partial")
    assert "WindowGroupLimit" in plan and final < plan.index("Exchange") < partial


def test_count_over_key_counts_nulls_as_equal(frame, rows):
    df = frame("k string, v int", ("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5))
    assert rows(w.count_over_key(df, ["k"]), "v", "count") == [
        (1, 2), (2, 2), (3, 2), (4, 2), (5, 1)]


def test_fill_both_ways(frame, rows):
    df = frame("k string, y int, v double", ("a", 1, None), ("a", 2, 5.0), ("a", 3, None),
               ("a", 4, 6.0), ("a", 5, None), ("b", 1, None), ("c", 1, 9.0))
    assert rows(w.fill_both_ways(df, ["k"], "y", ["v"]), "k", "y", "v") == [
        ("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 5.0), ("a", 4, 6.0), ("a", 5, 6.0),
        ("b", 1, None), ("c", 1, 9.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 12), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1])))
def test_fill_equals_two_passes(spark, rows, data):
    df = spark.createDataFrame(data, "k int, y int, v int")
    up = Window.partitionBy("k").orderBy("y")
    down = Window.partitionBy("k").orderBy(F.col("y").desc())
    two = df.withColumn("v", F.last("v", True).over(up)).withColumn("v", F.last("v", True).over(down))
    assert rows(w.fill_both_ways(df, ["k"], "y", ["v"])) == rows(two)


def test_intervals_start_after_the_cutoff_before(frame, rows):
    df = frame("c string", ("2024-01-25",), ("2024-02-26",)).withColumn("c", F.col("c").cast("date"))
    out = w.intervals_from_cutoffs(df, "c", "2000-01-01").select(
        F.col("c").cast("string"), F.col("start_date").cast("string"))
    assert rows(out) == [("2024-01-25", "2000-01-01"), ("2024-02-26", "2024-01-26")]


def test_release_number_ranks_distinct_days(frame, rows):
    df = frame("y string, m string, d string", ("2024", "05", "03"), ("2024", "05", "03"),
               ("2024", "05", "10"), ("2024", "06", "01"))
    assert rows(w.release_number(df, "y", "m", "d", "W"), "version") == [
        ("W.2024-05.1",), ("W.2024-05.1",), ("W.2024-05.2",), ("W.2024-06.1",)]


def test_newest_is_flagged_with_the_first_kind_on_a_tie(frame, rows):
    df = frame("d int, kind string", (1, "MONTHLY"), (2, "WEEKLY"), (2, "MONTHLY"))
    assert rows(w.flag_newest(df, "d", "kind", "f")) == [
        (1, "MONTHLY", False), (2, "MONTHLY", True), (2, "WEEKLY", False)]


def test_merge_by_priority_prefers_order_then_place(frame, rows):
    a = frame("k int, n int, s string", (1, 1, "a"), (2, 1, "a"))
    b = frame("k int, n int, s string", (1, 2, "b"), (2, 1, "b"), (3, 1, "b"))
    assert rows(w.merge_by_priority([a, b], ["k"], [F.col("n").desc()]), "k", "s") == [
        (1, "b"), (2, "a"), (3, "b")]


def test_backward_steps(frame, rows):
    df = frame("k string, d int, v int", ("a", 1, 5), ("a", 2, 4), ("a", 3, 6), ("b", 1, 1))
    assert rows(w.backward_steps(df, "k", "d", "v")) == [("a", 2, 4, 5)]
