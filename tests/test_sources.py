"""Readers and writers."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from saleweft.operators import columns as c
from saleweft.session import scratch_path, settle
from saleweft.sources import readers as r
from saleweft.sources import writers as w


@pytest.fixture
def place(spark):
    return scratch_path(spark, "sources")


def test_preactions_and_truncate_exclude_each_other(frame, place):
    with pytest.raises(ValueError):
        w.save_table(frame("a int", (1,)), "t", preactions=["select 1"], path=place)


def test_absent_table_is_empty_but_other_problems_are_raised(spark):
    empty = r.read_table_or_empty(spark, f"absent_{uuid.uuid4().hex}", "a int, b string")
    assert empty.columns == ["a", "b"] and empty.count() == 0
    broken = f"broken_{uuid.uuid4().hex}"
    spark.sql(f"create table {broken} (a int) using parquet location '{scratch_path(spark, 'x')}'")
    spark.sql(f"create or replace temp view v_{broken} as select a from {broken}")
    spark.sql(f"drop table {broken}")
    with pytest.raises(AnalysisException):
        r.read_table_or_empty(spark, f"v_{broken}", "a int").collect()


def test_delivery_must_be_complete(spark, frame, place):
    frame("v string", ("x",)).coalesce(1).write.csv(f"{place}/A_Overview")
    with pytest.raises(r.NotReady, match="end markers"):
        r.assert_ready(spark, place)
    frame("v string", ("x",)).coalesce(1).write.text(f"{place}/EndFile")
    with pytest.raises(r.NotReady):
        r.assert_ready(spark, place, marker="part-")
    r.assert_ready(spark, place, marker=".txt", overview="none of them")


def test_partition_overwrite_leaves_other_partitions(spark, frame, rows, place):
    w.write_partitioned(frame("a int, p string", (1, "x"), (2, "y")), place, ["p"])
    w.write_partitioned(frame("a int, p string", (3, "y")), place, ["p"])
    assert rows(spark.read.parquet(place)) == [(1, "x"), (3, "y")]


def test_newest_partition_over_a_year_end(spark, frame, rows, place):
    frame("v string, year string, month string, day string", ("old", "2023", "12", "31"),
          ("new", "2024", "01", "02"), ("mid", "2024", "01", "01")
          ).write.partitionBy("year", "month", "day").csv(place, header=True, sep=";")
    assert rows(r.read_newest_partition(spark, place), "v") == [("new",)]
    parts = r.padded_parts(r.read_csv(spark, place, ";"))
    assert ("2024", "01", "02") in rows(parts, "year", "month", "day")
    assert rows(r.newest_partition(r.read_csv(spark, place, ";"))) == [("2024", "01", "02")]


def test_saved_parquet_has_plain_names_and_doubles(spark, frame, place):
    saved = w.save_parquet(frame("A_B int, C string", (1, "x")).withColumn(
        "D", F.lit(1).cast("decimal(18,2)")), place)
    assert saved.dtypes == [("a_b", "int"), ("c", "string"), ("d", "double")]
    assert spark.read.parquet(place).columns == ["a_b", "c", "d"]


def test_settle_keeps_rows_and_cuts_the_plan(spark, rows):
    df = spark.range(5).selectExpr("id", "id * 2 as twice")
    kept = settle(df)
    assert rows(kept) == rows(df)
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_column_shape(frame, rows):
    df = frame("A int, `b.c` string, _c2 string", (1, "x", None))
    assert c.drop_unnamed_columns(df).columns == ["A", "b.c"]
    assert c.lower_columns(df).columns == ["a", "b.c", "_c2"]
    added = c.add_missing_columns(df, ["a", "Z"], F.lit(0))
    assert added.columns == ["A", "b.c", "_c2", "Z"]
    fitted = c.conform_to(df, "a bigint, other date")
    assert fitted.dtypes == [("a", "bigint"), ("other", "date")]
    fact, dim = c.split_fact_dim(df, ["A"], "A")
    assert fact.columns == ["A"] and dim.columns == ["b.c", "_c2", "A"]


def test_cast_columns_gives_null_for_bad_text(frame, rows):
    df = frame("Q string, D string, P string", ("1", "2024-01-02", "x"), ("one", "soon", "2.5"))
    out = c.cast_columns(df, ints=["q"], doubles=["p"], dates=["d"])
    assert out.dtypes == [("q", "int"), ("d", "date"), ("p", "double")]
    assert rows(out.select("q", F.col("d").cast("string"), "p")) == [
        (1, "2024-01-02", None), (None, None, 2.5)]
