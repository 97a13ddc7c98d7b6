"""How derived source tables are read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from workload import registry


@pytest.fixture
def parts(spark, tmp_path):
    """A folder with 500 parts in one file."""
    n = F.col("id")
    spark.range(1, 501).coalesce(1).select(
        n.alias("p_partkey"), F.lit("Brand#1").alias("p_brand"), F.lit("PROMO").alias("p_type"),
        (n % 50 + 1).cast("int").alias("p_size"), (n * 1.5).alias("p_retailprice"),
    ).write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_rows_a_view_makes_of_a_small_file_are_spread_over_tasks(spark, parts, monkeypatch):
    monkeypatch.setattr(registry, "REPEATED_ROWS", 10_000)
    tables = registry.Tables(spark, parts)
    for name, most in (("cost_export", 84), ("budget_export", 18), ("attributes", 11)):
        assert registry.repeats(registry.VIEWS[name]) == most
    exported = tables.cost_export
    assert exported.rdd.getNumPartitions() == 5  # 500 * 84 rows, 10,000 a task
    expected = spark.sql(registry.spark_text(registry.VIEWS["cost_export"]), part=tables.part)
    assert exported.exceptAll(expected).isEmpty() and expected.exceptAll(exported).isEmpty()
    assert tables.products.rdd.getNumPartitions() == 1  # repeats nothing


@pytest.fixture
def items(spark, tmp_path):
    """A folder with 300 order lines in one file, some of them twice."""
    n = F.col("id")
    lines = spark.range(300).select(
        (n / 4).cast("long").alias("l_orderkey"), (n % 4 + 1).cast("int").alias("l_linenumber"), (n % 20).alias("l_partkey"),
        (n % 7).alias("l_suppkey"), (n % 50 + 1).cast("double").alias("l_quantity"), (n * 1.5).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"), F.lit(0.2).alias("l_tax"), F.lit("R").alias("l_returnflag"),
        F.when(n % 3 == 0, "O").otherwise("F").alias("l_linestatus"), F.lit("1997-05-01").cast("timestamp").alias("l_shipdate"))
    lines.union(lines.where("l_orderkey < 5")).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_grouped_rows_are_dealt_out_before_a_view_repeats_them(spark, items, monkeypatch):
    monkeypatch.setattr(registry, "REPEATED_ROWS", 1_000)
    tables = registry.Tables(spark, items)
    prices = tables.prcd
    assert prices.rdd.getNumPartitions() == 5  # 320 * 13 rows, 1,000 a task
    assert prices._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("hashpartitioning") == 1
    grouped = spark.sql(registry.spark_text(registry.VIEWS["lines"]), lineitem=tables.lineitem)
    expected = spark.sql(registry.spark_text(registry.VIEWS["prcd"]), lines=grouped)
    assert prices.count() == expected.count() > 0
    assert prices.exceptAll(expected).isEmpty() and expected.exceptAll(prices).isEmpty()


def test_a_table_many_others_are_built_on_is_written_once_for_a_query(spark, items):
    plain = registry.Tables(spark, items)
    before = plain.vttp
    written = plain.written("likp")
    for name in ("vttp", "vbrk", "likp"):
        assert "Aggregate" not in getattr(written, name)._jdf.queryExecution().optimizedPlan().toString()
    assert written.vttp.exceptAll(before).isEmpty() and before.exceptAll(written.vttp).isEmpty()
    assert "Aggregate" in plain.vttp._jdf.queryExecution().optimizedPlan().toString()
