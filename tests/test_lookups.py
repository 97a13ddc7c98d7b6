"""Lookups and joins on edge rows."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saleweft.functions.text import clean_code
from saleweft.operators import joins as j
from saleweft.operators import lookup as lk


def test_default_is_for_absent_keys_only(frame, rows):
    facts = frame("id int, code string", (1, "a"), (2, "b"), (3, "x"), (4, None))
    texts = frame("code string, text string", ("a", "A"), ("b", None), (None, "N"))
    out = lk.checked_lookup(facts, texts, "code", "text", F.lit("none"))
    assert rows(out, "id", "text") == [(1, "A"), (2, None), (3, "none"), (4, "none")]


def test_without_default_absent_keys_are_null(frame, rows):
    facts = frame("id int, code string", (1, "a"), (2, "x"))
    texts = frame("code string, text string", ("a", "A"))
    assert rows(lk.checked_lookup(facts, texts, "code", "text"), "id", "text") == [
        (1, "A"), (2, None)]


def test_repeated_key_fails_even_when_no_row_asks_for_it(frame):
    facts = frame("id int, code string", (1, "a"))
    texts = frame("code string, text string", ("a", "A"), ("b", "B"), ("b", "B"))
    with pytest.raises(PySparkException, match="more than once"):
        lk.checked_lookup(facts, texts, "code", "text").collect()


def test_a_repeated_key_fails_whatever_is_read(frame):
    """Spark drops a join that nothing reads; the check must not go with it."""
    df, mapping = frame("k string, n int", ("a", 1), ("b", 2)), frame("k string, v int", ("a", 1), ("a", 2))
    for out in (lk.checked_lookup(df, mapping, "k", "v"), lk.unique_join(df, mapping, ["k"], "map")):
        for narrow in (out.select("n"), out.agg(F.count(F.lit(1)))):
            with pytest.raises(PySparkException, match="more than once"):
                narrow.collect()


def test_sides_that_repeat_a_key_fail(frame):
    twice = frame("sku string, base string, v int", ("1", "2", 1), ("2", None, 2), ("2", None, 3))
    with pytest.raises(PySparkException, match="base rows: key occurs more than once"):
        j.base_attributes(twice, "sku", "base", {"v": "base_v"}).select("sku").collect()
    fact = frame("source string, key_fact string", ("erp", "1"))
    with pytest.raises(PySparkException, match="dimension sides"):
        j.reassemble(fact, {"erp": frame("key_fact string, t string", ("1", "a"), ("1", "b"))}).select("key_fact").collect()
    with pytest.raises(PySparkException, match="client_dimension"):
        j.role_lookup(frame("client_k string", ("1",)), frame("k string, t string", ("1", "a"), ("1", "b")), ["k"], "client_").select("client_k").collect()


@pytest.mark.parametrize("name", ["j11_latest_per_key", "i09_latest_extract", "w07_release_number"])
def test_periods_need_no_join(spark, name):
    from workload import load_all

    plan = load_all()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0]


def test_period_bounds(frame, rows):
    df = frame("y int, q string, d string, v int", (1, "a", "2024-01-01", 1), (1, "a", "2024-01-02", 2), (1, "a", "2024-01-02", 3),
               (1, "b", "2024-01-01", 4), (None, "a", "2024-01-09", 5), (1, "c", None, 6))
    assert rows(j.latest_per_period(df, ["y", "q"], "d"), "v") == [(2,), (3,), (4,)]
    assert rows(j.latest_per_key(df, ["y", "q"], "d"), "v") == [(2,), (3,), (4,)]
    assert rows(j.latest_per_period(df.where("false"), ["y"], "d")) == []


def test_lookup_keeps_and_replaces_columns(frame, rows):
    facts = frame("id int, text string", (1, "old"))
    texts = frame("k int, v string", (1, "new"))
    out = lk.checked_lookup(facts, texts, "id", "text")
    assert out.columns == ["id", "text"]
    assert rows(out) == [(1, "new")]


def test_literal_lookup_quotes_its_texts(frame, rows):
    df = frame("k string", ("it's",), ("b\\c",), ("z",), (None,))
    out = df.select("k", lk.literal_lookup("k", {"it's": 1, "b\\c": 2}, F.lit(0)).alias("v"))
    assert rows(out) == sorted([("it's", 1), ("b\\c", 2), ("z", 0), (None, 0)], key=repr)


def test_constant_lookup(frame, rows):
    days = frame("d int, m string", (1, "jan"), (2, None))
    df = frame("id int", (7,))
    out = df.select(
        lk.constant_lookup(days, F.lit(1), F.lit("none")).alias("hit"),
        lk.constant_lookup(days, F.lit(2), F.lit("none")).alias("null_hit"),
        lk.constant_lookup(days, F.lit(3), F.lit("none")).alias("absent"))
    assert rows(out) == [("jan", None, "none")]


def test_inverse_rates(frame, rows):
    rates = frame("k string, r double", ("a", 1.0), ("b", 4.0), ("c", 0.0), ("d", None))
    assert rows(lk.inverse_rates(rates)) == [("a", 1.0), ("b", 0.25), ("c", None), ("d", None)]


def test_partial_match_uses_line_or_null(frame, rows):
    facts = frame("id int, org string, office string, line string",
                  (1, "o", "f", "01"), (2, "o", "f", "02"), (3, "o", "g", "09"), (4, "p", "f", "01"))
    rules = frame("org string, office string, line string, market string",
                  ("o", "f", "01", "M1"), ("o", "g", None, "M2"))
    out = j.partial_match(facts, rules.withColumnRenamed("line", "rule_line"),
                          {"org": "org", "office": "office"}, ("line", "rule_line"))
    assert rows(out, "id", "market") == [(1, "M1"), (2, None), (3, "M2"), (4, None)]


def test_interval_lookup_bounds_and_overlap(frame, rows):
    days = frame("id int, d string", (1, "2024-01-01"), (2, "2024-01-31"), (3, "2023-12-31"),
                 (4, "2024-03-01"), (5, "2024-02-01")).withColumn("d", F.col("d").cast("date"))
    spans = frame("s string, e string, m string", ("2024-01-01", "2024-01-31", "jan"),
                  ("2024-02-01", "2024-02-29", "feb")).withColumns(
        {"s": F.col("s").cast("date"), "e": F.col("e").cast("date")})
    out = j.interval_lookup(days, "d", spans, "s", "e", "m", "month")
    assert rows(out, "id", "month") == [(1, "jan"), (2, "jan"), (3, None), (4, None), (5, "feb")]
    overlapping = spans.withColumn("s", F.lit("2024-01-15").cast("date"))
    with pytest.raises(PySparkException, match="overlapping"):
        j.interval_lookup(days, "d", spans.union(overlapping), "s", "e", "m", "month").collect()


def test_superseded_rows_are_dropped_up_to_the_last_delta(frame, rows):
    bulk = frame("k string, d int", ("a", 1), ("a", 2), ("a", 3), ("b", 1))
    delta = frame("k string, d int", ("a", 2), ("a", 1))
    assert rows(j.drop_superseded(bulk, delta, ["k"], "d")) == [("a", 3), ("b", 1)]


PARTNERS = "vbeln string, posnr string, parvw string, kunnr string"


def test_partner_of_item_then_of_document(frame, rows):
    lines = frame("order_number string, order_line string", ("1", "10"), ("2", "10"), ("3", "10"),
                  ("4", "10"), ("5", "10"))
    partners = frame(
        PARTNERS,
        ("1", "10", "SP", "item"), ("1", "10", "BP", "item"),
        ("2", "000000", "SP", "head"), ("2", "000000", "BP", "head"),
        ("3", "10", "SP", "item"), ("3", "000000", "SP", "head"),
        ("3", "10", "BP", "item"), ("3", "000000", "BP", "head"),
        ("4", "10", "SP", " "), ("4", "000000", "SP", "head"),
        ("4", "10", "BP", " "), ("4", "000000", "BP", "head"),
        ("5", "10", "XX", "other"))
    out = j.with_partners(lines, partners)
    assert rows(out, "order_number", "dest_id", "inv_id") == [
        ("1", "item", "item"), ("2", "head", "head"), ("3", "item", "item"),
        ("4", " ", "head"), ("5", None, None)]


def test_partner_role_twice_fails(frame):
    lines = frame("order_number string, order_line string", ("1", "10"))
    partners = frame(PARTNERS, ("1", "10", "SP", "a"), ("1", "10", "SP", "b"))
    with pytest.raises(PySparkException, match="more than once"):
        j.with_partners(lines, partners).collect()


def test_cancelled_invoices(frame, rows):
    docs = frame("document_code string, cancelled_invoice string, doc_type_code_orig int",
                 ("1", None, 4), ("2", "1", None), ("3", "9", 4), ("4", "", 6))
    out = j.cancelled_lookup(docs)
    assert rows(out, "document_code", "doc_type_code", "flag_cancelled_invoice_valid") == [
        ("1", 4, None), ("2", 4, 1), ("4", 6, None)]


@pytest.mark.parametrize("how", ["inner", "left", "leftsemi", "leftanti"])
def test_salted_join_equals_join(spark, rows, how):
    left = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "k long, v string")
    plain = left.join(right, ["k"], how)
    assert rows(j.salted_join(left, right, ["k"], how, 7), *plain.columns) == rows(plain)


def test_salted_join_refuses_what_it_cannot_spread(frame):
    df = frame("k int", (1,))
    with pytest.raises(ValueError):
        j.salted_join(df, df, ["k"], "full")


def test_latest_per_key_drops_null_keys(frame, rows):
    df = frame("k string, d int, v int", ("a", 1, 1), ("a", 2, 2), ("a", 2, 3), (None, 9, 4))
    assert rows(j.latest_per_key(df, ["k"], "d"), "k", "v") == [("a", 2), ("a", 3)]


def test_reassemble_takes_each_rows_own_side(frame, rows):
    fact = frame("source string, key_fact string, q int", ("sap", "1", 1), ("cas", "1", 2))
    erp = frame("key_fact string, text string, only string", ("1", "erp", "x"))
    legacy = frame("key_fact string, text string", ("1", "old"))
    out = j.reassemble(fact, {"sap": erp, "cas": legacy})
    assert rows(out, "source", "text", "only") == [("cas", "old", None), ("sap", "erp", "x")]


def final_plan(spark, df):
    """The plan that ran, with broadcasts off and small limits for skew."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = df._jdf.queryExecution()
        query.toRdd().count()
        return query.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Nine of ten rows on one key, half of the others without a key."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    spark.range(200_000).selectExpr(
        "id", "case when id % 10 > 0 then 7 when id % 20 = 0 then null else id end as key",
        "cast(id % 10 as string) as text", "date'2024-01-01' as day").repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def test_a_hot_lookup_key_is_split(spark, hot):
    mapping = hot.where("key is not null").select("key", F.lit("v").alias("v")).distinct()
    out = lk.checked_lookup(hot, mapping, "key", "found")
    assert "skew=true" in final_plan(spark, out.select(F.max("found"), F.count("id")))


def test_hot_keys_of_the_other_joins_are_split(spark, hot):
    delta = hot.where("key is not null").select("key", F.lit("2023-01-01").cast("date").alias("day"))
    kept = j.drop_superseded(hot, delta, ["key"], "day").agg(F.count("id"))
    assert "skew=true" in final_plan(spark, kept)
    documents = hot.select(F.col("id").alias("document_code"), F.col("key").cast("string").alias("cancelled_invoice"),
                           F.lit(4).alias("doc_type_code_orig"), "text")
    documents = documents.withColumn("document_code", F.col("document_code").cast("string"))
    out = j.cancelled_lookup(documents).agg(F.count("doc_type_code"), F.max("text"))
    assert "skew=true" in final_plan(spark, out)


def test_rows_without_a_key_are_spread(spark):
    rows = spark.range(10_000).selectExpr("id", "cast(null as long) as key", "'' as blank")
    mapping = spark.range(5).select(F.col("id").alias("key"), F.lit("v").alias("v"))
    hits = mapping.groupBy("key").agg(F.first("v").alias("v")).withColumnRenamed("key", "k")
    final = lk.spread_join(rows, hits, {"k": F.col("key")}).where("v is null")
    assert final.count() == 10_000
    spread = rows.withColumn("n", F.lit(1) + F.pmod(F.xxhash64("id", "key", "blank"), F.lit(1_000_000)))
    assert spread.select("n").distinct().count() > 9_000
    blank = lk.spread_join(rows, hits.withColumn("k", F.lit("")), {"k": F.col("blank")}, blank=True)
    assert blank.where("v is not null").count() == 0


def test_longer_codes_stay_whole(frame, rows):
    codes = frame("v string", ("123",), ("1",), ("",), (None,), ("0-7",))
    assert rows(codes.select(clean_code("v", 2))) == sorted([("123",), ("01",), (None,), (None,), ("07",)], key=repr)
