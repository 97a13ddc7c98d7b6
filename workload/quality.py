"""Q: data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.operators import quality as q

from .registry import query

LINE = ["l_orderkey", "l_linenumber"]
KEY_SQL = "'l_orderkey=' || CAST(l_orderkey AS STRING) || ', l_linenumber=' || CAST(l_linenumber AS STRING)"


@query("q01_assert_unique", """
SELECT vbeln, posnr, kwmeng FROM vbap
""", "kwmeng")
def q01(t):
    return q.assert_unique(t.vbap.select("vbeln", "posnr", "kwmeng"), ["vbeln", "posnr"])


@query("q02_assert_not_blank", "SELECT vbeln, auart, vkorg FROM vbak")
def q02(t):
    return q.assert_not_blank(t.vbak.select("vbeln", "auart", "vkorg"), "vbeln", "auart", "vkorg")


@query("q03_duplicate_errors", f"""
SELECT {KEY_SQL} AS pkey_value,
  'key stands ' || CAST(n AS STRING) || ' times' AS error_message,
  CAST(NULL AS STRING) AS error_column, CAST(NULL AS STRING) AS error_value, 'lineitem.parquet' AS s3_input_file_name
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) x WHERE n > 1
""")
def q03(t):
    named = t.lineitem.select(*LINE, F.col("_metadata.file_name").alias("input_file_name"))
    return q.duplicate_errors(named, LINE)


def old_dates(t):
    """Line items with dates of which some lie before 1970, in two date columns."""
    shipped = F.col("l_shipdate").cast("date")
    early = F.when(F.col("l_tax") == 0, F.lit("1960-02-03").cast("date")).otherwise(shipped)
    return t.lineitem.select(
        *LINE, F.col("l_shipdate").alias("shipped_at"),
        early.alias("ship_day"),
        F.when(F.col("l_discount") == 0, F.lit("0001-01-01").cast("date")).otherwise(shipped).alias("due"),
        F.lit("lineitem.parquet").alias("input_file_name"))


@query("q04_old_date_check", f"""
SELECT 'error' AS kind, {KEY_SQL} AS key, c AS name, v AS value, 'before 1970-01-01, replaced by 1900-01-01' AS message
FROM (SELECT l_orderkey, l_linenumber, 'ship_day' AS c, '1960-02-03' AS v FROM lineitem WHERE l_tax = 0
  UNION ALL SELECT l_orderkey, l_linenumber, 'due', '0001-01-01' FROM lineitem WHERE l_discount = 0) e
UNION ALL SELECT 'row', {KEY_SQL}, CASE WHEN l_tax = 0 THEN '1900-01-01' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END,
  CASE WHEN l_discount = 0 THEN '1900-01-01' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END, CAST(CAST(l_shipdate AS DATE) AS STRING) FROM lineitem
""")
def q04(t):
    rows, errors = q.old_date_check(old_dates(t), LINE)
    return errors.select(
        F.lit("error").alias("kind"), F.col("pkey_value").alias("key"),
        F.col("error_column").alias("name"), F.col("error_value").alias("value"),
        F.col("error_message").alias("message"),
    ).unionByName(rows.select(
        F.lit("row").alias("kind"), q.key_text(LINE).alias("key"),
        F.col("ship_day").cast("string").alias("name"), F.col("due").cast("string").alias("value"),
        F.col("shipped_at").cast("date").cast("string").alias("message")))


NULL_TEXTS = """(SELECT c_custkey, 'c_mktsegment' AS c, 'NULL' AS v FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey, 'c_name', 'null' FROM customer WHERE c_acctbal < 1000)"""


def null_texts(t):
    return t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 1000, F.lit("null")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NULL")).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
        F.lit("customer.parquet").alias("input_file_name"))


@query("q05_null_text_check", f"""
SELECT 'c_custkey=' || CAST(c_custkey AS STRING) AS pkey_value,
  'reads null as a word' AS error_message, c AS error_column, v AS error_value,
  'customer.parquet' AS s3_input_file_name FROM {NULL_TEXTS} x
""")
def q05(t):
    return q.null_text_check(null_texts(t), ["c_custkey"])


@query("q06_key_text", f"SELECT {KEY_SQL} AS pkey FROM lineitem")
def q06(t):
    return t.lineitem.select(q.key_text(LINE).alias("pkey"))


@query("q07_error_table", f"""
SELECT 'c_custkey=' || CAST(c_custkey AS STRING) AS pkey_value, c AS error_column, v AS error_value,
  'customer.parquet' AS s3_input_file_name, 'store.customer' AS output_table_name, '2024-05-01' AS day, 'run-7' AS ingestion_id FROM {NULL_TEXTS} x
UNION ALL SELECT 'l_orderkey=' || CAST(l_orderkey AS STRING), NULL, NULL, 'customer.parquet', 'store.customer', '2024-05-01', 'run-7'
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) l WHERE n > 1
""")
def q07(t):
    lines = t.lineitem.select("l_orderkey", F.lit("customer.parquet").alias("input_file_name"))
    errors = [q.null_text_check(null_texts(t), ["c_custkey"]),
              q.duplicate_errors(lines, ["l_orderkey"]), None]
    return q.error_table(errors, "store.customer", "2024-05-01 06:00:00", "run-7").select(
        "pkey_value", "error_column", "error_value", "s3_input_file_name",
        "output_table_name",
        F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("day"), "ingestion_id")


@query("q08_audit_row", """
SELECT 'store.orders' AS output_table_name, 'run-1' AS ingestion_id, 'Full' AS mode, 'o_totalprice' AS incremental_field,
  'o_orderkey' AS p_key, count(*) AS count_loaded_rows, CAST(0 AS BIGINT) AS errors_count, count(*) AS count_after_update,
  'duplicates_on_pkey ; fix_date_before_limit ; log_null_as_string' AS cleaning_steps FROM orders
""")
def q08(t):
    from saleweft.plans.ingest import Run, ingest
    from saleweft.sources.store import KeyedStore

    path = t.scratch("landing")
    t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus").write.parquet(f"{path}/load=1")
    run = Run("store.orders", ["o_orderkey"], ["o_totalprice"], "Full", "run-1", "2024-05-01 06:00:00")
    store = KeyedStore(t.scratch("store"), ["o_orderkey"], ["o_totalprice"], buckets=8)
    return ingest(t.spark, path, run, store).audit.select(
        "output_table_name", "ingestion_id", "mode", "incremental_field", "p_key",
        "count_loaded_rows", "errors_count", "count_after_update", "cleaning_steps")


@query("q09_referential_gaps", """
SELECT 'order without line' AS gap, o_orderkey AS key, CAST(max(CAST(o_orderdate AS DATE)) AS STRING) AS day FROM orders
WHERE o_orderkey NOT IN (SELECT CASE WHEN l_returnflag = 'R' THEN l_orderkey ELSE -l_orderkey END FROM lineitem) GROUP BY o_orderkey
UNION ALL SELECT 'part without supply', l_partkey, CAST(max(CAST(l_shipdate AS DATE)) AS STRING) FROM lineitem
WHERE l_partkey NOT IN (SELECT CASE WHEN p_size < 40 THEN p_partkey ELSE -p_partkey END FROM part) GROUP BY l_partkey
""")
def q09(t):
    """Whole tables; some keys are moved, so that gaps are there to be found."""
    orders = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").cast("date").alias("day"))

    def moved(column, kept):
        return F.when(kept, F.col(column)).otherwise(-F.col(column)).alias("key")

    returned = t.lineitem.select(moved("l_orderkey", F.col("l_returnflag") == "R"))
    lines = t.lineitem.select(F.col("l_partkey").alias("key"), F.col("l_shipdate").cast("date").alias("day"))
    small = t.part.select(moved("p_partkey", F.col("p_size") < 40))
    gaps = {"order without line": q.referential_gaps(orders, returned, ["key"], ["key"], "day"),
            "part without supply": q.referential_gaps(lines, small, ["key"], ["key"], "day")}
    first, second = [df.select(F.lit(g).alias("gap"), "key", F.col("day").cast("string").alias("day"))
                     for g, df in gaps.items()]
    return first.unionByName(second)


@query("q10_inverted_dates", """
WITH d AS (SELECT user_id, CAST(CAST(ts AS DATE) AS STRING) AS day, max(value) AS modified FROM events GROUP BY 1, 2),
steps AS (SELECT *, lag(modified) OVER (PARTITION BY user_id ORDER BY day) AS prev_modified FROM d)
SELECT user_id, max(day) AS day, arg_max(modified, day) AS modified, arg_max(prev_modified, day) AS prev_modified
FROM steps WHERE modified < prev_modified GROUP BY user_id
""", "modified prev_modified")
def q10(t):
    daily = t.events.groupBy("user_id", F.col("ts").cast("date").cast("string").alias("day")).agg(
        F.max("value").alias("modified"))
    return q.inverted_dates(daily, "user_id", "day", "modified")


@query("q11_version_report", """
SELECT sku, cnt, string_agg('{"ingestion_date":"' || ingestion_date || '","ingestion_type":"' || ingestion_type || '"}', ',' ORDER BY ingestion_date, ingestion_type) AS dates
FROM (SELECT DISTINCT sku, ingestion_date, ingestion_type FROM attributes) a
JOIN (SELECT sku, count(DISTINCT ingestion_date) AS cnt FROM attributes GROUP BY sku) n USING (sku) GROUP BY sku, cnt
""")
def q11(t):
    from saleweft.operators.aggregate import version_dates
    from saleweft.operators.ordering import by_count_desc

    report = version_dates(t.attributes, "sku", "ingestion_date", "ingestion_type")
    return by_count_desc(report, "cnt", "sku").withColumn(
        "dates", F.regexp_replace("dates", r"^\[|\]$", ""))


@query("q12_class_conflicts", """
SELECT sku, tree_name, string_agg(DISTINCT class_id, ',' ORDER BY class_id) AS class_id FROM attributes WHERE tree_name IS NOT NULL
GROUP BY sku, tree_name HAVING count(DISTINCT class_id) > 1
""")
def q12(t):
    classes = t.attributes.where("tree_name is not null")
    return q.class_conflicts(classes, ["sku", "tree_name"], "class_id").withColumn(
        "class_id", F.array_join("class_id", ","))


@query("q13_status_check", """
SELECT DISTINCT sku, trim(upper(value)) AS value FROM attributes WHERE key = 'Release Status'
  AND (upper(value) LIKE '%OBSOLETE%' OR upper(value) LIKE '%REJECT%' OR upper(value) LIKE '%CANCEL%')
""")
def q13(t):
    rows = t.attributes.where("key = 'Release Status'").select("sku", "value")
    return q.status_check(rows, "value")


@query("q14_tree_conflicts", """
WITH ids AS (SELECT DISTINCT unnest(string_split(CASE WHEN p_size < 25 THEN p_type || '~' || p_brand ELSE p_type END, '~')) AS class_id, 'MKT Tree' AS tree FROM part
UNION SELECT DISTINCT unnest(string_split(CASE WHEN p_size < 5 THEN p_brand ELSE p_brand || 'x' END, '~')), 'EPREL Tree' FROM part)
SELECT class_id, count(*) AS count FROM ids GROUP BY class_id HAVING count(*) > 1
""")
def q14(t):
    lists = t.part.select(
        F.when(F.col("p_size") < 25, F.concat_ws("~", "p_type", "p_brand")).otherwise(F.col("p_type"))
        .alias(fixed.TREE_COLUMNS[0]),
        F.when(F.col("p_size") < 5, F.col("p_brand"))
        .otherwise(F.concat(F.col("p_brand"), F.lit("x"))).alias(fixed.TREE_COLUMNS[2]))
    return q.tree_conflicts(lists, [fixed.TREE_COLUMNS[0], fixed.TREE_COLUMNS[2]])
