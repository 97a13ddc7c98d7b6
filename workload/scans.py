"""S: sources and sinks, each as a round trip through the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from saleweft.operators.sets import tagged_union
from saleweft.sources import readers as r
from saleweft.sources import writers as w

from .registry import query


def table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def saved(t, df, prefix, **options):
    """A new table whose files lie in the shared folder."""
    name = table_name(prefix)
    w.save_table(df, name, path=t.scratch(name), **options)
    return name


@query("s01_read_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s01(t):
    return r.read_table(t.spark, saved(t, t.nation, "nation"))


@query("s02_read_table_or_empty", """
SELECT 'stored' AS kind, r_name FROM region
""")
def s02(t):
    schema = "r_regionkey int, r_name string"
    name = saved(t, t.region, "region")
    frames = {"stored": r.read_table_or_empty(t.spark, name, schema),
              "absent": r.read_table_or_empty(t.spark, table_name("absent"), schema)}
    return tagged_union(frames, "kind").select("kind", "r_name")


@query("s03_read_parquet_folder", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority FROM orders
""", "o_totalprice")
def s03(t):
    """Files of two shapes in nested folders, merged into one schema."""
    path = t.scratch("orders")
    t.orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice").write.parquet(f"{path}/a/b")
    t.orders.where("o_orderstatus <> 'O'").select("o_orderkey", "o_orderpriority").write.parquet(f"{path}/c")
    return r.read_parquet(t.spark, path, recursive=True)


def dated(df, date):
    return df.withColumns({
        "year": F.date_format(date, "yyyy"), "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd")})


def forecast_files(t, name):
    """Events as one ``;`` separated CSV folder per day."""
    path = t.scratch(name)
    rows = dated(t.events.select("event_id", "event_type", "value", "ts"), "ts").drop("ts")
    rows.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").csv(
        path, header=True, sep=";")
    return path


@query("s04_read_csv", """
SELECT CAST(event_id AS STRING) AS event_id, event_type, CAST(value AS STRING) AS value,
  CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day FROM events
""")
def s04(t):
    return r.read_csv(t.spark, forecast_files(t, "csv"), ";").select(
        "event_id", "event_type", "value", F.col("month").cast("int").alias("month"),
        F.col("day").cast("int").alias("day"))


@query("s05_read_wide_csv", """
SELECT CAST(p_partkey AS STRING) AS "SKU", p_name AS "Name", p_brand AS "Brand" FROM part
""")
def s05(t):
    """Lines that end in the separator, which adds a column without a name."""
    path = t.scratch("wide")
    rows = t.part.select(F.col("p_partkey").cast("string").alias("SKU"), F.col("p_name").alias("Name"),
                         F.col("p_brand").alias("Brand"), F.lit(None).cast("string").alias(""))
    rows.write.csv(path, header=True, sep="||")
    return r.read_wide_csv(t.spark, path)


@query("s06_read_file_glob", """
SELECT CAST(event_id AS STRING) AS event_id, event_type FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def s06(t):
    """Two kinds of files in each day folder; only one kind of the newest day is read."""
    path = forecast_files(t, "glob")
    keys = ["year", "month", "day"]
    notes = dated(t.events.select("ts"), "ts").select(F.lit("x").alias("other"), *keys).distinct()
    notes.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).option(
        "extension", "txt").csv(path, header=True, sep=";")
    return r.read_newest_partition(t.spark, path, ";", "part-*.csv").select("event_id", "event_type")


@query("s07_read_list", "SELECT DISTINCT p_brand AS \"Key\" FROM part")
def s07(t):
    path = t.scratch("list")
    t.part.select(F.concat(F.col("p_brand"), F.lit("  "))).distinct().write.text(path)
    return r.read_list(t.spark, path)


@query("s08_read_folders", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ordered FROM orders WHERE o_orderstatus IN ('F', 'P')
""")
def s08(t):
    path = t.scratch("folders")
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"), "o_orderstatus")
    for status in ("F", "O", "P"):
        w.save_parquet(rows.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), f"{path}/{status}")
    return r.read_parquet(t.spark, f"{path}/F", f"{path}/P", legacy_dates=True).withColumn(
        "ordered", F.col("ordered").cast("string"))


@query("s09_read_newest_partition", """
SELECT CAST(event_id AS STRING) AS event_id, event_type FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def s09(t):
    return r.read_newest_partition(t.spark, forecast_files(t, "newest")).select("event_id", "event_type")


@query("s10_literal_table", """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' END AS label FROM lineitem
""")
def s10(t):
    labels = r.literal_table(t.spark, [("A", "Accepted"), ("R", "Returned")], "l_returnflag string, label string")
    return t.lineitem.join(labels, ["l_returnflag"], "left").select("l_orderkey", "l_linenumber", "label")


@query("s11_empty_table", """
SELECT c_custkey, CAST(NULL AS DOUBLE) AS corrected_rate FROM customer
""", "corrected_rate")
def s11(t):
    corrections = r.empty_table(t.spark, "c_custkey bigint, corrected_rate double")
    return t.customer.select("c_custkey").join(corrections, ["c_custkey"], "left")


@query("s12_save_table", """
SELECT 'replaced' AS kind, r_name FROM region UNION ALL SELECT 'appended', r_name FROM region UNION ALL SELECT 'appended', r_name FROM region
""")
def s12(t):
    """Replaced by a second load, appended to after a statement, viewed after a statement."""
    replaced, appended, view = (table_name(n) for n in ("replaced", "appended", "view"))
    path = t.scratch("replaced")
    w.save_table(t.nation, replaced, path=path)
    w.save_table(t.region, replaced, path=path)
    location = t.scratch("appended")
    w.save_table(t.region, appended, path=location)
    w.save_table(t.region, appended, truncate=False, path=location,
                 preactions=[f"refresh table {appended}"],
                 postactions=[f"create or replace view {view} as select r_name from {appended}"])
    return tagged_union({"replaced": t.spark.table(replaced).select("r_name"),
                         "appended": t.spark.table(view)}, "kind").select("kind", "r_name")


@query("s13_save_parquet", """
SELECT l_orderkey AS orderkey, l_extendedprice AS price FROM lineitem
""", "price")
def s13(t):
    path = t.scratch("saved")
    rows = t.lineitem.select(F.col("l_orderkey").alias("OrderKey"),
                             F.col("l_extendedprice").cast("decimal(18,2)").alias("PRICE"))
    w.save_parquet(rows, path)
    return t.spark.read.parquet(path)


@query("s14_write_partitioned", """
SELECT l_orderkey, l_returnflag, l_quantity FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT l_orderkey, l_returnflag, -l_quantity FROM lineitem WHERE l_returnflag = 'R'
""", "l_quantity")
def s14(t):
    """A second write with rows of one partition leaves the others as they are."""
    path = t.scratch("parted")
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag")
    w.write_partitioned(rows, path, ["l_returnflag"])
    w.write_partitioned(rows.where("l_returnflag = 'R'").withColumn("l_quantity", -F.col("l_quantity")),
                        path, ["l_returnflag"])
    return t.spark.read.parquet(path)


@query("s15_write_fact_family", """
SELECT 'order' AS fact_type, o_orderkey AS key, o_totalprice AS amount, CAST(NULL AS STRING) AS flag FROM orders
UNION ALL SELECT 'invoice', l_orderkey, l_extendedprice, l_returnflag FROM lineitem
""", "amount")
def s15(t):
    path = t.scratch("facts")
    w.write_fact_family({
        "order": t.orders.select(F.col("o_orderkey").alias("Key"), F.col("o_totalprice").alias("amount")),
        "invoice": t.lineitem.select(F.col("l_orderkey").alias("key"),
                                     F.col("l_extendedprice").alias("amount"),
                                     F.col("l_returnflag").alias("flag"))}, path)
    return w.read_fact_family(t.spark, path).select("fact_type", "key", "amount", "flag")


@query("s16_publish_union_view", """
SELECT c_custkey AS key, c_name AS name, CAST(NULL AS INT) AS s_nationkey, 'sap' AS source FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, 'cas' FROM supplier
""")
def s16(t):
    erp = saved(t, t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), "erp")
    legacy = saved(t, t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), "s_nationkey"), "legacy")
    return w.publish_union_view(t.spark, table_name("both"), {"sap": erp, "cas": legacy})


@query("s17_write_attribute_tables", """
SELECT CASE key WHEN 'Markets' THEN 'market' ELSE 'derivate' END AS "table", sku AS product_code,
  unnest(string_split(value, '~')) AS value FROM attributes WHERE key IN ('Markets', 'Related Derivate Model')
""")
def s17(t):
    from saleweft.plans.master import typed_attributes

    typed = typed_attributes(t.attributes, t.attribute_kinds)
    return w.write_attribute_tables(
        typed, {"Markets": "market", "Related_Derivate_Model": "derivate"}, t.scratch("attributes"))


@query("s18_assert_ready", "SELECT CAST(p_partkey AS STRING) AS \"SKU\", p_name AS \"Name\" FROM part")
def s18(t):
    """A delivery with its end marker and one overview folder passes the check."""
    path = t.scratch("ready")
    t.part.select(F.col("p_partkey").alias("SKU"), F.col("p_name").alias("Name")).write.csv(
        f"{path}/data", header=True, sep="||")
    t.spark.range(1).select(F.lit("done")).coalesce(1).write.text(f"{path}/mark")
    r.assert_ready(t.spark, path, marker=".txt", overview="_Overview")
    return r.read_wide_csv(t.spark, f"{path}/data")
