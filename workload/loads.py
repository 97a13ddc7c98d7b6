"""I: incremental loads and the stream."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from saleweft.operators import incremental as inc
from saleweft.operators.columns import stamp_lineage
from saleweft.operators.quality import old_date_check
from saleweft.plans.ingest import Run, ingest
from saleweft.sources.store import KeyedStore
from saleweft.sources.writers import write_partitioned
from saleweft.streaming.upsert import read_errors, stream_upsert

from .registry import query


@query("i01_high_water_mark", """
SELECT 'events' AS source, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS mark FROM events
UNION ALL SELECT 'empty', '1970-01-01 00:00:00'
""")
def i01(t):
    def mark(df, name):
        return inc.high_water_mark(df, "ts").select(
            F.lit(name).alias("source"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("mark"))

    return mark(t.events, "events").unionByName(mark(t.events.where("event_id < 0"), "empty"))


@query("i02_files_since", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
""")
def i02(t):
    """Loads land in one folder each; the first one lies before the mark and is left out."""
    path = t.scratch("landing")
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    for status in ("F", "O", "P"):
        orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus").write.parquet(
            f"{path}/load={status}")
        if status == "F":
            landed = inc.files_of(t.spark, path).select(F.max("modificationTime").alias("ingestion_timestamp"))
            mark = inc.high_water_mark(landed)
            mark = t.spark.createDataFrame([(inc.mark_text(mark),)], "m string").select(F.col("m").cast("timestamp"))
            time.sleep(0.01)  # the next files are younger by a millisecond at least
    return inc.read_since(t.spark, path, mark)


NEW = """new_rows AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS changed, l_returnflag AS flag, 2 AS load
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'),
stored AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS changed, CAST(NULL AS STRING) AS flag, 1 AS load
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-06-01')"""
UPSERT = f"""WITH {NEW}
SELECT * EXCLUDE rn FROM (SELECT l_orderkey, l_linenumber, l_quantity, flag, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY changed DESC, load DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM (SELECT * FROM new_rows UNION ALL SELECT * FROM stored) u) x WHERE rn = 1"""

KEYS = ["l_orderkey", "l_linenumber"]


def two_loads(t):
    """Line items as two loads that overlap; only the newer one has the flag."""
    rows = t.lineitem.select(*KEYS, "l_quantity", "l_extendedprice", "l_returnflag",
                             F.col("l_shipdate").cast("date").alias("changed"))
    new = rows.where("changed >= date'1999-01-01'").withColumnRenamed("l_returnflag", "flag")
    stored = rows.where("changed < date'1999-06-01'").drop("l_returnflag")

    def stamped(df, day):
        return df.withColumn("ingestion_timestamp", F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp"))

    return stamped(new, 2), stamped(stored, 1)


TIES = ["changed", "ingestion_timestamp", "l_extendedprice", "l_quantity"]


@query("i03_upsert", UPSERT, "l_quantity")
def i03(t):
    new, stored = two_loads(t)
    return inc.upsert(new, stored, KEYS, TIES).select(*KEYS, "l_quantity", "flag")


@query("i03_upsert_unique_store", UPSERT, "l_quantity")
def i03_unique(t):
    """The same result from a bucketed store: only the buckets that the new rows fall into are read and replaced."""
    new, stored = two_loads(t)
    store = KeyedStore(t.scratch("store"), KEYS, TIES, buckets=8)
    store.replace(stored, 0)
    store.upsert(new, 1)
    return store.read(t.spark).select(*KEYS, "l_quantity", "flag")


@query("i04_skip_if_empty", """
SELECT 'store.lines' AS table_name, 'Delta' AS mode, count(*) AS count_loaded_rows, CAST(NULL AS STRING) AS message FROM orders
UNION ALL SELECT 'store.lines', 'Delta', NULL, 'no data detected after last_insertion_timestamp: ingestion skipped'
""")
def i04(t):
    """A first run loads; a second run finds nothing newer than the first, and says so."""
    path = t.scratch("landing")
    t.orders.select("o_orderkey", "o_totalprice").write.parquet(f"{path}/load=1")
    store = KeyedStore(t.scratch("store"), ["o_orderkey"], ["o_totalprice"], buckets=8)

    def run(name, time):
        return ingest(t.spark, path, Run("store.lines", store.keys, store.order, "Delta", name, time), store).audit

    audits = run("run-1", "2999-01-01 00:00:00").unionByName(run("run-2", "2999-01-02 00:00:00"))
    return audits.select(F.col("output_table_name").alias("table_name"), "mode", "count_loaded_rows", "message")


@query("i04_ingest_run", """
SELECT l_orderkey, max(l_quantity) AS top FROM lineitem GROUP BY l_orderkey
""", "top")
def i04_run(t):
    """A whole run: land, check, merge with what is stored, and read the merged table."""
    path = t.scratch("landing")
    lines = t.lineitem.select("l_orderkey", "l_quantity")
    lines.where("l_quantity > 25").write.parquet(f"{path}/load=1")
    stored = lines.where("l_quantity <= 25").withColumn(
        "ingestion_timestamp", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    store = KeyedStore(t.scratch("store"), ["l_orderkey"], ["l_quantity"], buckets=8)
    store.replace(stored)
    run = Run("store.lines", store.keys, store.order, "Delta", "run-1", "2999-01-01 00:00:00")
    return ingest(t.spark, path, run, store).table.select("l_orderkey", F.col("l_quantity").alias("top"))


@query("i05_stream_upsert", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) x WHERE rn = 1
""", "value")
def i05(t):
    """All events as a file stream in two rounds; buckets with several batches are folded after each."""
    landing, state = t.scratch("events"), t.scratch("checkpoint")
    store = KeyedStore(t.scratch("store"), ["user_id", "event_type"], ["ts", "event_id"], buckets=8)
    events = t.events.drop("props")
    for part in (events.where("event_type in ('view', 'click')"),
                 events.where("event_type not in ('view', 'click')")):
        part.write.mode("append").parquet(landing)
        source = t.spark.readStream.schema(events.schema).parquet(landing)
        stream_upsert(source, store, state, fold_above=1).awaitTermination()
    return store.read(t.spark).select("user_id", "event_type", "event_id", "value")


@query("i05_stream_errors", """
SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events WHERE ts < TIMESTAMP '2024-01-08'
""")
def i05_errors(t):
    """The checks of a load inside the stream: dates before a limit go to the error table, batch by batch."""
    landing, errors = t.scratch("events"), t.scratch("errors")
    store = KeyedStore(t.scratch("store"), ["event_id"], ["ts"], buckets=8)
    events = t.events.drop("props")
    events.write.parquet(landing)
    source = t.spark.readStream.schema(events.schema).parquet(landing).transform(
        stamp_lineage, "2024-05-01 06:00:00", "run-7")

    def check(batch):
        return old_date_check(batch, ["event_id"], limit="2024-01-08")

    stream_upsert(source, store, t.scratch("checkpoint"), check, errors).awaitTermination()
    return read_errors(t.spark, errors).select(
        F.regexp_extract("pkey_value", "[0-9]+", 0).cast("long").alias("event_id"),
        F.substring("error_value", 1, 10).alias("day"))


@query("i06_load_new_partitions", """
SELECT l_orderkey, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month FROM lineitem
WHERE (year(l_shipdate), month(l_shipdate)) NOT IN (SELECT DISTINCT (year(o_orderdate), month(o_orderdate)) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 300000)
""")
def i06(t):
    """Partitions are chosen by their paths; the scan opens no file of a loaded one."""
    def parted(df, date, *others):
        path = t.scratch("parted")
        df = df.select(*others, F.year(date).alias("year"), F.month(date).alias("month"))
        write_partitioned(df, path, ["year", "month"])
        return path

    stored = parted(t.orders.where(
        "o_orderstatus = 'F' and o_orderpriority = '1-URGENT' and o_totalprice > 300000"), "o_orderdate", "o_orderkey")
    source = parted(t.lineitem, "l_shipdate", "l_orderkey")
    return inc.load_new_partitions(t.spark, source, stored, ["year", "month"])


@query("i07_current_state", """
WITH delta AS (SELECT l_partkey, CAST(max(l_shipdate) AS DATE) AS day FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
SELECT 'delta' AS kind, l_partkey, CAST(day AS STRING) AS day FROM delta
UNION ALL SELECT 'bulk', b.l_partkey, CAST(CAST(b.l_shipdate AS DATE) AS STRING) FROM lineitem b LEFT JOIN delta d USING (l_partkey)
WHERE l_returnflag <> 'R' AND (d.day IS NULL OR CAST(b.l_shipdate AS DATE) > d.day)
""")
def i07(t):
    rows = t.lineitem.select("l_partkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("day"))
    current, kept = inc.current_state(rows.where("l_returnflag = 'R'"),
                                      rows.where("l_returnflag <> 'R'"), ["l_partkey"], "day")
    first, second = [df.select(F.lit(k).alias("kind"), "l_partkey", F.col("day").cast("string").alias("day"))
                     for k, df in (("delta", current), ("bulk", kept))]
    return first.unionByName(second)


@query("i08_backfill_ranges", """
WITH starts AS (SELECT CAST(s AS DATE) AS range_start FROM (SELECT unnest(generate_series(DATE '1995-01-15', DATE '2001-12-20', INTERVAL 4 MONTH)) AS s) g
  WHERE s < DATE '2001-12-20'),
ranges AS (SELECT range_start, least(CAST(range_start + INTERVAL 4 MONTH AS DATE), DATE '2001-12-20') AS range_end FROM starts)
SELECT CAST(range_start AS STRING) AS range_start, CAST(range_end AS STRING) AS range_end, count(o_orderkey) AS orders
FROM ranges LEFT JOIN orders ON CAST(o_orderdate AS DATE) >= range_start AND CAST(o_orderdate AS DATE) < range_end GROUP BY 1, 2
""")
def i08(t):
    """Ranges of four months, each with the orders it would load."""
    from saleweft.operators.joins import interval_lookup

    ranges = inc.backfill_ranges(t.spark, "1995-01-15", "2001-12-20", "month", 4)
    closed = ranges.withColumn("last_day", F.date_sub("range_end", 1))
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))
    counted = (
        interval_lookup(orders, "ordered", closed, "range_start", "last_day", "range_end", "range_end")
        .groupBy("range_end").agg(F.count("o_orderkey").alias("orders")))
    return ranges.join(counted, ["range_end"], "left").select(
        F.col("range_start").cast("string").alias("range_start"),
        F.col("range_end").cast("string").alias("range_end"),
        F.coalesce("orders", F.lit(0)).alias("orders"))


@query("i09_latest_extract", """
SELECT account, product_code, years, ingestion_date, May FROM budget_export b
WHERE ingestion_date = (SELECT max(ingestion_date) FROM budget_export x WHERE x.years = b.years)
""", "May")
def i09(t):
    return inc.latest_extract(t.budget_export, ["years"]).select(
        "account", "product_code", "years", "ingestion_date", "May")
