"""F: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft.functions import dates as d
from saleweft.functions import nulls as n
from saleweft.functions import rates as r
from saleweft.functions import text as x
from saleweft.functions import typed as ty
from saleweft.operators.lookup import literal_lookup

from .registry import query


@query("f01_text", """
SELECT o_orderkey, o_orderstatus || '-' || o_orderpriority AS pair, lower(o_orderpriority) AS low, upper(o_orderpriority) AS up,
  CAST(length(trim(o_orderpriority)) AS INT) AS size, substring(o_orderpriority, 3, 4) AS part,
  split_part(o_orderpriority, '-', 1) AS first, nullif(split_part(o_orderpriority, ' ', 2), '') AS second,
  lpad(CAST(o_orderkey AS STRING), 8, '0') AS padded, regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') AS letters,
  regexp_extract(o_orderpriority, '([0-9])-', 1) AS digit, starts_with(o_orderpriority, '1') AS urgent,
  contains(o_orderpriority, 'MED') AS medium FROM orders
""")
def f01(t):
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", x.strict_key("-", "o_orderstatus", p).alias("pair"), F.lower(p).alias("low"),
        F.upper(p).alias("up"), F.length(F.trim(p)).alias("size"), F.substring(p, 3, 4).alias("part"),
        x.split_part(p, "-", 0).alias("first"), x.split_part(p, " ", 1).alias("second"),
        F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("padded"),
        F.regexp_replace(p, "[^A-Z]", "").alias("letters"),
        F.regexp_extract(p, "([0-9])-", 1).alias("digit"), p.startswith("1").alias("urgent"),
        p.contains("MED").alias("medium"))


@query("f02_dates", """
SELECT o_orderkey, CAST(date_diff('day', DATE '1899-12-30', d) AS INT) AS serial, CAST(year(d) AS INT) AS y, CAST(month(d) AS INT) AS m,
  strftime(d, '%b') AS mon, strftime(d, '%B') AS month_name, strftime(d, '%b %Y') AS month_year,
  CAST(year(d) AS STRING) || 'Q' || CAST(quarter(d) AS STRING) AS quarter_label,
  CAST(CAST(date_trunc('month', d) AS DATE) AS STRING) AS month_start, CAST(CAST(date_trunc('month', d + INTERVAL 2 MONTH) AS DATE) AS STRING) AS month_after,
  CAST(CAST(d + 1 AS DATE) AS STRING) AS next_day, strftime(d, '%d/%m/%Y') AS parsed_from,
  CAST(make_date(CAST(year(d) AS INT), CAST(month(d) AS INT), 1) AS STRING) AS made,
  CASE WHEN quarter(d) = 4 THEN CAST(year(d) + 1 AS STRING) || 'Q1' ELSE CAST(year(d) AS STRING) || 'Q' || CAST(quarter(d) + 1 AS STRING) END AS next_quarter
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o
""")
def f02(t):
    day = F.col("o_orderdate").cast("date")
    text = F.date_format(day, "dd/MM/yyyy")
    return t.orders.select(
        "o_orderkey", d.serial_day(day).alias("serial"), F.year(day).alias("y"),
        F.month(day).alias("m"), F.date_format(day, "MMM").alias("mon"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM yyyy").alias("month_year"),
        d.quarter_label(day).alias("quarter_label"),
        d.month_start(day).cast("string").alias("month_start"),
        d.month_after(day, 2).cast("string").alias("month_after"),
        F.date_add(day, 1).cast("string").alias("next_day"),
        F.date_format(d.parsed_date(text, "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed_from"),
        d.day_from_parts(F.year(day), F.month(day), F.lit(1)).cast("string").alias("made"),
        d.next_quarter_label(d.quarter_label(day)).alias("next_quarter"))


@query("f03_math", """
SELECT l_orderkey, l_linenumber, abs(-l_quantity) AS absolute, 1 / l_quantity AS inverse,
  CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio, l_quantity / 1000 * l_tax / 1000 * 50 / 1000 AS volume FROM lineitem
""", "absolute inverse ratio volume:12")
def f03(t):
    qty = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.abs(-qty).alias("absolute"),
        F.try_divide(F.lit(1.0), qty).alias("inverse"),
        F.try_divide("l_tax", "l_discount").alias("ratio"),
        (qty / 1000 * F.col("l_tax") / 1000 * 50 / 1000).alias("volume"))


@query("f04_conditions", """
SELECT vbeln, CASE WHEN lifsk IS NOT NULL AND trim(lifsk) <> '' THEN 'Delivery Block' WHEN faksk = 'C' THEN 'Billing Block'
  WHEN cmgst IN ('C', 'B') THEN 'Credit Block' END AS blocking_type,
  CASE WHEN auart = 'ZBGR' THEN 'B' ELSE 'A' END AS grade,
  CASE WHEN vbtyp = 'H' THEN CASE WHEN augru IS NULL THEN 'return' ELSE 'return ' || augru END ELSE 'sale' END AS kind FROM vbak
""")
def f04(t):
    from saleweft.plans.orders import blocking_type

    return t.vbak.select(
        "vbeln", blocking_type().alias("blocking_type"),
        F.when(F.col("auart") == "ZBGR", "B").otherwise("A").alias("grade"),
        F.when(F.col("vbtyp") == "H",
               F.when(F.col("augru").isNull(), "return")
               .otherwise(F.concat(F.lit("return "), "augru"))).otherwise("sale").alias("kind"))


@query("f05_nulls", """
SELECT l_orderkey, l_partkey, CASE WHEN acc_extra_amount IS NOT NULL AND acc_extra_amount <> 0 THEN acc_extra_amount
    WHEN extra_amount IS NOT NULL AND extra_amount <> 0 THEN extra_amount ELSE 0 END AS amount,
  coalesce(acc_extra_amount, extra_amount) AS plain, coalesce(customer, inv_customer, 'none') AS customer,
  CASE WHEN ref_invoice IS NULL OR trim(ref_invoice) = '' THEN document_code ELSE ref_invoice END AS reference FROM legacy_sales
""", "amount plain")
def f05(t):
    return t.legacy_sales.select(
        "l_orderkey", "l_partkey", n.coalesce_zero("acc_extra_amount", "extra_amount").alias("amount"),
        F.coalesce("acc_extra_amount", "extra_amount").alias("plain"),
        F.coalesce("customer", "inv_customer", F.lit("none")).alias("customer"),
        n.coalesce_blank("ref_invoice", "document_code").alias("reference"))


@query("f06_signed_rate", """
SELECT currency, CAST(exchange_date AS STRING) AS exchange_date,
  CASE WHEN exchange_value < 0 THEN 1 / abs(exchange_value) ELSE exchange_value END AS rate,
  CASE WHEN exchange_value < 0 THEN 1 / (abs(exchange_value) + 0.25e0) ELSE exchange_value + 0.25e0 END AS text_rate FROM tcurr
""", "rate text_rate")
def f06(t):
    value = F.col("exchange_value")
    text = F.concat(F.when(value < 0, "/").otherwise(""),
                    F.replace((F.abs(value) + 0.25).cast("string"), F.lit("."), F.lit(",")))
    return t.tcurr.select(
        "currency", F.col("exchange_date").cast("string").alias("exchange_date"),
        r.signed_rate("exchange_value").alias("rate"), r.text_rate(text).alias("text_rate"))


@query("f07_arrays", """
SELECT sku, item, CAST(len(string_split(value, '~')) AS INT) AS members FROM (SELECT sku, value, unnest(string_split(value, '~')) AS item
  FROM attributes WHERE key = 'Markets') x
""")
def f07(t):
    items = ty.list_items("value")
    return t.attributes.where("key = 'Markets'").select(
        "sku", F.explode(items).alias("item"), F.size(items).alias("members"))


@query("f08_json", """
SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS STRING) AS value FROM events
""")
def f08(t):
    packed = t.events.select("event_id", F.to_json(F.struct(
        F.get_json_object("props", "$.k").alias("k"))).alias("payload"))
    return packed.select("event_id", F.explode(F.from_json("payload", "map<string,string>")))


@query("f09_typed_values", """
SELECT sku, key, CASE kind WHEN 'Number' THEN CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN NULL ELSE CAST(CAST(value AS DOUBLE) AS STRING) END
  WHEN 'Date' THEN CAST(TRY_CAST(value AS DATE) AS STRING) WHEN 'Array' THEN replace(value, '~', '; ') ELSE value END AS value
FROM (SELECT a.*, k.kind FROM attributes a LEFT JOIN attribute_kinds k ON trim(regexp_replace(regexp_replace(
  regexp_replace(key, '\\[[^\\]]*\\]', '', 'g'), '[^\\w]+', ' ', 'g'), ' +$', '')) = replace(k.std_key, '_', ' ')) x
""")
def f09(t):
    named = t.attributes.withColumn("std_key", x.standard_name_column("key"))
    return named.join(t.attribute_kinds, ["std_key"], "left").select(
        "sku", "key", ty.typed_value("value", "kind").alias("value"))


@query("f10_file_name", """
SELECT p_partkey, 'part.parquet' AS file, CASE p_type WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 2 ELSE 0 END AS code FROM part
""")
def f10(t):
    code = literal_lookup("p_type", {"PROMO": 1, "LARGE": 2}, F.lit(0))
    return t.part.select("p_partkey", F.col("_metadata.file_name").alias("file"), code.alias("code"))
