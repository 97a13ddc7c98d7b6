"""A: grouped results and pivots. O: sorted and limited results."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.functions.nulls import sum_null_safe
from saleweft.functions.text import strict_key
from saleweft.operators import aggregate as a
from saleweft.operators import ordering as o
from saleweft.operators import windows as w
from saleweft.plans import costs
from saleweft.plans.prices import invoice_conditions, prices

from .registry import query


@query("a01_sum_by", """
SELECT vgbel, vgpos, sum(lfimg) AS lfimg FROM lips GROUP BY vgbel, vgpos
""", "lfimg")
def a01(t):
    return a.sum_by(t.lips, ["vgbel", "vgpos"], ["lfimg"])


@query("a02_mixed_aggregates", """
SELECT l_orderkey, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS del_qty,
  sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS picking_qty,
  CAST(CAST(max(l_shipdate) AS DATE) AS STRING) AS last_slot FROM lineitem GROUP BY l_orderkey
""", "del_qty picking_qty")
def a02(t):
    issued = F.col("l_linestatus") == "F"
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(issued, F.col("l_quantity")).otherwise(0.0)).alias("del_qty"),
        F.sum(F.when(~issued, F.col("l_quantity")).otherwise(0.0)).alias("picking_qty"),
        F.max("l_shipdate").cast("date").cast("string").alias("last_slot"))


@query("a03_first_date", """
SELECT vbeln, posnr, CAST(min(edatu) AS STRING) AS first_req_del_date FROM vbep GROUP BY 1, 2
""")
def a03(t):
    return a.first_date(t.vbep, ["vbeln", "posnr"], "edatu", "first_req_del_date").withColumn(
        "first_req_del_date", F.col("first_req_del_date").cast("string"))


@query("a04_latest_by_counter", """
SELECT vbeln, posnr, etenr, ezeit, bmeng FROM vbep e WHERE etenr = (SELECT max(etenr) FROM vbep x WHERE x.vbeln = e.vbeln AND x.posnr = e.posnr)
""", "bmeng")
def a04(t):
    return t.vbep.transform(a.latest_by_counter, ["vbeln", "posnr"], "etenr").select(
        "vbeln", "posnr", "etenr", "ezeit", "bmeng")


@query("a05_global_bounds", """
SELECT CAST(CAST(min(o_orderdate) AS DATE) AS STRING) AS lowest,
  CAST(CAST(max(o_orderdate) AS DATE) AS STRING) AS highest FROM orders
""")
def a05(t):
    return a.global_bounds(t.orders, "o_orderdate").select(
        *[F.col(c).cast("date").cast("string").alias(c) for c in ("lowest", "highest")])


@query("a06_distinct", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def a06(t):
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("a07_dedup_by_key", """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS STRING) AS shipped, l_partkey FROM (SELECT *,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS rn FROM lineitem) x WHERE rn = 1
""")
def a07(t):
    order = [F.col("l_shipdate").desc(), F.col("l_partkey"), F.col("l_suppkey")]
    return w.dedup_ordered(t.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").cast("string").alias("shipped"), "l_partkey")


@query("a08_collect_text", """
SELECT l_orderkey, string_agg(DISTINCT l_returnflag || ' - ' || l_linestatus, ' ; ' ORDER BY l_returnflag || ' - ' || l_linestatus) AS kinds
FROM lineitem GROUP BY l_orderkey
""")
def a08(t):
    kind = strict_key(" - ", "l_returnflag", "l_linestatus")
    return a.collect_text(t.lineitem, ["l_orderkey"], kind, " ; ", "kinds")


@query("a09_version_dates", """
WITH d AS (SELECT DISTINCT user_id, CAST(CAST(ts AS DATE) AS STRING) AS day, event_type FROM events),
n AS (SELECT user_id, count(DISTINCT day) AS cnt,
  string_agg('{"day":"' || day || '","event_type":"' || event_type || '"}', ',' ORDER BY day, event_type) AS items
  FROM d GROUP BY user_id)
SELECT user_id, cnt, '[' || items || ']' AS dates FROM n
""")
def a09(t):
    rows = t.events.select(
        "user_id", F.col("ts").cast("date").cast("string").alias("day"), "event_type")
    return a.version_dates(rows, "user_id", "day", "event_type")


def condition_sql(name, codes, value):
    inside = ", ".join(f"'{c}'" for c in codes)
    return f"max(CASE WHEN kschl IN ({inside}) THEN {value} END) AS {name}"


LOCAL = "kwert * CASE WHEN kkurs < 0 THEN 1 / abs(kkurs) ELSE kkurs END"


@query("a10_condition_pivot", f"""
SELECT knumv || '|' || kposn AS price_key, {condition_sql('vat_reason_code', ['MWST'], 'mwsk1')},
  {condition_sql('inv_nsv_lc_temp', ['ZNSV', 'ZIV1', 'ZIV2'], f'abs({LOCAL})')},
  {condition_sql('inv_gsv_lc_temp', ['ZTTV', 'ZIV1', 'ZIV2'], LOCAL)},
  {condition_sql('inv_gsv_bonus_lc_temp', ['RENT', 'PPNT'], LOCAL)},
  {condition_sql('inv_raee_lc', ['ZWEE'], 'abs(kwert)')},
  {condition_sql('total_amount', ['ZGSV'], LOCAL)},
  {condition_sql('removable_charges_lc', ['ZFEE'], LOCAL)},
  {condition_sql('exchange_rate_erp', ['ZNSV', 'ZIV1', 'ZIV2'], 'CASE WHEN kkurs < 0 THEN 1 / abs(kkurs) ELSE kkurs END')},
  CAST({condition_sql('price_forced', ['PB00'], 'CASE WHEN kwert > 0 THEN 1 ELSE 0 END').replace(' AS price_forced', '')} AS DOUBLE) AS price_forced,
  coalesce(max(CASE WHEN kschl IN ('ZFR2', 'ZFR5') THEN abs(kwert) END),
    abs(max(CASE WHEN kschl = 'ZNET' THEN {LOCAL} END))) AS inv_transport_cost_lc_temp
FROM prcd GROUP BY knumv, kposn
""", "inv_nsv_lc_temp inv_gsv_lc_temp inv_gsv_bonus_lc_temp inv_raee_lc total_amount removable_charges_lc "
     "exchange_rate_erp inv_transport_cost_lc_temp")
def a10(t):
    return prices(t.prcd, invoice_conditions()).select(
        "price_key", "vat_reason_code", "inv_nsv_lc_temp", "inv_gsv_lc_temp",
        "inv_gsv_bonus_lc_temp", "inv_raee_lc", "total_amount", "removable_charges_lc",
        "exchange_rate_erp", F.col("price_forced").cast("double").alias("price_forced"),
        "inv_transport_cost_lc_temp")


@query("a11_pivot_max", """
SELECT organization, product_code, years,
  max(CASE WHEN account = 'A_NSV_MEDIO' AND currency = 'EUR' THEN May END) AS nsv_eur,
  max(CASE WHEN account = 'A_NSV_MEDIO' AND currency = 'Local' THEN May END) AS nsv_local,
  max(CASE WHEN account = '1095_LFG' THEN May END) AS qty_sold,
  max(CASE WHEN account = 'unknown' THEN May END) AS missing
FROM budget_export GROUP BY 1, 2, 3
""", "nsv_eur nsv_local qty_sold missing")
def a11(t):
    labelled = t.budget_export.withColumn("label", costs.account_label(fixed.BUDGET_ACCOUNTS))
    return a.pivot_max(labelled, ["organization", "product_code", "years"], "label", "May",
                       ["nsv_eur", "nsv_local", "qty_sold", "missing"])


@query("a12_pivot_sum", """
SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END) AS F,
  sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) AS O
FROM lineitem GROUP BY l_returnflag
""", "F:2 O:2")
def a12(t):
    return a.pivot_sum(t.lineitem, ["l_returnflag"], "l_linestatus", "l_extendedprice",
                       ["F", "O"])


EAV_KEYS = ["Brand", "Markets", "Noise", "Object_Type", "Release_Status"]


@query("a13_eav_pivot", """
SELECT sku, min(CASE WHEN key = 'Brand [12]' THEN value END) AS "Brand",
  min(CASE WHEN key = 'Markets' THEN value END) AS "Markets",
  min(CASE WHEN key = 'Noise' THEN value END) AS "Noise",
  min(CASE WHEN key = 'Object Type' THEN value END) AS "Object_Type",
  min(CASE WHEN key = 'Release Status' THEN value END) AS "Release_Status"
FROM attributes GROUP BY sku
""")
def a13(t):
    from saleweft.functions.text import standard_name_column

    rows = t.attributes.withColumn("std_key", standard_name_column("key"))
    return a.eav_pivot(rows, ["sku"], "std_key", "value", EAV_KEYS)


@query("a14_characteristic_pivot", """
WITH defs AS (SELECT DISTINCT CAST(n_regionkey AS STRING) AS id, CASE n_regionkey WHEN 0 THEN 'ZPROD_COMCODEEXT'
  WHEN 1 THEN 'ZPREF_ORIG' WHEN 2 THEN 'ZPROD_INWCODE' ELSE 'ZOTHER' END AS name FROM nation)
SELECT lpad(CAST(l_partkey AS STRING), 8, '0') AS product_code,
  min(CASE WHEN name = 'ZPROD_COMCODEEXT' THEN l_returnflag END) AS commodity_code_extension,
  min(CASE WHEN name = 'ZPREF_ORIG' THEN l_returnflag END) AS material_preferential_origin,
  min(CASE WHEN name = 'ZPROD_INWCODE' THEN l_returnflag END) AS inward_processing_code
FROM lineitem JOIN defs ON CAST(l_linenumber % 5 AS STRING) = id WHERE name <> 'ZOTHER' GROUP BY 1
""")
def a14(t):
    number = F.col("n_regionkey")
    definitions = t.nation.select(
        number.cast("string").alias("characteristic_id"),
        F.when(number == 0, "ZPROD_COMCODEEXT").when(number == 1, "ZPREF_ORIG")
        .when(number == 2, "ZPROD_INWCODE").otherwise("ZOTHER").alias("characteristic")).distinct()
    values = t.lineitem.select(
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("product_code"),
        (F.col("l_linenumber") % 5).cast("string").alias("characteristic_id"),
        F.col("l_returnflag").alias("characteristic_value"))
    return a.characteristic_pivot(values, definitions, fixed.CHARACTERISTICS)


MONTH_CELLS = " UNION ALL ".join(
    f"SELECT account, currency, years, {i + 1} AS month, {m} AS budget FROM budget_export"
    for i, m in enumerate(fixed.MONTHS))


@query("a15_unpivot_months", f"""
SELECT account, currency, years, month, sum(budget) AS budget, count(budget) AS known, count(*) AS cells FROM ({MONTH_CELLS}) c GROUP BY ALL
""", "budget:2")
def a15(t):
    cells = a.unpivot_months(
        t.budget_export, ["account", "organization", "product_code", "years", "currency"], "budget")
    return cells.groupBy("account", "currency", "years", "month").agg(
        F.sum("budget").alias("budget"), F.count("budget").alias("known"),
        F.count(F.lit(1)).alias("cells"))


@query("a16_month_offset_sums", """
SELECT l_suppkey, """ + ", ".join(
    f"sum(CASE WHEN date_trunc('month', l_shipdate) = DATE '1998-0{8 + i}-01' THEN {c} END) AS {c}_{i}"
    if i < 2 else
    f"sum(CASE WHEN date_trunc('month', l_shipdate) = DATE '1998-{8 + i}-01' THEN {c} END) AS {c}_{i}"
    for c in ("l_quantity", "l_extendedprice") for i in range(4)) + """
FROM lineitem GROUP BY l_suppkey
""", " ".join(f"{c}_{i}:2" for c in ("l_quantity", "l_extendedprice") for i in range(4)))
def a16(t):
    monthly = t.lineitem.withColumn("month", F.trunc(F.col("l_shipdate").cast("date"), "month"))
    return a.month_offset_sums(monthly, ["l_suppkey"], "month", ["l_quantity", "l_extendedprice"],
                               "1998-08-15", 4)


@query("a17_report_rollup", """
SELECT n_name AS market, c_mktsegment AS segment, strftime(o_orderdate, '%b %Y') AS month,
  o_orderpriority || ' / ' || o_orderstatus AS kind,
  sum(l_quantity) AS l_quantity, sum(l_extendedprice) AS l_extendedprice, sum(o_totalprice) AS o_totalprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4
""", "l_quantity:2 l_extendedprice:2 o_totalprice:2")
def a17(t):
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    keys = {"market": F.col("n_name"), "segment": F.col("c_mktsegment"),
            "month": F.date_format("o_orderdate", "MMM yyyy"),
            "kind": strict_key(" / ", "o_orderpriority", "o_orderstatus")}
    return a.rollup_report(rows, keys, ["l_quantity", "l_extendedprice", "o_totalprice"])


@query("a18_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def a18(t):
    return a.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("a19_multi_class", """
SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem
GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1
""")
def a19(t):
    return a.multi_class(t.lineitem, ["l_orderkey"], "l_returnflag").select(
        "l_orderkey", F.array_join("l_returnflag", ",").alias("flags"))


@query("a20_prefer_definitive", """
SELECT product_code, years,
  coalesce(sum(CASE WHEN account = 'TP_Commerciale_Definitive' THEN beg_balance END),
    sum(CASE WHEN account = 'TP_Commerciale_Indicative' THEN beg_balance END)) AS tp_commerciale,
  sum(CASE WHEN account = 'TP_ITCY_Indicative' THEN beg_balance END) AS tp_itcy
FROM cost_export GROUP BY 1, 2
""", "tp_commerciale tp_itcy")
def a20(t):
    return costs._definitive(t.cost_export, ["product_code", "years"],
                             ["tp_commerciale", "tp_itcy"]).select(
        "product_code", "years", "tp_commerciale", "tp_itcy")


@query("a21_sum_null_safe", """
SELECT product_code, year, coalesce(freight_in_eur, 0) + coalesce(transport_cost_infra_eur, 0) AS total
FROM freight
""", "total")
def a21(t):
    return t.freight.select("product_code", "year", sum_null_safe(
        "freight_in_eur", "transport_cost_infra_eur").alias("total"))


@query("o01_newest_row", """
SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders
ORDER BY 1 DESC, 2 DESC, 3 DESC LIMIT 1
""")
def o01(t):
    d = F.col("o_orderdate")
    parts = t.orders.select(F.year(d).cast("bigint").alias("year"),
                            F.month(d).cast("bigint").alias("month"),
                            F.dayofmonth(d).cast("bigint").alias("day")).distinct()
    return o.newest_row(parts, ["year", "month", "day"])


@query("o02_by_count_desc", """
SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY 1 ORDER BY cnt DESC, l_partkey
""")
def o02(t):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("cnt"))
    return o.by_count_desc(counts, "cnt", "l_partkey")


@query("o03_distinct_sorted", """
SELECT DISTINCT parse_filename(file) AS file FROM (SELECT 'x/orders.parquet' AS file FROM orders
UNION ALL SELECT 'x/customer.parquet' FROM customer) ORDER BY 1
""")
def o03(t):
    files = t.orders.select(F.col("_metadata.file_path").alias("file")).union(
        t.customer.select(F.col("_metadata.file_path").alias("file")))
    return o.distinct_sorted(files, "file").select(
        F.element_at(F.split("file", "/"), -1).alias("file"))


@query("o04_sample_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""", "o_totalprice")
def o04(t):
    return o.sample_rows(t.orders.select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("low")),
                         10, "low", "o_orderkey").drop("low")
