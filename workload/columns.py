"""P: projections, filters and gates. X: methods that chain with transform."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.functions.nulls import non_blank
from saleweft.functions.text import clean_code, make_key, strip_prefix
from saleweft.operators import columns as c
from saleweft.operators import filters as f
from saleweft.operators import joins as j
from saleweft.operators import quality as q
from saleweft.operators import sets as s
from saleweft.operators import windows as w
from saleweft.plans.bronze import CONTRACT, bronze, bronze_counts, contracts
from saleweft.plans.master import class_rows, overview_rows
from saleweft.plans.reassembly import split_fact
from saleweft.sources.readers import read_csv

from .registry import query


@query("p01_rename_select", """
SELECT vbeln AS order_number, auart AS order_type_code, CAST(audat AS STRING) AS order_date, vkorg AS sales_organization,
  spart AS division FROM vbak
""")
def p01(t):
    return c.rename_select(t.vbak, {
        "vbeln": "order_number", "auart": "order_type_code", "audat": "order_date",
        "vkorg": "sales_organization", "spart": "division",
    }).withColumn("order_date", F.col("order_date").cast("string"))


# Bronze tables: their keys, and the language that text tables are read in.
BRONZE_KEYS = {
    "vbak": "vbeln", "vbap": "vbeln posnr", "lips": "vbeln posnr", "likp": "vbeln", "vbbe": "vbeln posnr", "vbep": "vbeln posnr etenr",
    "vbpa": "vbeln posnr parvw", "tvak": "auart", "tvakt": "auart", "return_reasons": "order_reason", "block_texts": "lifsk",
    "category_texts": "vbtyp", "source_texts": "bsark", "areas": "zzlarea", "routes": "route", "company_currency": "company",
    "yearly_rates": "key_currency", "line_offices": "sales_office line", "product_lines": "product_code", "tcurr": "currency exchange_date",
    "cutoffs": "cutoff_date", "prcd": "knumv kposn kschl", "vbrk": "vbeln", "vbrp": "vbeln posnr", "prcd_invoice": "knumv kposn kschl",
    "vbfa": "vbelv vbeln", "vttp": "tknum vbeln", "vttk": "tknum", "shipping_texts": "vsart", "t052": "zterm", "t042": "land1 zlsch",
    "payment_texts": "zterm", "customer_offices": "key_knvv", "cdhdr": "objectid changenr", "cdpos": "objectid changenr",
    "delivery_kinds": "lfart",
}
BRONZE_LANGUAGES = {"tvakt": ("spras", "EN"), "t042": ("spras", "E")}


def bronze_sources(t):
    """Source tables as they might arrive: other names in capitals, numbers as texts, a column more."""
    out = {}
    for table in BRONZE_KEYS:
        view = t.get(table)
        out[table] = view.select(
            *[F.col(n).cast("string" if kind == "double" else kind).alias(f"SRC_{n.upper()}") for n, kind in view.dtypes],
            F.lit("x").alias("ZZ_ADDED"))
    return out


def bronze_rules(t):
    rows = []
    for table, keys in BRONZE_KEYS.items():
        language = BRONZE_LANGUAGES.get(table, (None, None))
        rows += [(table, f"src_{n}", n, kind, n in keys.split(), [language[1]] if n == language[0] else None)
                 for n, kind in t.get(table).dtypes]
    return contracts(t.spark.createDataFrame(rows, CONTRACT))


def bronze_sql():
    parts = []
    for table, keys in BRONZE_KEYS.items():
        where = " WHERE {} = '{}'".format(*BRONZE_LANGUAGES[table]) if table in BRONZE_LANGUAGES else ""
        columns = ", ".join(keys.split())
        key = f"struct_pack({', '.join(f'{k} := {k}' for k in keys.split())})"
        parts.append(f"SELECT '{table}' AS table_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys FROM (SELECT {columns} FROM {table}{where}) x_{table}")
    return " UNION ALL ".join(parts)


@query("p01_bronze_tables", bronze_sql())
def p01_bronze(t):
    """Every source table read by its contract."""
    t = t.written("likp", "lips")
    sources, rules = bronze_sources(t), bronze_rules(t)
    return bronze_counts({table: bronze(raw, rules[table]) for table, raw in sources.items()}, rules)


@query("p01_bronze_orders", """
SELECT vbeln, posnr, matnr, CAST(kwmeng AS DOUBLE) AS kwmeng, werks FROM vbap
""", "kwmeng")
def p01_orders(t):
    """The order items of the contract: names, types and all rows."""
    return bronze(bronze_sources(t)["vbap"], bronze_rules(t)["vbap"]).select("vbeln", "posnr", "matnr", "kwmeng", "werks")


@query("p02_lower_columns", "SELECT c_custkey AS custkey, c_name AS \"customer name\" FROM customer")
def p02(t):
    loud = t.customer.select(F.col("c_custkey").alias("CustKey"),
                             F.col("c_name").alias("CUSTOMER Name"))
    return c.lower_columns(loud)


@query("p03_decimals_to_double", """
SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
  CAST(CAST(l_discount AS DECIMAL(18,4)) AS DOUBLE) AS disc FROM lineitem
""", "price disc")
def p03(t):
    exact = t.lineitem.select("l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
                              F.col("l_discount").cast("decimal(18,4)").alias("disc"))
    return c.decimals_to_double(exact)


@query("p04_cast_columns", """
SELECT CAST(p_size AS INT) AS bdg_qty, CAST(p_retailprice AS DOUBLE) AS list_price,
  CAST(CASE WHEN p_size < 10 THEN DATE '2020-01-15' END AS STRING) AS mrdd, CAST(p_partkey AS STRING) AS area_code FROM part
""", "list_price")
def p04(t):
    texts = t.part.select(
        F.col("p_size").cast("string").alias("BDG_QTY"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("List_Price"),
        F.when(F.col("p_size") < 10, "2020-01-15").otherwise("none").alias("MRDD"),
        F.col("p_partkey").alias("area_code"))
    return c.cast_columns(texts, ints=["bdg_qty", "not there"], doubles=["list_price"],
                          dates=["mrdd"], strings=["area_code"]).withColumn(
        "mrdd", F.col("mrdd").cast("string"))


@query("p05_standardize_columns", """
SELECT p_partkey AS "SKU", p_size AS "Natural_Oil_Qty_g", p_brand AS "R_D_Tree", p_type AS "Max_Load" FROM part
""")
def p05(t):
    named = t.part.select(
        F.col("p_partkey").alias("SKU [item_id]"), F.col("p_size").alias("Natural Oil Qty (g) [26529]"),
        F.col("p_brand").alias("R&D Tree"), F.col("p_type").alias("Max. Load"))
    return c.standardize_columns(named)


@query("p06_add_missing_columns", """
SELECT p_partkey, p_name, CAST(NULL AS DOUBLE) AS nsv_eur, CAST(NULL AS DOUBLE) AS qty_sold FROM part
""")
def p06(t):
    return t.part.select("p_partkey", "p_name").transform(
        c.add_missing_columns, ["P_NAME", "nsv_eur", "qty_sold"])


@query("p07_conform_to", """
SELECT CAST(o_orderkey AS STRING) AS document_code, CAST(NULL AS STRING) AS distr_channel,
  o_totalprice AS amount, CAST(NULL AS DOUBLE) AS kurrf FROM orders
""", "amount kurrf")
def p07(t):
    rows = t.orders.select(F.col("o_orderkey").alias("Document_Code"),
                           F.col("o_totalprice").alias("AMOUNT"), "o_custkey")
    return rows.transform(
        c.conform_to, "document_code string, distr_channel string, amount double, kurrf double")


@query("p08_split_fact_dim", """
SELECT o_orderkey AS key_fact, o_totalprice, o_orderpriority, o_orderstatus FROM orders
""", "o_totalprice")
def p08(t):
    whole = t.orders.select(F.col("o_orderkey").alias("key_fact"), "o_totalprice",
                            "o_orderpriority", "o_orderstatus")
    fact, dim = split_fact(whole, ["key_fact", "o_totalprice"])
    return fact.join(dim, ["key_fact"], "left")


@query("p09_drop_shared", """
SELECT n_nationkey AS key, n_regionkey AS region FROM nation
""")
def p09(t):
    left = t.nation.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("Name"),
                           F.col("n_regionkey").alias("region"))
    right = t.region.select(F.col("r_regionkey").alias("KEY"), F.col("r_name").alias("NAME"))
    return c.drop_shared(left, right, "key")


@query("p10_filter_language", "SELECT auart, bezei FROM tvakt WHERE spras = 'EN'")
def p10(t):
    return f.filter_language(t.tvakt, "spras").select("auart", "bezei")


@query("p11_membership", """
SELECT vbeln, auart FROM vbak WHERE auart IN ('ZOR', 'ZREB', 'ZBGR') AND vkorg NOT IN ('62T0', '6230')
""")
def p11(t):
    return t.vbak.transform(f.keep_values, "auart", ["ZOR", "ZREB", "ZBGR"]).transform(
        f.exclude_values, "vkorg", ["62T0", "6230"]).select("vbeln", "auart")


@query("p12_non_blank", """
SELECT vbeln, coalesce(trim(lifsk), '') <> '' AS blocked FROM vbak WHERE lifsk IS NOT NULL OR cmgst = 'A'
""")
def p12(t):
    return t.vbak.where("lifsk is not null or cmgst = 'A'").select(
        "vbeln", non_blank("lifsk").alias("blocked"))


@query("p13_exclude_companies", "SELECT vbeln, vkorg FROM vbak WHERE vkorg <> '62T0' AND vkorg <> '6230'")
def p13(t):
    return f.exclude_values(t.vbak, "vkorg", fixed.EXCLUDED_COMPANIES).select("vbeln", "vkorg")


@query("p14_division_gate", """
SELECT vbeln, spart, CASE WHEN vtweg = '10' THEN 'sap' ELSE 'cas' END AS source FROM vbak
WHERE vtweg <> '10' OR spart = 'FG'
""")
def p14(t):
    tagged = t.vbak.withColumn("source", F.when(F.col("vtweg") == "10", F.lit("sap")).otherwise("cas"))
    return f.division_gate(tagged, "source", "spart").select("vbeln", "spart", "source")


@query("p15_any_nonzero", """
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0
""", "l_discount l_tax")
def p15(t):
    return f.any_nonzero(t.lineitem, ["l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("p16_report_gate", """
SELECT l_orderkey, l_linenumber, CAST(l_suppkey % 25 AS STRING) AS network, product_type_code FROM lineitem
LEFT JOIN products ON lpad(CAST(l_partkey AS STRING), 8, '0') = product_code
WHERE l_suppkey % 25 NOT IN (1, 2) AND coalesce(TRY_CAST(product_type_code AS INT), 0) > 0
""")
def p16(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_suppkey") % 25).cast("string").alias("network"),
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("product_code"))
    return rows.join(t.products.select("product_code", "product_type_code"), ["product_code"],
                     "left").transform(f.report_gate).drop("product_code")


@query("p17_future_months", f"""
SELECT account, material_sku, years, month, forecast FROM ({" UNION ALL ".join(
    f"SELECT account, material_sku, years, ingestion_date, {i + 1} AS month, {m} AS forecast FROM forecast_export"
    for i, m in enumerate(fixed.MONTHS))}) x WHERE month > CAST(substring(ingestion_date, 5, 2) AS INT)
""", "forecast")
def p17(t):
    from saleweft.operators.aggregate import unpivot_months

    rows = unpivot_months(t.forecast_export, ["account", "material_sku", "years", "ingestion_date"], "forecast")
    return f.future_months(rows, "month", "ingestion_date").drop("ingestion_date")


@query("p18_stamp_lineage", """
SELECT o_orderkey, 'orders.parquet' AS file, '2024-05-01 06:00:00' AS ingestion_timestamp, 'run-1' AS ingestion_id FROM orders
""")
def p18(t):
    stamped = c.stamp_lineage(t.orders.select("o_orderkey", "_metadata"), "2024-05-01 06:00:00",
                              "run-1")
    return stamped.select(
        "o_orderkey", F.element_at(F.split("input_file_name", "/"), -1).alias("file"),
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp"),
        "ingestion_id")


@query("p19_clean_code", """
SELECT sales_organization AS raw, nullif(regexp_replace(sales_organization, '[^a-zA-Z0-9]', '', 'g'), '') AS cleaned,
  lpad(nullif(regexp_replace(network, '[^a-zA-Z0-9]', '', 'g'), ''), 2, '0') AS network FROM market_raw
""")
def p19(t):
    return t.market_raw.select(
        F.col("sales_organization").alias("raw"), clean_code("sales_organization").alias("cleaned"),
        clean_code("network", 2).alias("network"))


@query("p20_strip_prefix", """
SELECT regexp_replace(market_budget, '^M_', '') AS market_budget,
  regexp_replace(responsible_code1, '^R_', '') AS region, regexp_replace(responsible_code, '^C_', '') AS cluster FROM market_raw
""")
def p20(t):
    return t.market_raw.select(
        strip_prefix("market_budget", "M_").alias("market_budget"),
        strip_prefix("responsible_code1", "R_").alias("region"),
        strip_prefix("responsible_code", "C_").alias("cluster"))


@query("p21_make_key", """
SELECT concat_ws('|', vkorg, lifsk, vtweg) AS bar_key, concat_ws('###', 'ORDER', vbeln, augru) AS hash_key,
  concat_ws('-@-', vkorg, CAST(year(audat) AS STRING), CAST(month(audat) AS STRING)) AS at_key FROM vbak
""")
def p21(t):
    return t.vbak.select(
        make_key("|", "vkorg", "lifsk", "vtweg").alias("bar_key"),
        make_key("###", F.lit("ORDER"), "vbeln", "augru").alias("hash_key"),
        make_key("-@-", "vkorg", F.year("audat"), F.month("audat")).alias("at_key"))


@query("p22_fix_values", """
SELECT sku, CASE WHEN value = 'Out of Production' THEN 'Out Of Production' ELSE value END AS value
FROM attributes WHERE key = 'Release Status' AND value NOT IN ('Draft')
""")
def p22(t):
    rows = t.attributes.where("key = 'Release Status'").transform(
        f.exclude_values, "value", ["Draft"])
    return c.fix_values(rows, "value", {"Out of Production": "Out Of Production"}).select(
        "sku", "value")


# --- X: the same operators as chained methods ------------------------------------


@query("x01_chained_lookups", """
SELECT vbeln, m.text AS source_text, coalesce(b.text, CASE WHEN b.lifsk IS NULL THEN 'free' END) AS block_text
FROM vbak LEFT JOIN source_texts m ON vbak.bsark = m.bsark LEFT JOIN block_texts b ON vbak.lifsk = b.lifsk
""")
def x01(t):
    from saleweft.operators.lookup import checked_lookup

    return (
        t.vbak.transform(checked_lookup, t.source_texts, "bsark", "source_text")
        .transform(checked_lookup, t.block_texts, "lifsk", "block_text", F.lit("free"))
        .select("vbeln", "source_text", "block_text")
    )


@query("x02_chained_dedup", """
SELECT tabname, objectid, changenr FROM (SELECT *, row_number() OVER (PARTITION BY tabname, objectid ORDER BY changenr DESC) AS rn
  FROM cdpos) x WHERE rn = 1
""")
def x02(t):
    return t.cdpos.transform(
        w.dedup_ordered, ["tabname", "objectid"], [F.col("changenr").desc()],
    ).select("tabname", "objectid", "changenr")


@query("x03_assert_unique", "SELECT o_orderkey, o_orderstatus FROM orders")
def x03(t):
    return t.orders.transform(q.assert_unique, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("x04_assert_not_blank", "SELECT c_custkey, c_name FROM customer")
def x04(t):
    return t.customer.select("c_custkey", "c_name").transform(
        q.assert_not_null, "c_custkey", "c_name").transform(q.assert_not_blank, "c_name")


@query("x05_drop_blank", """
SELECT vbeln, lifsk, augru FROM vbak WHERE augru IS NOT NULL AND lifsk IS NOT NULL AND trim(lifsk) <> ''
""")
def x05(t):
    return t.vbak.transform(f.drop_null, "augru").transform(f.drop_blank, "lifsk").select(
        "vbeln", "lifsk", "augru")


@query("x06_merge_lists", """
SELECT product_code, place FROM (SELECT product_code, place, row_number() OVER (PARTITION BY product_code ORDER BY place) AS rn
  FROM (SELECT product_code, 0 AS place FROM product_lines UNION ALL SELECT lpad(CAST(l_partkey AS STRING), 8, '0'), 1 FROM lineitem
  UNION ALL SELECT lpad(CAST(p_partkey AS STRING), 8, '0'), 2 FROM part) a) b WHERE rn = 1
""")
def x06(t):
    def keyed(df, column, place):
        return df.select(F.lpad(F.col(column).cast("string"), 8, "0").alias("product_code"),
                         F.lit(place).alias("place"))

    lines = keyed(t.product_lines, "product_code", 0)
    stacked = s.union_all([keyed(t.lineitem, "l_partkey", 1), keyed(t.part, "p_partkey", 2)])
    ordered = w.dedup_ordered(stacked, ["product_code"], ["place"])
    return w.merge_by_priority([lines, ordered], ["product_code"])


@query("x07_last_info_with_missing_columns", """
SELECT product_code, years, ingestion_date, beg_balance, CAST(NULL AS DOUBLE) AS qty_sold FROM cost_export c
WHERE ingestion_date = (SELECT max(ingestion_date) FROM cost_export x WHERE x.years = c.years)
""", "beg_balance qty_sold")
def x07(t):
    return (
        t.cost_export.select("product_code", "years", "ingestion_date", "beg_balance")
        .transform(j.latest_per_key, ["years"], "ingestion_date")
        .transform(c.add_missing_columns, ["Years", "qty_sold"])
    )


@query("x08_chained_column_shape", """
SELECT p_partkey AS sku, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS list_price FROM part
""", "list_price")
def x08(t):
    raw = t.part.select(F.col("p_partkey").alias("SKU [item_id]"),
                        F.col("p_retailprice").cast("decimal(18,2)").alias("List Price"),
                        F.col("p_size").alias("_c3"))
    return (raw.transform(c.drop_unnamed_columns).transform(c.standardize_columns)
            .transform(c.lower_columns).transform(c.decimals_to_double))


@query("x10_model_files", """
SELECT CAST(p_partkey AS STRING) AS "SKU", p_brand AS "MKT Tree", 'Model' AS source_type, '2024-01-09' AS ingestion_date,
  CASE WHEN p_size > 45 THEN '2024-01-02' ELSE '2024-01-01' END AS modified FROM part
UNION ALL SELECT CAST(p_partkey AS STRING), p_type, 'EPREL Tree', '2024-01-09', NULL FROM part
""")
def x10(t):
    """Overview and class files, written as the delivery has them and read back."""
    files = t.scratch("model")
    overview = t.part.select(
        F.col("p_partkey").alias("SKU [item_id]"), F.col("p_brand").alias("MKT Tree"),
        F.col("p_name").alias("Name"), F.explode(F.when(
            F.col("p_size") > 45, F.array(F.lit("2024-01-02"), F.lit("2024-01-01")))
            .otherwise(F.array(F.lit("2024-01-01")))).alias("Date Last Modify [last_mod_date]"))
    overview.write.csv(f"{files}/overview", header=True, sep="||")
    classes = t.part.select(
        F.col("p_partkey").alias("SKU"), F.col("p_type").alias("ClassID"), "p_size")
    classes.write.csv(f"{files}/class", header=True, sep="||")
    first = overview_rows(read_csv(t.spark, f"{files}/overview", "||"), "Model", "2024-01-09")
    modified = F.get_json_object("payload", "$.Date_Last_Modify")
    second = class_rows(read_csv(t.spark, f"{files}/class", "||"), "EPREL Tree", "2024-01-09")
    return first.select("SKU", "MKT Tree", "source_type", "ingestion_date",
                        modified.alias("modified")).unionByName(
        second.select("SKU", F.col("ClassID").alias("MKT Tree"),
                      F.col("tree_name").alias("source_type"), "ingestion_date",
                      F.lit(None).cast("string").alias("modified")))
