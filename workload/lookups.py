"""J: lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.functions.dates import day
from saleweft.functions.text import make_key, strict_key
from saleweft.operators import joins as j
from saleweft.operators import lookup as lk
from saleweft.operators.windows import intervals_from_cutoffs
from saleweft.plans.calendar import fiscal_calendar
from saleweft.plans.prices import open_conditions, prices

from .registry import query

AS_OF = "1998-08-15"


@query("j01_checked_lookup", """
SELECT vbeln, auart, CASE WHEN m.bsark IS NULL THEN 'none' ELSE m.text END AS source_text,
  CASE WHEN r.route IS NULL THEN 'no route' ELSE r.text END AS route_text
FROM vbak LEFT JOIN source_texts m ON vbak.bsark = m.bsark
LEFT JOIN routes r ON 'R' || CAST(CAST(vbeln AS BIGINT) % 30 AS STRING) = r.route
""")
def j01(t):
    route = F.concat(F.lit("R"), (F.col("vbeln").cast("bigint") % 30).cast("string"))
    return (
        t.vbak.transform(lk.checked_lookup, t.source_texts, "bsark", "source_text", F.lit("none"))
        .transform(lk.checked_lookup, t.routes, route, "route_text", F.lit("no route"))
        .select("vbeln", "auart", "source_text", "route_text")
    )


@query("j02_two_step_lookup", """
SELECT c_custkey, CASE WHEN r.r_regionkey IS NULL THEN 'Not Defined' ELSE r.r_name END AS region
FROM customer LEFT JOIN nation n ON c_nationkey = n.n_nationkey
LEFT JOIN (SELECT CASE WHEN r_name = 'ASIA' THEN 99 ELSE r_regionkey END AS r_regionkey, r_name FROM region) r ON n.n_regionkey = r.r_regionkey
""")
def j02(t):
    return t.customer.transform(
        lk.two_step_lookup, t.nation.select("n_nationkey", "n_regionkey"),
        t.region.select(F.when(F.col("r_name") == "ASIA", 99).otherwise(F.col("r_regionkey")).alias("r_regionkey"), "r_name"),
        "c_nationkey", "region", F.lit(fixed.NOT_DEFINED),
    ).select("c_custkey", "region")


CALENDAR_SQL = """
intervals AS (SELECT month, cutoff_date, coalesce(CAST(lag(cutoff_date) OVER (ORDER BY cutoff_date) + 1 AS DATE), DATE '2000-01-01') AS start_date FROM cutoffs),
spans AS (SELECT month, start_date, cutoff_date FROM intervals WHERE start_date <= cutoff_date)
"""


@query("j03_lookup_on_expression", f"""
WITH {CALENDAR_SQL},
today AS (SELECT CAST(max(month) AS STRING) AS month FROM spans WHERE DATE '1998-08-15' BETWEEN start_date AND cutoff_date)
SELECT vbeln, coalesce(y.exchange_value, 1.0e0) AS exchange,
  coalesce(today.month, '1998-08-15') AS time_id
FROM vbak LEFT JOIN company_currency c ON vbak.vkorg = c.company
LEFT JOIN yearly_rates y ON coalesce(c.currency, 'EUR') || '|' || CAST(year(audat) AS STRING) = y.key_currency, today
""", "exchange")
def j03(t):
    calendar = fiscal_calendar(t.cutoffs).select("day", "month")
    time = lk.constant_lookup(calendar, day(AS_OF), day(AS_OF))
    key = strict_key("|", "currency", F.year("audat"))
    return (
        t.vbak.transform(lk.checked_lookup, t.company_currency, "vkorg", "currency", F.lit("EUR"))
        .transform(lk.checked_lookup, t.yearly_rates, key, "exchange", F.lit(1.0))
        .select("vbeln", "exchange", time.cast("string").alias("time_id"))
    )


@query("j04_inverse_rate", """
SELECT vbeln, CASE WHEN y.key_currency IS NULL THEN 1.0e0 WHEN y.exchange_value = 1 THEN 1.0e0
  ELSE 1 / y.exchange_value END AS exchange_to_local
FROM vbak LEFT JOIN company_currency c ON vbak.vkorg = c.company
LEFT JOIN yearly_rates y ON coalesce(c.currency, 'EUR') || '|' || CAST(year(audat) AS STRING) = y.key_currency
""", "exchange_to_local")
def j04(t):
    key = strict_key("|", "currency", F.year("audat"))
    return (
        t.vbak.transform(lk.checked_lookup, t.company_currency, "vkorg", "currency", F.lit("EUR"))
        .transform(lk.checked_lookup, lk.inverse_rates(t.yearly_rates), key, "exchange_to_local",
                   F.lit(1.0))
        .select("vbeln", "exchange_to_local")
    )


@query("j05_inner_join", """
SELECT a.vbeln, a.posnr, a.kwmeng, h.auart, b.vmeng FROM vbap a JOIN vbak h ON a.vbeln = h.vbeln
JOIN vbbe b ON a.vbeln = b.vbeln AND a.posnr = b.posnr
""", "kwmeng vmeng")
def j05(t):
    return (
        t.vbap.join(t.vbak.select("vbeln", "auart"), ["vbeln"], "inner")
        .join(t.vbbe.select("vbeln", "posnr", "vmeng"), ["vbeln", "posnr"], "inner")
        .select("vbeln", "posnr", "kwmeng", "auart", "vmeng")
    )


@query("j06_left_join", """
SELECT a.vbeln, a.posnr, CAST(e.edatu AS STRING) AS edatu, p.vmeng FROM vbap a
LEFT JOIN vbep e ON a.vbeln = e.vbeln AND a.posnr = e.posnr AND e.etenr = '0001'
LEFT JOIN (SELECT vbeln, posnr, etenr, lgort, sum(vmeng) AS vmeng FROM vbbe GROUP BY ALL) p
  ON a.vbeln = p.vbeln AND a.posnr = p.posnr AND e.etenr = p.etenr AND a.lgort = p.lgort
""", "vmeng")
def j06(t):
    first = t.vbep.where("etenr = '0001'").select("vbeln", "posnr", "etenr", "edatu")
    confirmed = t.vbbe.groupBy("vbeln", "posnr", "etenr", "lgort").agg(
        F.sum("vmeng").alias("vmeng"))
    return (
        t.vbap.select("vbeln", "posnr", "lgort").join(first, ["vbeln", "posnr"], "left")
        .join(confirmed, ["vbeln", "posnr", "etenr", "lgort"], "left")
        .select("vbeln", "posnr", F.col("edatu").cast("string").alias("edatu"), "vmeng")
    )


@query("j07_right_join", """
SELECT i.vbeln, i.posnr, CAST(h.kodat AS STRING) AS kodat
FROM (SELECT * FROM likp WHERE wadat_ist IS NOT NULL) h RIGHT JOIN lips i ON h.vbeln = i.vbeln
""")
def j07(t):
    issued = t.likp.where("wadat_ist is not null").select("vbeln", "kodat")
    return issued.join(t.lips.select("vbeln", "posnr"), ["vbeln"], "right").select(
        "vbeln", "posnr", F.col("kodat").cast("string").alias("kodat"))


NEEDED = """needed AS (SELECT DISTINCT lpad(CAST(l_partkey AS STRING), 8, '0') AS product_code,
  CAST(year(l_shipdate) AS INT) AS year FROM lineitem)"""


def needed_years(t):
    return t.lineitem.select(
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("product_code"),
        F.year("l_shipdate").alias("year")).distinct()


@query("j08_needed_keys", f"""
WITH {NEEDED}, known AS (SELECT product_code, year, tca FROM indefinite WHERE currency = 'EUR')
SELECT coalesce(k.product_code, n.product_code) AS product_code,
  CAST(coalesce(k.year, n.year) AS INT) AS year, tca
FROM known k FULL JOIN needed n ON k.product_code = n.product_code AND k.year = n.year
""", "tca")
def j08(t):
    known = t.indefinite.where("currency = 'EUR'").select("product_code", "year", "tca")
    return known.transform(j.with_needed_keys, needed_years(t), ["product_code", "year"])


@query("j09_semi_join", """
SELECT vbeln, posnr, lfimg FROM lips
WHERE vbeln IN (SELECT vbeln FROM likp WHERE wadat_ist IS NOT NULL)
""", "lfimg")
def j09(t):
    issued = t.likp.where("wadat_ist is not null")
    return j.semi(t.lips, issued, ["vbeln"]).select("vbeln", "posnr", "lfimg")


@query("j10_anti_join", """
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')
""")
def j10(t):
    returned = t.lineitem.where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return j.anti(t.orders, returned, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("j11_latest_per_key", """
SELECT account, product_code, years, ingestion_date, beg_balance FROM cost_export c
WHERE ingestion_date = (SELECT max(ingestion_date) FROM cost_export x
  WHERE x.years = c.years AND x.product_code = c.product_code)
""", "beg_balance")
def j11(t):
    return t.cost_export.transform(
        j.latest_per_key, ["years", "product_code"], "ingestion_date",
    ).select("account", "product_code", "years", "ingestion_date", "beg_balance")


@query("j12_latest_global", """
SELECT o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS STRING) AS o_orderdate
FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
""", "o_totalprice")
def j12(t):
    return j.latest_global(t.orders, "o_orderdate").select(
        "o_orderkey", "o_totalprice",
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"))


@query("j13_partial_match", """
WITH items AS (SELECT a.vbeln, posnr, vkorg, vkbur, coalesce(l.line_code, '999') AS line
  FROM vbap a JOIN vbak h ON a.vbeln = h.vbeln LEFT JOIN product_lines l ON a.matnr = l.product_code)
SELECT vbeln, posnr, i.line, r.company, r.network, r.market FROM items i
LEFT JOIN market_rules r ON i.vkorg = r.sales_organization AND i.vkbur = r.sales_office
  AND (r.line = i.line OR r.line IS NULL)
""")
def j13(t):
    items = t.vbap.join(t.vbak.select("vbeln", "vkorg", "vkbur"), ["vbeln"], "inner").transform(
        lk.checked_lookup, t.product_lines, "matnr", "line", F.lit(fixed.DEFAULT_LINE))
    keys = {"vkorg": "sales_organization", "vkbur": "sales_office"}
    rules = t.market_rules.withColumnRenamed("line", "rule_line")
    return items.transform(j.partial_match, rules, keys, ("line", "rule_line")).select(
        "vbeln", "posnr", "line", "company", "network", "market")


@query("j14_interval_lookup", f"""
WITH {CALENDAR_SQL}
SELECT o_orderkey, CAST(month AS STRING) AS fiscal_month FROM orders
LEFT JOIN spans ON CAST(o_orderdate AS DATE) BETWEEN start_date AND cutoff_date
""".replace("DATE '2000-01-01'", "DATE '1995-01-01'"))
def j14(t):
    spans = intervals_from_cutoffs(t.cutoffs, "cutoff_date", "1995-01-01")
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))
    return orders.transform(
        j.interval_lookup, "ordered", spans, "start_date", "cutoff_date", "month", "fiscal_month",
    ).select("o_orderkey", F.col("fiscal_month").cast("string").alias("fiscal_month"))


@query("j15_drop_superseded", """
SELECT b.l_orderkey, b.l_partkey, CAST(CAST(b.l_shipdate AS DATE) AS STRING) AS l_shipdate FROM lineitem b
WHERE l_linestatus = 'O' AND NOT EXISTS (SELECT 1 FROM (SELECT l_partkey, max(l_shipdate) AS last
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_partkey) d
  WHERE d.l_partkey = b.l_partkey AND b.l_shipdate <= d.last)
""")
def j15(t):
    bulk = t.lineitem.where("l_linestatus = 'O'")
    delta = t.lineitem.where("l_linestatus = 'F'")
    return bulk.transform(j.drop_superseded, delta, ["l_partkey"], "l_shipdate").select(
        "l_orderkey", "l_partkey",
        F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"))


@query("j16_date_spine", """
SELECT m.c_mktsegment, CAST(CAST(d AS DATE) AS STRING) AS day
FROM (SELECT DISTINCT c_mktsegment FROM customer) m,
  (SELECT unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events),
    (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS d) days
""")
def j16(t):
    days = t.events.select(F.col("ts").cast("date").alias("d"))
    first, last = days.agg(F.min("d")).scalar(), days.agg(F.max("d")).scalar()
    return j.date_spine(t.customer, "c_mktsegment", first, last, "day").select(
        "c_mktsegment", F.col("day").cast("string").alias("day"))


@query("j17_semi_on_expression", """
SELECT objectid, changenr, fname FROM cdpos WHERE objectid || '|' || changenr IN
  (SELECT objectid || '|' || max(changenr) FROM cdhdr GROUP BY objectid)
""")
def j17(t):
    last = t.cdhdr.groupBy("objectid").agg(F.max("changenr").alias("changenr")).select(
        make_key("|", "objectid", "changenr").alias("last"))
    return t.cdpos.transform(
        j.semi_on_expr, last, make_key("|", "objectid", "changenr"), "last",
    ).select("objectid", "changenr", "fname")


@query("j18_role_lookup", """
SELECT account, product_code, years, o.sales_office, c.sales_office AS client_sales_office
FROM (SELECT *, lpad(split_part(organization, '_', 1), 2, '0') AS company,
  lpad(split_part(organization, '_', 2), 2, '0') AS network,
  lpad(split_part(client, '_', 2), 2, '0') AS client_company,
  lpad(split_part(client, '_', 3), 2, '0') AS client_network FROM cost_export) e
LEFT JOIN company_network o ON e.company = o.company AND e.network = o.network
LEFT JOIN company_network c ON e.client_company = c.company AND e.client_network = c.network
""")
def j18(t):
    from saleweft.plans.costs import unit_split

    company, network = unit_split("organization", 0, 1)
    client_company, client_network = unit_split("client", 1, 2)
    named = t.cost_export.withColumns({
        "company": company, "network": network, "client_company": client_company,
        "client_network": client_network})
    return (
        named.join(t.company_network, ["company", "network"], "left")
        .transform(j.role_lookup, t.company_network, ["company", "network"], "client_")
        .select("account", "product_code", "years", "sales_office", "client_sales_office")
    )


ROLE_CODES = {"dest_id": "SP", "inv_id": "BP", "purchase_group_code": "ZC", "main_group_code": "ZD",
              "super_group_code": "ZE", "sale_zone_code": "YB", "salesman_code": "YD",
              "sale_director_code": "YA", "rsm_code": "YC"}
BLANK_FALLS_BACK = ["inv_id", "purchase_group_code", "main_group_code", "super_group_code", "salesman_code"]
PER_ROLE = ", ".join(f"max(CASE WHEN parvw = '{code}' THEN kunnr END) AS {target}" for target, code in ROLE_CODES.items())
PARTNERS_SQL = f"""LEFT JOIN (SELECT vbeln, posnr, {PER_ROLE} FROM vbpa GROUP BY 1, 2) i ON a.vbeln = i.vbeln AND a.posnr = i.posnr
LEFT JOIN (SELECT vbeln, {PER_ROLE} FROM vbpa WHERE posnr = '000000' GROUP BY 1) h ON a.vbeln = h.vbeln"""
PARTNER_COLUMNS = ", ".join(
    (f"CASE WHEN i.{t} IS NULL OR trim(i.{t}) = '' THEN h.{t} ELSE i.{t} END" if t in BLANK_FALLS_BACK
     else f"coalesce(i.{t}, h.{t})") + f" AS {t}" for t in ROLE_CODES)


@query("j19_partner_roles", f"""
SELECT a.vbeln AS order_number, a.posnr AS order_line, {PARTNER_COLUMNS} FROM vbap a {PARTNERS_SQL}
""")
def j19(t):
    lines = t.vbap.select(F.col("vbeln").alias("order_number"), F.col("posnr").alias("order_line"))
    return lines.transform(j.with_partners, t.vbpa)


CANCEL_SQL = """docs AS (SELECT k.vbeln AS document_code, posnr, sfakn AS cancelled_invoice,
  CAST(CASE fkart WHEN 'ZRE' THEN 7 WHEN 'ZG2' THEN 6 WHEN 'ZL2' THEN 5 WHEN 'ZL3' THEN 14
    WHEN 'ZF2' THEN 4 END AS INT) AS doc_type_code_orig
  FROM vbrk k JOIN vbrp p ON k.vbeln = p.vbeln),
known AS (SELECT document_code, max(doc_type_code_orig) AS doc_type_code_cancelled FROM docs GROUP BY 1)"""


@query("j20_cancelled_lookup", f"""
WITH {CANCEL_SQL}
SELECT d.document_code, posnr, CAST(coalesce(doc_type_code_cancelled, doc_type_code_orig) AS DOUBLE) AS doc_type_code,
  CAST(CASE WHEN k.document_code IS NOT NULL THEN 1 END AS DOUBLE) AS flag_cancelled_invoice_valid
FROM docs d LEFT JOIN known k ON d.cancelled_invoice = k.document_code
WHERE coalesce(cancelled_invoice, '') = '' OR k.document_code IS NOT NULL
""")
def j20(t):
    docs = t.vbrk.join(t.vbrp.select("vbeln", "posnr"), ["vbeln"], "inner").select(
        F.col("vbeln").alias("document_code"), "posnr",
        F.col("sfakn").alias("cancelled_invoice"),
        lk.literal_lookup("fkart", fixed.INVOICE_TYPE).alias("doc_type_code_orig"))
    return docs.transform(j.cancelled_lookup).select(
        "document_code", "posnr", F.col("doc_type_code").cast("double").alias("doc_type_code"),
        F.col("flag_cancelled_invoice_valid").cast("double").alias("flag_cancelled_invoice_valid"))


@query("j21_base_attributes", """
SELECT p.p_partkey, b.p_name AS base_name, b.p_retailprice AS base_price
FROM part p LEFT JOIN part b ON p.p_partkey - p.p_partkey % 10 = b.p_partkey AND p.p_partkey % 10 <> 0
""", "base_price")
def j21(t):
    base = F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey") - F.col("p_partkey") % 10)
    return t.part.withColumn("base_key", base).transform(
        j.base_attributes, "p_partkey", "base_key",
        {"p_name": "base_name", "p_retailprice": "base_price"},
    ).select("p_partkey", "base_name", "base_price")


@query("j22_reassemble", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'sap' ELSE 'cas' END AS source,
  CAST(o_orderkey AS STRING) AS key_fact, o_totalprice, o_orderpriority,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS erp_status,
  CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_custkey AS DOUBLE) END AS legacy_customer FROM orders
""", "o_totalprice")
def j22(t):
    keyed = t.orders.withColumns({
        "key_fact": F.col("o_orderkey").cast("string"),
        "source": F.when(F.col("o_orderkey") % 2 == 0, F.lit("sap")).otherwise(F.lit("cas"))})
    fact = keyed.select("source", "key_fact", "o_totalprice")
    erp = keyed.where("source = 'sap'").select(
        "key_fact", "o_orderpriority", F.col("o_orderstatus").alias("erp_status"))
    legacy = keyed.where("source = 'cas'").select(
        "key_fact", "o_orderpriority", F.col("o_custkey").cast("double").alias("legacy_customer"))
    return fact.transform(j.reassemble, {"sap": erp, "cas": legacy})


@query("j23_change_log", """
SELECT i.objectid, i.changenr, fname, value_new, username, CAST(udate AS STRING) AS udate
FROM cdpos i JOIN cdhdr h ON i.objectclas = h.objectclas AND i.objectid = h.objectid AND i.changenr = h.changenr
""")
def j23(t):
    return j.join_change_log(t.cdhdr, t.cdpos).select(
        "objectid", "changenr", "fname", "value_new", "username",
        F.col("udate").cast("string").alias("udate"))


@query("j24_sql_left_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_type AS product_type FROM lineitem a
LEFT JOIN (SELECT CASE WHEN p_size > 10 THEN p_partkey ELSE -p_partkey END AS p_partkey, p_type FROM part) b ON a.l_partkey = b.p_partkey
""", "l_quantity")
def j24(t):
    """All parts, some under another key, so that some lines find none."""
    key = F.when(F.col("p_size") > 10, F.col("p_partkey")).otherwise(-F.col("p_partkey"))
    return t.spark.sql("""
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_type AS product_type
        FROM {facts} a LEFT JOIN {types} b ON a.l_partkey = b.p_partkey
    """, facts=t.lineitem, types=t.part.select(key.alias("p_partkey"), "p_type"))


SLICES = {"vat": "MWST", "nsv": "ZNSV", "gsv": "ZTTV", "list": "ZNET", "fee": "ZFEE", "raee": "ZWEE",
          "disc": "ZCDS", "forced": "PB00"}
SLICE_JOINS = "".join(
    f"LEFT JOIN (SELECT knumv, kposn, kwert, kkurs FROM prcd WHERE kschl = '{code}') {name} "
    f"ON b.knumv = {name}.knumv AND b.kposn = {name}.kposn "
    for name, code in SLICES.items())
RATE = "CASE WHEN {0}.kkurs < 0 THEN 1 / abs({0}.kkurs) ELSE {0}.kkurs END"


@query("j25_enrichment_slices", f"""
SELECT b.knumv || '|' || b.kposn AS price_key, vat.kwert AS vat_amount_1_tot,
  nsv.kwert * {RATE.format('nsv')} AS ord_nsv_lc_tot, gsv.kwert * {RATE.format('gsv')} AS ord_gsv_lc_tot,
  list.kwert * {RATE.format('list')} AS list_price_tot, fee.kwert * {RATE.format('fee')} AS removable_charges_tot,
  raee.kwert AS ord_raee_lc, disc.kwert AS ord_ic_discount, forced.kwert * {RATE.format('forced')} AS forced_price_tot
FROM (SELECT DISTINCT knumv, kposn FROM prcd) b {SLICE_JOINS}
""", "vat_amount_1_tot ord_nsv_lc_tot ord_gsv_lc_tot list_price_tot removable_charges_tot ord_raee_lc "
     "ord_ic_discount forced_price_tot")
def j25(t):
    return prices(t.prcd, open_conditions("ord")).select(
        "price_key", "vat_amount_1_tot", "ord_nsv_lc_tot", "ord_gsv_lc_tot", "list_price_tot",
        "removable_charges_tot", "ord_raee_lc", "ord_ic_discount", "forced_price_tot")
