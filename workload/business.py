"""B: business plans over whole source tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.operators.columns import add_missing_columns
from saleweft.operators.aggregate import characteristic_pivot
from saleweft.operators.joins import with_partners
from saleweft.operators.lookup import checked_lookup
from saleweft.operators.quality import settle_unique
from saleweft.operators.sets import union_all
from saleweft.plans import analysis, blocks, calendar, costs, deliveries, dimensions, forecast
from saleweft.plans import invoices, legacy, market, master, orders, portfolio, prices
from saleweft.plans import reassembly, segments
from saleweft.sources import readers, writers

from . import measures as ms
from .lookups import CALENDAR_SQL, PARTNERS_SQL, PARTNER_COLUMNS
from .registry import query

AS_OF = "1998-08-15"


def text_dates(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- orders: quantities and status ---------------------------------------------------

PROGRESS = """progress AS (SELECT vgbel, vgpos, sum(CASE WHEN wadat_ist IS NOT NULL THEN lfimg ELSE 0 END) AS del_qty,
    sum(CASE WHEN wadat_ist IS NULL THEN lfimg ELSE 0 END) AS picking_qty, max(zzdate_slot) AS slot
  FROM lips LEFT JOIN likp USING (vbeln) GROUP BY vgbel, vgpos),
open_all AS (SELECT vbeln, posnr, kwmeng, lgort, abgru, kwmeng - coalesce(del_qty, 0) AS ord_qty, del_qty, picking_qty, slot
  FROM vbap LEFT JOIN progress ON vbeln = vgbel AND posnr = vgpos WHERE kwmeng - coalesce(del_qty, 0) > 0)"""
BLOCKED = "(coalesce(trim(lifsk), '') <> '' OR cmgst IN ('C', 'B'))"
BLOCK_TYPE = """CASE WHEN coalesce(trim(lifsk), '') <> '' THEN 'Delivery Block' WHEN faksk = 'C' THEN 'Billing Block'
  WHEN cmgst IN ('C', 'B') THEN 'Credit Block' END"""
VALID = """valid AS (SELECT vbeln FROM vbak WHERE (auart IN (SELECT auart FROM tvak WHERE vbtyp IN ('C', 'K', 'L', 'H')) OR auart = 'Z23')
  AND auart NOT IN ('ZKL', 'ZFOC', 'YFOC', 'ZWBF', 'ZWPC', 'ZWPR'))"""
CONFIRMED = """sched AS (SELECT vbeln, posnr, etenr, lgort, sum(vmeng) AS qty FROM vbbe WHERE vmeng > 0 GROUP BY ALL),
conf AS (SELECT vbeln, posnr, sum(qty) AS qty_confirmed FROM sched GROUP BY ALL)"""
STATUS = f"""{PROGRESS}, {VALID}, {CONFIRMED},
open_lines AS (SELECT o.*, qty_confirmed, coalesce({BLOCKED}, false) AS blocked FROM open_all o JOIN vbak h ON o.vbeln = h.vbeln
  LEFT JOIN conf c ON o.vbeln = c.vbeln AND o.posnr = c.posnr WHERE o.vbeln IN (SELECT vbeln FROM valid) AND abgru IS NULL),
status AS (SELECT DISTINCT order_number, order_line, order_status, ord_qty_fabs, ord_qty_orig, ord_qty_fabs / ord_qty_orig AS pct_ord_qty,
    booking_slot_delivery, schedule_line, allocation_warehouse, confirmed_date, confirmed_time, planned_dispatch_date FROM (
  SELECT vbeln AS order_number, posnr AS order_line, 'Blocked' AS order_status, ord_qty AS ord_qty_fabs, kwmeng AS ord_qty_orig,
    CAST(NULL AS DATE) AS booking_slot_delivery, CAST(NULL AS STRING) AS schedule_line, CAST(NULL AS STRING) AS allocation_warehouse,
    CAST(NULL AS DATE) AS confirmed_date, CAST(NULL AS STRING) AS confirmed_time, CAST(NULL AS DATE) AS planned_dispatch_date FROM open_lines WHERE blocked
  UNION ALL SELECT vbeln, posnr, 'In Picking', picking_qty, kwmeng, slot, NULL, NULL, NULL, NULL, NULL FROM open_lines WHERE NOT blocked
  UNION ALL SELECT vbeln, posnr, 'Not Deliverables', ord_qty - coalesce(picking_qty, 0) - coalesce(qty_confirmed, 0), kwmeng, NULL, NULL, NULL, NULL, NULL, NULL
    FROM open_lines WHERE NOT blocked
  UNION ALL SELECT s.vbeln, s.posnr, 'Confirmed SAP', s.qty, l.kwmeng, NULL, s.etenr, s.lgort, e.edatu, e.ezeit, e.tddat
    FROM sched s JOIN open_lines l ON s.vbeln = l.vbeln AND s.posnr = l.posnr AND NOT l.blocked
    LEFT JOIN (SELECT DISTINCT vbeln, posnr, etenr, edatu, ezeit, tddat FROM vbep) e ON s.vbeln = e.vbeln AND s.posnr = e.posnr AND s.etenr = e.etenr
  ) u WHERE ord_qty_fabs > 0)"""


def order_tables(t):
    return orders.OrderTables(t.vbak, t.vbap, t.lips, t.likp, t.vbbe, t.vbep, t.tvak)


@query("b01_open_quantity", f"WITH {PROGRESS} SELECT vbeln AS order_number, posnr AS order_line, kwmeng AS ord_qty_orig, ord_qty FROM open_all",
       "ord_qty_orig ord_qty")
def b01(t):
    progress = orders.delivery_progress(t.lips, t.likp)
    return orders.open_quantity(t.vbap, progress).select(
        "order_number", "order_line", "ord_qty_orig", "ord_qty")


@query("b02_blocking", f"SELECT vbeln AS order_number, coalesce({BLOCKED}, false) AS blocked, {BLOCK_TYPE} AS blocking_type FROM vbak")
def b02(t):
    return orders.blocking(t.vbak)


@query("b03_valid_orders", f"WITH {VALID} SELECT vbeln AS order_number FROM valid")
def b03(t):
    return orders.valid_orders(t.vbak, orders.order_types(t.tvak))


@query("b04_picking_delivered", f"""
WITH {PROGRESS} SELECT vgbel AS order_number, vgpos AS order_line, del_qty, picking_qty, CAST(slot AS STRING) AS booking_slot_delivery FROM progress
""", "del_qty picking_qty")
def b04(t):
    return text_dates(orders.delivery_progress(t.lips, t.likp), "booking_slot_delivery")


@query("b05_confirmed", f"""
WITH {CONFIRMED} SELECT vbeln AS order_number, posnr AS order_line, etenr AS schedule_line, lgort AS allocation_warehouse, qty AS qty_confirmed FROM sched
UNION ALL SELECT vbeln, posnr, NULL, NULL, qty_confirmed FROM conf
""", "qty_confirmed")
def b05(t):
    by_schedule = orders.confirmed_by_schedule(t.vbbe)
    return union_all([by_schedule, orders.confirmed_by_line(by_schedule)])


@query("b06_order_status", f"""
WITH {STATUS} SELECT order_number, order_line, order_status, schedule_line, allocation_warehouse, ord_qty_fabs, ord_qty_orig, pct_ord_qty,
  CAST(booking_slot_delivery AS STRING) AS booking_slot_delivery, CAST(confirmed_date AS STRING) AS confirmed_date, confirmed_time FROM status
""", "ord_qty_fabs ord_qty_orig pct_ord_qty")
def b06(t):
    return text_dates(orders.order_status(order_tables(t)), "booking_slot_delivery",
                      "confirmed_date").drop("planned_dispatch_date")


# --- orders: enrichment --------------------------------------------------------------

ORDER_KIND = "CASE vbtyp WHEN 'B' THEN 4 WHEN 'C' THEN 4 WHEN 'L' THEN 5 WHEN 'K' THEN 6 WHEN 'H' THEN 7 END"
ORDER_SIGN = "CASE vbtyp WHEN 'C' THEN 1 WHEN 'L' THEN 1 WHEN 'B' THEN 1 WHEN 'K' THEN -1 WHEN 'H' THEN -1 END"
HEADERS = f"""{CALENDAR_SQL},
today AS (SELECT coalesce(max(month), DATE '1998-08-15') AS time_id FROM spans WHERE DATE '1998-08-15' BETWEEN start_date AND cutoff_date),
heads AS (SELECT h.vbeln AS order_number, auart AS order_type_code, t.bezei AS order_type_descr, CAST(time_id AS DATE) AS document_date,
    CASE WHEN r.order_reason IS NULL THEN 'Not Defined' ELSE r.cause END AS return_reason,
    CASE WHEN r.order_reason IS NULL THEN 'Not Defined' ELSE r.motive_descr END AS return_reason_descr,
    CAST(vdatu AS DATE) AS requested_delivery_date, strftime(vdatu, '%b') AS requested_delivery_month, lifsk || ' ' || faksk AS order_blocking_descr,
    vtweg AS distr_channel, vkorg AS sales_organization, vkbur AS sales_office, spart AS division, b.text AS block_delivery_text,
    {ORDER_KIND} AS doc_type_code, c.text AS doc_type_descr, knumv, {ORDER_SIGN} AS return_sign, vbtyp AS category, s.text AS order_source_descr,
    CASE WHEN auart = 'ZBGR' THEN 0 ELSE 1 END AS flag_bgrade, CASE WHEN auart = 'ZBGR' THEN 'B' ELSE 'A' END AS ab_grade, {BLOCK_TYPE} AS blocking_type,
    CASE WHEN auart IN ('ZKA', 'ZKB', 'ZKE', 'ZKR') THEN 'No' ELSE 'Yes' END AS old_perimeter
  FROM vbak h LEFT JOIN (SELECT auart, bezei FROM tvakt WHERE spras = 'EN') t USING (auart)
  LEFT JOIN return_reasons r ON r.order_reason = CASE WHEN {ORDER_KIND} = 7 OR auart IN ('ZREB', 'ZREG') THEN augru END
  LEFT JOIN block_texts b USING (lifsk) LEFT JOIN category_texts c USING (vbtyp) LEFT JOIN source_texts s USING (bsark), today)"""
ITEMS = """goods AS (SELECT vbeln AS order_number, posnr AS order_line, matnr AS product_code, a.text AS area_descr, r.text AS routing_descr, pstyv,
  werks AS plant, coalesce(zzso_bookdate, zzso_pbsdate) AS booking_slot_item FROM vbap LEFT JOIN areas a USING (zzlarea) LEFT JOIN routes r USING (route))"""


def texts(t):
    reasons = t.return_reasons
    return orders.Texts(
        order_type=t.tvakt.where("spras = 'EN'").select("auart", "bezei"),
        return_cause=reasons.select("order_reason", "cause"),
        return_text=reasons.select("order_reason", "motive_descr"),
        delivery_block=t.block_texts, category=t.category_texts, order_source=t.source_texts)


def headers(t):
    days = calendar.fiscal_calendar(t.cutoffs).select("day", "month")
    return orders.enrich_headers(t.vbak, texts(t), days, AS_OF)


def items(t):
    return orders.enrich_items(t.vbap, t.areas, t.routes)


HEADER_COLUMNS = ["order_type_code", "order_type_descr", "return_reason", "return_reason_descr",
                  "requested_delivery_month", "order_blocking_descr", "division",
                  "block_delivery_text", "doc_type_descr", "category", "order_source_descr",
                  "ab_grade", "blocking_type", "old_perimeter"]


@query("b07_enrich_orders", f"""
WITH {STATUS}, {HEADERS}, {ITEMS}
SELECT order_number, order_line, order_status, {', '.join(HEADER_COLUMNS)}, CAST(document_date AS STRING) AS document_date,
  CAST(doc_type_code AS DOUBLE) AS doc_type_code, CAST(return_sign AS DOUBLE) AS return_sign, product_code, area_descr, routing_descr,
  CAST(booking_slot_item AS STRING) AS booking_slot_item
FROM status LEFT JOIN heads USING (order_number) LEFT JOIN goods USING (order_number, order_line) WHERE division <> 'SE'
""")
def b07(t):
    lines = orders.order_status(order_tables(t), by_line=True)
    rows = orders.enrich_orders(lines, headers(t), items(t)).transform(orders.each_status)
    return text_dates(rows, "document_date", "booking_slot_item").select(
        "order_number", "order_line", "order_status", *HEADER_COLUMNS, "document_date",
        F.col("doc_type_code").cast("double").alias("doc_type_code"),
        F.col("return_sign").cast("double").alias("return_sign"), "product_code", "area_descr",
        "routing_descr", "booking_slot_item")


@query("b08_market_of", """
SELECT a.vbeln, posnr, r.company, r.network, r.market FROM vbap a JOIN vbak h ON a.vbeln = h.vbeln
LEFT JOIN product_lines l ON a.matnr = l.product_code LEFT JOIN market_rules r ON vkorg = r.sales_organization
  AND vkbur = r.sales_office AND (r.line = coalesce(l.line_code, '999') OR r.line IS NULL)
""")
def b08(t):
    heads = t.vbak.select("vbeln", F.col("vkorg").alias("sales_organization"), F.col("vkbur").alias("sales_office"))
    rows = t.vbap.select("vbeln", "posnr", F.col("matnr").alias("product_code")).join(heads, ["vbeln"], "inner")
    return market.market_of(rows, t.market_rules, t.product_lines).select(
        "vbeln", "posnr", "company", "network", "market")


@query("b09_partners", f"""
SELECT a.vbeln AS order_number, a.posnr AS order_line, {PARTNER_COLUMNS} FROM lips d JOIN vbap a ON d.vgbel = a.vbeln AND d.vgpos = a.posnr {PARTNERS_SQL}
""")
def b09(t):
    lines = t.lips.select(F.col("vgbel").alias("order_number"), F.col("vgpos").alias("order_line"))
    return with_partners(lines, t.vbpa)


@query("b10_signed_quantity", f"""
WITH {STATUS}, {HEADERS}, rows AS (SELECT * FROM status LEFT JOIN heads USING (order_number))
SELECT order_number, order_line, order_status, schedule_line, allocation_warehouse, {ms.ORD_QTY} AS ord_qty, {ms.ORD_CONS} AS ord_qty_consignment FROM rows
""", "ord_qty ord_qty_consignment")
def b10(t):
    from saleweft.plans.measures import order_quantities

    rows = orders.order_status(order_tables(t)).join(headers(t), ["order_number"], "left")
    return order_quantities(rows).select(
        "order_number", "order_line", "order_status", "schedule_line", "allocation_warehouse",
        "ord_qty", "ord_qty_consignment")


# --- prices and costs -----------------------------------------------------------------


@query("b11_price_conditions", """
WITH newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, knumv, kposn, stunr, zaehk ORDER BY deltadate DESC) AS rn
    FROM prcd_source WHERE kschl NOT IN ('ZFR2', 'ZXXX')) x WHERE rn = 1),
merged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY knumv, kposn, kschl ORDER BY zaehk DESC, source) AS place FROM newest) y WHERE place = 1),
rated AS (SELECT m.*, coalesce(r.rate, kkurs) AS rate FROM merged m LEFT JOIN (
  SELECT '00' || substring(k.knumv, 3, 8) AS knumv, CASE WHEN starts_with(exchange_rate_text, '/') THEN 1 / CAST(replace(replace(exchange_rate_text, '/', ''), ',', '.') AS DOUBLE)
    ELSE CAST(replace(exchange_rate_text, ',', '.') AS DOUBLE) END AS rate
  FROM corrected_rate_texts c JOIN vbrk k ON company_code = k.vkorg AND billing_document = k.vbeln) r ON m.knumv = r.knumv)
SELECT knumv, kposn, kschl, zaehk, source, kwert, rate AS kkurs FROM rated
""", "kwert kkurs")
def b11(t):
    sources = [t.prcd_source.where(F.col("source") == s) for s in (1, 2, 3)]
    documents = t.vbrk.select("vkorg", "vbeln", F.concat(F.lit("00"), F.substring("knumv", 3, 8)).alias("knumv"))
    rates = prices.corrected_rates(t.corrected_rate_texts, documents).select("knumv", F.col("exchange_rate").alias("rate"))
    merged = prices.consolidate_conditions(sources)
    return prices.current_conditions(merged, rates).select(
        "knumv", "kposn", "kschl", "zaehk", "source", "kwert", "kkurs")


def fill_sql(name, table, where, keys, period, columns, needed):
    """Common table expressions for one filled cost table."""
    k = ", ".join(keys)
    both = f"{k}, {period}"
    known = ", ".join(f"max({c}) AS {c}" for c in columns)
    step = f"(SELECT {both}, {', '.join(columns)} FROM {name}_known FULL JOIN {name}_needed USING ({both}))"
    if needed is None:
        step = f"{name}_known"
    want = f"{name}_needed AS (SELECT DISTINCT {both} FROM ({needed}) n WHERE " + " AND ".join(
        f"{c} IS NOT NULL" for c in [*keys, period]) + ")," if needed else ""

    def fill(order):
        return ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY {period} {order}) AS {c}"
                         for c in columns)

    key = ", ".join(f"CAST({c} AS STRING)" for c in [*keys, period])
    return f"""{name}_known AS (SELECT {both}, {known} FROM {table} WHERE {where} GROUP BY {both}), {want}
{name}_forward AS (SELECT {both}, {fill('ASC')} FROM {step} e),
{name} AS (SELECT concat_ws('###', {key}) AS cost_key, {fill('DESC')} FROM {name}_forward)"""


UNIT = ["company", "network", "product_code"]


def cost_sql(facts, date):
    year, quarter = f"CAST(year({date}) AS INT)", f"CAST(year({date}) AS STRING) || 'Q' || CAST(quarter({date}) AS STRING)"
    by_unit = f"SELECT company, network, product_code, {year} AS year FROM {facts}"
    by_product = f"SELECT product_code, {year} AS year FROM {facts}"
    by_quarter = f"SELECT product_code, {quarter} AS year_quarter FROM {facts}"
    return ",\n".join([
        fill_sql("c_comm", "transfer_price", "currency = 'EUR' AND tp_commerciale IS NOT NULL", UNIT, "year", ["tp_commerciale"], by_unit),
        fill_sql("c_itcy", "transfer_price", "currency = 'EUR' AND tp_itcy IS NOT NULL", UNIT, "year", ["tp_itcy"], by_unit),
        fill_sql("c_freight", "freight", "true", UNIT, "year", ["freight_in_eur", "transport_cost_infra_eur"], None),
        fill_sql("c_std", "commercial", "currency = 'EUR'", ["product_code"], "year_quarter", ["std_prod_cost_commercial"], by_quarter),
        fill_sql("c_ind", "indefinite", "currency = 'EUR'", ["product_code"], "year", ["std_prod_cost_no_tca", "tca"], by_product),
        f"""costed AS (SELECT f.*, c_comm.tp_commerciale AS comm_cost_unit, c_itcy.tp_itcy AS tp_itcy_unit, freight_in_eur AS freight_in_unit, transport_cost_infra_eur AS infra_unit,
  std_prod_cost_commercial AS std_prod_cost_commercial_unit, std_prod_cost_no_tca AS cons_cost_unit, tca AS tca_unit FROM (SELECT *, concat_ws('###', company, network, product_code, CAST({year} AS STRING)) AS unit_key,
  concat_ws('###', product_code, CAST({year} AS STRING)) AS product_key, concat_ws('###', product_code, {quarter}) AS quarter_key FROM {facts}) f
  LEFT JOIN c_comm ON unit_key = c_comm.cost_key LEFT JOIN c_itcy ON unit_key = c_itcy.cost_key LEFT JOIN c_freight ON unit_key = c_freight.cost_key
  LEFT JOIN c_std ON quarter_key = c_std.cost_key LEFT JOIN c_ind ON product_key = c_ind.cost_key)""",
    ])


def cost_tables(t):
    return {"transfer_price": t.transfer_price, "freight_in": t.freight,
            "commercial": t.commercial, "indefinite": t.indefinite}


COST_COLUMNS = ["comm_cost_unit", "tp_itcy_unit", "freight_in_unit", "infra_unit",
                "std_prod_cost_commercial_unit", "cons_cost_unit", "tca_unit"]


@query("b12_unit_costs", f"""
WITH sold AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS document_date, lpad(CAST(l_partkey AS STRING), 8, '0') AS product_code,
  CASE l_suppkey % 4 WHEN 0 THEN '80' WHEN 1 THEN '07' WHEN 2 THEN '46' END AS company, CASE l_suppkey % 4 WHEN 0 THEN '4' WHEN 1 THEN '2' WHEN 2 THEN '3' END AS network FROM lineitem),
{cost_sql('sold', 'document_date')}
SELECT l_orderkey, l_linenumber, {', '.join(COST_COLUMNS)} FROM costed
""", " ".join(COST_COLUMNS))
def b12(t):
    unit = F.col("l_suppkey") % 4
    sold = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("document_date"),
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("product_code"),
        F.when(unit == 0, "80").when(unit == 1, "07").when(unit == 2, "46").alias("company"),
        F.when(unit == 0, "4").when(unit == 1, "2").when(unit == 2, "3").alias("network"))
    span = costs.span_of(t.lineitem, "l_shipdate")
    return costs.with_unit_costs(sold, cost_tables(t), span).select("l_orderkey", "l_linenumber", *COST_COLUMNS)


@query("b13_market_hierarchy", """
WITH clean AS (SELECT DISTINCT regexp_replace(sales_organization, '[^a-zA-Z0-9]', '', 'g') AS sales_organization, sales_office, lpad(company, 2, '0') AS company, lpad(network, 2, '0') AS network,
  substring(responsible_code1, 3) AS responsible_code1, substring(market_budget, 3) AS market_budget, responsible_descr FROM market_raw),
uk AS (SELECT DISTINCT company, network, responsible_code1, market_budget, responsible_descr FROM clean WHERE company = '80'),
by_line AS (SELECT '66J0' AS sales_organization, sales_office, line, '80' AS company, min(lpad(network, 2, '0')) AS network FROM line_offices GROUP BY sales_office, line)
SELECT l.sales_organization, l.sales_office, l.line, l.company, l.network, u.responsible_code1, u.market_budget, u.responsible_descr FROM by_line l LEFT JOIN uk u USING (company, network)
UNION ALL SELECT sales_organization, sales_office, NULL, company, network, responsible_code1, market_budget, responsible_descr FROM (SELECT *, row_number() OVER (
  PARTITION BY sales_organization, sales_office ORDER BY company, network) AS rn FROM clean c WHERE NOT EXISTS (SELECT 1 FROM by_line b
  WHERE b.sales_organization = c.sales_organization AND b.sales_office = c.sales_office)) x WHERE rn = 1
""")
def b13(t):
    return market.market_hierarchy(t.market_raw, t.line_offices).select(
        "sales_organization", "sales_office", "line", "company", "network", "responsible_code1",
        "market_budget", "responsible_descr")


def customer_maps(t):
    offices = t.customer_offices

    def named(prefix, condition="true"):
        return offices.where(condition).select("vkbur", F.concat(F.lit(prefix), "vkbur").alias("text")).distinct()

    return orders.CustomerMaps(
        sales_group=offices, sales_group_text=named("Group "), type_code=offices, type_level3=offices,
        type_text=named("Type ", "vkbur < 'K500'"), type_level3_text=named("Level ", "vkbur > 'K100'"),
        names=t.customer.select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"), "c_name"))


def delivery_notes(t):
    shipping = deliveries.shipment_types(t.vttp, t.vttk, t.shipping_texts)
    return deliveries.note_texts(t.likp, shipping, deliveries.picking_numbers(t.vbfa), t.delivery_kinds, t.routes)


def fact_tables(t, conditions):
    return orders.FactTables(
        t.vbpa, conditions, t.market_rules, t.product_lines, t.company_currency, t.yearly_rates, cost_tables(t),
        customers=customer_maps(t), block_events=blocks.block_events(t.cdhdr, t.cdpos), notes=delivery_notes(t),
        terms=t.t052, payment_texts=t.t042)


BLOCK_EVENTS = """log AS (SELECT i.objectid, i.changenr, username, CAST(udate AS STRING) AS udate,
  (fname = 'LIFSK' AND trim(value_new) <> '') OR (fname = 'CMGST' AND value_new IN ('B', 'C')) AS blocks,
  (fname = 'LIFSK' AND trim(value_old) <> '') OR (fname = 'CMGST' AND value_old IN ('B', 'C') AND value_new NOT IN ('B', 'C')) AS unblocks
  FROM cdpos i JOIN cdhdr h ON i.objectclas = h.objectclas AND i.objectid = h.objectid AND i.changenr = h.changenr
  WHERE i.objectclas = 'VERKBELEG' AND tabname = 'VBAK' AND fname IN ('LIFSK', 'CMGST') AND trim(username) <> ''),
last AS (SELECT objectid, max(CASE WHEN blocks THEN changenr END) AS b, max(CASE WHEN unblocks THEN changenr END) AS u FROM log GROUP BY objectid),
block_log AS (SELECT l.objectid AS order_number, b.username AS order_blocking_user, b.udate AS order_blocking_date, u.username AS order_unblocking_user, u.udate AS order_unblocking_date
FROM last l LEFT JOIN log b ON l.objectid = b.objectid AND l.b = b.changenr LEFT JOIN log u ON l.objectid = u.objectid AND l.u = u.changenr WHERE l.b IS NOT NULL OR l.u IS NOT NULL)"""
CONTEXT_COLUMNS = ["customer_type_descr", "dest_customer_type_code", "sales_group", "salesman_name", "main_group_descr",
                   "order_blocking_user", "order_unblocking_date"]
_AREA = "b.sales_organization, b.distr_channel, b.division"


def context_sql(rows):
    """Partners, customer texts and block events of a row set with an order line; its columns and its joins."""
    return f"""ctx AS (SELECT a.vbeln AS p_order, a.posnr AS p_line, {PARTNER_COLUMNS} FROM (SELECT DISTINCT order_number AS vbeln, order_line AS posnr FROM {rows}) a {PARTNERS_SQL}),
names AS (SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS code, c_name FROM customer), {BLOCK_EVENTS}"""


CONTEXT_SELECT = """CASE WHEN oi.vkbur > 'K100' THEN 'Level ' || oi.vkbur ELSE 'Not Defined' END || '-' || CASE WHEN oi.vkbur < 'K500' THEN 'Type ' || oi.vkbur ELSE 'Not Defined' END AS customer_type_descr,
  od.vkbur AS dest_customer_type_code, 'Group ' || od.vkbur AS sales_group, ns.c_name AS salesman_name, nm.c_name AS main_group_descr, order_blocking_user, order_unblocking_date"""
CONTEXT_JOINS = f"""LEFT JOIN ctx w ON b.order_number = p_order AND b.order_line = p_line LEFT JOIN customer_offices oi ON concat_ws('|', w.inv_id, {_AREA}) = oi.key_knvv
  LEFT JOIN customer_offices od ON concat_ws('|', w.dest_id, {_AREA}) = od.key_knvv LEFT JOIN names ns ON w.salesman_code = ns.code LEFT JOIN names nm ON w.main_group_code = nm.code
  LEFT JOIN block_log k ON b.order_number = k.order_number"""
NOTES_SQL = """picks AS (SELECT vbelv AS pick_note, string_agg(DISTINCT vbeln, ',' ORDER BY vbeln) AS picking_number FROM vbfa WHERE vbtyp_n = 'Q' GROUP BY 1),
note_kinds AS (SELECT i.vbeln AS ship_note, k.vsart || ' - ' || coalesce(s.text, 'Not Defined') AS kind FROM vttp i LEFT JOIN vttk k USING (tknum) LEFT JOIN shipping_texts s USING (vsart)),
ships AS (SELECT ship_note, coalesce(string_agg(DISTINCT kind, ' ; ' ORDER BY kind), '') AS shipping_type FROM note_kinds GROUP BY 1),
issued AS (SELECT vbeln AS note, CAST(wadat_ist AS STRING) AS issued_on, d.text AS shipment_descr, r.text AS routing_descr FROM likp LEFT JOIN delivery_kinds d USING (lfart) LEFT JOIN routes r USING (route)
  WHERE wadat_ist IS NOT NULL)"""


def price_sql(table, names):
    signed = "kwert * CASE WHEN kkurs < 0 THEN 1 / abs(kkurs) ELSE kkurs END"
    every = {
        "exchange_rate_erp": (fixed.NSV_CODES, "CASE WHEN kkurs < 0 THEN 1 / abs(kkurs) ELSE kkurs END"),
        "ic_discount": (fixed.DISCOUNT_CODES, "kwert"), "list_price_tot": (fixed.LIST_CODES, signed),
        "forced_price_tot": (fixed.FORCED_CODES, signed), "nsv": (fixed.NSV_CODES, signed),
        "gsv": (fixed.GSV_CODES, signed), "raee": (fixed.RAEE_CODES, "kwert"), "fee": (fixed.FEE_CODES, signed),
        "bonus": (fixed.BONUS_CODES, signed), "freight": (fixed.FREIGHT_CODES, "abs(kwert)"),
    }
    cells = []
    for key, name in names.items():
        codes, value = every[key]
        inside = ", ".join(f"'{c}'" for c in codes)
        cells.append(f"max(CASE WHEN kschl IN ({inside}) THEN {value} END) AS {name}")
    return f"price AS (SELECT knumv || '|' || kposn AS price_key, {', '.join(cells)} FROM {table} GROUP BY knumv, kposn)"


def currency_sql(date):
    return f"""coalesce(cc.currency, 'EUR') AS currency_code, coalesce(y.exchange_value, 1.0e0) AS exchange,
  CASE WHEN y.key_currency IS NULL OR y.exchange_value = 1 THEN 1.0e0 ELSE 1 / y.exchange_value END AS exchange_to_local""", f"""
  LEFT JOIN company_currency cc ON b.sales_organization = cc.company LEFT JOIN yearly_rates y ON coalesce(cc.currency, 'EUR') || '|' || CAST(year({date}) AS STRING) = y.key_currency"""


MARKET_JOIN = """LEFT JOIN product_lines pl ON b.product_code = pl.product_code LEFT JOIN market_rules r ON b.sales_organization = r.sales_organization
  AND b.sales_office = r.sales_office AND (r.line = coalesce(pl.line_code, '999') OR r.line IS NULL)"""
SERVICE = "(" + ", ".join(f"'{p}'" for p in fixed.SERVICE_POSITIONS) + ")"
COMPANIES = "('62T0', '6230')"
_rate, _rates = currency_sql("DATE '1998-08-15'")
ORDER_ROWS = f"""{STATUS}, {HEADERS}, {ITEMS}, {price_sql('prcd', {'exchange_rate_erp': 'exchange_rate_erp', 'ic_discount': 'ord_ic_discount', 'nsv': 'ord_nsv_lc_tot', 'gsv': 'ord_gsv_lc_tot',
    'list_price_tot': 'list_price_tot', 'forced_price_tot': 'forced_price_tot', 'fee': 'removable_charges_tot', 'raee': 'ord_raee_lc'})},
first AS (SELECT vbeln AS order_number, posnr AS order_line, min(edatu) AS first_req_del_date FROM vbep GROUP BY 1, 2),
base AS (SELECT * FROM status JOIN heads USING (order_number) JOIN goods USING (order_number, order_line) LEFT JOIN first USING (order_number, order_line)
  WHERE division <> 'SE' AND sales_organization NOT IN {COMPANIES} AND order_type_code || '|' || pstyv NOT IN {SERVICE}),
priced AS (SELECT b.*, r.company, r.network, {_rate}, price.* EXCLUDE (price_key) FROM base b {MARKET_JOIN} {_rates}
  LEFT JOIN price ON price_key = CASE WHEN order_type_code NOT IN ('ZKA', 'ZKB') THEN knumv || '|' || order_line END),
{cost_sql('priced', 'document_date')},
{ms.ORD_SQL.replace('ord_base', 'costed')}"""
ORDER_MEASURES = ["ord_qty", "ord_nsv_lc", "ord_gsv_lc", "ord_cp_lc", "ord_tp_lc", "ord_nsv_eur", "ord_gm_tp_eur", "ord_gm_cp_lc"]
GRAIN = ["order_number", "order_line", "order_status", "schedule_line", "allocation_warehouse"]


def order_fact(t):
    return orders.order_fact(orders.order_status(order_tables(t), by_line=True), headers(t), items(t), t.vbep,
                             fact_tables(t, t.prcd), AS_OF)


@query("b14_order_fact", f"""
WITH {ORDER_ROWS}, {context_sql('gm')}
SELECT concat_ws('###', 'ORDER', {', '.join('b.' + c for c in orders.FACT_GRAIN)}) AS key_fact, {', '.join('b.' + c for c in GRAIN)},
  CAST(first_req_del_date AS STRING) AS first_req_del_date, company, network, currency_code, product_code, exchange, {', '.join(ORDER_MEASURES)},
  CASE WHEN requested_delivery_date < DATE '1998-08-01' THEN ord_nsv_eur ELSE 0 END AS ord_bo_nsv_eur,
  CASE WHEN order_status = 'Blocked' THEN ord_qty ELSE 0 END AS blk_qty, CASE WHEN order_status = 'In Picking' THEN ord_nsv_lc ELSE 0 END AS pck_nsv_lc,
  ord_gm_tp_eur AS pot_gm_tp_eur, {CONTEXT_SELECT} FROM gm b {CONTEXT_JOINS}
""", " ".join(f"{x}:4" for x in ["exchange", *ORDER_MEASURES, "ord_bo_nsv_eur", "blk_qty", "pck_nsv_lc", "pot_gm_tp_eur"]))
def b14(t):
    fact = settle_unique(text_dates(order_fact(t), "first_req_del_date").select(
        "key_fact", *GRAIN, "first_req_del_date", "company", "network", "currency_code", "product_code",
        "exchange", *ORDER_MEASURES, "ord_bo_nsv_eur", "blk_qty", "pck_nsv_lc", "pot_gm_tp_eur", *CONTEXT_COLUMNS), ["key_fact"], "order-fact")
    return fact


CUSTOMER_SQL = """lines_of AS (SELECT o.*, 'D' AS dummy FROM (SELECT vbeln, kunnr AS inv_id FROM vbpa WHERE parvw = 'BP' AND posnr = '000000') o),
keyed AS (SELECT l.vbeln, l.inv_id, vkorg, coalesce(w.kunnr, '') AS salesman_code, l.inv_id || '|' || vkorg || '|10|FG' AS k FROM lines_of l JOIN vbak h ON l.vbeln = h.vbeln
  LEFT JOIN (SELECT vbeln, kunnr FROM vbpa WHERE parvw = 'YD' AND posnr = '000000') w ON l.vbeln = w.vbeln)"""


@query("b14_customer_context", f"""
WITH {CUSTOMER_SQL}
SELECT vbeln AS order_number, o.vkbur AS customer_type_code, coalesce(t3.text, 'Not Defined') || '-' || coalesce(t5.text, 'Not Defined') AS customer_type_descr,
  g.text AS sales_group, c.c_name AS salesman_name FROM keyed LEFT JOIN customer_offices o ON k = o.key_knvv
LEFT JOIN (SELECT DISTINCT vkbur, 'Type ' || vkbur AS text FROM customer_offices WHERE vkbur < 'K500') t5 ON o.vkbur = t5.vkbur
LEFT JOIN (SELECT DISTINCT vkbur, 'Level ' || vkbur AS text FROM customer_offices WHERE vkbur > 'K100') t3 ON o.vkbur = t3.vkbur
LEFT JOIN (SELECT DISTINCT vkbur, 'Group ' || vkbur AS text FROM customer_offices) g ON o.vkbur = g.vkbur
LEFT JOIN (SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS code, c_name FROM customer) c ON salesman_code = c.code
""")
def b14_customers(t):
    """Customer types, sales group and partner names by lookups through customer maps."""
    maps = customer_maps(t)
    area = ["sales_organization", "distr_channel", "division"]
    heads = t.vbak.select(F.col("vbeln").alias("order_number"), F.col("vkorg").alias("sales_organization"),
                          F.lit("10").alias("distr_channel"), F.lit("FG").alias("division"), F.lit("-").alias("order_line"))
    rows = with_partners(heads, t.vbpa, names=maps.names).where("inv_id is not null").withColumn("dest_id", F.col("inv_id"))
    return orders.with_customers(rows.select("order_number", "inv_id", "dest_id", "salesman_name", *area), maps).select(
        "order_number", "customer_type_code", "customer_type_descr", "sales_group", "salesman_name")


# --- deliveries -------------------------------------------------------------------------

OPEN_DELIVERY = """open_del AS (SELECT i.*, lfimg - coalesce(billed, 0) AS del_qty_fabs, (lfimg - coalesce(billed, 0)) / lfimg AS pct_del_qty FROM lips i
  JOIN likp h ON i.vbeln = h.vbeln AND wadat_ist IS NOT NULL LEFT JOIN (SELECT vgbel AS note, vgpos AS line, sum(fkimg) AS billed FROM vbrp GROUP BY 1, 2) v
  ON i.vbeln = note AND i.posnr = line WHERE lfimg - coalesce(billed, 0) > 0)"""


@query("b15_open_deliveries", f"""
WITH {OPEN_DELIVERY} SELECT vbeln, posnr, lfimg, del_qty_fabs, pct_del_qty FROM open_del
""", "lfimg del_qty_fabs pct_del_qty")
def b15_open(t):
    return deliveries.open_deliveries(t.likp, t.lips, t.vbrp).select(
        "vbeln", "posnr", "lfimg", "del_qty_fabs", "pct_del_qty")


DEL_SQL = f"""q AS (SELECT *, {ms.DEL_QTY} AS del_qty FROM costed),
lc AS (SELECT *, (del_nsv_lc_tot + {ms.disc('del_ic_discount')}) / nullif(ord_qty_orig, 0) * del_qty AS del_nsv_lc,
  (del_gsv_lc_tot + {ms.disc('del_ic_discount')}) / nullif(ord_qty_orig, 0) * del_qty AS del_gsv_lc, {ms.CP} * del_qty AS del_cp_lc, {ms.TP} * del_qty AS del_tp_lc FROM q),
gm AS (SELECT *, del_nsv_lc * exchange AS del_nsv_eur, CASE WHEN coalesce(del_nsv_lc, 0) = 0 THEN 0 ELSE del_nsv_lc - coalesce(del_tp_lc, 0) END AS del_gm_tp_lc,
  CASE WHEN coalesce(del_nsv_lc * exchange, 0) = 0 THEN 0 ELSE del_nsv_lc * exchange - coalesce(del_cp_lc * exchange, 0) END AS del_gm_cp_eur FROM lc)"""
DELIVERY_MEASURES = ["del_qty", "del_nsv_lc", "del_gsv_lc", "del_cp_lc", "del_tp_lc", "del_nsv_eur", "del_gm_tp_lc", "del_gm_cp_eur"]


@query("b15_delivery_fact", f"""
WITH {OPEN_DELIVERY}, {HEADERS}, {price_sql('prcd', {'exchange_rate_erp': 'exchange_rate_erp', 'ic_discount': 'del_ic_discount', 'nsv': 'del_nsv_lc_tot', 'gsv': 'del_gsv_lc_tot'})},
valid_heads AS (SELECT * EXCLUDE (sales_office) FROM heads WHERE order_type_code IN (SELECT auart FROM tvak WHERE vbtyp IN ('C', 'K', 'L', 'H'))
  AND order_type_code NOT IN ('ZKL', 'ZFOC', 'YFOC', 'ZWBF', 'ZWPC', 'ZWPR') AND division <> 'SE' AND sales_organization NOT IN {COMPANIES}),
base AS (SELECT d.vbeln AS despatching_note, d.posnr, d.matnr AS product_code, d.vgbel AS order_number, d.vgpos AS order_line, d.vkbur AS sales_office, del_qty_fabs, pct_del_qty,
  kwmeng AS ord_qty_orig, h.* EXCLUDE (order_number) FROM open_del d JOIN valid_heads h ON d.vgbel = h.order_number JOIN vbap a ON d.vgbel = a.vbeln AND d.vgpos = a.posnr
  WHERE a.abgru IS NULL AND order_type_code || '|' || pstyv NOT IN {SERVICE}),
priced AS (SELECT b.*, r.company, r.network, {_rate}, price.* EXCLUDE (price_key) FROM base b {MARKET_JOIN} {_rates}
  LEFT JOIN price ON price_key = CASE WHEN order_type_code NOT IN ('ZKA', 'ZKB') THEN knumv || '|' || order_line END),
{cost_sql('priced', 'document_date')}, {DEL_SQL}, {context_sql('gm')}, {NOTES_SQL}
SELECT 'DELIVERY###' || despatching_note || '###' || posnr AS key_fact, b.order_number, b.order_line, company, network, currency_code, {', '.join(DELIVERY_MEASURES)},
  {CONTEXT_SELECT}, shipping_type, picking_number, shipment_descr, routing_descr
FROM gm b {CONTEXT_JOINS} LEFT JOIN picks ON despatching_note = pick_note LEFT JOIN ships ON despatching_note = ship_note LEFT JOIN issued ON despatching_note = note
""", " ".join(f"{x}:4" for x in DELIVERY_MEASURES))
def b15_fact(t):
    types = orders.order_types(t.tvak)
    heads = headers(t).join(types.select(F.col("auart").alias("order_type_code")), ["order_type_code"], "leftsemi")
    open_items = deliveries.open_deliveries(t.likp, t.lips, t.vbrp)
    tables = fact_tables(t, t.prcd)
    base = deliveries.delivery_base(open_items, heads, t.vbap, t.vbep, AS_OF, tables)
    fact = deliveries.delivery_fact(base, tables, AS_OF).select(
        "key_fact", "order_number", "order_line", "company", "network", "currency_code", *DELIVERY_MEASURES,
        *CONTEXT_COLUMNS, "shipping_type", "picking_number", "shipment_descr", "routing_descr")
    return settle_unique(fact, ["key_fact"], "delivery-fact")


@query("b15_delivery_texts", """
WITH picks AS (SELECT vbelv AS despatching_note, string_agg(DISTINCT vbeln, ',' ORDER BY vbeln) AS picking_number FROM vbfa WHERE vbtyp_n = 'Q' GROUP BY 1),
dates AS (SELECT vbeln, posnr, string_agg(DISTINCT CAST(edatu AS STRING), ',' ORDER BY CAST(edatu AS STRING)) AS confirmed_date,
  string_agg(DISTINCT ezeit, ',' ORDER BY ezeit) AS confirmed_time FROM vbep WHERE bmeng > 0 GROUP BY 1, 2)
SELECT i.vbeln, i.posnr, picking_number, confirmed_date, confirmed_time FROM lips i LEFT JOIN picks ON i.vbeln = despatching_note
LEFT JOIN dates d ON i.vgbel = d.vbeln AND i.vgpos = d.posnr
""")
def b15_texts(t):
    lines = t.lips.select(F.col("vbeln").alias("despatching_note"), "posnr",
                          F.col("vgbel").alias("order_number"), F.col("vgpos").alias("order_line"))
    return (
        lines.join(deliveries.picking_numbers(t.vbfa), ["despatching_note"], "left")
        .join(deliveries.confirmed_dates(t.vbep), ["order_number", "order_line"], "left")
        .select(F.col("despatching_note").alias("vbeln"), "posnr", "picking_number",
                "confirmed_date", "confirmed_time"))


# --- invoices ---------------------------------------------------------------------------

INVOICE_KIND = "CASE fkart WHEN 'ZRE' THEN 7 WHEN 'ZG2' THEN 6 WHEN 'ZL2' THEN 5 WHEN 'ZL3' THEN 14 WHEN 'ZF2' THEN 4 END"
INVOICE_LINES = f"""inv_lines AS (SELECT k.vbeln AS document_code, p.posnr, fkdat AS document_date, fkdat AS time_id, vkorg AS sales_organization, vtweg AS distr_channel, spart AS division,
  fkart AS invoice_type, knumv, sfakn AS cancelled_invoice, zterm, land1, {INVOICE_KIND} AS kind, CASE fkart WHEN 'ZRE' THEN -1 WHEN 'ZG2' THEN -1 WHEN 'ZS1' THEN -1 ELSE 1 END AS return_sign,
  matnr AS product_code, vgbel AS despatching_note, aubel AS order_number, aupos AS order_line, fkimg AS inv_qty_fabs, CASE WHEN trim(vkbur) <> '' THEN vkbur END AS office
  FROM vbrk k JOIN vbrp p ON k.vbeln = p.vbeln WHERE buchk = 'C' AND ({INVOICE_KIND} IS NOT NULL OR fkart IN ('ZS1', 'ZS2', 'ZS3', 'ZS4')))"""
INVOICE_BASE = f"""{INVOICE_LINES}, valid_types AS (SELECT auart FROM tvak WHERE vbtyp IN ('C', 'K', 'L', 'H')),
partner_rows AS (SELECT a.vbeln AS p_order, a.posnr AS p_line, {PARTNER_COLUMNS} FROM (SELECT DISTINCT order_number AS vbeln, order_line AS posnr FROM inv_lines) a {PARTNERS_SQL}),
docs AS (SELECT i.*, h.auart AS order_type_code, h.augru, w.dest_id, w.inv_id, coalesce(office, o.vkbur) AS sales_office,
    CASE WHEN invoice_type = 'ZG2' AND upper(h.submi) = 'PEX' THEN 7 ELSE coalesce(CASE invoice_type || '|' || h.augru WHEN 'ZL3|Z04' THEN 12 END, kind) END AS kind_orig
  FROM inv_lines i LEFT JOIN (SELECT * FROM vbak WHERE auart IN (SELECT auart FROM valid_types)) h ON i.order_number = h.vbeln
  LEFT JOIN vbap a ON i.order_number = a.vbeln AND i.order_line = a.posnr LEFT JOIN partner_rows w ON i.order_number = p_order AND i.order_line = p_line
  LEFT JOIN customer_offices o ON concat_ws('|', w.inv_id, sales_organization, distr_channel, division) = o.key_knvv
  WHERE coalesce(h.auart || '|' || a.pstyv, '') NOT IN {SERVICE}),
known AS (SELECT document_code AS code, max(kind_orig) AS top_kind FROM docs GROUP BY 1),
typed AS (SELECT d.*, coalesce(top_kind, kind_orig) AS doc_type_code FROM docs d LEFT JOIN known ON cancelled_invoice = code WHERE coalesce(cancelled_invoice, '') = '' OR code IS NOT NULL)"""


def invoice_base(t):
    lines = invoices.invoice_lines(t.vbrk, t.vbrp, t.payment_texts)
    types = orders.order_types(t.tvak).select("auart")
    heads = t.vbak.join(types, ["auart"], "leftsemi").select(
        F.col("vbeln").alias("order_number"), F.col("auart").alias("order_type_code"),
        F.col("augru").alias("order_reason"), F.col("submi").alias("collective_number"),
        F.col("vbtyp").alias("category"))
    goods = t.vbap.select(F.col("vbeln").alias("order_number"), F.col("posnr").alias("order_line"), "pstyv")
    names = customer_maps(t).names
    rows = invoices.invoice_rows(lines, heads, goods, t.vbpa, names, blocks.block_events(t.cdhdr, t.cdpos))
    return invoices.invoice_base(rows, t.vbpa, t.customer_offices, t.vbfa, names)


@query("b16_invoice_base", f"""
WITH {INVOICE_BASE} SELECT document_code, posnr, invoice_type, order_type_code, dest_id, inv_id, sales_office, CAST(doc_type_code AS DOUBLE) AS doc_type_code,
  CAST(return_sign AS DOUBLE) AS return_sign, inv_qty_fabs FROM typed
""", "inv_qty_fabs")
def b16_base(t):
    return invoice_base(t).select(
        "document_code", "posnr", "invoice_type", "order_type_code", "dest_id", "inv_id", "sales_office",
        F.col("doc_type_code").cast("double").alias("doc_type_code"),
        F.col("return_sign").cast("double").alias("return_sign"), "inv_qty_fabs")


@query("b16_payment_terms", """
WITH terms AS (SELECT * FROM (SELECT zterm, zlsch, zprz1, row_number() OVER (PARTITION BY zterm ORDER BY zlsch NULLS FIRST, zprz1) AS rn FROM t052) x WHERE rn = 1)
SELECT k.vbeln, t.zlsch AS payment_type_code, zprz1 AS payment_expiring_disc, text2 AS payment_type_descr FROM vbrk k LEFT JOIN terms t USING (zterm)
LEFT JOIN t042 z ON k.land1 = z.land1 AND t.zlsch = z.zlsch AND spras = 'E'
""", "payment_expiring_disc")
def b16_terms(t):
    lines = t.vbrk.select("vbeln", F.col("zterm").alias("payment_expiring_code"), "land1")
    return invoices.payment_terms(lines, t.t052, t.t042).select(
        "vbeln", "payment_type_code", "payment_expiring_disc", "payment_type_descr")


_inv_rate, _inv_rates = currency_sql("document_date")
INVOICE_MEASURES = ["inv_qty", "inv_nsv_lc", "inv_gsv_lc", "inv_cp_lc", "inv_tp_lc", "inv_gm_tp_lc", "inv_gm_cp_eur", "inv_nsv_eur", "inv_transport_cost_lc"]


@query("b16_invoice_fact", f"""
WITH {INVOICE_BASE}, {price_sql('prcd_invoice', {'exchange_rate_erp': 'exchange_rate_erp', 'ic_discount': 'inv_ic_discount', 'nsv': 'nsv', 'gsv': 'inv_gsv_lc_temp', 'bonus': 'inv_gsv_bonus_lc_temp',
  'list_price_tot': 'list_price_tot', 'freight': 'freight'})},
flow AS (SELECT DISTINCT vbeln, posnn, vbelv AS ref_invoice FROM vbfa WHERE vbtyp_v = 'M'),
dated AS (SELECT document_code AS ref_code, max(time_id) AS ref_invoice_date FROM typed GROUP BY 1),
base AS (SELECT t.*, ref_invoice, ref_invoice_date FROM typed t LEFT JOIN flow ON document_code = vbeln AND t.posnr = posnn LEFT JOIN dated ON ref_invoice = ref_code
  WHERE sales_organization NOT IN {COMPANIES}),
priced AS (SELECT b.*, r.company, r.network, {_inv_rate}, price.* EXCLUDE (price_key, nsv, freight), abs(nsv) AS inv_nsv_lc_temp, coalesce(freight, abs(list_price_tot)) * return_sign AS inv_transport_cost_lc
  FROM base b {MARKET_JOIN} {_inv_rates} LEFT JOIN price ON price_key = knumv || '|' || posnr),
{cost_sql('priced', 'document_date')}, {ms.INV_SQL.replace('inv_base', 'costed')}, {context_sql('gm')}, {NOTES_SQL},
terms AS (SELECT * FROM (SELECT zterm, zlsch, zprz1, row_number() OVER (PARTITION BY zterm ORDER BY zlsch NULLS FIRST, zprz1) AS rn FROM t052) x WHERE rn = 1)
SELECT concat_ws('###', 'INVOICE', document_code, b.posnr, ref_invoice) AS key_fact, CAST(ref_invoice_date AS STRING) AS ref_invoice_date, company, network, currency_code, {', '.join(INVOICE_MEASURES)},
  {CONTEXT_SELECT}, shipping_type, picking_number, shipment_descr, routing_descr, b.despatching_note AS ref_despatch_note, issued_on AS ref_despatch_date,
  y.zlsch AS payment_type_code, zprz1 AS payment_expiring_disc, text2 AS payment_type_descr
FROM gm b {CONTEXT_JOINS} LEFT JOIN picks ON despatching_note = pick_note LEFT JOIN ships ON despatching_note = ship_note LEFT JOIN issued ON despatching_note = note
  LEFT JOIN terms y ON b.zterm = y.zterm LEFT JOIN t042 z ON b.land1 = z.land1 AND y.zlsch = z.zlsch AND z.spras = 'E'
""", " ".join(f"{x}:4" for x in [*INVOICE_MEASURES, "payment_expiring_disc"]))
def b16_fact(t):
    span = costs.span_of(t.vbrk, "fkdat")
    fact = invoices.invoice_fact(invoice_base(t), fact_tables(t, t.prcd_invoice), span)
    fact = text_dates(fact, "ref_invoice_date", "ref_despatch_date").select(
        "key_fact", "ref_invoice_date", "company", "network", "currency_code", *INVOICE_MEASURES, *CONTEXT_COLUMNS,
        "shipping_type", "picking_number", "shipment_descr", "routing_descr", "ref_despatch_note", "ref_despatch_date",
        "payment_type_code", "payment_expiring_disc", "payment_type_descr")
    return settle_unique(fact, ["key_fact"], "invoice-fact")


@query("b16_delivery_context", f"""
WITH {INVOICE_LINES}, picks AS (SELECT vbelv AS despatching_note, string_agg(DISTINCT vbeln, ',' ORDER BY vbeln) AS picking_number FROM vbfa WHERE vbtyp_n = 'Q' GROUP BY 1),
kinds AS (SELECT i.vbeln AS despatching_note, k.vsart || ' - ' || coalesce(s.text, 'Not Defined') AS kind FROM vttp i LEFT JOIN vttk k USING (tknum) LEFT JOIN shipping_texts s USING (vsart)),
ships AS (SELECT despatching_note, coalesce(string_agg(DISTINCT kind, ' ; ' ORDER BY kind), '') AS shipping_type FROM kinds GROUP BY 1)
SELECT document_code, l.posnr, CAST(h.wadat_ist AS STRING) AS despatching_date, h.route AS routing, CAST(h.zzdate_slot AS STRING) AS booking_slot, shipping_type, picking_number
FROM inv_lines l LEFT JOIN (SELECT * FROM likp WHERE wadat_ist IS NOT NULL) h ON l.despatching_note = h.vbeln LEFT JOIN ships USING (despatching_note) LEFT JOIN picks USING (despatching_note)
""")
def b16_delivery(t):
    """Invoice lines with what is known of their delivery."""
    lines = invoices.invoice_lines(t.vbrk, t.vbrp, t.payment_texts)
    rows = deliveries.with_delivery(lines, delivery_notes(t))
    return text_dates(rows, "despatching_date", "booking_slot").select(
        "document_code", "posnr", "despatching_date", "routing", "booking_slot", "shipping_type",
        "picking_number")


# --- the legacy system --------------------------------------------------------------------

LEGACY_ROWS = f"""{CALENDAR_SQL},
today AS (SELECT coalesce(max(month), DATE '1998-08-15') AS today FROM spans WHERE DATE '1998-08-15' BETWEEN start_date AND cutoff_date),
legacy_rows AS (SELECT s.* EXCLUDE (company, network), n.company, n.network, n.sales_organization, n.sales_office, coalesce(cur.currency, 'EUR') AS currency_code,
  p.nsv_local AS budget_price, p.nsv_local AS budget_price_revised, CASE WHEN data_type IN (2, 3) THEN CAST(today AS DATE) ELSE document_date END AS time_id,
  CASE WHEN data_type = 2 THEN order_requested_delivery_date ELSE DATE '1900-01-01' END AS mrdd, coalesce(s.product_code, 'NOT DEFINED') AS product_id,
  coalesce(customer, 'NOT DEFINED') AS dest_id, n.company || '-@-' || n.network AS network_id,
  CASE WHEN flag_bgrade = 1 THEN 'B' ELSE 'A' END AS ab_grade, CASE data_type WHEN 1 THEN 'Invoiced' WHEN 2 THEN 'Open Orders' WHEN 3 THEN 'Delivered' END AS type,
  CASE WHEN data_type = 2 THEN CASE WHEN order_alloc_status = 6 AND coalesce(order_blocking_code, 0) < 50 THEN 'In Picking'
    WHEN coalesce(order_blocking_code, 0) < 50 THEN 'Not Blocked' ELSE 'Blocked' END WHEN data_type = 1 THEN 'Invoiced' WHEN data_type = 3 THEN 'Delivered' END AS potential_status
  FROM legacy_sales s JOIN company_network n ON lpad(CAST(s.company AS STRING), 2, '0') = n.company AND lpad(CAST(s.network AS STRING), 2, '0') = n.network AND n.sales_organization NOT IN {COMPANIES}
  LEFT JOIN unit_currency cur ON n.company = cur.company
  LEFT JOIN budget_prices p ON p.key = concat_ws('-@-', n.sales_organization, n.sales_office, s.product_code, CAST(year(document_date) AS STRING), CAST(month(document_date) AS STRING)), today),
{ms.LEGACY_SQL.replace('legacy_base', 'legacy_rows')}"""
LEGACY_MEASURES = ["inv_qty", "inv_nsv_eur", "del_nsv_eur", "ord_nsv_eur", "bdg_nsv_eur", "rev_nsv_eur", "inv_gm_cp_eur", "ord_gm_tp_eur", "del_gm_cp_eur"]
LEGACY_KEYS = ["product_id", "dest_id", "network_id", "sales_organization", "currency_code", "ab_grade", "type", "potential_status", "order_status"]


def legacy_facts(t):
    days = calendar.fiscal_calendar(t.cutoffs).select("day", "month")
    return legacy.legacy_facts(t.legacy_sales, t.company_network, t.budget_prices, days,
                               t.unit_currency, AS_OF)


@query("b17_legacy_facts", f"""
WITH {LEGACY_ROWS} SELECT {ms.K}, {', '.join(LEGACY_KEYS)}, CAST(time_id AS STRING) AS time_id, CAST(mrdd AS STRING) AS mrdd, {', '.join(LEGACY_MEASURES)},
  coalesce(inv_nsv_eur, 0) + coalesce(del_nsv_eur, 0) + coalesce(ord_nsv_eur, 0) AS pot_nsv_eur FROM b
""", " ".join(f"{x}:4" for x in [*LEGACY_MEASURES, "pot_nsv_eur"]))
def b17(t):
    return text_dates(legacy_facts(t), "time_id", "mrdd").select(
        *ms.KEY, *LEGACY_KEYS, "time_id", "mrdd", *LEGACY_MEASURES, "pot_nsv_eur")


@query("b17_legacy_order_fact", """
SELECT 'ORDER###' || order_number || '###' || order_line AS key_fact, c.code AS customer_code, d.c_name AS dest_name, quantity AS ord_qty_fabs, CAST(NULL AS STRING) AS distr_channel,
  CAST(doc_type_code AS BIGINT) AS doc_type_code FROM legacy_sales s LEFT JOIN customer_codes c ON inv_customer = c.customer
LEFT JOIN (SELECT 'C' || CAST(c_custkey AS STRING) AS k, c_name FROM customer) d ON s.customer = d.k WHERE data_type = 2
""", "ord_qty_fabs")
def b17_orders(t):
    """Legacy orders with both customer sides, in the shape of a given schema."""
    named = t.legacy_sales.withColumnsRenamed({"inv_customer": "inv_id", "customer": "dest_id", "quantity": "ord_qty_fabs"})
    sides = {"inv_id": t.customer_codes.select(F.col("customer").alias("inv_id"), F.col("code").alias("customer_code")),
             "dest_id": t.customer.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("dest_id"),
                                          F.col("c_name").alias("dest_name"))}
    return legacy.legacy_fact(
        named, "ORDER", "key_fact string, customer_code string, dest_name string, ord_qty_fabs double, distr_channel string, doc_type_code bigint", sides)


# --- dimensions, segments, analysis -----------------------------------------------------


@query("b18_invoice_customers", """
SELECT CAST(c_nationkey AS STRING) || '-@-' || CAST(c_custkey AS STRING) AS inv_id, CAST(c_custkey AS STRING) || '-' || c_name AS invoice_customer,
  c_mktsegment || ' - ' || coalesce(CASE WHEN c_acctbal > 0 THEN 'Group' END, '0') AS super_group, CASE WHEN c_acctbal > 0 THEN c_mktsegment || ' - Main' END AS main_group FROM customer
UNION ALL SELECT 'NOT DEFINED', NULL, NULL, NULL
""")
def b18_invoice(t):
    return dimensions.invoice_customers(customer_source(t)).select(
        "inv_id", "invoice_customer", "super_group", "main_group")


def customer_source(t):
    segment = F.col("c_mktsegment")
    good = F.col("c_acctbal") > 0
    return t.customer.select(
        F.col("c_nationkey").cast("string").alias("customer_company"),
        F.col("c_custkey").cast("string").alias("customer_code"), F.col("c_name").alias("customer_name"),
        segment.alias("super_group_code"), F.when(good, F.lit("Group")).alias("super_group_descr"),
        segment.alias("main_group_code"), F.when(good, F.lit("Main")).alias("main_group_descr"),
        segment.alias("purchase_group_code"), F.lit("Purchase").alias("purchase_group_descr"))


@query("b18_delivery_customers", """
SELECT CAST(c_nationkey AS STRING) || '-@-' || CAST(c_custkey AS STRING) AS dest_id, c_name AS dest_name, CAST(c_custkey AS STRING) || '-' || c_name AS delivery_customer FROM customer
UNION ALL SELECT 'NOT DEFINED', NULL, NULL
""")
def b18_delivery(t):
    side = dimensions.invoice_customers(customer_source(t))
    return dimensions.delivery_customers(side, {"inv_id": "dest_id", "customer_name": "dest_name"})


@query("b18_companies", """
SELECT CAST(s_suppkey AS STRING) AS company_id, 'C' || CAST(s_suppkey AS STRING) || '-' || s_name AS company FROM supplier UNION ALL SELECT 'NOT DEFINED', NULL
""")
def b18_companies(t):
    source = t.supplier.select(F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("company"),
                               F.col("s_name").alias("company_desc"))
    return dimensions.companies(source).select("company_id", "company")


@query("b18_sale_networks", """
SELECT network_id, kind AS sales_type, network FROM (SELECT CAST(n_regionkey AS STRING) || '-@-' || CAST(n_nationkey AS STRING) AS network_id,
  CAST(n_nationkey AS STRING) || '-' || n_name AS network, CASE WHEN n_nationkey IN (1, 2) THEN 'ITC' ELSE 'NO ITC' END AS own FROM nation) n,
  LATERAL (SELECT unnest([own, 'ALL']) AS kind) k
""")
def b18_networks(t):
    source = t.nation.select(F.col("n_regionkey").cast("string").alias("company"),
                             F.col("n_nationkey").alias("code"), F.col("n_name").alias("description"))
    return dimensions.sale_networks(source).select("network_id", "sales_type", "network")


@query("b18_return_reasons", """
SELECT motive, coalesce(motive_descr, 'TO BE DEFINED') AS motive_descr, cause, CASE WHEN CAST(motive AS INT) IN (60, 70, 80, 90, 100) THEN 'GOOD RETURN'
  WHEN CAST(motive AS INT) IN (20, 30, 40, 50) THEN 'BAD RETURN' ELSE 'TO BE DEFINED' END AS return_type, reason_key FROM return_reasons,
  LATERAL (SELECT unnest([motive, motive || '|' || cause]) AS reason_key) k
""")
def b18_reasons(t):
    return dimensions.return_reasons(t.return_reasons).select(
        "motive", "motive_descr", "cause", "return_type", "reason_key")


def segments_sql():
    from .sets import segment_sql

    rows = segment_sql().replace("SELECT product_id, product_type_code,", "SELECT product_id, product_type_code, business_sector_descr,")
    unknown = " UNION ALL ".join(f"SELECT 'NOT DEFINED', '1', CAST(NULL AS STRING), '{s}'" for s in fixed.UNKNOWN_SEGMENTS)
    return (f"WITH seg AS ({rows} UNION ALL {unknown}), sectors AS (SELECT DISTINCT business_sector_descr FROM seg) "
            "SELECT product_id, product_type_code, product_segment FROM seg "
            "UNION ALL SELECT business_sector_descr, '1', 'ONLY FG (1)' FROM sectors "
            "UNION ALL SELECT business_sector_descr, '1', 'ALL' FROM sectors")


@query("b19_product_segments", segments_sql())
def b19(t):
    return segments.product_segments(t.products).select("product_id", "product_type_code", "product_segment")


_DIVISIONS = ", ".join(f"('{c}', '{n}')" for c, n in fixed.BUDGET_DIVISIONS.items())
_SEGMENTS = ", ".join(f"('{s}')" for s in fixed.UNKNOWN_SEGMENTS)


@query("b19_budget_products", f"""
WITH division_lines AS (SELECT DISTINCT CASE p_brand WHEN 'Brand#1' THEN 'TV' WHEN 'Brand#2' THEN 'Cooking' WHEN 'Brand#3' THEN 'Freezer' END AS division, p_brand AS line_code FROM part)
SELECT 'BUDGET_' || code AS product_id, segment AS product_segment, name AS division, l.line_code,
  CASE WHEN l.line_code IS NULL THEN 'NOT DEFINED' ELSE (SELECT min(line_descr) FROM products p WHERE p.line_code = l.line_code) END AS line_descr,
  CASE WHEN l.line_code IS NULL THEN 'NOT DEFINED' ELSE (SELECT CASE WHEN count(*) = count(fob) THEN min(fob) END FROM products p WHERE p.line_code = l.line_code) END AS fob
FROM (VALUES {_DIVISIONS}) AS d(code, name), (VALUES {_SEGMENTS}) AS s(segment) LEFT JOIN division_lines l ON l.division = name
""")
def b19_budget(t):
    brand = F.col("p_brand")
    lines = t.part.select(
        F.when(brand == "Brand#1", "TV").when(brand == "Brand#2", "Cooking")
        .when(brand == "Brand#3", "Freezer").alias("division"), brand.alias("line_code")).distinct()
    return segments.budget_products(t.products, lines.where("division is not null")).select(
        "product_id", "product_segment", "division", "line_code", "line_descr", "fob")


GATE = f"(source = 'cas' OR (source = 'sap' AND division = 'FG')) AND sales_organization NOT IN {COMPANIES}"


def analysis_sql(kind, table, measure, closed=""):
    return f"""SELECT '{kind}' AS fact_type, product_code, dest_id, coalesce(d.code, '0') AS dest_code, coalesce(c.code, '0') AS customer_code,
  CASE WHEN doc_type_code IN (4, 5, 6) THEN '999' ELSE return_reason END AS key_return_reason, {measure} AS amount, {closed or 'CAST(NULL AS DOUBLE)'} AS closed_amount
  FROM {table} LEFT JOIN customer_codes d ON dest_id = d.customer LEFT JOIN customer_codes c ON inv_id = c.customer WHERE {GATE}"""


@query("b20_analysis_facts", " UNION ALL ".join([
    analysis_sql("order", "report_orders", "ord_nsv_eur"), analysis_sql("delivery", "report_deliveries", "del_nsv_eur"),
    analysis_sql("invoice", "report_invoices", "inv_nsv_eur", "CASE WHEN time_id < DATE '1998-08-01' THEN inv_nsv_eur ELSE 0 END"),
    f"SELECT 'budget', product_code, NULL, NULL, NULL, NULL, budget_nsv_eur, NULL FROM report_budget WHERE sales_organization NOT IN {COMPANIES}"]),
    "amount:4 closed_amount:4")
def b20(t):
    """The whole family written to its folders and read back as one frame."""
    facts = analysis.analysis_facts(t.report_orders, t.report_deliveries, t.report_invoices, t.report_budget,
                                    t.customer_codes, t.customer_codes, AS_OF)
    path = t.scratch("analysis")
    writers.write_fact_family(facts, path)
    family = writers.read_fact_family(t.spark, path)
    return family.select(
        "fact_type", "product_code", "dest_id", "dest_code", "customer_code", "key_return_reason",
        F.coalesce("ord_nsv_eur", "del_nsv_eur", "inv_nsv_eur", "bdg_nsv_eur").alias("amount"),
        F.col("inv_sf_nsv_eur").alias("closed_amount"))


REPORT_CODES = ["order_date", "confirmed_date", "area_code", "order_blocking_code", "order_customer_reference_1", "order_type_code",
                "order_delivery_warehouse", "ab_grade", "warehouse_classification", "main_group_code", "sale_zone_code", "salesman_code",
                "sale_director_code", "rsm_code", "market_budget", "market_budget_descr"]
REPORT_KEYS = ["product_code", "dest_id", "inv_id", "company", "network", "sales_organization", "sales_office", "order_number", "year", "month",
               "first_req_del_date", "requested_year_month", "super_group_code", "super_group_descr", "purchase_group", "order_source", "record_source",
               "order_requested_delivery_date", "invoice_date", *REPORT_CODES]
REPORT_NAMES = ["main_group", "sale_zone", "salesman", "sale_director", "rsm", "order_type", *fixed.MARKET_NAMES.values()]
_STARTS = [f"DATE '{y}-{m:02d}-01'" for y, m in [(1998, 9), (1998, 10), (1998, 11), (1998, 12), (1999, 1), (1999, 2)]]


def bucket_sql():
    cells = []
    for v in portfolio.VALUES:
        cells.append(f"CASE WHEN first_req < {_STARTS[0]} THEN ord_{v} ELSE 0 END AS ord_{v}")
        for i in range(5):
            cells.append(f"CASE WHEN first_req >= {_STARTS[i]} AND first_req < {_STARTS[i + 1]} THEN ord_{v} ELSE 0 END AS ord_{v}_m{i + 1}")
    return ", ".join(cells)


def report_sql(prefix, table, date, source, scale, measures):
    cells = ", ".join(f"CAST({prefix}_{v} AS DECIMAL(18, {scale})) AS {prefix}_{v}" for v in portfolio.VALUES)
    nonzero = " OR ".join(f"CAST({prefix}_{v} AS DECIMAL(18, {scale})) <> 0" for v in portfolio.VALUES)
    return f"""SELECT product_code, dest_id, inv_id, company, network, sales_organization, sales_office, order_number, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
  first_req AS first_req_del_date, strftime(requested_delivery_date, '%b %Y') AS requested_year_month, super_group_code, super_group_descr,
  concat_ws(' ', purchase_group_code, purchase_group_descr) AS purchase_group, CASE WHEN flag_erp = 1 THEN 'SAP' ELSE 'DWH' END AS order_source, '{source}' AS record_source,
  requested_delivery_date AS order_requested_delivery_date, {'d' if prefix == 'inv' else 'CAST(NULL AS DATE)'} AS invoice_date, {', '.join(REPORT_CODES)}, {measures}
  FROM (SELECT f.* EXCLUDE ({', '.join(f'{prefix}_{v}' for v in portfolio.VALUES)}), {cells}, {date} AS d, CASE WHEN flag_erp = 1 THEN first_req_del_date ELSE requested_delivery_date END AS first_req
    FROM {table} f JOIN products USING (product_code) WHERE (f.source = 'cas' OR (f.source = 'sap' AND division = 'FG')) AND ({nonzero})
    AND CAST(network AS INT) NOT IN (1, 2) AND coalesce(TRY_CAST(product_type_code AS INT), 0) > 0) x"""


def portfolio_sql():
    plain = {p: ", ".join(f"{p}_{v}" for v in portfolio.VALUES) for p in ("inv", "del")}
    budget_cells = ", ".join(
        f"sum(CASE WHEN month = {8 + i} THEN {old} END) AS bdg_{new}{'' if i == 0 else f'_m{i}'}"
        for old, new in (("qty_sold", "qty"), ("budget_nsv_eur", "nsv_eur")) for i in range(4))
    budget = f"""SELECT b.*, m.market_budget, m.market_budget_descr, 1998 AS year, 8 AS month, 'BUD' AS record_source FROM (SELECT company, network, sales_organization, sales_office, product_code, {budget_cells}
      FROM report_budget GROUP BY ALL) b LEFT JOIN network_markets m USING (company, network) WHERE CAST(network AS INT) NOT IN (1, 2)"""
    texts = ["first_req_del_date", "order_requested_delivery_date", "invoice_date", "order_date", "confirmed_date"]
    codes = ("salesman_code", "rsm_code")
    keys = [k for k in REPORT_KEYS if k not in ("month", "super_group_descr", "sale_director_code", *texts, *codes)]
    sums = ", ".join(f"CAST(sum({s}) AS DOUBLE) AS {s}" for s in portfolio.SUMS)
    return f"""WITH o AS ({report_sql('ord', 'report_orders', 'document_date', 'ORD', 4, bucket_sql())}), d AS ({report_sql('del', 'report_deliveries', 'document_date', 'DEL', 2, plain['del'])}),
i AS ({report_sql('inv', 'report_invoices', 'time_id', 'INV', 2, plain['inv'])}), bud AS ({budget}),
u AS (SELECT * FROM o UNION ALL BY NAME SELECT * FROM d UNION ALL BY NAME SELECT * FROM i UNION ALL BY NAME SELECT * FROM bud),
n AS (SELECT u.* EXCLUDE (month, {', '.join(texts)}), {', '.join(f'CAST(u.{c} AS STRING) AS {c}' for c in texts)}, strftime(make_date(u.year, u.month, 1), '%b') AS month, super_group_code || ' - ' || super_group_descr AS super_group,
  main_group_code || ' - ' || g.name AS main_group, z.name AS sale_zone, m.name AS salesman, r.name AS sale_director, s.name AS rsm, t.bezei AS order_type,
  responsible_code1 AS region_code, responsible_code AS cluster_code, responsible_code3 AS subcluster_code, responsible_descr1 AS region, responsible_descr AS cluster, responsible_descr3 AS subcluster,
  TRY_CAST(u.salesman_code AS DOUBLE) AS salesman_no, TRY_CAST(u.rsm_code AS DOUBLE) AS rsm_no, CAST(u.first_req_del_date - DATE '1899-12-30' AS DOUBLE) AS first_req_del_date_num
  FROM u LEFT JOIN sales_names g ON main_group_code = g.code LEFT JOIN sales_names z ON sale_zone_code = z.code LEFT JOIN sales_names m ON u.salesman_code = m.code
  LEFT JOIN sales_names r ON sale_director_code = r.code LEFT JOIN sales_names s ON u.rsm_code = s.code LEFT JOIN (SELECT auart, bezei FROM tvakt WHERE spras = 'EN') t ON u.order_type_code = t.auart
  LEFT JOIN network_responsibles USING (company, network) WHERE u.year = 1998 AND u.month = 8)
SELECT {', '.join(keys)}, {', '.join(texts)}, month, super_group, {', '.join(REPORT_NAMES)}, salesman_no AS salesman_code, rsm_no AS rsm_code, first_req_del_date_num,
  CAST(NULL AS STRING) AS comm_organization_id, {sums}
FROM n GROUP BY {', '.join(keys)}, {', '.join(texts)}, month, super_group, {', '.join(REPORT_NAMES)}, salesman_no, rsm_no, first_req_del_date_num"""


@query("b21_portfolio", portfolio_sql(), " ".join(f"{s}:4" for s in portfolio.SUMS))
def b21(t):
    types = t.products.select("product_code", "product_type_code")
    order_rows = portfolio.report_columns(
        portfolio.typed_rows(portfolio.in_month(t.report_orders, "document_date", AS_OF), types, "ord", 4), "ORD", "document_date")
    delivery_rows = portfolio.report_columns(
        portfolio.typed_rows(portfolio.in_month(t.report_deliveries, "document_date", AS_OF), types, "del", 2), "DEL", "document_date")
    invoice_rows = portfolio.report_columns(
        portfolio.typed_rows(portfolio.in_month(t.report_invoices, "time_id", AS_OF), types, "inv", 2), "INV", "time_id"
    ).withColumn("invoice_date", F.col("time_id").cast("date"))
    budget = portfolio.budget_rows(t.report_budget, t.network_markets, AS_OF)
    codes = portfolio.portfolio(order_rows, budget, delivery_rows, invoice_rows, REPORT_KEYS, AS_OF)
    order_types = t.tvakt.where("spras = 'EN'").select("auart", "bezei")
    report = portfolio.with_report_texts(codes, t.sales_names, order_types, t.network_responsibles)
    report = portfolio.measures_by_source(report, AS_OF)
    report = text_dates(report, "first_req_del_date", "order_requested_delivery_date", "invoice_date", "order_date", "confirmed_date",
                        "comm_organization_id").withColumn("first_req_del_date_num", F.col("first_req_del_date_num").cast("double"))
    return report.select(
        *[k for k in REPORT_KEYS if k not in ("super_group_descr", "sale_director_code")], "super_group", *REPORT_NAMES,
        "first_req_del_date_num", "comm_organization_id", *[F.col(s).cast("double").alias(s) for s in portfolio.SUMS])


# --- cost and budget tables -------------------------------------------------------------

NEWEST = "ingestion_date = (SELECT max(ingestion_date) FROM {0} x WHERE x.years = e.years)"
EXPORT_UNIT = "lpad(split_part(organization, '_', 1), 2, '0') AS company, lpad(split_part(organization, '_', 2), 2, '0') AS network"
CLIENT_UNIT = "lpad(split_part(client, '_', 2), 2, '0') AS client_company, lpad(split_part(client, '_', 3), 2, '0') AS client_network"
YEAR = "CAST('20' || substring(years, 3, 2) AS INT) AS year"


@query("b22_budget", f"""
WITH cells AS ({" UNION ALL ".join(
    f"SELECT account, currency, organization, product_code, years, {i + 1} AS month, {m} AS v FROM budget_export e WHERE {NEWEST.format('budget_export')}"
    for i, m in enumerate(fixed.MONTHS))}),
wide AS (SELECT {EXPORT_UNIT}, product_code, {YEAR}, month, max(CASE WHEN account = 'A_NSV_MEDIO' AND currency = 'EUR' THEN v END) AS nsv_eur,
  max(CASE WHEN account = '1095_LFG' THEN v END) AS qty_sold, max(CASE WHEN account = '2000_ASO_CALC' THEN v END) AS gross_sales_local FROM cells GROUP BY organization, product_code, years, month)
SELECT company, network, product_code, year, month, nsv_eur, qty_sold, gross_sales_local, nsv_eur * qty_sold AS budget_nsv_eur, sales_organization FROM wide LEFT JOIN company_network USING (company, network)
""", "nsv_eur qty_sold gross_sales_local budget_nsv_eur")
def b22_budget(t):
    return costs.budget(t.budget_export, t.company_network).select(
        "company", "network", "product_code", "year", "month", "nsv_eur", "qty_sold",
        "gross_sales_local", "budget_nsv_eur", "sales_organization")


@query("b22_forecast", f"""
WITH cells AS ({" UNION ALL ".join(
    f"SELECT *, {i + 1} AS month, {m} AS v FROM forecast_export WHERE {m} IS NOT NULL AND {i + 1} > CAST(substring(ingestion_date, 5, 2) AS INT)"
    for i, m in enumerate(fixed.MONTHS))}),
newest AS (SELECT * FROM cells c WHERE ingestion_date = (SELECT max(ingestion_date) FROM cells x WHERE x.years = c.years AND x.month = c.month))
SELECT {YEAR}, month, substring(material_sku, 5) AS product_code, nullif(substring(product_brand, 5), 'None') AS product_brand, split_part(sales_offices, '_', 2) AS sales_office,
  nullif(regexp_replace(source_plant, '^SrcPlant_', ''), 'None') AS source_plant, max(CASE WHEN account = 'Dest_1095' THEN v END) AS qty_sold, max(CASE WHEN account = 'NSV' THEN v END) AS nsv_local
FROM newest GROUP BY years, month, material_sku, product_brand, sales_offices, source_plant
""", "qty_sold nsv_local")
def b22_forecast(t):
    return costs.forecast_values(t.forecast_export).select(
        "year", "month", "product_code", "product_brand", "sales_office", "source_plant", "qty_sold",
        "nsv_local")


def account(name):
    return f"max(CASE WHEN account = '{name}' THEN beg_balance END)"


@query("b22_freight_in", f"""
WITH wide AS (SELECT {EXPORT_UNIT}, {CLIENT_UNIT}, product_code, {YEAR}, {', '.join(f"{account(a)} AS {n}" for a, n in fixed.FREIGHT_ACCOUNTS.items())}
  FROM cost_export e WHERE ingestion_date = (SELECT max(ingestion_date) FROM cost_export x WHERE x.years = e.years AND x.product_code = e.product_code) GROUP BY organization, client, product_code, years)
SELECT w.company, w.network, client_company, client_network, product_code, year, coalesce(customs_cost_1, 0) + coalesce(customs_cost_2, 0) + coalesce(customs_cost_3, 0) AS customs_duty_eur,
  coalesce(customs_cost_1, 0) + coalesce(customs_cost_2, 0) + coalesce(customs_cost_3, 0) + coalesce(handling_network, 0) + coalesce(transportation_cost, 0) AS freight_in_eur,
  coalesce(handling_ic, 0) AS transport_cost_infra_eur, o.sales_office, c.sales_office AS client_sales_office FROM wide w LEFT JOIN company_network o ON w.company = o.company AND w.network = o.network
  LEFT JOIN company_network c ON client_company = c.company AND client_network = c.network
""", "customs_duty_eur freight_in_eur transport_cost_infra_eur")
def b22_freight(t):
    return costs.freight_in(t.cost_export, t.company_network).select(
        "company", "network", "client_company", "client_network", "product_code", "year",
        "customs_duty_eur", "freight_in_eur", "transport_cost_infra_eur", "sales_office",
        "client_sales_office")


def total(name):
    return f"sum(CASE WHEN lower(account) = '{name}' THEN beg_balance END)"


@query("b22_transfer_prices", f"""
WITH wide AS (SELECT {EXPORT_UNIT}, {CLIENT_UNIT}, product_code, {YEAR}, coalesce({total('tp_commerciale_definitive')}, {total('tp_commerciale_indicative')}) AS tp_commerciale,
  {total('tp_itcy_indicative')} AS tp_itcy FROM cost_export e WHERE {NEWEST.format('cost_export')} GROUP BY organization, client, product_code, years)
SELECT w.company, w.network, client_company, client_network, product_code, year, tp_commerciale, tp_itcy, o.sales_organization FROM wide w
LEFT JOIN company_network o ON w.company = o.company AND w.network = o.network
""", "tp_commerciale tp_itcy")
def b22_transfer(t):
    return costs.transfer_prices(t.cost_export, t.company_network).select(
        "company", "network", "client_company", "client_network", "product_code", "year",
        "tp_commerciale", "tp_itcy", "sales_organization")


@query("b22_indefinite_costs", f"""
SELECT product_code, {YEAR}, coalesce({total('std_prod_cost_no_tca_definitive')}, {total('std_prod_cost_no_tca_indicative')}) AS std_prod_cost_no_tca, {total('tca_indicative')} AS tca
FROM cost_export e WHERE {NEWEST.format('cost_export')} GROUP BY product_code, years
""", "std_prod_cost_no_tca tca")
def b22_indefinite(t):
    return costs.indefinite_costs(t.cost_export).select("product_code", "year", "std_prod_cost_no_tca", "tca")


@query("b22_commercial_costs", f"""
WITH q AS (SELECT *, regexp_extract(input_file_name, '(Q[1-4])', 1) AS quarter FROM cost_export),
n AS (SELECT product_code, '20' || substring(years, 3, 2) || quarter AS year_quarter, beg_balance AS cost FROM q e WHERE account = 'A_CDC_1'
  AND ingestion_date = (SELECT max(ingestion_date) FROM q x WHERE account = 'A_CDC_1' AND x.years = e.years AND x.quarter = e.quarter))
SELECT * FROM n UNION ALL SELECT product_code, CASE WHEN right(year_quarter, 1) = '4' THEN CAST(CAST(left(year_quarter, 4) AS INT) + 1 AS STRING) || 'Q1'
  ELSE left(year_quarter, 5) || CAST(CAST(right(year_quarter, 1) AS INT) + 1 AS STRING) END, cost FROM n WHERE year_quarter = (SELECT max(year_quarter) FROM n)
""", "cost")
def b22_commercial(t):
    export = t.cost_export.where("account = 'A_CDC_1'").withColumn("std_prod_cost_commercial", F.col("beg_balance"))
    return costs.commercial_costs(export).select(
        "product_code", "year_quarter", F.col("std_prod_cost_commercial").alias("cost"))


# --- forecast, calendars, change log --------------------------------------------------------

RELEASE = """rel AS (SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, CAST(CAST(ts AS DATE) AS STRING) AS forecast_date,
  event_type AS logistic_area, CAST(user_id AS STRING) AS sku, value FROM events)"""


def forecast_source(t, days):
    day = F.col("ts")
    return t.events.where(days).select(
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.date_format(day, "yyyy-MM-dd").alias("forecastdate"), F.lit("2024-03-01").alias("forecastmonth"),
        F.col("value").cast("string").alias("forecastqty"), F.lit("1").alias("matematico"),
        F.col("event_type").alias("logisticarea"), F.col("user_id").cast("string").alias("SKU"))


@query("b23_release_totals", f"""
WITH {RELEASE}, fresh AS (SELECT * FROM rel WHERE day > '07')
SELECT 'W.' || year || '-' || month || '.' || CAST(dense_rank() OVER (PARTITION BY year, month ORDER BY day) AS STRING) AS version, year || '-' || month || '-' || day AS ingestion_date,
  forecast_date, logistic_area, sku, sum(value) AS forecast_qty, CAST(count(*) AS DOUBLE) AS matematico FROM fresh GROUP BY year, month, day, forecast_date, logistic_area, sku
""", "forecast_qty:4 matematico")
def b23_releases(t):
    """Days up to the seventh are stored already; the rest are new releases."""
    stored = readers.padded_parts(forecast_source(t, "dayofmonth(ts) <= 7")).select("year", "month", "day")
    rows = forecast.new_releases(forecast_source(t, "true"), stored)
    return text_dates(forecast.release_totals(rows, "W"), "ingestion_date", "forecast_date").select(
        "version", "ingestion_date", "forecast_date", "logistic_area", "sku", "forecast_qty", "matematico")


@query("b23_newest_forecast", f"""
WITH {RELEASE}, w AS (SELECT * FROM rel WHERE day < '25'), m AS (SELECT * FROM rel WHERE logistic_area = 'view'),
both_kinds AS (SELECT 'WEEKLY' AS forecast_type, * FROM w WHERE day = (SELECT max(day) FROM w) UNION ALL SELECT 'MONTHLY', * FROM m WHERE day = (SELECT max(day) FROM m))
SELECT forecast_type, forecast_date AS ingestion_date, logistic_area, sku, sum(value) AS forecast_qty, CAST(forecast_type = 'MONTHLY' AS INT) AS latest_forecast FROM both_kinds GROUP BY ALL
""", "forecast_qty:4")
def b23_newest(t):
    weekly = forecast.release_totals(forecast.typed_forecast(forecast_source(t, "dayofmonth(ts) < 25")), "W")
    monthly = forecast.release_totals(forecast.typed_forecast(forecast_source(t, "event_type = 'view'")), "M")
    return text_dates(forecast.newest_forecast(weekly, monthly), "ingestion_date").select(
        "forecast_type", "ingestion_date", "logistic_area", "sku", "forecast_qty",
        F.col("latest_forecast").cast("int").alias("latest_forecast"))


@query("b24_rate_calendar", """
WITH known AS (SELECT currency, exchange_date, exchange_value, type FROM tcurr WHERE target = 'EUR' AND type = 'EURX' AND exchange_value IS NOT NULL),
spine AS (SELECT currency, CAST(d AS DATE) AS exchange_date FROM (SELECT DISTINCT currency FROM known) c,
  (SELECT unnest(generate_series((SELECT min(exchange_date) FROM known), greatest((SELECT max(exchange_date) FROM known), DATE '2002-01-31'), INTERVAL 1 DAY)) AS d) s),
filled AS (SELECT currency, exchange_date, last_value(exchange_value IGNORE NULLS) OVER w AS v, last_value(type IGNORE NULLS) OVER w AS type FROM spine LEFT JOIN known USING (currency, exchange_date)
  WINDOW w AS (PARTITION BY currency ORDER BY exchange_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT currency, CAST(exchange_date AS STRING) AS exchange_date, CASE WHEN v < 0 THEN 1 / abs(v) ELSE v END AS exchange_value, type FROM filled
""", "exchange_value")
def b24(t):
    return text_dates(calendar.rate_calendar(t.tcurr, "2002-01-31"), "exchange_date").select(
        "currency", "exchange_date", "exchange_value", "type")


@query("b25_fiscal_calendar", f"""
WITH {CALENDAR_SQL} SELECT CAST(CAST(d AS DATE) AS STRING) AS day, CAST(month AS STRING) AS month FROM spans, LATERAL (SELECT unnest(generate_series(start_date, cutoff_date, INTERVAL 1 DAY)) AS d) x
WHERE year(d) = 1998
""")
def b25(t):
    texts = t.cutoffs.select(F.date_format("cutoff_date", "dd/MM/yyyy").alias("cutoff_date"),
                             F.date_format("month", "MMM-yy").alias("month"))
    parsed = calendar.cutoffs_from_text(texts).withColumn(
        "month", F.when(F.year("month") > 2050, F.add_months("month", -1200)).otherwise(F.col("month")))
    return text_dates(calendar.fiscal_calendar(parsed, 1998), "day", "month")


@query("b26_block_events", f"""
WITH {BLOCK_EVENTS} SELECT * FROM block_log
""")
def b26(t):
    return blocks.block_events(t.cdhdr, t.cdpos)


# --- products, re-assembly, texts -------------------------------------------------------------

MASTER_NAMES = ["Brand", "Energy_kWh", "Markets", "Object_Type", "Packed_Product_Depth_mm", "Packed_Product_Height_mm",
                "Packed_Product_Width_mm", "Release_Status", "Start_Date", "Factory_CAS", "Supplier_Code_SAP"]
SIDE_NAMES = ["release_date", "smd_input_date", "commodity_code_extension", "material_preferential_origin", "inward_processing_code",
              "plant_status", "customs_number", "material_group", "producer_code", "producer_descr", "supplier_code", "supplier_descr"]


def workflow_sql(name, task):
    return f"""{name} AS (SELECT product_code, done_on FROM (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY last_mod_date DESC, done_on) AS rn
  FROM (SELECT unnest(string_split(item_ids, '~')) AS product_code, done_on, last_mod_date FROM workflow WHERE task_name = '{task}') w) x WHERE rn = 1)"""


@query("b27_product_master", f"""
WITH typed AS (SELECT sku, trim(regexp_replace(regexp_replace(key, '\\[[^\\]]*\\]', '', 'g'), '[^\\w]+', ' ', 'g')) AS k, value, tree_name FROM attributes),
wide AS (SELECT sku, min(CASE WHEN k = 'Brand' THEN value END) AS brand, min(CASE WHEN k = 'Markets' THEN replace(value, '~', '; ') END) AS markets,
  min(CASE WHEN k = 'Object Type' THEN value END) AS object_type, min(CASE WHEN k = 'Release Status' THEN value END) AS release_status,
  CAST(TRY_CAST(min(CASE WHEN k = 'Start Date' THEN CAST(TRY_CAST(value AS DATE) AS STRING) END) AS STRING) AS STRING) AS start_date,
  TRY_CAST(min(CASE WHEN k = 'Packed Product Height mm' THEN CAST(TRY_CAST(value AS DOUBLE) AS STRING) END) AS DOUBLE) AS h,
  TRY_CAST(min(CASE WHEN k = 'Packed Product Width mm' THEN value END) AS DOUBLE) AS w,
  min(CASE WHEN k = 'Factory CAS' THEN value END) AS factory, min(CASE WHEN k = 'Supplier Code SAP' THEN value END) AS supplier,
  string_agg(DISTINCT tree_name, ', ' ORDER BY tree_name) AS tree_names FROM typed GROUP BY sku),
{workflow_sql('released', 'Release')}, {workflow_sql('smd', 'SMD input')},
chars AS (SELECT product_code, min(CASE WHEN characteristic = 'ZPROD_COMCODEEXT' THEN characteristic_value END) AS commodity_code_extension,
  min(CASE WHEN characteristic = 'ZPREF_ORIG' THEN characteristic_value END) AS material_preferential_origin,
  min(CASE WHEN characteristic = 'ZPROD_INWCODE' THEN characteristic_value END) AS inward_processing_code FROM characteristics JOIN characteristic_names USING (characteristic_id) GROUP BY 1),
trade AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY last_update DESC) AS rn FROM trade_classes WHERE validity_end_date > DATE '2024-02-01') x WHERE rn = 1),
base AS (SELECT unnest(string_split(value, '~')) AS sku, sku AS base_sku FROM attributes WHERE key = 'Related Derivate Model')
SELECT w.sku, w.brand, w.markets, CASE WHEN w.release_status = 'Released' THEN 'On sale' WHEN w.release_status = 'Draft' THEN 'Planned' END AS business_status, w.start_date, base_sku,
  b.start_date AS base_start, w.tree_names, split_part(w.object_type, '-', 1) AS product_type_code, nullif(split_part(w.object_type, '-', 2), '') AS product_type_descr,
  CAST(released.done_on AS STRING) AS release_date, CAST(smd.done_on AS STRING) AS smd_input_date, commodity_code_extension, material_preferential_origin, inward_processing_code,
  plant_status, customs_number, material_group, split_part(w.factory, '-', 1) AS producer_code, w.factory AS producer_descr, split_part(w.supplier, '-', 1) AS supplier_code, w.supplier AS supplier_descr,
  w.h / 1000 * (w.w / 1000) * 0.5e0 AS volume_m3 FROM wide w LEFT JOIN base USING (sku) LEFT JOIN wide b ON base_sku = b.sku LEFT JOIN released ON w.sku = released.product_code LEFT JOIN smd ON w.sku = smd.product_code
LEFT JOIN chars ON w.sku = chars.product_code LEFT JOIN trade ON w.sku = trade.product_code LEFT JOIN plants ON w.sku = plants.product_code LEFT JOIN materials ON w.sku = materials.product_code
""", "volume_m3:9")
def b27(t):
    typed = master.typed_attributes(t.attributes, t.attribute_kinds)
    statuses = t.part.select(F.lit("Released").alias("status"), F.lit("On sale").alias("text")).distinct().unionByName(
        t.part.select(F.lit("Draft").alias("status"), F.lit("Planned").alias("text")).distinct())
    out = master.product_master(typed, MASTER_NAMES, statuses, {"Start_Date": "base_start"})
    out = text_dates(master.with_product_sides(out, [
        master.released_products(t.workflow, "Release", "done_on").withColumnRenamed("done_on", "release_date"),
        master.released_products(t.workflow, "SMD input", "done_on").withColumnRenamed("done_on", "smd_input_date"),
        characteristic_pivot(t.characteristics, t.characteristic_names, fixed.CHARACTERISTICS), t.plants, t.materials,
        master.trade_class(t.trade_classes, "2024-02-01").select("product_code", "customs_number"),
    ]), "release_date", "smd_input_date")
    return out.select(
        *SIDE_NAMES,
        "sku", F.col("Brand").alias("brand"), F.col("Markets").alias("markets"), "business_status",
        F.col("Start_Date").alias("start_date"), "base_sku", "base_start",
        F.nullif("tree_names", F.lit("")).alias("tree_names"), "product_type_code", "product_type_descr",
        "volume_m3")


@query("b27_current_attributes", """
WITH d AS (SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS sku, p_brand AS brand, p_type AS kind, CASE WHEN p_size < 25 THEN '2024-01-05' ELSE '2024-01-09' END AS day FROM part),
k AS (SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS sku, 'bulk ' || p_brand AS brand, '2024-01-07' AS day FROM part)
SELECT sku, 'brand' AS key, brand AS value, 'delta' AS ingestion_type FROM d UNION ALL SELECT sku, 'kind', kind, 'delta' FROM d
UNION ALL SELECT k.sku, 'brand', k.brand, 'bulk' FROM k JOIN d USING (sku) WHERE k.day > d.day
""")
def b27_current(t):
    sku = F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("sku")
    older = F.when(F.col("p_size") < 25, "2024-01-05").otherwise("2024-01-09")
    delta = t.part.select(sku, F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"))).alias("payload"),
                          older.alias("ingestion_date"))
    early = t.part.select(sku, F.to_json(F.struct(F.lit("old").alias("brand"))).alias("payload"),
                          F.lit("2024-01-01").alias("ingestion_date"))
    bulk = t.part.select(sku, F.to_json(F.struct(F.concat(F.lit("bulk "), "p_brand").alias("brand"))).alias("payload"),
                         F.lit("2024-01-07").alias("ingestion_date"))
    return master.current_attributes(delta.unionByName(early), bulk, ["sku"]).select(
        "sku", "key", "value", "ingestion_type")


@query("b28_fact_roundtrip", f"""
WITH {STATUS}, {HEADERS}, erp AS (SELECT 'sap' AS source, concat_ws('###', 'ORDER', order_number, order_line, order_status, schedule_line, allocation_warehouse) AS key_fact,
    ord_qty_fabs, blocking_type AS detail, order_type_descr FROM status JOIN heads USING (order_number)),
cas AS (SELECT 'cas' AS source, 'ORDER###' || order_number || '###' || order_line AS key_fact, max(quantity) AS ord_qty_fabs, max(type_text) AS detail, CAST(NULL AS STRING) AS order_type_descr
  FROM (SELECT *, 'legacy ' || CAST(flag_bgrade AS STRING) AS type_text FROM legacy_sales WHERE data_type = 2) s GROUP BY order_number, order_line)
SELECT source, key_fact, max(ord_qty_fabs) AS ord_qty_fabs, max(detail) AS detail, max(order_type_descr) AS order_type_descr FROM (SELECT * FROM erp UNION ALL SELECT * FROM cas) u GROUP BY source, key_fact
""", "ord_qty_fabs")
def b28(t):
    """Both systems' orders split into fact and dimension side, stacked and joined again."""
    from saleweft.functions.text import make_key

    grain = ["order_number", "order_line", "order_status", "schedule_line", "allocation_warehouse"]
    lines = orders.order_status(order_tables(t), by_line=True).join(headers(t), ["order_number"], "inner")
    erp = lines.transform(orders.each_status).select(
        make_key("###", F.lit("ORDER"), *grain).alias("key_fact"), "ord_qty_fabs",
        F.col("blocking_type").alias("detail"), "order_type_descr", "sales_organization", "sales_office",
        F.lit("p").alias("product_code"), "document_date")
    erp = erp.groupBy("key_fact").agg(*[F.max(c).alias(c) for c in erp.columns[1:]])
    old = legacy.legacy_fact(t.legacy_sales, "ORDER").groupBy("key_fact").agg(
        F.max("quantity").alias("ord_qty_fabs"),
        F.max(F.concat(F.lit("legacy "), F.col("flag_bgrade").cast("string"))).alias("detail"),
        F.max("document_date").alias("document_date"))
    fact = add_missing_columns(old, ["sales_organization", "sales_office", "product_code"], F.lit(None).cast("string"))
    narrow = ["key_fact", "ord_qty_fabs", "sales_organization", "sales_office", "product_code", "document_date"]
    erp_fact, erp_dim = reassembly.split_fact(erp, narrow)
    old_fact, old_dim = reassembly.split_fact(fact, narrow)
    whole = reassembly.joined_facts({fixed.ERP: erp_fact, fixed.LEGACY: old_fact},
                                    {fixed.ERP: erp_dim, fixed.LEGACY: old_dim})
    return whole.select("source", "key_fact", "ord_qty_fabs", "detail", "order_type_descr")


@query("b29_shipment_types", """
WITH typed AS (SELECT i.vbeln AS despatching_note, k.vsart || ' - ' || coalesce(s.text, 'Not Defined') AS kind FROM vttp i LEFT JOIN vttk k USING (tknum) LEFT JOIN shipping_texts s USING (vsart))
SELECT despatching_note, coalesce(string_agg(DISTINCT kind, ' ; ' ORDER BY kind), '') AS shipping_type FROM typed GROUP BY 1
""")
def b29(t):
    return deliveries.shipment_types(t.vttp, t.vttk, t.shipping_texts)


@query("b30_load_csv_table", """
SELECT CAST(n_nationkey AS STRING) AS area, n_name AS area_descr, CAST(n_regionkey AS STRING) AS responsible FROM nation
""")
def b30(t):
    """A headed CSV export loaded into a table."""
    from .scans import table_name

    path, name = t.scratch("areas"), table_name("areas")
    t.nation.select(F.col("n_nationkey").alias("area"), F.col("n_name").alias("area_descr"),
                    F.col("n_regionkey").alias("responsible")).write.csv(path, header=True)
    writers.save_table(readers.read_csv(t.spark, path), name, path=t.scratch(name))
    return readers.read_table(t.spark, name)


# --- the flagship -----------------------------------------------------------------------


@query("flagship_margin_by_nation", """
WITH order_lines AS (SELECT l_orderkey, sum(l_quantity) AS ordered, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS delivered,
    sum(l_extendedprice * (1 - l_discount)) AS net, sum(p_retailprice * l_quantity * 0.5e0) AS cost FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT coalesce(n_name, 'Not Defined') AS nation, count(*) AS open_orders, sum(ordered - delivered) AS open_qty, sum(net) AS nsv, sum(CASE WHEN net <> 0 THEN net - cost ELSE 0 END) AS margin
FROM order_lines JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE ordered - delivered > 0 GROUP BY 1
""", "open_qty:2 nsv:2 margin:2")
def flagship(t):
    """Open orders and their margin by nation: the smallest cut through the order plans."""
    delivered = F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)
    cost = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    lines = (
        t.lineitem.join(cost, ["l_partkey"], "inner").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum("l_quantity").alias("ordered"), F.sum(delivered).alias("delivered"),
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
            F.sum(F.col("p_retailprice") * F.col("l_quantity") * 0.5).alias("cost"))
        .withColumn("open_qty", F.col("ordered") - F.col("delivered")).where("open_qty > 0"))
    margin = F.when(F.col("net") != 0, F.col("net") - F.col("cost")).otherwise(0.0)
    return (
        lines.join(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], "inner")
        .transform(checked_lookup, t.customer.select("c_custkey", "c_nationkey"), "o_custkey", "nation_key")
        .transform(checked_lookup, t.nation.select("n_nationkey", "n_name"), "nation_key", "nation",
                   F.lit(fixed.NOT_DEFINED))
        .groupBy("nation").agg(
            F.count(F.lit(1)).alias("open_orders"), F.sum("open_qty").alias("open_qty"),
            F.sum("net").alias("nsv"), F.sum(margin).alias("margin"))
    )
