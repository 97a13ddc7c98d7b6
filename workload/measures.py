"""M: measure formulas over whole line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.operators.joins import cancelled_lookup
from saleweft.operators.lookup import literal_lookup
from saleweft.functions.text import make_key
from saleweft.plans import legacy as lg
from saleweft.plans import measures as m

from .registry import query

AS_OF = "1998-08-15"
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
K = ", ".join(KEY)


def c0(x):
    return f"coalesce({x}, 0)"


# --- orders -----------------------------------------------------------------------

ORD_QTY = """CASE WHEN doc_type_code IN (5, 6) OR order_type_code IN ('ZKA', 'ZKB') THEN 0
  WHEN doc_type_code = 4 AND order_type_code IN ('ZREB', 'ZREG') AND category = 'C' THEN -ord_qty_fabs
  ELSE ord_qty_fabs * return_sign END"""
ORD_CONS = "CASE WHEN order_type_code IN ('ZKA', 'ZKB') THEN ord_qty_fabs * return_sign ELSE 0 END"


def disc(name):
    return f"coalesce({name} * coalesce(exchange_rate_erp, 1) * return_sign, 0)"


def ord_value(name):
    return f"(ord_{name}_lc_tot + {disc('ord_ic_discount')}) * pct_ord_qty * return_sign"


@query("m01_order_qty", f"""
SELECT {K}, {ORD_QTY} AS ord_qty, {ORD_CONS} AS ord_qty_consignment FROM ord_base
""", "ord_qty ord_qty_consignment")
def m01(t):
    return m.order_quantities(t.ord_base).select(*KEY, "ord_qty", "ord_qty_consignment")


@query("m02_order_values", f"""
SELECT {K}, {ord_value('nsv')} AS ord_nsv_lc, {ord_value('gsv')} AS ord_gsv_lc FROM ord_base
""", "ord_nsv_lc:4 ord_gsv_lc:4")
def m02(t):
    return m.order_values(t.ord_base).select(*KEY, "ord_nsv_lc", "ord_gsv_lc")


@query("m03_order_prices", f"""
SELECT {K}, list_price_tot * pct_ord_qty / nullif(ord_qty, 0) AS list_price,
  forced_price_tot * pct_ord_qty / nullif(ord_qty, 0) AS forced_price,
  coalesce(forced_price_tot * pct_ord_qty / nullif(ord_qty, 0), 0) + coalesce(list_price_tot * pct_ord_qty / nullif(ord_qty, 0), 0) AS net_price,
  removable_charges_tot * pct_ord_qty AS removable_charges FROM (SELECT *, {ORD_QTY} AS ord_qty FROM ord_base) b
""", "list_price:4 forced_price:4 net_price:4 removable_charges:4")
def m03(t):
    return m.order_prices(m.order_quantities(t.ord_base)).select(
        *KEY, "list_price", "forced_price", "net_price", "removable_charges")


CP = "(cons_cost_unit + tca_unit + freight_in_unit + infra_unit) * exchange_to_local"
TP = "(comm_cost_unit + freight_in_unit) * exchange_to_local"


@query("m04_cost_price", f"SELECT {K}, {CP} * ({ORD_QTY}) AS ord_cp_lc FROM ord_base", "ord_cp_lc")
def m04(t):
    return t.ord_base.transform(m.order_quantities).transform(m.cost_price, "ord").select(
        *KEY, "ord_cp_lc")


@query("m05_transfer_price", f"SELECT {K}, {TP} * ({ORD_QTY}) AS ord_tp_lc FROM ord_base", "ord_tp_lc")
def m05(t):
    return t.ord_base.transform(m.order_quantities).transform(m.transfer_price, "ord").select(
        *KEY, "ord_tp_lc")


ORD_SQL = f"""q AS (SELECT *, {ORD_QTY} AS ord_qty FROM ord_base),
lc AS (SELECT *, {ord_value('nsv')} AS ord_nsv_lc, {ord_value('gsv')} AS ord_gsv_lc, {CP} * ord_qty AS ord_cp_lc, {TP} * ord_qty AS ord_tp_lc FROM q),
eur AS (SELECT *, ord_nsv_lc * exchange AS ord_nsv_eur, ord_gsv_lc * exchange AS ord_gsv_eur, ord_cp_lc * exchange AS ord_cp_eur, ord_tp_lc * exchange AS ord_tp_eur FROM lc),
gm AS (SELECT *, """ + ", ".join(
    f"CASE WHEN coalesce(ord_nsv_{u}, 0) <> 0 THEN ord_nsv_{u} - coalesce(ord_{c}_{u}, 0) ELSE 0 END AS ord_gm_{c}_{u}"
    for c in ("tp", "cp") for u in ("eur", "lc")) + " FROM eur)"


def order_chain(t):
    return (
        t.ord_base.transform(m.order_quantities).transform(m.order_values)
        .transform(m.cost_price, "ord").transform(m.transfer_price, "ord")
        .transform(m.euro_values, "ord").transform(m.margins, "ord")
    )


@query("m06_euro_values", f"""
WITH {ORD_SQL} SELECT {K}, ord_nsv_eur, ord_gsv_eur, ord_cp_eur, ord_tp_eur FROM eur
""", "ord_nsv_eur:4 ord_gsv_eur:4 ord_cp_eur:4 ord_tp_eur:4")
def m06(t):
    return order_chain(t).select(*KEY, "ord_nsv_eur", "ord_gsv_eur", "ord_cp_eur", "ord_tp_eur")


@query("m07_margins", f"""
WITH {ORD_SQL} SELECT {K}, ord_gm_tp_eur, ord_gm_cp_eur, ord_gm_tp_lc, ord_gm_cp_lc FROM gm
""", "ord_gm_tp_eur:4 ord_gm_cp_eur:4 ord_gm_tp_lc:4 ord_gm_cp_lc:4")
def m07(t):
    return order_chain(t).select(*KEY, "ord_gm_tp_eur", "ord_gm_cp_eur", "ord_gm_tp_lc", "ord_gm_cp_lc")


@query("m08_backlog", f"""
WITH {ORD_SQL} SELECT l_suppkey, """ + ", ".join(
    f"sum(CASE WHEN requested_delivery_date < DATE '1998-08-01' THEN ord_{x} ELSE 0 END) AS ord_bo_{x}"
    for x in ("qty", "nsv_eur", "gm_cp_eur")) + " FROM gm GROUP BY l_suppkey",
    "ord_bo_qty:6 ord_bo_nsv_eur:6 ord_bo_gm_cp_eur:6")
def m08(t):
    out = order_chain(t).transform(m.backlog_copies, AS_OF)
    return out.groupBy("l_suppkey").agg(*[F.sum(c).alias(c) for c in (
        "ord_bo_qty", "ord_bo_nsv_eur", "ord_bo_gm_cp_eur")])


@query("m09_status_copies", f"""
WITH {ORD_SQL} SELECT {K}, """ + ", ".join(
    f"CASE WHEN order_status = '{s}' THEN ord_{x} ELSE 0 END AS {p}_{x}"
    for p, s in m.STATUS_PREFIXES.items() for x in ("qty", "nsv_eur")) + " FROM gm",
    " ".join(f"{p}_{x}:4" for p in m.STATUS_PREFIXES for x in ("qty", "nsv_eur")))
def m09(t):
    names = [f"{p}_{x}" for p in m.STATUS_PREFIXES for x in ("qty", "nsv_eur")]
    return order_chain(t).transform(m.status_copies).select(*KEY, *names)


@query("m10_potential_copies", f"""
WITH {ORD_SQL} SELECT {K}, ord_qty AS pot_qty, ord_nsv_eur AS pot_nsv_eur, ord_gm_tp_lc AS pot_gm_tp_lc FROM gm
""", "pot_qty pot_nsv_eur:4 pot_gm_tp_lc:4")
def m10(t):
    return order_chain(t).transform(m.potential_copies, "ord").select(
        *KEY, "pot_qty", "pot_nsv_eur", "pot_gm_tp_lc")


# --- deliveries --------------------------------------------------------------------

DEL_QTY = """CASE WHEN doc_type_code IN (5, 6) OR order_type_code IN ('ZKA', 'ZKB') THEN 0 ELSE del_qty_fabs * return_sign END"""


@query("m11_delivery_qty", f"""
SELECT {K}, {DEL_QTY} AS del_qty, {ORD_CONS.replace('ord_qty_fabs', 'del_qty_fabs')} AS del_qty_consignment FROM del_base
""", "del_qty del_qty_consignment")
def m11(t):
    return m.delivery_quantities(t.del_base).select(*KEY, "del_qty", "del_qty_consignment")


@query("m12_delivery_values", f"""
SELECT {K}, (del_nsv_lc_tot + {disc('del_ic_discount')}) / nullif(ord_qty_orig, 0) * del_qty AS del_nsv_lc,
  (del_gsv_lc_tot + {disc('del_ic_discount')}) / nullif(ord_qty_orig, 0) * del_qty AS del_gsv_lc FROM (SELECT *, {DEL_QTY} AS del_qty FROM del_base) b
""", "del_nsv_lc:4 del_gsv_lc:4")
def m12(t):
    return m.delivery_values(m.delivery_quantities(t.del_base)).select(*KEY, "del_nsv_lc", "del_gsv_lc")


# --- invoices ----------------------------------------------------------------------


@query("m13_invoice_doc_type", """
WITH docs AS (SELECT k.vbeln AS document_code, posnr, sfakn, CASE WHEN fkart = 'ZG2' AND upper(submi) = 'PEX' THEN 7
    ELSE coalesce(CASE fkart || '|' || augru WHEN 'ZL3|Z04' THEN 12 WHEN 'ZG3|Z04' THEN 13 END,
      CASE fkart WHEN 'ZRE' THEN 7 WHEN 'ZG2' THEN 6 WHEN 'ZL2' THEN 5 WHEN 'ZL3' THEN 14 WHEN 'ZF2' THEN 4 END) END AS kind
  FROM vbrk k JOIN vbrp p ON k.vbeln = p.vbeln LEFT JOIN vbak a ON p.aubel = a.vbeln),
top AS (SELECT document_code AS code, max(kind) AS top_kind FROM docs GROUP BY 1)
SELECT document_code, posnr, CAST(coalesce(top_kind, kind) AS DOUBLE) AS doc_type_code FROM docs LEFT JOIN top ON sfakn = code
WHERE coalesce(sfakn, '') = '' OR code IS NOT NULL
""")
def m13(t):
    orders = t.vbak.select(F.col("vbeln").alias("aubel"), F.col("augru").alias("order_reason"),
                           F.col("submi").alias("collective_number"))
    lines = t.vbrk.select("vbeln", F.col("fkart").alias("invoice_type"), F.col("sfakn").alias("cancelled_invoice")).join(
        t.vbrp.select("vbeln", "posnr", "aubel"), ["vbeln"], "inner").join(orders, ["aubel"], "left")
    return lines.withColumns({
        "document_code": F.col("vbeln"),
        "doc_type_code_single": literal_lookup("invoice_type", fixed.INVOICE_TYPE),
        "doc_type_code_concatenate": literal_lookup(make_key("|", "invoice_type", "order_reason"), fixed.INVOICE_TYPE),
    }).withColumn("doc_type_code_orig", m.invoice_doc_type()).transform(cancelled_lookup).select(
        "document_code", "posnr", F.col("doc_type_code").cast("double").alias("doc_type_code"))


INV_QTY = "CASE WHEN doc_type_code >= 5 AND doc_type_code <> 7 THEN 0 ELSE inv_qty_fabs * return_sign END"
INV_GSV = """CASE WHEN doc_type_code <= 7 THEN coalesce(inv_gsv_lc_temp, inv_gsv_bonus_lc_temp) * return_sign
  + coalesce(inv_ic_discount, 0) * coalesce(exchange_rate_erp, 1) * return_sign ELSE 0 END"""
INV_NSV = f"inv_nsv_lc_temp * return_sign + {disc('inv_ic_discount')}"


@query("m14_invoice_qty", f"SELECT {K}, {INV_QTY} AS inv_qty FROM inv_base", "inv_qty")
def m14(t):
    return m.invoice_quantity(t.inv_base).select(*KEY, "inv_qty")


@query("m15_invoice_gsv", f"""
SELECT {K}, {INV_GSV} AS inv_gsv_lc, coalesce(inv_gsv_lc_temp, inv_gsv_bonus_lc_temp) * return_sign AS inv_gsv_promo_bonus_lc FROM inv_base
""", "inv_gsv_lc inv_gsv_promo_bonus_lc")
def m15(t):
    return m.invoice_values(t.inv_base).select(*KEY, "inv_gsv_lc", "inv_gsv_promo_bonus_lc")


@query("m16_invoice_nsv", f"""
SELECT {K}, {INV_NSV} AS inv_nsv_lc, coalesce(forced_price_tot, 0) - coalesce(list_price_tot, 0) AS net_price FROM inv_base
""", "inv_nsv_lc net_price")
def m16(t):
    return m.invoice_values(t.inv_base).select(*KEY, "inv_nsv_lc", "net_price")


INV_SQL = f"""q AS (SELECT *, {INV_QTY} AS inv_qty, {INV_GSV} AS inv_gsv_lc, {INV_NSV} AS inv_nsv_lc FROM inv_base),
lc AS (SELECT *, {CP} * inv_qty AS inv_cp_lc, {TP} * inv_qty AS inv_tp_lc FROM q),
gm AS (SELECT *, {c0('inv_nsv_lc')} - {c0('inv_tp_lc')} AS inv_gm_tp_lc, {c0('inv_nsv_lc')} - {c0('inv_cp_lc')} AS inv_gm_cp_lc,
  ({c0('inv_nsv_lc')} - {c0('inv_tp_lc')}) * exchange AS inv_gm_tp_eur, ({c0('inv_nsv_lc')} - {c0('inv_cp_lc')}) * exchange AS inv_gm_cp_eur,
  {c0('inv_nsv_lc')} * exchange AS inv_nsv_eur FROM lc)"""


def invoice_chain(t):
    return (
        t.inv_base.transform(m.invoice_quantity).transform(m.invoice_values)
        .transform(m.cost_price, "inv").transform(m.transfer_price, "inv")
        .transform(m.euro_values, "inv", ("nsv", "gsv", "tp", "cp"), True)
        .transform(m.invoice_margins)
    )


@query("m17_invoice_margins", f"""
WITH {INV_SQL} SELECT {K}, inv_gm_tp_lc, inv_gm_cp_lc, inv_gm_tp_eur, inv_gm_cp_eur, inv_nsv_eur FROM gm
""", "inv_gm_tp_lc inv_gm_cp_lc inv_gm_tp_eur inv_gm_cp_eur inv_nsv_eur")
def m17(t):
    return invoice_chain(t).select(*KEY, "inv_gm_tp_lc", "inv_gm_cp_lc", "inv_gm_tp_eur", "inv_gm_cp_eur",
                                   "inv_nsv_eur")


@query("m18_closed_months", f"""
WITH {INV_SQL} SELECT {K}, """ + ", ".join(
    f"CASE WHEN time_id < DATE '1998-08-01' THEN inv_{x} ELSE 0 END AS inv_sf_{x}"
    for x in ("qty", "nsv_eur", "gm_cp_eur", "gm_tp_eur")) + " FROM gm",
    "inv_sf_qty inv_sf_nsv_eur inv_sf_gm_cp_eur inv_sf_gm_tp_eur")
def m18(t):
    return invoice_chain(t).transform(m.closed_month_copies, AS_OF).select(
        *KEY, "inv_sf_qty", "inv_sf_nsv_eur", "inv_sf_gm_cp_eur", "inv_sf_gm_tp_eur")


# --- the legacy system ---------------------------------------------------------------

FX = "currency_euro_exch"


def per_fx(value):
    return f"CASE WHEN coalesce({FX}, 0) = 0 THEN 0 ELSE ({value}) / {FX} END"


def first_nonzero(a, b):
    return (f"CASE WHEN {a} IS NOT NULL AND {a} <> 0 THEN {a} "
            f"WHEN {b} IS NOT NULL AND {b} <> 0 THEN {b} ELSE 0 END")


NET = "coalesce(tot_amount_no_transport, 0) - coalesce(removable_charges, 0)"
UNIT_CP = f"""CASE WHEN coalesce(cons_cost_of_sales, 0) + coalesce(tca, 0) = 0 THEN 0 ELSE {per_fx(
    'coalesce(cons_cost_of_sales, 0) + coalesce(tca, 0) + coalesce(transport_cost, 0) + coalesce(transport_cost_infra, 0)')} END"""
COMM = "coalesce(CASE WHEN document_date > start_date_tprice_revised THEN revised_comm_cos ELSE comm_cost_of_sales END, 0)"
UNIT_TP = f"CASE WHEN {COMM} = 0 THEN 0 ELSE {per_fx(f'{COMM} + coalesce(transport_cost, 0)')} END"
BDG_PRICE = "CASE WHEN year(document_date) < 2019 THEN std_sale_price ELSE budget_price END"
REV_PRICE = "CASE WHEN year(document_date) < 2018 THEN revised_sale_price ELSE budget_price_revised END"
INVOICED = "CASE WHEN doc_type_code IN (4, 7) THEN coalesce(quantity, 0) ELSE 0 END"
BEFORE = "document_date < start_date_nsv_revised"

AMOUNTS = {
    "inv_qty": INVOICED,
    "inv_nsv_eur": f"CASE WHEN doc_type_code IN (4, 5, 6, 7) THEN {per_fx(first_nonzero('acc_extra_amount', 'extra_amount'))} ELSE 0 END",
    "inv_gsv_eur": f"CASE WHEN doc_type_code IN (4, 5, 6, 7) AND data_type = 1 THEN {per_fx(NET)} ELSE 0 END",
    "inv_gsv_transport_eur": f"CASE WHEN doc_type_code IN (4, 5, 6, 7) AND data_type = 1 THEN {per_fx('(' + first_nonzero('acc_amount', 'doc_total_amount') + ') - coalesce(removable_charges, 0)')} ELSE 0 END",
    "inv_gsv_promo_bonus_eur": f"CASE WHEN data_type = 1 THEN {per_fx(NET)} ELSE 0 END",
}
COST = {
    "inv_cp_eur": f"CASE WHEN doc_type_code IN (4, 7) THEN ({UNIT_CP}) * coalesce(quantity, 0) ELSE 0 END",
    "del_cp_eur": f"({UNIT_CP}) * coalesce(delivery_quantity, 0)",
    "ord_cp_eur": f"CASE WHEN doc_type_code IN (4, 7) THEN ({UNIT_CP}) * coalesce(order_qty, 0) ELSE 0 END",
}
TRANSFER = {
    "inv_tp_eur": f"CASE WHEN doc_type_code IN (4, 7) THEN ({UNIT_TP}) * coalesce(quantity, 0) ELSE 0 END",
    "del_tp_eur": f"({UNIT_TP}) * coalesce(delivery_quantity, 0)",
    "ord_tp_eur": f"CASE WHEN doc_type_code = 7 AND coalesce(order_nsv_amount, 0) = 0 THEN 0 ELSE ({UNIT_TP}) * coalesce(order_qty, 0) END",
}
DELIVERY = {
    "del_qty": "coalesce(delivery_quantity, 0)",
    "del_nsv_eur": f"CASE doc_type_code WHEN 4 THEN {per_fx('coalesce(delivery_nsv_amount, 0)')} WHEN 7 THEN {per_fx(f'coalesce(delivery_quantity, 0) * coalesce({BDG_PRICE}, 0)')} ELSE 0 END",
    "del_gsv_eur": f"CASE WHEN data_type = 3 THEN {per_fx(f'coalesce(delivery_total_amount, 0) - coalesce(tot_amount_no_transport, 0) - coalesce(removable_charges, 0)')} ELSE 0 END",
}
ORDER = {
    "ord_qty": "coalesce(order_qty, 0)",
    "ord_nsv_eur": per_fx("coalesce(order_nsv_amount, 0)"),
    "ord_gsv_eur": f"CASE WHEN data_type = 2 THEN {per_fx('coalesce(order_doc_total_amount, 0) - coalesce(tot_amount_no_transport, 0) - coalesce(removable_charges, 0)')} ELSE 0 END",
}
REV_QTY = f"CASE WHEN {BEFORE} THEN {INVOICED} ELSE coalesce(quantity_revised, 0) END"
BUDGET = {
    "bdg_qty": "coalesce(network_budget, 0)",
    "bdg_nsv_eur": per_fx(f"coalesce(network_budget, 0) * ({BDG_PRICE})"),
    "bdg_avg_nsv_eur": per_fx("coalesce(network_budget, 0) * std_sale_price"),
    "bdg_cp_eur": f"({UNIT_CP}) * coalesce(network_budget, 0)",
    "bdg_tp_eur": f"CASE WHEN coalesce(cons_cost_of_sales, 0) = 0 THEN 0 ELSE ({per_fx('coalesce(cons_cost_of_sales, 0) + coalesce(transport_cost, 0)')}) * coalesce(network_budget, 0) END",
    "rev_qty": REV_QTY,
    "rev_nsv_eur": f"CASE WHEN coalesce({FX}, 0) = 0 THEN 0 WHEN {BEFORE} THEN coalesce(acc_extra_amount, extra_amount) / {FX} ELSE coalesce(quantity_revised, 0) * coalesce({REV_PRICE}, 0) / {FX} END",
    "rev_cp_eur": f"({UNIT_CP}) * ({REV_QTY})",
    "rev_tp_eur": f"CASE WHEN {BEFORE} THEN ({per_fx('coalesce(comm_cost_of_sales, 0)')}) * ({INVOICED}) WHEN coalesce(transfpri_revised_nsv, 0) = 0 THEN 0 ELSE ({per_fx('coalesce(transfpri_revised_nsv, 0) + coalesce(transport_cost, 0)')}) * coalesce(quantity_revised, 0) END",
}
MARGIN = {}
for _c in ("cp", "tp"):
    for _p in ("inv", "bdg", "rev"):
        MARGIN[f"{_p}_gm_{_c}_eur"] = f"coalesce({_p}_nsv_eur, 0) - coalesce({_p}_{_c}_eur, 0)"
    MARGIN[f"del_gm_{_c}_eur"] = f"CASE WHEN doc_type_code = 7 AND del_nsv_eur = 0 THEN 0 ELSE coalesce(del_nsv_eur, 0) - coalesce(del_{_c}_eur, 0) END"
    MARGIN[f"ord_gm_{_c}_eur"] = f"CASE WHEN t3316lng = 2 AND evaluation_type = 0 THEN 0 WHEN coalesce(ord_nsv_eur, 0) = 0 THEN 0 ELSE coalesce(ord_nsv_eur, 0) - coalesce(ord_{_c}_eur, 0) END"
STATUS = """CASE WHEN potential_status IN ('Blocked', 'Not Blocked') THEN CASE WHEN order_alloc_status = 1 AND order_delivery_warehouse = allocation_warehouse
  THEN 'Deliverables' ELSE 'Not Deliverables' END ELSE potential_status END"""


def select(measures):
    return ", ".join(f"{v} AS {k}" for k, v in measures.items())


LEGACY_SQL = (
    f"a AS (SELECT *, {select(AMOUNTS)}, {select(COST)}, {select(TRANSFER)}, {select(DELIVERY)}, {select(ORDER)}, {select(BUDGET)}, {STATUS} AS order_status FROM legacy_base),\n"
    f"b AS (SELECT *, {select(MARGIN)} FROM a)")


def legacy_query(name, measures, transform):
    digits = " ".join(f"{c}:4" for c in measures)

    @query(name, f"SELECT {K}, {select(measures)} FROM legacy_base", digits)
    def run(t):
        return transform(t.legacy_base).select(*KEY, *measures)

    return run


m19 = legacy_query("m19_legacy_invoice", AMOUNTS, lg.invoice_amounts)
m20 = legacy_query("m20_legacy_cost_price", COST, lg.cost_prices)
m21 = legacy_query("m21_legacy_transfer_price", TRANSFER, lg.transfer_prices)
m22 = legacy_query("m22_legacy_delivery", DELIVERY, lg.delivery_amounts)
m23 = legacy_query("m23_legacy_order", ORDER, lg.order_amounts)
m24 = legacy_query("m24_legacy_budget", BUDGET, lg.budget_amounts)


def legacy_chain(t):
    out = t.legacy_base
    for step in (lg.invoice_amounts, lg.delivery_amounts, lg.order_amounts, lg.cost_prices,
                 lg.transfer_prices, lg.budget_amounts, lg.legacy_margins, lg.legacy_status):
        out = out.transform(step)
    return out


@query("m25_legacy_margins", f"WITH {LEGACY_SQL} SELECT {K}, {', '.join(MARGIN)} FROM b",
       " ".join(f"{c}:4" for c in MARGIN))
def m25(t):
    return legacy_chain(t).select(*KEY, *MARGIN)


@query("m26_legacy_status", f"SELECT {K}, {STATUS} AS order_status FROM legacy_base")
def m26(t):
    return lg.legacy_status(t.legacy_base).select(*KEY, "order_status")


BUCKETS = {"bo": "date_trunc('month', mrdd) < DATE '1998-08-01'",
           **{f"m{i}": f"date_trunc('month', mrdd) = DATE '1998-{8 + i:02d}-01'" for i in range(1, 5)},
           "m5": "date_trunc('month', mrdd) = DATE '1999-01-01'"}
TOTALS = {
    **{f"pot_{x}": f"coalesce(inv_{x}, 0) + coalesce(del_{x}, 0) + coalesce(ord_{x}, 0)" for x in lg.MEASURES},
    **{f"inv_del_{x}": f"coalesce(inv_{x}, 0) + coalesce(del_{x}, 0)" for x in lg.MEASURES},
    **{f"ord_{b}_{x}": f"CASE WHEN data_type = 2 AND {cond} THEN ord_{x} END"
       for b, cond in BUCKETS.items() for x in lg.MEASURES},
}


@query("m27_legacy_totals", f"WITH {LEGACY_SQL} SELECT {K}, {select(TOTALS)} FROM b",
       " ".join(f"{c}:4" for c in TOTALS))
def m27(t):
    return legacy_chain(t).transform(lg.totals_and_months, AS_OF).select(*KEY, *TOTALS)


CONDITIONS = {
    "blk": "coalesce(order_blocking_code, -1) >= 50",
    "pck": "order_alloc_status = 6 AND coalesce(order_blocking_code, -1) < 50",
    **{n: f"order_alloc_status = {c}" for n, c in lg.ALLOCATION.items()},
    "ode": "order_status = 'Deliverables' AND potential_status = 'Not Blocked'",
    "ond": "order_status = 'Not Deliverables' AND potential_status = 'Not Blocked'",
}
COPIES = {f"{n}_{x}": f"CASE WHEN {cond} THEN ord_{x} ELSE 0 END"
          for n, cond in CONDITIONS.items() for x in lg.MEASURES}


@query("m28_legacy_blocks", f"""
WITH {LEGACY_SQL} SELECT {K}, {select(COPIES)}, CASE WHEN order_blocking_code <= 18 THEN 'Not Blocked'
  WHEN order_blocking_code BETWEEN 50 AND 57 THEN 'Commercial Block' WHEN order_blocking_code BETWEEN 58 AND 67 THEN 'Credit Blocked'
  WHEN order_blocking_code > 67 THEN 'Price Missing' END AS blocking_type FROM b
""", " ".join(f"{c}:4" for c in COPIES))
def m28(t):
    return legacy_chain(t).transform(lg.block_copies).select(*KEY, *COPIES, "blocking_type")


@query("m29_legacy_local", f"""
WITH {LEGACY_SQL} SELECT {K}, {', '.join(f'{n}_eur * {FX} AS {n}_lc' for n in lg.LOCAL)} FROM b
""", " ".join(f"{n}_lc:4" for n in lg.LOCAL))
def m29(t):
    return legacy_chain(t).transform(lg.local_values).select(*KEY, *[f"{n}_lc" for n in lg.LOCAL])


VARIANCE = {}
for _n, _price in (("bdg", BDG_PRICE), ("rev", REV_PRICE)):
    _lc, _eur = f"coalesce({_price}, 0)", f"coalesce({_price}, 0) / nullif({FX}, 0)"
    VARIANCE[f"{_n}_unit_nsv_lc"], VARIANCE[f"{_n}_unit_nsv_eur"] = _lc, _eur
    for _s, _at in (("lc", _lc), ("eur", f"coalesce({_eur}, 0)")):
        _net = "coalesce(inv_nsv_lc, 0)" if _s == "lc" else "coalesce(inv_nsv_eur, 0)"
        VARIANCE[f"inv_{_n}_nsv_{_s}"] = f"{_at} * coalesce(inv_qty, 0)"
        VARIANCE[f"price_variance_{_n}_{_s}"] = (
            f"CASE WHEN {_at} * coalesce(inv_qty, 0) = 0 THEN 0 ELSE {_net} - {_at} * coalesce(inv_qty, 0) END"
            f" + CASE WHEN doc_type_code IN (5, 6) THEN {_net} ELSE 0 END")
VARIANCE["transport_cost_lc"] = "coalesce(transport_cost, 0) * coalesce(inv_qty, 0)"
VARIANCE["transport_cost_eur"] = f"coalesce(transport_cost, 0) * coalesce(inv_qty, 0) / nullif({FX}, 0)"
VARIANCE["inv_bdg_tp_lc"] = "CASE WHEN comm_cost_of_sales = 0 THEN 0 ELSE (coalesce(comm_cost_of_sales, 0) + coalesce(transport_cost, 0)) * coalesce(inv_qty, 0) END"


@query("m30_price_variance", f"""
WITH {LEGACY_SQL}, c AS (SELECT *, inv_nsv_eur * {FX} AS inv_nsv_lc FROM b) SELECT {K}, {select(VARIANCE)} FROM c
""", " ".join(f"{c}:4" for c in VARIANCE))
def m30(t):
    return legacy_chain(t).transform(lg.local_values).transform(lg.price_variance).select(*KEY, *VARIANCE)
