"""Facts of the legacy system: one table holds invoices, orders and deliveries.

``data_type`` is 1 for invoices, 2 for orders, 3 for deliveries, 4 for budget.
Amounts are in local currency and are divided by ``fx`` (local per euro); every
measure is zero where there is no rate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.dates import day, month_after, month_start
from ..functions.nulls import coalesce_zero, sum_null_safe, zero_if_null
from ..functions.text import make_key, zero_padded
from ..operators.columns import conform_to
from ..operators.filters import exclude_values
from ..operators.lookup import checked_lookup, constant_lookup
from .measures import conditional_copies

FX = "currency_euro_exch"
ZERO = 0.0
MEASURES = ["qty", "nsv_eur", "gsv_eur", "gm_cp_eur", "gm_tp_eur"]

# What a data type is called, as a fact and as a potential.
TYPES = {1: "Invoiced", 2: "Open Orders", 3: "Delivered", 4: "Budget"}
POTENTIAL_TYPES = {1: "Invoiced + Delivered", 2: "Open Orders", 3: "Invoiced + Delivered"}

# Copies of order measures by allocation status.
ALLOCATION = {"instock": 1, "replenishment": 2, "orm": 3, "unallocated": 5}


def _per_fx(value: Column) -> Column:
    return F.when(zero_if_null(FX) == 0, F.lit(ZERO)).otherwise(F.try_divide(value, F.col(FX)))


def _kind(*codes: int) -> Column:
    return F.col("doc_type_code").isin(*codes)


def _data(*types: int) -> Column:
    return F.col("data_type").isin(*types)


def _if(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(ZERO))


def base_columns(df: DataFrame, as_of: str, calendar: DataFrame) -> DataFrame:
    """Keys, dates, type labels and potential status."""
    open_data = _data(2, 3)
    today = constant_lookup(calendar, day(as_of), day(as_of))
    time = F.when(open_data, today).otherwise(F.col("document_date"))
    status, block = F.col("order_alloc_status"), F.coalesce("order_blocking_code", F.lit(0))
    labels = {
        name: F.coalesce(*[F.when(F.col("data_type") == t, F.lit(text))
                           for t, text in table.items()])
        for name, table in (("type", TYPES), ("pot_type", POTENTIAL_TYPES))
    }
    unknown = F.lit(fixed.NOT_DEFINED_KEY)
    return df.withColumns({
        "product_id": F.coalesce("product_code", unknown),
        "dest_id": F.coalesce("customer", unknown),
        "inv_id": F.coalesce("inv_customer", unknown),
        "company_id": F.coalesce("company", unknown),
        "network_id": make_key("-@-", "company", "network"),
        "time_id": time,
        "mrdd": F.when(_data(2), F.col("order_requested_delivery_date"))
        .when(_data(4), F.col("document_date")).otherwise(day(fixed.NO_DATE)),
        "ab_grade": F.when(F.col("flag_bgrade") == 1, F.lit("B")).otherwise(F.lit("A")),
        **labels,
        "potential_status": F.when(
            _data(2),
            F.when((status == 6) & (block < 50), F.lit("In Picking"))
            .when(block < 50, F.lit("Not Blocked")).otherwise(F.lit("Blocked")),
        ).when(_data(1), F.lit("Invoiced")).when(_data(3), F.lit("Delivered")),
    })


def invoice_amounts(df: DataFrame) -> DataFrame:
    """Invoice quantity, net and gross value."""
    net_of_charges = zero_if_null("tot_amount_no_transport") - zero_if_null("removable_charges")
    with_transport = (coalesce_zero("acc_amount", "doc_total_amount")
                      - zero_if_null("removable_charges"))
    invoiced = _kind(4, 5, 6, 7) & _data(1)
    return df.withColumns({
        "inv_qty": _if(_kind(4, 7), zero_if_null("quantity")),
        "inv_nsv_eur": _if(_kind(4, 5, 6, 7),
                           _per_fx(coalesce_zero("acc_extra_amount", "extra_amount"))),
        "inv_gsv_eur": _if(invoiced, _per_fx(net_of_charges)),
        "inv_gsv_transport_eur": _if(invoiced, _per_fx(with_transport)),
        "inv_gsv_promo_bonus_eur": _if(_data(1), _per_fx(net_of_charges)),
        "removable_charges_eur": F.try_divide(zero_if_null("removable_charges"), F.col(FX)),
    })


def _unit_cp() -> Column:
    standard = sum_null_safe("cons_cost_of_sales", "tca")
    full = standard + sum_null_safe("transport_cost", "transport_cost_infra")
    return F.when(standard == 0, F.lit(ZERO)).otherwise(_per_fx(full))


def cost_prices(df: DataFrame) -> DataFrame:
    """Cost price of invoices, deliveries and orders."""
    return df.withColumns({
        "inv_cp_eur": _if(_kind(4, 7), _unit_cp() * zero_if_null("quantity")),
        "del_cp_eur": _unit_cp() * zero_if_null("delivery_quantity"),
        "ord_cp_eur": _if(_kind(4, 7), _unit_cp() * zero_if_null("order_qty")),
    })


def _unit_tp() -> Column:
    revised = F.col("document_date") > F.col("start_date_tprice_revised")
    cost = zero_if_null(F.when(revised, F.col("revised_comm_cos"))
                        .otherwise(F.col("comm_cost_of_sales")))
    return F.when(cost == 0, F.lit(ZERO)).otherwise(_per_fx(cost + zero_if_null("transport_cost")))


def transfer_prices(df: DataFrame) -> DataFrame:
    """Transfer price, the revised one after its start date."""
    worthless = F.coalesce(_kind(7), F.lit(False)) & (zero_if_null("order_nsv_amount") == 0)
    return df.withColumns({
        "inv_tp_eur": _if(_kind(4, 7), _unit_tp() * zero_if_null("quantity")),
        "del_tp_eur": _unit_tp() * zero_if_null("delivery_quantity"),
        "ord_tp_eur": _if(~worthless, _unit_tp() * zero_if_null("order_qty")),
    })


def _list_price(until: int, price: str, budget: str) -> Column:
    early = F.year("document_date") < until
    return F.when(early, F.col(price)).otherwise(F.col(budget))


def delivery_amounts(df: DataFrame) -> DataFrame:
    price = zero_if_null(_list_price(2019, "std_sale_price", "budget_price"))
    gross = (zero_if_null("delivery_total_amount") - zero_if_null("tot_amount_no_transport")
             - zero_if_null("removable_charges"))
    return df.withColumns({
        "del_qty": zero_if_null("delivery_quantity"),
        "del_nsv_eur": F.when(_kind(4), _per_fx(zero_if_null("delivery_nsv_amount")))
        .when(_kind(7), _per_fx(zero_if_null("delivery_quantity") * price))
        .otherwise(F.lit(ZERO)),
        "del_gsv_eur": _if(_data(3), _per_fx(gross)),
    })


def order_amounts(df: DataFrame) -> DataFrame:
    gross = (zero_if_null("order_doc_total_amount") - zero_if_null("tot_amount_no_transport")
             - zero_if_null("removable_charges"))
    return df.withColumns({
        "ord_qty": zero_if_null("order_qty"),
        "ord_nsv_eur": _per_fx(zero_if_null("order_nsv_amount")),
        "ord_gsv_eur": _if(_data(2), _per_fx(gross)),
    })


def budget_amounts(df: DataFrame) -> DataFrame:
    """Budget and revised measures.

    Before the revision date revised figures are the invoiced ones. A missing
    price makes the budget value null, not zero.
    """
    qty, fx = zero_if_null("network_budget"), F.col(FX)
    before = F.col("document_date") < F.col("start_date_nsv_revised")
    invoiced = _if(_kind(4, 7), zero_if_null("quantity"))
    revised = zero_if_null("quantity_revised")
    rev_qty = F.when(before, invoiced).otherwise(revised)
    cons = zero_if_null("cons_cost_of_sales")
    comm, transfer = zero_if_null("comm_cost_of_sales"), zero_if_null("transfpri_revised_nsv")
    freight = zero_if_null("transport_cost")
    revised_price = zero_if_null(_list_price(2018, "revised_sale_price", "budget_price_revised"))
    return df.withColumns({
        "bdg_qty": qty,
        "bdg_nsv_eur": _per_fx(qty * _list_price(2019, "std_sale_price", "budget_price")),
        "bdg_avg_nsv_eur": _per_fx(qty * F.col("std_sale_price")),
        "bdg_cp_eur": _unit_cp() * qty,
        "bdg_tp_eur": F.when(cons == 0, F.lit(ZERO)).otherwise(_per_fx(cons + freight) * qty),
        "rev_qty": rev_qty,
        "rev_nsv_eur": F.when(zero_if_null(FX) == 0, F.lit(ZERO)).when(
            before, F.try_divide(F.coalesce("acc_extra_amount", "extra_amount"), fx),
        ).otherwise(F.try_divide(revised * revised_price, fx)),
        "rev_cp_eur": _unit_cp() * rev_qty,
        "rev_tp_eur": F.when(before, _per_fx(comm) * invoiced).otherwise(
            F.when(transfer == 0, F.lit(ZERO))
            .otherwise(_per_fx(transfer + freight) * revised)),
    })


def legacy_margins(df: DataFrame) -> DataFrame:
    """Net value less cost price or transfer price.

    Zero for free deliveries (type 7 without value), for orders without value
    and for orders that are excluded from evaluation.
    """
    def plain(p: str, c: str) -> Column:
        return zero_if_null(f"{p}_nsv_eur") - zero_if_null(f"{p}_{c}_eur")

    free = F.coalesce(_kind(7) & (F.col("del_nsv_eur") == 0), F.lit(False))
    excluded = F.coalesce(
        (F.col("t3316lng") == 2) & (F.col("evaluation_type") == 0), F.lit(False))
    no_order = excluded | (zero_if_null("ord_nsv_eur") == 0)
    columns = {}
    for c in ("cp", "tp"):
        columns[f"inv_gm_{c}_eur"] = plain("inv", c)
        columns[f"del_gm_{c}_eur"] = _if(~free, plain("del", c))
        columns[f"ord_gm_{c}_eur"] = _if(~no_order, plain("ord", c))
        columns[f"bdg_gm_{c}_eur"] = plain("bdg", c)
        columns[f"rev_gm_{c}_eur"] = plain("rev", c)
    return df.withColumns(columns)


def legacy_status(df: DataFrame) -> DataFrame:
    """Order status: open orders are deliverable when allocated in their warehouse."""
    allocated = (F.col("order_alloc_status") == 1) & (
        F.col("order_delivery_warehouse") == F.col("allocation_warehouse"))
    return df.withColumn(
        "order_status",
        F.when(F.col("potential_status").isin("Blocked", "Not Blocked"),
               F.when(allocated, F.lit("Deliverables")).otherwise(F.lit("Not Deliverables")))
        .otherwise(F.col("potential_status")))


def totals_and_months(df: DataFrame, as_of: str, months: int = 5) -> DataFrame:
    """Totals over the three facts, the backlog and the next months of orders."""
    month = month_start(F.col("mrdd"))
    orders = _data(2)
    buckets = {"bo": month < month_start(day(as_of))}
    buckets.update({f"m{i}": month == month_after(as_of, i) for i in range(1, months + 1)})
    out = df.withColumns({
        **{f"pot_{m}": sum_null_safe(f"inv_{m}", f"del_{m}", f"ord_{m}") for m in MEASURES},
        **{f"inv_del_{m}": sum_null_safe(f"inv_{m}", f"del_{m}") for m in MEASURES},
    })
    return conditional_copies(out, {
        f"ord_{b}_{m}": (f"ord_{m}", orders & inside)
        for b, inside in buckets.items() for m in MEASURES
    }, F.lit(None).cast("double"))


def block_copies(df: DataFrame) -> DataFrame:
    """Order measures that are blocked, in picking, or in one allocation status."""
    block = F.coalesce("order_blocking_code", F.lit(-1))
    status = F.col("order_alloc_status")
    conditions = {
        "blk": block >= 50, "pck": (status == 6) & (block < 50),
        **{name: status == code for name, code in ALLOCATION.items()},
        **{name: (F.col("order_status") == text) & (F.col("potential_status") == "Not Blocked")
           for name, text in (("ode", "Deliverables"), ("ond", "Not Deliverables"))},
    }
    code = F.col("order_blocking_code")
    return conditional_copies(df, {
        f"{name}_{m}": (f"ord_{m}", condition)
        for name, condition in conditions.items() for m in MEASURES
    }).withColumn(
        "blocking_type",
        F.when(code <= 18, F.lit("Not Blocked"))
        .when(code.between(50, 57), F.lit("Commercial Block"))
        .when(code.between(58, 67), F.lit("Credit Blocked"))
        .when(code > 67, F.lit("Price Missing")))


LOCAL = [
    *[f"{p}_{m}" for p in ("inv", "del", "ord") for m in ("nsv", "gsv", "cp", "tp")],
    *[f"{p}_{m}" for p in ("bdg", "rev") for m in ("nsv", "cp", "tp")],
    "inv_gsv_transport",
    *[f"{p}_gm_{c}" for p in ("inv", "del", "ord", "bdg", "rev") for c in ("cp", "tp")],
]


def local_values(df: DataFrame, names: list[str] = LOCAL) -> DataFrame:
    """Euro measures back in local currency."""
    return df.withColumns({f"{n}_lc": F.col(f"{n}_eur") * F.col(FX) for n in names})


def price_variance(df: DataFrame) -> DataFrame:
    """Unit budget, invoices at budget price, and the variance of price.

    The variance is zero where the budget value is zero; credit and debit notes
    (types 5 and 6) add their net value.
    """
    unit = {
        "bdg": zero_if_null(_list_price(2019, "std_sale_price", "budget_price")),
        "rev": zero_if_null(_list_price(2018, "revised_sale_price", "budget_price_revised")),
    }
    qty = zero_if_null("inv_qty")
    columns = {}
    for name, price in unit.items():
        euro = F.try_divide(price, F.col(FX))
        columns[f"{name}_unit_nsv_lc"], columns[f"{name}_unit_nsv_eur"] = price, euro
        for suffix, at in (("lc", price), ("eur", zero_if_null(euro))):
            valued, net = at * qty, zero_if_null(f"inv_nsv_{suffix}")
            columns[f"inv_{name}_nsv_{suffix}"] = valued
            columns[f"price_variance_{name}_{suffix}"] = (
                F.when(valued == 0, F.lit(ZERO)).otherwise(net - valued)
                + _if(_kind(5, 6), net))
    freight = {
        "transport_cost_lc": zero_if_null("transport_cost") * qty,
        "transport_cost_infra_lc": zero_if_null("transport_cost_infra") * qty,
    }
    transfer = F.when(F.col("comm_cost_of_sales") == 0, F.lit(ZERO)).otherwise(
        sum_null_safe("comm_cost_of_sales", "transport_cost") * qty)
    return df.withColumns({
        **columns, **freight,
        **{n.replace("_lc", "_eur"): F.try_divide(v, F.col(FX)) for n, v in freight.items()},
        "inv_bdg_tp_lc": transfer,
        "inv_bdg_tp_eur": F.try_divide(zero_if_null(transfer), F.col(FX)),
    })


def with_budget_prices(df: DataFrame, budget: DataFrame) -> DataFrame:
    """Budget price of product and month; ``budget`` is a map by price key."""
    key = make_key("-@-", "sales_organization", "sales_office", "product_code",
                   F.year("document_date"), F.month("document_date"))
    return df.transform(checked_lookup, budget, key, "budget_price", None, "budget price"
                        ).withColumn("budget_price_revised", F.col("budget_price"))


def legacy_measures(df: DataFrame, as_of: str) -> DataFrame:
    return (
        df.transform(invoice_amounts).transform(delivery_amounts).transform(order_amounts)
        .transform(cost_prices).transform(transfer_prices).transform(budget_amounts)
        .transform(legacy_margins).transform(legacy_status)
        .transform(totals_and_months, as_of).transform(block_copies)
        .transform(local_values).transform(price_variance)
    )


def legacy_facts(
    sales: DataFrame, networks: DataFrame, budget: DataFrame, calendar: DataFrame,
    company_currency: DataFrame, as_of: str,
) -> DataFrame:
    """All legacy facts in one frame; ``data_type`` tells them apart.

    ``networks`` gives one sales organisation and office per company and network.
    """
    codes = {c: zero_padded(c, 2) for c in ("company", "network")}
    return (
        sales.withColumns(codes)
        .join(networks, ["company", "network"], "left")
        .transform(exclude_values, "sales_organization", fixed.EXCLUDED_COMPANIES)
        .transform(base_columns, as_of, calendar)
        .transform(checked_lookup, company_currency, "company", "currency_code",
                   F.lit(fixed.DEFAULT_CURRENCY), "company currency")
        .transform(with_budget_prices, budget)
        .transform(legacy_measures, as_of)
    )


# Data type, label and key parts of each legacy fact.
FACTS: Mapping[str, tuple[int, list[str]]] = {
    "INVOICE": (1, ["document_code", "order_line", "ref_invoice"]),
    "ORDER": (2, ["order_number", "order_line"]),
    "DELIVERY": (3, ["despatching_note", "order_line"]),
}


def legacy_fact(
    facts: DataFrame, name: str, schema: str | None = None,
    sides: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One of the facts with its key and the dimension sides of its customers.

    ``sides`` maps a key column, such as ``inv_id``, to a dimension with one row
    per key. With a schema the result has the shape of the ERP fact.
    """
    data_type, parts = FACTS[name]
    rows = facts.where(F.col("data_type") == data_type).withColumn(
        "key_fact", make_key("###", F.lit(name), *parts))
    for key, side in (sides or {}).items():
        rows = rows.join(side, [key], "left")
    return rows if schema is None else conform_to(rows, schema)
