"""Measure formulas of the order, delivery and invoice facts.

Nulls run through a formula unless a part is written as ``zero_if_null``. LC is
local currency; ``return_sign`` is -1 for returns; ``exchange`` takes LC to euro
and ``exchange_to_local`` euro costs to LC. Every function adds its columns in
one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.dates import day, month_start
from ..functions.nulls import zero_if_null

VALUE_MEASURES = ["qty", "nsv_eur", "nsv_lc", "gsv_eur", "gsv_lc", "gm_tp_eur", "gm_tp_lc",
                  "gm_cp_eur", "gm_cp_lc"]
STATUS_PREFIXES = {"blk": "Blocked", "pck": "In Picking", "ond": "Not Deliverables"}


def _consignment() -> Column:
    return F.coalesce(F.col("order_type_code").isin(fixed.CONSIGNMENT_TYPES), F.lit(False))


def _without_value() -> Column:
    return F.coalesce(F.col("doc_type_code").isin(5, 6), F.lit(False)) | _consignment()


def order_quantities(df: DataFrame) -> DataFrame:
    """Signed order quantity, and the same for consignment only."""
    amount, sign = F.col("ord_qty_fabs"), F.col("return_sign")
    wrong_sign = (
        (F.col("doc_type_code") == 4)
        & F.col("order_type_code").isin(fixed.RETURN_ORDER_TYPES)
        & (F.col("category") == "C")
    )
    return df.withColumns({
        "ord_qty": F.when(_without_value(), F.lit(0.0)).when(wrong_sign, -amount)
        .otherwise(amount * sign),
        "ord_qty_consignment": F.when(_consignment(), amount * sign).otherwise(F.lit(0.0)),
    })


def delivery_quantities(df: DataFrame) -> DataFrame:
    signed = F.col("del_qty_fabs") * F.col("return_sign")
    return df.withColumns({
        "del_qty": F.when(_without_value(), F.lit(0.0)).otherwise(signed),
        "del_qty_consignment": F.when(_consignment(), signed).otherwise(F.lit(0.0)),
    })


def invoice_quantity(df: DataFrame) -> DataFrame:
    kind = F.col("doc_type_code")
    return df.withColumn(
        "inv_qty",
        F.when((kind >= 5) & (kind != 7), F.lit(0.0))
        .otherwise(F.col("inv_qty_fabs") * F.col("return_sign")),
    )


def _discount(name: str) -> Column:
    rate = F.coalesce(F.col("exchange_rate_erp"), F.lit(1.0))
    return zero_if_null(F.col(name) * rate * F.col("return_sign"))


def order_values(df: DataFrame) -> DataFrame:
    """Net and gross value of the open share of an order line."""
    share = F.col("pct_ord_qty") * F.col("return_sign")
    return df.withColumns({
        f"ord_{m}_lc": (F.col(f"ord_{m}_lc_tot") + _discount("ord_ic_discount")) * share
        for m in ("nsv", "gsv")
    })


def order_prices(df: DataFrame) -> DataFrame:
    """Unit list and forced price, net price, and the charges of the open share."""
    share, qty = F.col("pct_ord_qty"), F.col("ord_qty")
    prices = {
        p: F.try_divide(F.col(f"{p}_tot") * share, qty) for p in ("list_price", "forced_price")
    }
    return df.withColumns({
        **prices,
        "net_price": zero_if_null(prices["forced_price"]) + zero_if_null(prices["list_price"]),
        "removable_charges": F.col("removable_charges_tot") * share,
    })


def delivery_values(df: DataFrame) -> DataFrame:
    """Value of the delivered part: order total over ordered, times delivered quantity."""
    return df.withColumns({
        f"del_{m}_lc": F.try_divide(
            F.col(f"del_{m}_lc_tot") + _discount("del_ic_discount"), F.col("ord_qty_orig"))
        * F.col("del_qty")
        for m in ("nsv", "gsv")
    })


def delivery_prices(df: DataFrame) -> DataFrame:
    prices = {
        p: F.try_divide(F.col(f"{p}_tot"), F.col("ord_qty_orig"))
        for p in ("list_price", "forced_price")
    }
    return df.withColumns({
        **prices,
        "net_price": zero_if_null(prices["forced_price"]) + zero_if_null(prices["list_price"]),
        "removable_charges": F.col("removable_charges_tot") * F.col("pct_del_qty"),
    })


def invoice_values(df: DataFrame) -> DataFrame:
    """Net, gross and promotional value of an invoice line."""
    sign = F.col("return_sign")
    gross = F.coalesce("inv_gsv_lc_temp", "inv_gsv_bonus_lc_temp") * sign
    return df.withColumns({
        "inv_nsv_lc": F.col("inv_nsv_lc_temp") * sign + _discount("inv_ic_discount"),
        "inv_gsv_lc": F.when(
            F.col("doc_type_code") <= 7,
            gross + zero_if_null("inv_ic_discount")
            * F.coalesce(F.col("exchange_rate_erp"), F.lit(1.0)) * sign,
        ).otherwise(F.lit(0.0)),
        "inv_gsv_promo_bonus_lc": gross,
        "inv_transport_cost_lc": F.col("inv_transport_cost_lc_temp") * sign,
        "net_price": zero_if_null("forced_price_tot") - zero_if_null("list_price_tot"),
    })


def cost_price(df: DataFrame, prefix: str) -> DataFrame:
    """Cost price: standard cost, surcharge, freight and infrastructure per unit."""
    unit = (F.col("cons_cost_unit") + F.col("tca_unit") + F.col("freight_in_unit")
            + F.col("infra_unit"))
    return df.withColumn(
        f"{prefix}_cp_lc", unit * F.col("exchange_to_local") * F.col(f"{prefix}_qty"))


def transfer_price(df: DataFrame, prefix: str) -> DataFrame:
    """Transfer price: commercial cost and freight per unit."""
    unit = F.col("comm_cost_unit") + F.col("freight_in_unit")
    return df.withColumn(
        f"{prefix}_tp_lc", unit * F.col("exchange_to_local") * F.col(f"{prefix}_qty"))


def euro_values(
    df: DataFrame, prefix: str, measures: Sequence[str] = ("nsv", "gsv", "tp", "cp"),
    null_as_zero: bool = False,
) -> DataFrame:
    def lc(m: str) -> Column:
        value = F.col(f"{prefix}_{m}_lc")
        return zero_if_null(value) if null_as_zero else value

    return df.withColumns({f"{prefix}_{m}_eur": lc(m) * F.col("exchange") for m in measures})


def margins(df: DataFrame, prefix: str) -> DataFrame:
    """Net value less transfer or cost price; zero where there is no net value."""
    def one(cost: str, unit: str) -> Column:
        nsv = F.col(f"{prefix}_nsv_{unit}")
        return F.when(zero_if_null(nsv) != 0,
                      nsv - zero_if_null(f"{prefix}_{cost}_{unit}")).otherwise(F.lit(0.0))

    return df.withColumns({
        f"{prefix}_gm_{cost}_{unit}": one(cost, unit)
        for cost in ("tp", "cp") for unit in ("eur", "lc")
    })


def invoice_margins(df: DataFrame) -> DataFrame:
    """The plain difference with nulls as zero; the euro figure is taken from LC."""
    lc = {c: zero_if_null("inv_nsv_lc") - zero_if_null(f"inv_{c}_lc") for c in ("tp", "cp")}
    return df.withColumns({
        **{f"inv_gm_{c}_lc": v for c, v in lc.items()},
        **{f"inv_gm_{c}_eur": v * F.col("exchange") for c, v in lc.items()},
    })


def conditional_copies(
    df: DataFrame, copies: Mapping[str, tuple[str, Column]], otherwise: Column | None = None
) -> DataFrame:
    """Copies of measures that hold under a condition: name to (measure, condition)."""
    rest = F.lit(0.0) if otherwise is None else otherwise
    return df.withColumns({
        name: F.when(condition, F.col(measure)).otherwise(rest)
        for name, (measure, condition) in copies.items()
    })


def backlog_copies(
    df: DataFrame, as_of: str, prefix: str = "ord", date: str = "requested_delivery_date",
    measures: Sequence[str] = VALUE_MEASURES,
) -> DataFrame:
    """Measures of orders requested before the current month."""
    late = F.col(date) < month_start(day(as_of))
    return conditional_copies(df, {f"{prefix}_bo_{m}": (f"{prefix}_{m}", late) for m in measures})


def status_copies(
    df: DataFrame, prefixes: Mapping[str, str] = STATUS_PREFIXES,
    measures: Sequence[str] = VALUE_MEASURES,
) -> DataFrame:
    """Measures of one order status each."""
    return conditional_copies(df, {
        f"{p}_{m}": (f"ord_{m}", F.col("order_status") == status)
        for p, status in prefixes.items() for m in measures
    })


def potential_copies(
    df: DataFrame, prefix: str, measures: Sequence[str] = VALUE_MEASURES
) -> DataFrame:
    """The same measures under the name of the potential."""
    return df.withColumns({f"pot_{m}": F.col(f"{prefix}_{m}") for m in measures})


def closed_month_copies(
    df: DataFrame, as_of: str, date: str = "time_id",
    measures: Sequence[str] = ("qty", "nsv_eur", "gm_cp_eur", "gm_tp_eur"),
) -> DataFrame:
    """Invoice measures of closed months."""
    closed = F.col(date) < month_start(day(as_of))
    return conditional_copies(df, {f"inv_sf_{m}": (f"inv_{m}", closed) for m in measures})


def invoice_doc_type() -> Column:
    """Document type: a special credit note, else by type and reason, else by type."""
    special = (F.col("invoice_type") == "ZG2") & (F.upper("collective_number") == "PEX")
    return F.when(special, F.lit(7)).otherwise(
        F.coalesce("doc_type_code_concatenate", "doc_type_code_single"))
