"""Facts kept as a narrow fact and a dimension side, and put together again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import make_key
from ..operators.columns import split_fact_dim
from ..operators.joins import reassemble
from ..operators.sets import tagged_union
from ..session import settle

KEY = "key_fact"

# Columns of the narrow order fact; all others go to the dimension side.
ORDER_FACT = [
    "key_fact", "order_number", "order_line", "order_status", "data_type", "doc_type_code",
    "order_type_code", "category", "division", "distr_channel", "sales_organization",
    "sales_office", "company", "network", "product_code", "area_code", "plant", "pstyv",
    "order_date", "document_date", "time_id", "requested_delivery_date", "first_req_del_date",
    "confirmed_date", "confirmed_time", "dest_id", "inv_id", "purchase_group_code",
    "main_group_code", "super_group_code", "sale_zone_code", "salesman_code",
    "sale_director_code", "rsm_code", "currency_code", "exchange", "exchange_rate_erp",
    "knumv", "return_sign", "ord_qty", "ord_qty_fabs", "ord_qty_orig", "ord_qty_consignment",
    "ord_nsv_lc", "ord_nsv_eur", "ord_gsv_lc", "ord_gsv_eur", "ord_raee_lc", "ord_ic_discount",
    "removable_charges_tot", "order_blocking_code", "block_credit", "order_creation_user",
    "order_customer_reference_1", "order_delivery_warehouse", "order_source",
    "key_cost_commercial", "key_cost_freight_in", "key_cost_indefinite",
    "key_cost_transfer_price",
]


def split_fact(
    fact: DataFrame, columns: Sequence[str], key: str = KEY
) -> tuple[DataFrame, DataFrame]:
    """Narrow fact and dimension side of a fact.

    The fact is written once, for both are read: its plan would run once for each side.
    """
    return split_fact_dim(settle(fact, "split-fact"), [c for c in columns if c in fact.columns], key)


def joined_facts(
    facts: Mapping[str, DataFrame], sides: Mapping[str, DataFrame], date: str = "document_date"
) -> DataFrame:
    """Facts of all systems stacked, with their dimension sides and the price key.

    Facts and sides have one row per key, as `split_fact` gives them of a fact that has.
    """
    stacked = tagged_union(facts)
    price_key = make_key("-@-", "sales_organization", "sales_office", "product_code",
                         F.year(date), F.month(date))
    return reassemble(stacked, sides).withColumn("product_price_key", price_key)
