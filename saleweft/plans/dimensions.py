"""Dimension tables of the sales analysis."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.text import make_key, strict_key, strip_prefix
from ..operators.columns import rename_select
from ..operators.sets import add_all_member, add_unknown_member

GROUPS = ("super_group", "main_group", "purchase_group")


def invoice_customers(customers: DataFrame) -> DataFrame:
    """Customers with key, group labels and the unknown member."""
    labels = {g: strict_key(" - ", f"{g}_code", f"{g}_descr") for g in GROUPS}
    described = customers.withColumn(
        "super_group_descr", F.coalesce("super_group_descr", F.lit("0")))
    named = described.withColumns({
        "inv_id": strict_key("-@-", "customer_company", "customer_code"),
        "invoice_customer": strict_key("-", "customer_code", "customer_name"),
        **labels,
    })
    return add_unknown_member(named, "inv_id", fixed.NOT_DEFINED_KEY)


def delivery_customers(invoice_side: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The same customers under the names of the delivery role."""
    label = strict_key("-", "customer_code", "customer_name")
    return rename_select(invoice_side.withColumn("delivery_customer", label),
                         {**names, "delivery_customer": "delivery_customer"})


def companies(source: DataFrame) -> DataFrame:
    """Companies without the letter in front of their code, and the unknown one."""
    named = source.withColumns({
        "company_id": strip_prefix("company", "[CH]"),
        "company": strict_key("-", "company", "company_desc"),
    })
    return add_unknown_member(named, "company_id", fixed.NOT_DEFINED_KEY)


def sale_networks(source: DataFrame) -> DataFrame:
    """Networks twice: as internal or external trade, and under "ALL"."""
    kind: Column = F.when(F.col("code").isin(fixed.EXCLUDED_NETWORKS), F.lit("ITC")).otherwise(
        F.lit("NO ITC"))
    named = source.withColumns({
        "network_id": make_key("-@-", "company", "code"),
        "network": make_key("-", "code", "description"),
    })
    return add_all_member(named, "sales_type", kind)


def return_type(motive: str = "motive") -> Column:
    code = F.col(motive).try_cast("int")
    return (
        F.when(code.isin(fixed.GOOD_RETURN_MOTIVES), F.lit("GOOD RETURN"))
        .when(code.isin(fixed.BAD_RETURN_MOTIVES), F.lit("BAD RETURN"))
        .otherwise(F.lit(fixed.TO_BE_DEFINED))
    )


def return_reasons(source: DataFrame) -> DataFrame:
    """Return reasons with their kind and the two keys facts use."""
    return source.withColumns({
        "motive_descr": F.coalesce("motive_descr", F.lit(fixed.TO_BE_DEFINED)),
        "return_type": return_type(),
        "reason_key": F.explode(F.array(F.col("motive"), make_key("|", "motive", "cause"))),
    })
