"""Sales analysis facts: orders, deliveries, budget, invoices as one family."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.dates import day_from_parts
from ..operators.filters import division_gate, exclude_values
from ..operators.lookup import checked_lookup
from ..session import settle
from .measures import closed_month_copies


def analysis_fact(
    fact: DataFrame, delivery_codes: DataFrame, customer_codes: DataFrame
) -> DataFrame:
    """A fact cut to what is analysed, with customer codes and the return key.

    Documents of types 4 to 6 are no returns and all get the key 999. Codes are looked up for the
    distinct pairs of customers, which are written once: the wide rows find both by one join, which is a
    broadcast where the pairs are few.
    """
    reason = F.when(F.col("doc_type_code").isin(4, 5, 6), F.lit("999")).otherwise(
        F.col("return_reason").cast("string"))
    kept = fact.transform(division_gate).transform(
        exclude_values, "sales_organization", fixed.EXCLUDED_COMPANIES)
    pairs = settle(
        kept.select("dest_id", "inv_id").distinct()
        .transform(checked_lookup, delivery_codes, "dest_id", "dest_code", F.lit("0"))
        .transform(checked_lookup, customer_codes, "inv_id", "customer_code", F.lit("0")), "customer-pairs",
    ).withColumnsRenamed({"dest_id": "__dest", "inv_id": "__inv"})
    same = F.col("dest_id").eqNullSafe(F.col("__dest")) & F.col("inv_id").eqNullSafe(F.col("__inv"))
    return kept.join(pairs, same, "left").drop("__dest", "__inv").withColumn("key_return_reason", reason)


def analysis_budget(budget: DataFrame) -> DataFrame:
    """The budget as a fact on the first day of its month."""
    first = day_from_parts("year", "month", F.lit(1))
    return exclude_values(budget, "sales_organization", fixed.EXCLUDED_COMPANIES).select(
        "product_code", "network", "company", "sales_organization", "sales_office",
        "year", "month", first.alias("time_id"),
        F.col("budget_nsv_eur").alias("bdg_nsv_eur"),
        F.col("budget_nsv_local").alias("bdg_nsv_lc"),
        F.col("qty_sold").cast("int").alias("bdg_qty"),
        "nsv_eur", F.col("nsv_local").alias("nsv_lc"), F.lit(4).alias("data_type"))


def analysis_facts(
    orders: DataFrame, deliveries: DataFrame, invoices: DataFrame, budget: DataFrame,
    delivery_codes: DataFrame, customer_codes: DataFrame, as_of: str,
) -> Mapping[str, DataFrame]:
    """The fact family, ready to be written; invoices also for closed months."""
    codes = (delivery_codes, customer_codes)
    return {
        "order": analysis_fact(orders, *codes),
        "delivery": analysis_fact(deliveries, *codes),
        "budget": analysis_budget(budget),
        "invoice": closed_month_copies(analysis_fact(invoices, *codes), as_of),
    }
