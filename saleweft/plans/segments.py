"""Product segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..operators.lookup import checked_lookup
from ..operators.sets import explode_segments, union_all
from ..operators.windows import dedup_ordered

SEGMENT = "product_segment"


def segment_rules(
    kind: str = "product_type_code", product: str = "product_id"
) -> Mapping[str, Column]:
    """For each segment whether a product belongs to it."""
    finished = reduce(or_, [F.col(product).startswith(p) for p in fixed.FINISHED_GOOD_PREFIXES])

    def rule(codes: Sequence[str], with_prefix: bool) -> Column:
        if not codes:
            return F.lit(True)
        listed = F.col(kind).cast("string").isin(list(codes))
        return listed | finished if with_prefix else listed

    return {label: rule(codes, flag) for label, codes, flag in fixed.PRODUCT_SEGMENTS}


def select_product(df: DataFrame, segment: str) -> DataFrame:
    """The products of one segment."""
    return df.where(segment_rules()[segment]).withColumn(SEGMENT, F.lit(segment))


def _pseudo_products(rows: DataFrame) -> DataFrame:
    return rows.withColumn("product_type_code", F.lit("1"))


def product_segments(products: DataFrame) -> DataFrame:
    """Products once per segment, plus stand-ins for unknown products and sectors.

    Each distinct business sector of the segmented rows is a product of its own
    in the segments for finished goods and for all.
    """
    spark = products.sparkSession
    typed = products.withColumn("product_type_code", F.col("product_type_code").cast("string"))
    segmented = explode_segments(typed, segment_rules(), SEGMENT)
    unknown = _pseudo_products(spark.createDataFrame(
        [(fixed.NOT_DEFINED_KEY, s) for s in fixed.UNKNOWN_SEGMENTS],
        f"product_id string, {SEGMENT} string"))
    sectors = _pseudo_products(
        union_all([segmented, unknown])
        .select(F.col("business_sector_descr").alias("product_id")).distinct()
        .withColumn(SEGMENT, F.explode(F.array(*[F.lit(s) for s in fixed.SECTOR_SEGMENTS]))))
    return union_all([segmented, unknown, sectors])


def line_attribute(products: DataFrame, attribute: str) -> DataFrame:
    """A map from product line to an attribute: its first value in order."""
    return dedup_ordered(products.select("line_code", attribute), ["line_code"], [attribute])


LINE_ATTRIBUTES = ["line_descr", "business_sector_code", "business_sector_descr",
                   "ind_division_code", "ind_division_descr", "fob"]


def budget_products(
    products: DataFrame, division_lines: DataFrame, prefix: str = "BUDGET"
) -> DataFrame:
    """Stand-ins for budget that is planned by division, in four segments each.

    ``division_lines`` maps a division to a product line; the line gives the
    other attributes, or "NOT DEFINED" when there is none.
    """
    rows = [(f"{prefix}_{code}", segment, name)
            for code, name in fixed.BUDGET_DIVISIONS.items() for segment in fixed.UNKNOWN_SEGMENTS]
    out = _pseudo_products(products.sparkSession.createDataFrame(
        rows, f"product_id string, {SEGMENT} string, division string"))
    out = checked_lookup(out, division_lines, "division", "line_code", None, "division line")
    unknown = F.lit(fixed.NOT_DEFINED_KEY)
    for attribute in LINE_ATTRIBUTES:
        out = checked_lookup(out, line_attribute(products, attribute), "line_code", attribute,
                             unknown, attribute)
    return out
