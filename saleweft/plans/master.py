"""Product master: attribute files to attribute rows to wide product tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.text import split_part, standard_name_column
from ..functions.typed import list_items, typed_value
from ..operators.aggregate import collect_text, eav_pivot
from ..operators.columns import fix_values, quoted, standardize_columns
from ..operators.incremental import current_state
from ..operators.lookup import ONCE, checked_lookup, held, spread_join, unique_rows
from ..operators.sets import union_all
from ..operators.windows import dedup_ordered, latest_version

MAP = "map<string,string>"


def packed(df: DataFrame, keep: Sequence[str], name: str, leave_out: Sequence[str]) -> DataFrame:
    """Some columns as they are, all but ``leave_out`` as one JSON text.

    Names are put in order, so the same row always gives the same text; null
    attributes are not part of it.
    """
    rest = sorted(c for c in df.columns if c not in leave_out)
    return df.select(*map(quoted, keep), F.to_json(F.struct(*map(quoted, rest))).alias(name))


def overview_rows(raw: DataFrame, source_type: str, ingestion_date: str) -> DataFrame:
    """An overview file: the last modified row per product, attributes packed."""
    named = standardize_columns(
        raw.withColumnsRenamed({"SKU [item_id]": "SKU",
                                "Date Last Modify [last_mod_date]": "Date_Last_Modify"}),
        keep_brackets=True)
    date = ["Date_Last_Modify"] if "Date_Last_Modify" in named.columns else []
    one = dedup_ordered(named, ["SKU"], [F.col(d).desc() for d in date])
    trees = [t for t in fixed.TREE_COLUMNS if t in named.columns]
    return packed(one, ["SKU", *trees], "payload", ["SKU"]).withColumns({
        "source_type": F.lit(source_type), "ingestion_date": F.lit(ingestion_date)})


def class_rows(raw: DataFrame, tree: str, ingestion_date: str) -> DataFrame:
    """A class file: one row per product and class, attributes packed."""
    named = standardize_columns(raw, keep_brackets=True)
    one = dedup_ordered(named, ["SKU", "ClassID"], sorted(
        c for c in named.columns if c not in ("SKU", "ClassID")) or ["SKU"])
    return packed(one, ["SKU", "ClassID"], "payload", ["SKU", "ClassID"]).withColumns({
        "tree_name": F.lit(tree), "ingestion_date": F.lit(ingestion_date)})


def attribute_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A packed payload as (key, value) rows next to the other columns."""
    others = [c for c in df.columns if c != payload]
    return df.select(*map(quoted, others), F.explode(F.from_json(payload, MAP)))


def current_attributes(
    delta: DataFrame, bulk: DataFrame, keys: Sequence[str], delta_type: str = "delta",
    bulk_type: str = "bulk", date: str = "ingestion_date",
) -> DataFrame:
    """Attribute rows as they stand: newest delta per product, newer bulk rows."""
    newest, kept = current_state(delta, bulk, keys, date)
    return union_all([
        attribute_rows(newest).withColumn("ingestion_type", F.lit(delta_type)),
        attribute_rows(kept).withColumn("ingestion_type", F.lit(bulk_type)),
    ])


def typed_attributes(
    rows: DataFrame, kinds: DataFrame, key_fixes: Mapping[str, str] | None = None,
    rejected: Sequence[str] = (),
) -> DataFrame:
    """One row per product, class and attribute with a standard key and typed value.

    ``kinds`` maps standard keys to Number, Date or Array. The newest row counts;
    on the same day the type that comes last in the alphabet, delta before bulk.
    """
    named = fix_values(rows, "key", key_fixes or {}).withColumn(
        "std_key", standard_name_column("key"))
    one = dedup_ordered(
        named.where(~F.col("sku").isin(list(rejected))) if rejected else named,
        ["key", "sku", "class_id", "std_key"],  # the last one follows from the first: a filter on it is put ahead of the sort
        [F.col("ingestion_date").desc(), F.col("ingestion_type").desc()])
    return one.transform(checked_lookup, kinds, "std_key", "kind", None, "attribute kind"
                         ).withColumn("value", typed_value("value", "kind"))


def wide_products(attributes: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per product with the listed attributes as columns."""
    return eav_pivot(attributes, ["sku"], "std_key", "value", list(names))


def base_skus(attributes: DataFrame, key: str = "Related_Derivate_Model") -> DataFrame:
    """Which base product a derived product belongs to."""
    return attributes.where(F.col("std_key") == key).select(
        F.explode(F.split("value", "; ")).alias("sku"), F.col("sku").alias("base_sku")).distinct()


def tree_names(attributes: DataFrame) -> DataFrame:
    return collect_text(attributes, ["sku"], "tree_name", ", ", "tree_names")


def categories(attributes: DataFrame) -> DataFrame:
    return attributes.select("sku", "class_id", "tree_name").distinct()


def released_products(workflow: DataFrame, task: str, date: str) -> DataFrame:
    """The last date a workflow task touched each product of its list."""
    rows = workflow.where(F.col("task_name") == task).select(
        F.explode(list_items("item_ids")).alias("product_code"), date, "last_mod_date")
    return dedup_ordered(rows, ["product_code"], [
        F.col("last_mod_date").desc(), F.col(date)]).drop("last_mod_date")


def volume_m3(height: str, width: str, depth: str):
    """Volume in cubic metres from sides in millimetres held as text."""
    sides = [F.col(c).try_cast("double") / 1000 for c in (height, width, depth)]
    return sides[0] * sides[1] * sides[2]


def product_master(
    attributes: DataFrame, names: Sequence[str], statuses: DataFrame,
    base_names: Mapping[str, str],
) -> DataFrame:
    """The wide product table with status text, trees, base product and volume."""
    wide = wide_products(attributes, names)
    base = base_skus(attributes)
    return (
        wide.transform(checked_lookup, statuses, "Release_Status", "business_status")
        .transform(checked_lookup, base.select("sku", "base_sku"), "sku", "base_sku", None,
                   "base product")
        .join(tree_names(attributes), ["sku"], "left")
        .transform(_with_base, wide, base_names)
        .withColumns({
            "product_type_code": split_part("Object_Type", "-", 0),
            "product_type_descr": split_part("Object_Type", "-", 1),
            "volume_m3": volume_m3("Packed_Product_Height_mm", "Packed_Product_Width_mm",
                                   "Packed_Product_Depth_mm"),
        })
    )


def _with_base(df: DataFrame, wide: DataFrame, names: Mapping[str, str]) -> DataFrame:
    base = wide.select(F.col("sku").alias("base_sku"),
                       *[quoted(a).alias(n) for a, n in names.items()])
    return df.join(base, ["base_sku"], "left")


def product_sides(sides: Sequence[DataFrame], key: str = "product_code") -> DataFrame:
    """Tables with one row per product each as one table, so that the master joins them once.

    A product that repeats in a side fails the job.
    """
    stacked = union_all([unique_rows(side, [key], "product side") for side in sides])
    columns = [c for c in stacked.columns if c not in (key, ONCE)]
    return stacked.groupBy(key).agg(*[F.max(c).alias(c) for c in columns], F.bool_and(ONCE).alias(ONCE))


def with_product_sides(master: DataFrame, sides: Sequence[DataFrame], sku: str = "sku") -> DataFrame:
    """The master with workflow dates, characteristics, plant, trade class and material data, and its codes split.

    Producer and supplier are held as ``code-name``; the text itself is the description.
    """
    joined = spread_join(master, product_sides(sides), {"product_code": F.col(sku)})
    return held(joined).drop("product_code").withColumns({
        "producer_code": split_part("Factory_CAS", "-", 0), "producer_descr": F.col("Factory_CAS"),
        "supplier_code": split_part("Supplier_Code_SAP", "-", 0), "supplier_descr": F.col("Supplier_Code_SAP"),
    })


def trade_class(source: DataFrame, as_of: str) -> DataFrame:
    """The last valid customs number of a product."""
    valid = source.where(F.col("validity_end_date") > F.lit(as_of).cast("date"))
    return latest_version(valid, ["product_code"], "last_update")
