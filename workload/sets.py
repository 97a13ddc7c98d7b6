"""U: stacking frames and repeating rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.operators import sets as s
from saleweft.plans.segments import SEGMENT, segment_rules, select_product

from .registry import query


@query("u01_union_by_name", """
SELECT o_orderkey AS key, o_totalprice AS amount, o_orderstatus AS status, CAST(NULL AS STRING) AS flag FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice, NULL, l_returnflag FROM lineitem
""", "amount")
def u01(t):
    orders = t.orders.select(F.col("o_orderkey").alias("key"),
                             F.col("o_totalprice").alias("amount"),
                             F.col("o_orderstatus").alias("status"))
    lines = t.lineitem.select(F.col("l_returnflag").alias("flag"),
                              F.col("l_extendedprice").alias("amount"),
                              F.col("l_orderkey").alias("key"))
    return s.union_all([orders, lines])


@query("u02_union_all", """
SELECT n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT r_name, 'region' FROM region
UNION ALL SELECT s_name, 'supplier' FROM supplier UNION ALL SELECT c_name, 'customer' FROM customer
""")
def u02(t):
    frames = {"nation": ("n_name", t.nation), "region": ("r_name", t.region),
              "supplier": ("s_name", t.supplier), "customer": ("c_name", t.customer)}
    return s.union_all([df.select(F.col(c).alias("name"), F.lit(k).alias("kind"))
                        for k, (c, df) in frames.items()])


@query("u03_positional_union", """
SELECT c_custkey AS id, c_name AS label FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
""")
def u03(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label")).union(
        t.supplier.select("s_suppkey", "s_name"))


@query("u04_tagged_union", """
SELECT o_orderkey, o_totalprice, 'sap' AS source FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_totalprice, 'cas' FROM orders WHERE o_orderstatus = 'F'
""", "o_totalprice")
def u04(t):
    finished = F.col("o_orderstatus") == "F"
    rows = t.orders.select("o_orderkey", "o_totalprice", finished.alias("finished"))
    return s.tagged_union({fixed.ERP: rows.where("not finished").drop("finished"),
                           fixed.LEGACY: rows.where("finished").drop("finished")})


FINISHED = "(product_id LIKE '1-@-%' OR product_id LIKE '2-@-%')"


def segment_sql():
    selects = []
    for label, codes, with_prefix in fixed.PRODUCT_SEGMENTS:
        listed = ", ".join(f"'{c}'" for c in codes)
        rule = f"product_type_code IN ({listed})" if codes else "true"
        if with_prefix:
            rule = f"({rule} OR {FINISHED})"
        selects.append(f"SELECT product_id, product_type_code, '{label}' AS product_segment "
                       f"FROM products WHERE {rule}")
    return " UNION ALL ".join(selects)


@query("u05_explode_segments", segment_sql())
def u05(t):
    return s.explode_segments(t.products, segment_rules(), SEGMENT).select(
        "product_id", "product_type_code", SEGMENT)


@query("x09_select_product", f"""
SELECT product_id, product_code, 'FG (1) + ACCESSORIES (3)' AS product_segment FROM products
WHERE product_type_code IN ('1', '3') OR {FINISHED}
""")
def x09(t):
    return select_product(t.products, "FG (1) + ACCESSORIES (3)").select(
        "product_id", "product_code", SEGMENT)


@query("u06_add_all_member", """
SELECT c_custkey, CASE WHEN c_nationkey IN (1, 2) THEN 'ITC' ELSE 'NO ITC' END AS sales_type FROM customer
UNION ALL SELECT c_custkey, 'ALL' FROM customer
""")
def u06(t):
    member = F.when(F.col("c_nationkey").isin(1, 2), F.lit("ITC")).otherwise(F.lit("NO ITC"))
    return s.add_all_member(t.customer.select("c_custkey", "c_nationkey"), "sales_type",
                            member).select("c_custkey", "sales_type")


@query("u07_add_unknown_member", """
SELECT c_name, c_mktsegment FROM customer UNION ALL SELECT 'NOT DEFINED', NULL
""")
def u07(t):
    return s.add_unknown_member(t.customer.select("c_name", "c_mktsegment"), "c_name",
                                fixed.NOT_DEFINED_KEY)


@query("u08_carry_forward", """
WITH q AS (SELECT product_code, year_quarter, std_prod_cost_commercial AS cost FROM commercial)
SELECT * FROM q UNION ALL
SELECT product_code, CASE WHEN substring(year_quarter, 6, 1) = '4'
  THEN CAST(CAST(substring(year_quarter, 1, 4) AS INT) + 1 AS STRING) || 'Q1'
  ELSE substring(year_quarter, 1, 5) || CAST(CAST(substring(year_quarter, 6, 1) AS INT) + 1 AS STRING) END, cost
FROM q WHERE year_quarter = (SELECT max(year_quarter) FROM q)
""", "cost")
def u08(t):
    rows = t.commercial.select("product_code", "year_quarter",
                               F.col("std_prod_cost_commercial").alias("cost"))
    return s.carry_forward_quarter(rows, "year_quarter")
