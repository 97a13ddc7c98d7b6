"""Plans that have to hold at size: what is broadcast and what is shuffled."""

from __future__ import annotations

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.functions.dates import day
from saleweft.operators import aggregate, lookup
from saleweft.plans import analysis, costs, invoices, master, orders, portfolio, prices, reassembly


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_cost_tables_are_never_broadcast(frame, rows, capsys):
    sold = frame("id int, company string, network string, product_code string, d string",
                 (1, "80", "4", "A", "1997-05-01"), (2, None, None, "B", "1997-11-30"), (3, "80", "4", "A", None)
                 ).withColumn("document_date", F.col("d").cast("date"))
    tables = {
        "transfer_price": frame("currency string, company string, network string, product_code string, year int, "
                                "tp_commerciale double, tp_itcy double", ("EUR", "80", "4", "A", 1996, 7.0, None)),
        "freight_in": frame("company string, network string, product_code string, year int, freight_in_eur double, "
                            "transport_cost_infra_eur double", ("80", "4", "A", 1997, 2.0, 1.0)),
        "commercial": frame("currency string, product_code string, year_quarter string, std_prod_cost_commercial double",
                            ("EUR", "B", "1997Q1", 5.0)),
        "indefinite": frame("currency string, product_code string, year int, std_prod_cost_no_tca double, tca double",
                            ("EUR", "B", 1997, 3.0, 0.5)),
    }
    out = costs.with_unit_costs(sold, tables, (day("1997-01-01"), day("1997-12-31")))
    joins = [line for line in plan(out, capsys).splitlines() if "Join" in line and "key_cost" in line]
    assert len(joins) == 2 and all("SortMergeJoin" in line for line in joins)
    assert rows(out, "id", "comm_cost_unit", "freight_in_unit", "std_prod_cost_commercial_unit", "tca_unit") == [
        (1, 7.0, 2.0, None, None), (2, None, None, 5.0, 0.5), (3, None, None, None, None)]


def test_current_conditions_are_shuffled_by_item_once(spark, frame, rows, capsys):
    one = frame("knumv string, kposn string, stunr string, zaehk string, kschl string, deltadate date, kkurs double",
                ("1", "10", "001", "01", "ZNSV", None, 1.0), ("1", "10", "001", "02", "ZNSV", None, 2.0),
                ("2", "10", "001", "01", "ZNSV", None, 3.0))
    rates = frame("knumv string, rate double", ("2", 9.0))
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prices.current_conditions(prices.consolidate_conditions([one, one]), rates)
        shuffles = re.findall(r"hashpartitioning\(([^)]*)\)", plan(out, capsys))
        assert not [s for s in shuffles if "stunr" in s]
        assert rows(out, "knumv", "zaehk", "kkurs") == [("1", "02", 2.0), ("2", "01", 9.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_costs_outside_the_span_are_not_made(frame, rows):
    tables = {
        "transfer_price": frame("currency string, company string, network string, product_code string, year int, "
                                "tp_commerciale double, tp_itcy double",
                                *[("EUR", "80", "4", "A", y, float(y), None) for y in (1990, 1994, 1999)]),
        "freight_in": frame("company string, network string, product_code string, year int, freight_in_eur double, "
                            "transport_cost_infra_eur double", ("80", "4", "A", 1990, 2.0, 1.0), ("80", "4", "A", 1996, 3.0, 1.0)),
        "commercial": frame("currency string, product_code string, year_quarter string, std_prod_cost_commercial double",
                            ("EUR", "A", "1990Q1", 5.0), ("EUR", "A", "1996Q4", 6.0), ("EUR", "A", "2001Q1", 7.0)),
        "indefinite": frame("currency string, product_code string, year int, std_prod_cost_no_tca double, tca double",
                            ("EUR", "A", 2002, 3.0, 0.5)),
    }
    by_unit, by_product = costs.unit_costs(tables, (day("1995-11-01"), day("1996-02-01")))
    assert rows(by_unit, "cost_key", "freight_in_unit", "comm_cost_unit") == [
        ("80###4###A###1995", None, 1994.0), ("80###4###A###1996", 3.0, 1994.0)]
    known = {k: (s, c) for k, s, c in rows(by_product, "cost_key", "std_prod_cost_commercial_unit", "cons_cost_unit")}
    assert sorted(known) == sorted(f"A###{y}Q{q}" for y in (1995, 1996) for q in (1, 2, 3, 4))
    assert known["A###1995Q4"] == (5.0, 3.0) and known["A###1996Q1"] == (5.0, 3.0)


def test_one_lookup_gives_the_rate_both_ways(frame, rows):
    facts = frame("id int, sales_organization string, d string", (1, "A", "1997-01-01"), (2, "A", "1998-01-01"),
                  (3, "B", "1997-01-01"), (4, None, None), (5, "C", "1997-01-01"))
    rates = frame("key string, value double", ("GBP|1997", 2.0), ("EUR|1997", 1.0), ("PLN|1997", None))
    out = orders.with_currency(facts, frame("company string, currency string", ("A", "GBP"), ("C", "PLN")), rates, "d")
    assert rows(out, "id", "currency_code", "exchange", "exchange_to_local") == [
        (1, "GBP", 2.0, 0.5), (2, "GBP", 1.0, 1.0), (3, "EUR", 1.0, 1.0), (4, "EUR", 1.0, 1.0), (5, "PLN", None, None)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2


def test_prices_join_the_facts_last(spark):
    from workload import business as b
    from workload.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    invoiced = invoices.invoice_fact(b.invoice_base(t), b.fact_tables(t, t.prcd_invoice), costs.span_of(t.vbrk, "fkdat"))
    for fact in (b.order_fact(t), invoiced):
        joins = [x for x in fact._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
        assert "price_key" in joins[0]


def test_a_spread_join_does_not_carry_columns_for_its_number(spark, tmp_path):
    names = [f"c{i}" for i in range(20)]
    path = str(tmp_path / "wide")
    spark.range(10).selectExpr(*[f"id + {i} as {n}" for i, n in enumerate(names)]).write.parquet(path)
    side = spark.range(5).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("v"))
    out = lookup.spread_join(spark.read.parquet(path), side, {"k": F.col("c0")}).select("c0", "v")
    read = out._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split(">")[0]
    assert "c7" in read and "c8" not in read


def test_a_pivot_shuffles_once_and_has_all_labels(frame, rows, capsys):
    df = frame("k string, label string, v double", ("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", None), ("a", None, 5.0),
               ("b", "z", 7.0), (None, "y", 3.0), ("c", "x", None))
    wide = aggregate.pivot_sum(df, ["k"], "label", "v", ["x", "y"])
    assert plan(wide, capsys).count("Exchange hashpartitioning") == 1
    assert wide.columns == ["k", "x", "y"]
    assert set(rows(wide, "k", "x", "y")) == {(None, None, 3.0), ("a", 3.0, None), ("b", None, None), ("c", None, None)}
    assert set(rows(aggregate.pivot_max(df, ["k"], "label", "v", ["x"]), "k", "x")) == {
        (None, None), ("a", 2.0), ("b", None), ("c", None)}
    assert plan(costs.indefinite_costs(frame(
        "currency string, product_code string, years string, account string, beg_balance double, ingestion_date string, "
        "input_file_name string", ("EUR", "A", "FY97", "TCA_Indicative", 2.0, "19970601", "f"))), capsys).split(
            "Subquery")[0].count("Exchange hashpartitioning") == 1


def test_months_of_labels_nobody_reads_are_not_grouped(frame, rows):
    schema = "k string, label string, " + ", ".join(f"{m} double" for m in fixed.MONTHS)
    cells = [float(i) for i in range(11)]
    df = frame(schema, ("a", "x", *cells, None), ("a", "y", *cells, 99.0), ("b", "z", *cells, 1.0))
    one = costs.pivot_then_unpivot(df, ["k"], "label", ["x", "y"]).select("k", "month", "x")
    assert one._jdf.queryExecution().optimizedPlan().toString().count("max(CASE WHEN") == 12
    assert set(rows(one, "k", "month", "x")) == {
        *(("a", i + 1, float(i)) for i in range(11)), ("a", 12, None), *(("b", i + 1, None) for i in range(12))}


def test_attributes_that_are_left_out_are_not_sorted(frame, rows):
    attributes = frame(
        "sku string, class_id string, tree_name string, key string, value string, ingestion_date string, ingestion_type string",
        ("1", None, None, "Markets", "IT~UK", "2024-01-09", "delta"), ("1", None, None, "Markets", "FR", "2024-01-05", "delta"),
        ("1", "C", None, "Markets", "DE", "2024-01-05", "delta"), ("1", None, None, "Noise", "3", "2024-01-05", "delta"))
    kinds = frame("std_key string, kind string", ("Markets", "Array"))
    out = master.typed_attributes(attributes, kinds).where("std_key = 'Markets'")
    below = out._jdf.queryExecution().optimizedPlan().toString().split("Window [")[-1]
    assert "Filter" in below and "= Markets" in below
    assert set(rows(out, "sku", "class_id", "value")) == {("1", None, "IT; UK"), ("1", "C", "DE")}


def test_a_split_fact_is_computed_once(frame, rows, capsys):
    fact = frame("key_fact string, qty int, text string", ("a", 1, "x"), ("a", 2, "y"), ("b", None, None)).groupBy(
        "key_fact").agg(F.max("qty").alias("qty"), F.max("text").alias("text"))
    narrow, side = reassembly.split_fact(fact, ["key_fact", "qty"])
    for df in (narrow, side):
        text = plan(df, capsys)
        assert "split-fact" in text and "Aggregate" not in text
    assert set(rows(narrow, "key_fact", "qty")) == {("a", 2), ("b", None)}
    assert set(rows(side, "key_fact", "text")) == {("a", "y"), ("b", None)}


def test_a_source_of_the_portfolio_groups_its_own_measures(frame, rows):
    def source(prefix, tag, *lines):
        schema = "product_code string, d string, year int, month int, " + ", ".join(f"{prefix}_{v} decimal(18,4)" for v in portfolio.VALUES)
        return frame(schema, *[(*line[:4], *[Decimal(line[4]) if line[4] else None] * 5) for line in lines]).withColumns(
            {"first_req_del_date": F.col("d").cast("date"), "record_source": F.lit(tag)}).drop("d")

    ordered = source("ord", "ORD", ("A", "1998-08-01", 1998, 8, "1.5"), ("A", "1998-08-01", 1998, 8, "2"), ("A", "1998-10-01", 1998, 8, "4"),
                     ("A", None, 1998, 8, "5"), ("B", "1998-08-01", 1998, 8, None), ("B", "1998-08-01", 1998, 7, "9"))
    delivered = source("del", "DEL", ("A", "1998-08-01", 1998, 8, "7"), ("A", "1998-08-01", 1998, 8, None))
    invoiced = source("inv", "INV", (None, "1998-08-01", 1998, 8, "8"))
    budget = frame("product_code string, year int, month int, record_source string, " + ", ".join(f"{b} double" for b in portfolio.BUDGETS),
                   ("A", 1998, 8, "BUD", *[6.0] * 8))
    keys = ["product_code", "year", "month", "first_req_del_date", "record_source"]
    rolled = portfolio.portfolio(ordered, budget, delivered, invoiced, keys, "1998-08-15")
    sums = [line.count("sum(") for line in rolled._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line]
    assert sorted(sums) == [5, 5, 5, 8]
    out = portfolio.measures_by_source(rolled, "1998-08-15")
    assert set(portfolio.SUMS) <= set(out.columns) and not set(portfolio.VALUES) & set(out.columns)
    shown = ["ord_qty", "ord_qty_m1", "ord_qty_m2", "del_qty", "inv_qty", "bdg_qty"]
    got = rows(out, "record_source", "product_code", F.col("first_req_del_date").cast("string"), *[F.col(c).cast("double") for c in shown])
    assert set(got) == {
        ("ORD", "A", "1998-08-01", 3.5, 0.0, 0.0, None, None, None), ("ORD", "A", "1998-10-01", 0.0, 0.0, 4.0, None, None, None),
        ("ORD", "A", None, 0.0, 0.0, 0.0, None, None, None), ("ORD", "B", "1998-08-01", None, 0.0, 0.0, None, None, None),
        ("DEL", "A", "1998-08-01", None, None, None, 7.0, None, None), ("INV", None, "1998-08-01", None, None, None, None, 8.0, None),
        ("BUD", "A", None, None, None, None, None, None, 6.0)}


def test_both_customer_codes_join_the_wide_rows_once(frame, rows):
    fact = frame("id int, dest_id string, inv_id string, source string, division string, sales_organization string, doc_type_code int, "
                 "return_reason string", *[(i, d, v, "cas", None, "60B0", 7, "Z01") for i, (d, v) in enumerate(
                     [("a", "b"), ("a", "b"), ("b", "a"), (None, "a"), ("a", None), (None, None), ("x", "n")])],
                 (9, "a", "b", "sap", "AC", "60B0", 7, None), (10, "a", "b", "cas", None, None, 7, None))
    codes = frame("customer string, code string", ("a", "1"), ("b", "2"), ("n", None), (None, "9"))
    out = analysis.analysis_fact(fact, codes, codes)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
    assert set(out.columns) == {*fact.columns, "dest_code", "customer_code", "key_return_reason"}
    assert rows(out, "id", "dest_code", "customer_code") == [
        (0, "1", "2"), (1, "1", "2"), (2, "2", "1"), (3, "0", "1"), (4, "1", "0"), (5, "0", "0"), (6, "0", None)]
    with pytest.raises(Exception, match="occurs more than once"):
        analysis.analysis_fact(fact, codes, codes.union(codes)).collect()


@pytest.fixture
def shuffles(spark, capsys):
    """Keys of the shuffles of a plan in which nothing is broadcast."""
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda df: re.findall(r"hashpartitioning\((.*), \d+\)", re.sub(r"#\d+L?", "", plan(df, capsys)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_a_line_is_joined_once_for_all_its_statuses(frame, rows):
    t = orders.OrderTables(
        frame("vbeln string, auart string, lifsk string, faksk string, cmgst string", ("1", "ZOR", None, None, "A"), ("2", "ZOR", "01", None, "A")),
        frame("vbeln string, posnr string, kwmeng double, lgort string, abgru string", ("1", "10", 10.0, "W", None), ("1", "20", 2.0, "W", None),
              ("2", "10", 4.0, "W", None)),
        frame("vbeln string, vgbel string, vgpos string, lfimg double", ("8", "1", "10", 1.0), ("9", "1", "20", 2.0)),
        frame("vbeln string, wadat_ist date, zzdate_slot date", ("8", None, None), ("9", date(1998, 1, 1), None)),
        frame("vbeln string, posnr string, etenr string, lgort string, vmeng double", ("1", "10", "1", "W", 3.0), ("1", "10", "2", "W", 2.0)),
        frame("vbeln string, posnr string, etenr string, edatu date, ezeit string, tddat date", ("1", "10", "1", None, "08", None),
              ("1", "10", "1", None, "14", None), ("1", "10", "1", None, "14", None)),
        frame("auart string, vbtyp string", ("ZOR", "C")))
    lines = orders.order_status(t, by_line=True)
    assert rows(lines, "order_number", "order_line") == [("1", "10"), ("2", "10")]
    wanted = sorted([("1", "In Picking", 1.0, None, None), ("1", "Not Deliverables", 4.0, None, None), ("1", "Confirmed SAP", 3.0, "1", "08"),
                     ("1", "Confirmed SAP", 3.0, "1", "14"), ("1", "Confirmed SAP", 2.0, "2", None), ("2", "Blocked", 4.0, None, None)], key=repr)
    columns = ["order_number", "order_status", "ord_qty_fabs", "schedule_line", "confirmed_time"]
    assert rows(orders.each_status(lines), *columns) == wanted == rows(orders.order_status(t), *columns)


def lines_for_partners(keys):
    return [k for k in keys if k.startswith("__spread, order_number") or k == "order_number, order_line, schedule_line"]


def test_the_order_fact_does_not_shuffle_lines_for_partners(spark, shuffles):
    from workload import business as b
    from workload.registry import Tables

    assert not lines_for_partners(shuffles(b.order_fact(Tables(spark, "/root/testdata/sf0.001"))))


def test_invoices_are_not_shuffled_for_partners(spark, shuffles):
    from workload import business as b
    from workload.registry import Tables

    keys = shuffles(b.invoice_base(Tables(spark, "/root/testdata/sf0.001")))
    assert not lines_for_partners(keys)


def test_deliveries_are_not_shuffled_for_partners(spark, shuffles):
    from saleweft.plans import deliveries
    from workload import business as b
    from workload.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    tables, open_items = b.fact_tables(t, t.prcd), deliveries.open_deliveries(t.likp, t.lips, t.vbrp)
    base = deliveries.delivery_base(open_items, b.headers(t), t.vbap, t.vbep, b.AS_OF, tables)
    assert not lines_for_partners(shuffles(base))
    assert "inv_id" in deliveries.delivery_fact(base, tables, b.AS_OF).columns


@pytest.mark.parametrize("name", ["b07_enrich_orders", "b28_fact_roundtrip"])
def test_statuses_are_not_shuffled_by_schedule_line(spark, shuffles, name):
    from workload import load_all

    assert "order_number, order_line, schedule_line" not in shuffles(load_all()[name](spark, "/root/testdata/sf0.001"))


def test_prices_and_costs_are_shuffled_by_one_key(frame, shuffles):
    conditions = frame("knumv string, kposn string, kschl string, kwert double, kbetr double, kkurs double, mwsk1 string",
                       ("1", "10", "ZNSV", 10.0, None, -2.0, None))
    facts = frame("price_key string", ("1|10",))
    assert shuffles(facts.join(prices.prices(conditions, prices.open_conditions("ord")), ["price_key"], "left")) == ["price_key"] * 2
    history = frame("product string, year int, cost double", ("a", 2020, 1.0))
    assert shuffles(costs.filled_costs(history, ["product"], F.col("year"), {"cost": "unit"}, (F.lit(2019), F.lit(2021)))) == ["product"]
