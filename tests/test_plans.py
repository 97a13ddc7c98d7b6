"""Business plans on short frames and against brute force."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saleweft import fixed_values as fixed
from saleweft.operators.aggregate import condition_pivot
from saleweft.operators.joins import with_needed_keys
from saleweft.operators.windows import fill_both_ways
from saleweft.plans import market, costs, legacy, measures, orders, portfolio, prices, segments


def day(column):
    return F.col(column).cast("date").alias(column)


# --- prices ---------------------------------------------------------------------

PRCD = "knumv string, kposn string, kschl string, kwert double, kbetr double, kkurs double, mwsk1 string"


def test_condition_pivot_equals_a_join_chain(frame, rows):
    df = frame(PRCD, ("1", "10", "ZNSV", 10.0, None, -2.0, None), ("1", "10", "MWST", 1.0, 22.0, 1.0, "V1"),
               ("1", "10", "XXXX", 9.0, None, 1.0, None), ("2", "10", "XXXX", 9.0, None, 1.0, None),
               ("3", "10", "ZIV1", 4.0, None, 0.0, None))
    out = prices.prices(df, prices.open_conditions("ord"))
    assert rows(out, "price_key", "ord_nsv_lc_tot", "ord_gsv_lc_tot", "vat_reason_code", "exchange_rate_erp") == [
        ("1|10", 5.0, None, "V1", 0.5), ("2|10", None, None, None, None), ("3|10", 0.0, 0.0, None, 0.0)]


def test_second_row_of_a_condition_fails(frame):
    df = frame(PRCD, ("1", "10", "ZNSV", 10.0, None, 1.0, None), ("1", "10", "ZIV1", 1.0, None, 1.0, None))
    with pytest.raises(PySparkException, match="more than once"):
        prices.prices(df, prices.open_conditions("ord")).collect()


def test_bonus_rows_may_repeat_when_they_agree(frame, rows):
    df = frame(PRCD, ("1", "10", "RENT", 3.0, None, 1.0, None), ("1", "10", "PPNT", 3.0, None, 1.0, None),
               ("1", "10", "ZFR2", -7.0, None, 1.0, None), ("2", "10", "ZNET", -8.0, None, 2.0, None))
    out = prices.prices(df, prices.invoice_conditions())
    assert rows(out, "price_key", "inv_gsv_bonus_lc_temp", "inv_transport_cost_lc_temp") == [
        ("1|10", 3.0, 7.0), ("2|10", None, 16.0)]
    clash = df.withColumn("kwert", F.when(F.col("kschl") == "PPNT", 4.0).otherwise(F.col("kwert")))
    with pytest.raises(PySparkException):
        condition_pivot(clash, ["knumv", "kposn"], "kschl", prices.invoice_conditions()).collect()


# --- costs ------------------------------------------------------------------------


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(2000, 2009), st.one_of(st.none(), st.integers(1, 9))),
             min_size=1, max_size=12, unique_by=lambda r: (r[0], r[1])),
    st.integers(1998, 2005), st.integers(0, 6))
def test_filled_costs_equal_a_full_join_and_fill(spark, rows, data, first, length):
    """The form that needs no facts gives what joining every needed key and filling gives."""
    last = first + length
    history = spark.createDataFrame(data, "product int, year int, cost int")
    out = costs.filled_costs(history, ["product"], F.col("year"), {"cost": "unit"},
                             (F.lit(first), F.lit(last)))
    needed = history.select("product", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    brute = fill_both_ways(with_needed_keys(history, needed, ["product", "year"]), ["product"], "year", ["cost"])
    wanted = brute.select(F.concat_ws("###", F.col("product").cast("string"), F.col("year").cast("string")).alias("cost_key"),
                          F.col("cost").alias("unit"))
    # Years between two known ones are filled as well; compare the asked-for years.
    asked = needed.select(F.concat_ws("###", F.col("product").cast("string"), F.col("year").cast("string")).alias("cost_key")).distinct()
    assert rows(out.join(asked, ["cost_key"], "leftsemi")) == rows(wanted.join(asked, ["cost_key"], "leftsemi"))


def test_costs_that_disagree_fail(frame):
    history = frame("product string, year int, cost double", ("a", 2020, 1.0), ("a", 2020, 2.0))
    with pytest.raises(PySparkException, match="different costs"):
        costs.filled_costs(history, ["product"], F.col("year"), {"cost": "unit"}, None).collect()


def test_quarter_index_there_and_back(frame, rows):
    df = frame("q string", ("2023Q4",), ("2024Q1",))
    index = costs.quarter_index(F.col("q"))
    assert rows(df.select("q", costs.quarter_of_index(index).alias("back"))) == [
        ("2023Q4", "2023Q4"), ("2024Q1", "2024Q1")]
    assert df.agg(F.max(index) - F.min(index)).first()[0] == 1


def test_pivot_before_unpivot_equals_the_other_way_round(frame, rows):
    from saleweft.operators.aggregate import pivot_max, unpivot_months

    schema = "k string, label string, " + ", ".join(f"{m} double" for m in fixed.MONTHS)
    cells = [float(i) for i in range(11)]
    df = frame(schema, ("a", "x", *cells, None), ("a", "y", None, *cells), ("a", "z", 5.0, *cells),
               ("b", "x", *cells, 1.0), ("b", "x", 9.0, *cells))
    ours = costs.pivot_then_unpivot(df, ["k"], "label", ["x", "y"])
    theirs = pivot_max(unpivot_months(df, ["k", "label"], "v"), ["k", "month"], "label", "v", ["x", "y"])
    assert rows(ours, "k", "month", "x", "y") == rows(theirs, "k", "month", "x", "y")


# --- orders ----------------------------------------------------------------------------


def order_tables(frame, **change):
    tables = {
        "headers": frame("vbeln string, auart string, lifsk string, faksk string, cmgst string",
                         ("1", "ZOR", None, None, "A"), ("2", "ZOR", "01", None, "A"), ("3", "ZKL", None, None, "A"),
                         ("4", "Z23", " ", "C", "A"), ("5", "ZXX", None, None, "A")),
        "items": frame("vbeln string, posnr string, kwmeng double, lgort string, abgru string",
                       ("1", "10", 10.0, "W", None), ("1", "20", 5.0, "W", "R1"), ("2", "10", 4.0, "W", None),
                       ("3", "10", 4.0, "W", None), ("4", "10", 3.0, "W", None), ("5", "10", 3.0, "W", None)),
        "delivery_items": frame("vbeln string, vgbel string, vgpos string, lfimg double",
                                ("d1", "1", "10", 2.0), ("d2", "1", "10", 3.0), ("d3", "4", "10", 3.0)),
        "delivery_headers": frame("vbeln string, wadat_ist string, zzdate_slot string",
                                  ("d1", "2024-01-01", None), ("d2", None, "2024-02-01"),
                                  ("d3", "2024-01-01", None)).select("vbeln", day("wadat_ist"), day("zzdate_slot")),
        "requirements": frame("vbeln string, posnr string, etenr string, lgort string, vmeng double",
                              ("1", "10", "0001", "W", 1.0), ("1", "10", "0001", "W", 1.0), ("1", "10", "0002", "W", 0.5),
                              ("1", "10", "0003", "W", -5.0), ("2", "10", "0001", "W", 1.0)),
        "schedule": frame("vbeln string, posnr string, etenr string, edatu string, ezeit string, tddat string",
                          ("1", "10", "0001", "2024-03-01", "08", "2024-02-28")).select(
            "vbeln", "posnr", "etenr", day("edatu"), "ezeit", day("tddat")),
        "types": frame("auart string, vbtyp string", ("ZOR", "C"), ("ZKL", "C"), ("ZXX", "X")),
    }
    return orders.OrderTables(**{**tables, **change})


def test_order_status(frame, rows):
    out = orders.order_status(order_tables(frame))
    assert rows(out, "order_number", "order_status", "schedule_line", "ord_qty_fabs", "pct_ord_qty") == sorted([
        ("1", "In Picking", None, 3.0, 0.3), ("1", "Confirmed SAP", "0001", 2.0, 0.2),
        ("1", "Confirmed SAP", "0002", 0.5, 0.05), ("1", "Not Deliverables", None, 2.5, 0.25),
        ("2", "Blocked", None, 4.0, 1.0)], key=repr)
    confirmed = out.where("schedule_line = '0001'").select(F.col("confirmed_date").cast("string"), "confirmed_time")
    assert rows(confirmed) == [("2024-03-01", "08")]


def test_blocking_types(frame, rows):
    out = orders.blocking(order_tables(frame).headers)
    assert rows(out) == sorted([
        ("1", False, None), ("2", True, "Delivery Block"), ("3", False, None),
        ("4", False, "Billing Block"), ("5", False, None)], key=repr)


def test_services_are_dropped_and_null_items_stay(frame, rows):
    df = frame("order_type_code string, pstyv string", ("ZOR", "ZTAX"), ("ZOR", "TAN"), ("ZOR", None))
    assert orders.without_services(df).count() == 2


# --- measures ------------------------------------------------------------------------------


def test_margin_is_zero_without_net_value(frame, rows):
    df = frame("x_nsv_lc double, x_nsv_eur double, x_tp_lc double, x_tp_eur double, x_cp_lc double, x_cp_eur double",
               (0.0, None, 5.0, 5.0, 5.0, 5.0), (10.0, 10.0, None, 4.0, 3.0, None))
    assert rows(measures.margins(df, "x"), "x_gm_tp_lc", "x_gm_tp_eur", "x_gm_cp_lc", "x_gm_cp_eur") == [
        (0.0, 0.0, 0.0, 0.0), (10.0, 6.0, 7.0, 10.0)]


def test_zero_and_null_denominators_give_null(frame, rows):
    df = frame("list_price_tot double, forced_price_tot double, removable_charges_tot double, pct_ord_qty double, ord_qty double",
               (10.0, None, 1.0, 0.5, 0.0), (10.0, 6.0, 1.0, 0.5, None), (10.0, 6.0, 1.0, 0.5, 2.0))
    assert rows(measures.order_prices(df), "list_price", "forced_price", "net_price") == sorted(
        [(None, None, 0.0), (None, None, 0.0), (2.5, 1.5, 4.0)], key=repr)


def test_month_buckets_are_half_open(frame, rows):
    days = ["1990-01-01", "1998-08-31", "1998-09-01", "1998-09-30", "1998-10-01", "1999-01-31", "1999-02-01"]
    schema = "first_req_del_date string, " + ", ".join(f"ord_{v} double" for v in portfolio.VALUES)
    df = frame(schema, *[(d, 1.0, 1.0, 1.0, 1.0, 1.0) for d in days]).withColumn(
        "first_req_del_date", F.col("first_req_del_date").cast("date"))
    out = portfolio.order_buckets(df, "1998-08-15")
    picked = out.select(F.col("first_req_del_date").cast("string").alias("d"),
                        *[F.col(f"ord_qty{s}").cast("int") for s in ("", "_m1", "_m2", "_m3", "_m4", "_m5")])
    assert rows(picked) == sorted([
        ("1990-01-01", 1, 0, 0, 0, 0, 0), ("1998-08-31", 1, 0, 0, 0, 0, 0), ("1998-09-01", 0, 1, 0, 0, 0, 0),
        ("1998-09-30", 0, 1, 0, 0, 0, 0), ("1998-10-01", 0, 0, 1, 0, 0, 0), ("1999-01-31", 0, 0, 0, 0, 0, 1),
        ("1999-02-01", 0, 0, 0, 0, 0, 0)])


def test_legacy_values_are_zero_without_a_rate(frame, rows):
    df = frame("currency_euro_exch double, order_qty double, order_nsv_amount double, order_doc_total_amount double, "
               "tot_amount_no_transport double, removable_charges double, data_type int",
               (0.0, 1.0, 5.0, 9.0, 1.0, 1.0, 2), (None, 1.0, 5.0, 9.0, 1.0, 1.0, 2), (2.0, None, 5.0, 9.0, None, 1.0, 2),
               (2.0, 1.0, 5.0, 9.0, 1.0, 1.0, 1))
    assert rows(legacy.order_amounts(df), "ord_qty", "ord_nsv_eur", "ord_gsv_eur") == [
        (0.0, 2.5, 4.0), (1.0, 0.0, 0.0), (1.0, 0.0, 0.0), (1.0, 2.5, 0.0)]


# --- segments -----------------------------------------------------------------------------


def test_a_product_is_in_every_segment_it_fits(frame, rows):
    df = frame("product_id string, product_type_code string, business_sector_descr string",
               ("1-@-7", None, "S"), ("P1", "2", "S"), ("P2", "W", None))
    out = segments.product_segments(df)
    assert rows(out.where("product_id = '1-@-7'"), segments.SEGMENT) == [
        ("ALL",), ("FG (1) + ACCESSORIES (3)",), ("FG (1) + PROGR.ACC. (2)",), ("ONLY FG (1)",)]
    assert rows(out.where("product_id = 'P2'"), segments.SEGMENT) == [("ALL",), ("SERVICE WASHPASS",)]
    for label, rule in segments.segment_rules().items():
        alone = segments.select_product(df, label)
        assert rows(alone, "product_id") == rows(
            out.where(F.col(segments.SEGMENT) == label).join(df, ["product_id"], "leftsemi"), "product_id")


def test_a_date_outside_the_cost_span_fails(spark):
    from workload.business import cost_tables
    from workload.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    sold = t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("document_date"), F.lit("00000001").alias("product_code"),
        F.lit("80").alias("company"), F.lit("4").alias("network"))
    span = (F.lit("1997-01-01").cast("date"), F.lit("1997-02-01").cast("date"))
    with pytest.raises(PySparkException, match="outside the span"):
        costs.with_unit_costs(sold, cost_tables(t), span).select("document_date").collect()


RAW_MARKETS = ("sales_organization string, sales_office string, company string, network string, responsible_code string, responsible_descr string, "
               "responsible_code1 string, responsible_descr1 string, responsible_code3 string, responsible_descr3 string, "
               "market_budget string, market_budget_descr string")


def raw_market(organization, office, company, network, name):
    return (organization, office, company, network, "C_1", name, "R_2", "r", "S_3", "s", "M_4", "m")


def test_market_rules_by_line_and_without(frame, rows):
    raw = frame(RAW_MARKETS, raw_market("66-J0", "H001", "80", "4", "four"), raw_market("60B0", "H002", "7", "2", "two"),
                raw_market("60B0", "H002", "7", "1", "one"), raw_market(" ", "H003", "80", "8", "eight"))
    lines = frame("sales_office string, line string, network string", ("H001", "01", "8"), ("H001", "02", "5"), ("H001", "01", "4"))
    out = market.market_hierarchy(raw, lines)
    assert rows(out, "sales_organization", "sales_office", "line", "company", "network", "responsible_descr", "market_budget") == sorted([
        ("66J0", "H001", "01", "80", "04", "four", "4"), ("66J0", "H001", "02", "80", "05", None, None),
        ("60B0", "H002", None, "07", "01", "one", "4"), (None, "H003", None, "80", "08", "eight", "4")], key=repr)


def test_a_network_described_twice_fails(frame):
    raw = frame(RAW_MARKETS, raw_market("66J0", "H001", "80", "4", "four"), raw_market("66J0", "H002", "80", "4", "other"))
    lines = frame("sales_office string, line string, network string", ("H009", "01", "4"))
    with pytest.raises(PySparkException, match="market networks"):
        market.market_hierarchy(raw, lines).select("line").collect()


def test_two_joins_bring_all_unit_costs(spark):
    from workload import load_all

    plan = load_all()["b12_unit_costs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2


def test_partner_names_follow_the_code_that_was_picked(frame, rows):
    from saleweft.operators.joins import with_partners

    lines = frame("order_number string, order_line string", ("1", "10"), ("2", "10"), ("3", "10"))
    partners = frame("vbeln string, posnr string, parvw string, kunnr string", ("1", "10", "YD", "a"), ("1", "000000", "YD", "b"),
                     ("2", "10", "YD", " "), ("2", "000000", "YD", "b"), ("3", "10", "YD", "unknown"))
    out = with_partners(lines, partners, names=frame("code string, name string", ("a", "Ann"), ("b", "Bob")))
    assert rows(out, "order_number", "salesman_code", "salesman_name") == [("1", "a", "Ann"), ("2", "b", "Bob"), ("3", "unknown", None)]


def test_a_key_is_checked_where_the_result_is_written(frame):
    from saleweft.operators.quality import DataError, settle_unique

    assert settle_unique(frame("k int, v int", (1, 1), (2, 1)), ["k"]).count() == 2
    with pytest.raises(DataError):
        settle_unique(frame("k int, v int", (1, 1), (1, 2)), ["k"])
