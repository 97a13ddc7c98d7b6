"""Open orders: quantities, status, enrichment and the order fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.dates import day
from ..functions.nulls import is_blank, non_blank
from ..functions.rates import inverse_rate
from ..functions.text import make_key, strict_key
from ..operators.aggregate import first_date, sum_by
from ..operators.columns import quoted
from ..operators.filters import exclude_values
from ..operators.joins import document_partners, item_partners, with_partners
from ..operators.lookup import checked_lookup, constant_lookup, literal_lookup, spread_join
from ..operators.sets import union_all
from . import measures as m
from .costs import span_around, with_unit_costs
from .market import market_of
from .prices import open_conditions, prices


def _order() -> Column:
    return F.col("vbeln").alias("order_number")


def _line() -> Column:
    return F.col("posnr").alias("order_line")


def delivery_progress(delivery_items: DataFrame, delivery_headers: DataFrame) -> DataFrame:
    """Per order line: quantity delivered, quantity in picking, latest booking slot.

    A delivery counts as delivered once its goods issue is dated. Delivered and
    picked quantities come from one pass over the delivery items.
    """
    headers = delivery_headers.groupBy("vbeln").agg(
        F.max(F.col("wadat_ist").isNotNull()).alias("__issued"),
        F.max(F.col("zzdate_slot").cast("date")).alias("__slot"))
    issued = F.coalesce("__issued", F.lit(False))
    return (
        delivery_items.join(headers, ["vbeln"], "left")
        .groupBy(F.col("vgbel").alias("order_number"), F.col("vgpos").alias("order_line"))
        .agg(
            F.sum(F.when(issued, F.col("lfimg")).otherwise(F.lit(0.0))).alias("del_qty"),
            F.sum(F.when(~issued, F.col("lfimg")).otherwise(F.lit(0.0))).alias("picking_qty"),
            F.max("__slot").alias("booking_slot_delivery"),
        )
    )


def open_quantity(items: DataFrame, progress: DataFrame, *more: str) -> DataFrame:
    """Order lines that are not fully delivered, with what is still open and ``more`` columns of the items."""
    ordered = items.select(
        _order(), _line(), F.col("kwmeng").alias("ord_qty_orig"),
        F.col("lgort").alias("order_delivery_warehouse"), "abgru", *more)
    return (
        ordered.join(progress, ["order_number", "order_line"], "left")
        .withColumn("ord_qty", F.col("ord_qty_orig") - F.coalesce("del_qty", F.lit(0.0)))
        .where("ord_qty > 0")
    )


def blocking_type(delivery: str = "lifsk", billing: str = "faksk", credit: str = "cmgst") -> Column:
    return (
        F.when(non_blank(delivery), "Delivery Block")
        .when(F.col(billing) == fixed.BILLING_BLOCK, "Billing Block")
        .when(F.col(credit).isin(fixed.CREDIT_BLOCKS), "Credit Block")
    )


def blocking(headers: DataFrame) -> DataFrame:
    """Whether an order is blocked, and what blocks it."""
    blocked = non_blank("lifsk") | F.col("cmgst").isin(fixed.CREDIT_BLOCKS)
    return headers.select(_order(), F.coalesce(blocked, F.lit(False)).alias("blocked"),
                          blocking_type().alias("blocking_type"))


def _counting_headers(headers: DataFrame, types: DataFrame) -> DataFrame:
    extra = headers.sparkSession.createDataFrame([(fixed.EXTRA_ORDER_TYPE,)], "auart string")
    counting = types.select("auart").unionByName(extra)
    return exclude_values(headers, "auart", fixed.EXCLUDED_ORDER_TYPES).join(
        counting, ["auart"], "leftsemi")


def valid_orders(headers: DataFrame, types: DataFrame) -> DataFrame:
    """Orders whose type counts: listed in ``types``, or the extra type."""
    return _counting_headers(headers, types).select(_order())


def order_types(types: DataFrame) -> DataFrame:
    """Order types of the categories that count."""
    return types.where(F.col("vbtyp").isin(fixed.ORDER_CATEGORIES)).select("auart", "vbtyp")


def confirmed_by_schedule(requirements: DataFrame) -> DataFrame:
    """Confirmed quantity per schedule line and warehouse, from positive rows only."""
    positive = requirements.where("vmeng > 0").select(
        _order(), _line(), F.col("etenr").alias("schedule_line"),
        F.col("lgort").alias("allocation_warehouse"), F.col("vmeng").alias("qty_confirmed"))
    return sum_by(positive, ["order_number", "order_line", "schedule_line",
                             "allocation_warehouse"], ["qty_confirmed"])


def confirmed_by_line(by_schedule: DataFrame) -> DataFrame:
    return sum_by(by_schedule, ["order_number", "order_line"], ["qty_confirmed"])


@dataclass(frozen=True)
class OrderTables:
    """Source tables of the order plans, under their ERP column names."""

    headers: DataFrame
    items: DataFrame
    delivery_items: DataFrame
    delivery_headers: DataFrame
    requirements: DataFrame
    schedule: DataFrame
    types: DataFrame


def open_lines(t: OrderTables) -> DataFrame:
    """Open lines of valid orders that are not rejected, with progress and block.

    One join to the headers both checks the order and brings its block. It comes first, so
    that the lines lie by order and line from then on.
    """
    progress = delivery_progress(t.delivery_items, t.delivery_headers)
    counting = _counting_headers(t.headers, order_types(t.types))
    blocks = blocking(counting).select(F.col("order_number").alias("vbeln"), "blocked")
    kept = t.items.where(is_blank("abgru")).join(blocks, ["vbeln"], "inner")
    return open_quantity(kept, progress, "blocked").drop("abgru")


def each_status(lines: DataFrame) -> DataFrame:
    """One row per status of a line, from the lines that `order_status` gives with ``by_line``. Other frames are left alone."""
    if "__confirmed" not in lines.columns:
        return lines

    fields = [f for f in lines.schema["__confirmed"].dataType.elementType.fields if f.name != "qty_confirmed"]

    def status(label: str, amount: Column, row: Column | None = None) -> Column:
        return F.struct(F.lit(label).alias("order_status"), amount.alias("ord_qty_fabs"), *[
            (F.lit(None).cast(f.dataType) if row is None else row[f.name]).alias(f.name) for f in fields])

    of_line = F.array(status("Blocked", F.col("__open_qty")), status("In Picking", F.col("__picking_qty")),
                      status("Not Deliverables", F.col("__rest_qty")))
    of_schedule = F.transform("__confirmed", lambda c: status("Confirmed SAP", c["qty_confirmed"], c))
    every = F.when(F.col("__confirmed").isNull(), of_line).otherwise(F.concat(of_line, of_schedule))
    own = [c for c in lines.columns if c not in ("__open_qty", "__picking_qty", "__rest_qty", "__confirmed")]
    return lines.select(*own, F.inline(F.filter(every, lambda s: s["ord_qty_fabs"] > 0))).withColumns({
        "booking_slot_delivery": F.when(F.col("order_status") == "In Picking", F.col("__slot")),
        "pct_ord_qty": F.try_divide("ord_qty_fabs", "ord_qty_orig")}).drop("__slot")


def order_status(t: OrderTables, by_line: bool = False) -> DataFrame:
    """What is open of each line, by status, with its share of the line.

    * blocked orders: all that is open, as "Blocked";
    * others: what is "In Picking", what is "Confirmed SAP" per schedule line,
      and the rest as "Not Deliverables".

    All four are read off one frame: open lines with the lists of what is confirmed for them and of
    their dates, all lying by order and line, so the open lines are computed once and not once
    per status. A confirmed quantity has a status for each of the dates of its schedule line, and one
    without dates where there are none. With ``by_line`` each line stays one row, with the amounts of its
    statuses, and what is confirmed as a list: it is joined once, not once per status, see `each_status`.
    """
    line = ["order_number", "order_line"]
    confirmed = confirmed_by_schedule(t.requirements).groupBy(*line).agg(
        F.sum("qty_confirmed").alias("__line_confirmed"),
        F.collect_list(F.struct("schedule_line", "allocation_warehouse", "qty_confirmed")).alias("__schedule"))
    dates = t.schedule.select(
        _order(), _line(), F.col("etenr").alias("schedule_line"),
        F.col("edatu").alias("confirmed_date"), F.col("ezeit").alias("confirmed_time"),
        F.col("tddat").alias("planned_dispatch_date"))
    days = ["confirmed_date", "confirmed_time", "planned_dispatch_date"]
    dated = dates.dropna(subset=[*line, "schedule_line"]).groupBy(*line).agg(
        F.collect_set(F.struct("schedule_line", *days)).alias("__dates"))
    rows = open_lines(t).join(confirmed, line, "left").join(dated, line, "left")

    def of_schedule(c: Column) -> Column:
        def row(d: Column | None) -> Column:
            return F.struct(c["schedule_line"].alias("schedule_line"), c["allocation_warehouse"].alias("allocation_warehouse"),
                            c["qty_confirmed"].alias("qty_confirmed"),
                            *[(F.lit(None).cast(dates.schema[x].dataType) if d is None else d[x]).alias(x) for x in days])

        found = F.filter("__dates", lambda d: d["schedule_line"] == c["schedule_line"])
        return F.when(F.size(found) > 0, F.transform(found, row)).otherwise(F.array(row(None)))

    blocked, free = F.col("blocked"), ~F.col("blocked")
    rest = (F.col("ord_qty") - F.coalesce("picking_qty", F.lit(0.0))
            - F.coalesce("__line_confirmed", F.lit(0.0)))
    positive = F.filter("__schedule", lambda c: c["qty_confirmed"] > 0)
    lines = rows.select(
        *line, "ord_qty_orig", F.when(blocked, F.col("ord_qty")).alias("__open_qty"),
        F.when(free, F.col("picking_qty")).alias("__picking_qty"), F.when(free, rest).alias("__rest_qty"),
        F.when(free & (F.size(positive) > 0), F.flatten(F.transform(positive, of_schedule))).alias("__confirmed"),
        F.when(free, F.col("booking_slot_delivery")).alias("__slot"))
    some = F.greatest("__open_qty", "__picking_qty", "__rest_qty") > 0
    lines = lines.where(some | F.col("__confirmed").isNotNull())
    return lines if by_line else each_status(lines)


@dataclass(frozen=True)
class Texts:
    """Two-column maps that name codes. Missing ones are simply not looked up."""

    order_type: DataFrame
    return_cause: DataFrame
    return_text: DataFrame
    delivery_block: DataFrame
    category: DataFrame
    order_source: DataFrame


def enrich_headers(headers: DataFrame, texts: Texts, calendar: DataFrame, as_of: str) -> DataFrame:
    """Order headers with texts, document type, sign, grade and block."""
    kind = literal_lookup("vbtyp", fixed.ORDER_TYPE)
    returns = (kind == 7) | F.col("auart").isin(fixed.RETURN_ORDER_TYPES)
    undefined = F.lit(fixed.NOT_DEFINED)
    today = day(as_of)
    looked_up = (
        headers.withColumns({
            "__reason": F.when(returns, F.col("augru")),
            "time_id": constant_lookup(calendar, today, today),
        })
        .transform(checked_lookup, texts.order_type, "auart", "order_type_descr")
        .transform(checked_lookup, texts.return_cause, "__reason", "return_reason", undefined)
        .transform(checked_lookup, texts.return_text, "__reason", "return_reason_descr", undefined)
        .transform(checked_lookup, texts.delivery_block, "lifsk", "block_delivery_text")
        .transform(checked_lookup, texts.category, "vbtyp", "doc_type_descr")
        .transform(checked_lookup, texts.order_source, "bsark", "order_source_descr")
    )
    b_grade = F.col("auart") == fixed.B_GRADE_TYPE
    return looked_up.select(
        _order(),
        F.lit(2).alias("data_type"),
        F.col("auart").alias("order_type_code"),
        "order_type_descr", "time_id", F.col("time_id").alias("document_date"),
        today.alias("document_date_original"),
        "return_reason", "return_reason_descr",
        F.col("bstnk").alias("order_customer_reference_1"),
        F.col("audat").alias("order_date"),
        F.col("ernam").alias("order_creation_user"),
        F.col("vdatu").alias("order_requested_delivery_date"),
        F.col("vdatu").cast("date").alias("requested_delivery_date"),
        F.date_format(F.col("vdatu").cast("date"), "MMM").alias("requested_delivery_month"),
        F.col("lifsk").alias("order_blocking_code"),
        strict_key(" ", "lifsk", "faksk").alias("order_blocking_descr"),
        F.col("vtweg").alias("distr_channel"),
        F.col("vkorg").alias("sales_organization"),
        F.col("vkbur").alias("sales_office"),
        F.col("spart").alias("division"),
        F.col("cmgst").alias("block_credit"),
        "block_delivery_text",
        kind.alias("doc_type_code"), "doc_type_descr", "knumv",
        literal_lookup("vbtyp", fixed.ORDER_SIGN).alias("return_sign"),
        F.col("vbtyp").alias("category"),
        F.col("vsbed").alias("warehouse_classification"),
        F.col("bsark").alias("order_source"), "order_source_descr",
        F.when(b_grade, F.lit(0)).otherwise(F.lit(1)).alias("flag_bgrade"),
        F.when(b_grade, F.lit("B")).otherwise(F.lit("A")).alias("ab_grade"),
        blocking_type().alias("blocking_type"),
        F.when(F.col("auart").isin(fixed.OLD_PERIMETER_TYPES), F.lit("No"))
        .otherwise(F.lit("Yes")).alias("old_perimeter"),
    )


def enrich_items(items: DataFrame, areas: DataFrame, routes: DataFrame) -> DataFrame:
    """Order items with area and route texts and their booking slot."""
    return (
        items.transform(checked_lookup, areas, "zzlarea", "area_descr")
        .transform(checked_lookup, routes, "route", "routing_descr")
        .select(
            _order(), _line(), F.col("matnr").alias("product_code"), F.col("zzlarea").alias("area_code"),
            "area_descr", F.col("lgort").alias("order_delivery_warehouse"),
            F.col("werks").alias("plant"), F.col("vstel").alias("shipping_point"),
            F.col("route").alias("routing"), "routing_descr", "pstyv",
            F.coalesce("zzso_bookdate", "zzso_pbsdate").alias("booking_slot_item"))
    )


def enrich_orders(
    status: DataFrame, headers: DataFrame, items: DataFrame
) -> DataFrame:
    """Status rows with their header and item, without the service division.

    Items first: the rows lie by order and line and are shuffled for the headers only.
    """
    return (
        status.join(items, ["order_number", "order_line"], "left")
        .join(headers, ["order_number"], "left")
        .where(F.col("division") != fixed.SERVICE_DIVISION)
    )


def without_services(df: DataFrame, kind: str = "order_type_code", item: str = "pstyv") -> DataFrame:
    """Drop positions that stand for services."""
    key = F.coalesce(strict_key("|", kind, item), F.lit(""))
    return df.where(~key.isin(fixed.SERVICE_POSITIONS))


def with_currency(
    df: DataFrame, company_currency: DataFrame, yearly_rates: DataFrame, date: str
) -> DataFrame:
    """Currency of the organisation and its budget rate of the year, both ways by one lookup."""
    key, rate = yearly_rates.columns
    rates = yearly_rates.select(quoted(key), F.struct(quoted(rate).alias("rate")).alias("__rate"))
    found, absent = F.col("__rate")["rate"], F.col("__rate").isNull()
    return (
        df.transform(checked_lookup, company_currency, "sales_organization", "currency_code",
                     F.lit(fixed.DEFAULT_CURRENCY), "company currency")
        .transform(checked_lookup, rates, strict_key("|", "currency_code", F.year(date)), "__rate", None, "budget rate")
        .withColumns({
            "exchange": F.when(absent, F.lit(1.0)).otherwise(found),
            "exchange_to_local": F.when(absent, F.lit(1.0)).otherwise(inverse_rate(found)),
        })
        .drop("__rate")
    )


@dataclass(frozen=True)
class CustomerMaps:
    """Customer maps by ``customer|organisation|channel|division`` or by code."""

    sales_group: DataFrame
    sales_group_text: DataFrame
    type_code: DataFrame
    type_level3: DataFrame
    type_text: DataFrame
    type_level3_text: DataFrame
    names: DataFrame


@dataclass(frozen=True)
class FactTables:
    """Tables an order, delivery or invoice fact is enriched with.

    ``notes`` has one row per delivery note, see `deliveries.note_texts`; ``terms`` and
    ``payment_texts`` are the payment terms and the texts of their types.
    """

    partners: DataFrame
    conditions: DataFrame
    market_rules: DataFrame
    product_lines: DataFrame
    company_currency: DataFrame
    yearly_rates: DataFrame
    costs: Mapping[str, DataFrame] = field(default_factory=dict)
    customers: CustomerMaps | None = None
    block_events: DataFrame | None = None
    notes: DataFrame | None = None
    terms: DataFrame | None = None
    payment_texts: DataFrame | None = None

    @property
    def names(self) -> DataFrame | None:
        return None if self.customers is None else self.customers.names


CUSTOMER_TYPES = ["customer_type_code", "customer_type_code_lev3", "customer_type_descr"]


def customer_table(maps: CustomerMaps) -> DataFrame:
    """All that is known under a customer key, one row per key: the maps stacked, their texts looked up once here."""
    sides = {"customer_type_code": maps.type_code, "customer_type_code_lev3": maps.type_level3, "__group": maps.sales_group}
    stacked = union_all([side.toDF("__customer", name).withColumn("__kind", F.lit(name)) for name, side in sides.items()])
    twice = F.concat(F.lit("customer map: key occurs more than once: "), F.col("__customer"))

    def value(name: str) -> Column:
        rows = F.count_if(F.col("__kind") == name)
        return F.when(rows > 1, F.raise_error(twice)).otherwise(F.max(name)).alias(name)

    undefined = F.lit(fixed.NOT_DEFINED)
    return (
        stacked.groupBy("__customer").agg(*map(value, sides))
        .transform(checked_lookup, maps.type_level3_text, "customer_type_code_lev3", "__level3", undefined, "level text")
        .transform(checked_lookup, maps.type_text, "customer_type_code", "__type", undefined, "type text")
        .transform(checked_lookup, maps.sales_group_text, "__group", "sales_group", None, "sales group")
        .withColumn("customer_type_descr", strict_key("-", "__level3", "__type"))
        .select("__customer", *CUSTOMER_TYPES, "sales_group")
    )


def with_customers(df: DataFrame, maps: CustomerMaps) -> DataFrame:
    """Customer types of the invoiced and the receiving customer, and the sales group of the latter: one join each.

    Names of partners come with `with_partners`, where their codes are rows.
    """
    nothing = F.lit(f"{fixed.NOT_DEFINED}-{fixed.NOT_DEFINED}")
    known, out = customer_table(maps), df
    for source, role, more in (("inv_id", "", []), ("dest_id", "dest_", ["sales_group"])):
        side = known.select("__customer", *[F.col(c).alias(role + c) for c in CUSTOMER_TYPES], *more)
        key = make_key("|", source, "sales_organization", "distr_channel", "division")
        descr = f"{role}customer_type_descr"
        out = spread_join(out, side, {"__customer": key}).withColumn(
            descr, F.when(F.col("__customer").isNull(), nothing).otherwise(F.col(descr))).drop("__customer")
    return out


def with_blocks(df: DataFrame, t: FactTables) -> DataFrame:
    """The last block and unblock of an order, where their table is given."""
    return df if t.block_events is None else df.join(t.block_events, ["order_number"], "left")


def with_context(df: DataFrame, t: FactTables) -> DataFrame:
    """Customer texts and the last block and unblock, where their tables are given; blocks not again where they are there."""
    if t.customers is not None:
        df = with_customers(df, t.customers)
    return df if "order_blocking_user" in df.columns else with_blocks(df, t)


def order_measures(df: DataFrame, as_of: str) -> DataFrame:
    """All measures of the order fact."""
    return (
        df.transform(m.order_values)
        .transform(m.order_prices)
        .transform(m.cost_price, "ord")
        .transform(m.transfer_price, "ord")
        .transform(m.euro_values, "ord")
        .transform(m.margins, "ord")
        .transform(m.potential_copies, "ord")
        .transform(m.backlog_copies, as_of)
        .transform(m.status_copies)
    )


FACT_GRAIN = ["order_number", "order_line", "order_status", "schedule_line",
              "allocation_warehouse", "confirmed_date", "confirmed_time",
              "planned_dispatch_date"]


def order_fact(
    status: DataFrame, headers: DataFrame, items: DataFrame, schedule: DataFrame,
    t: FactTables, as_of: str,
) -> DataFrame:
    """The order fact: one row per order line and status.

    The key names the line and its status; confirmed rows add what makes them
    one row per schedule line. Status rows are distinct and every table joined to
    them has one row per key, so the wide rows need no distinct of their own. ``status`` may be by line,
    so that a line is joined once for all of its statuses. All that is known by order and line is joined while it
    lies by these, all that is known of the order comes through its header. Prices are joined last: their many amounts are not shuffled for any other join.
    """
    line = ["order_number", "order_line"]
    first = first_date(schedule.select(_order(), _line(), "edatu"), line, "edatu", "first_req_del_date")
    consignment = F.col("order_type_code").isin(fixed.CONSIGNMENT_TYPES)
    heads = headers.transform(with_blocks, t).transform(document_partners, t.partners, names=t.names)
    lines = status.join(first, line, "left").transform(item_partners, t.partners, names=t.names)
    base = (
        enrich_orders(lines, heads, items)
        .transform(exclude_values, "sales_organization", fixed.EXCLUDED_COMPANIES)
        .transform(without_services)
        .transform(market_of, t.market_rules, t.product_lines)
        .transform(with_partners, t.partners, names=t.names)
        .withColumns({
            "mrdd": F.col("requested_delivery_date"),
            "price_key": F.when(~consignment, make_key("|", "knumv", "order_line")),
        })
        .transform(with_currency, t.company_currency, t.yearly_rates, "document_date_original")
    )
    return (
        with_unit_costs(with_context(base, t), t.costs, span_around(as_of))
        .join(prices(t.conditions, open_conditions("ord")), ["price_key"], "left")
        .transform(each_status)
        .transform(m.order_quantities)
        .withColumns({
            "potential_status": F.when(F.col("order_status").isin("Blocked", "In Picking"),
                                       F.col("order_status")).otherwise(F.lit("Not Blocked")),
            "booking_slot": F.coalesce("booking_slot_delivery", "booking_slot_item"),
        })
        .transform(order_measures, as_of)
        .withColumn("key_fact", make_key("###", F.lit("ORDER"), *FACT_GRAIN))
    )
