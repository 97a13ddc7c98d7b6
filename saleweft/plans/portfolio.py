"""The portfolio report: orders by month bucket, budget, deliveries, invoices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.dates import day, day_from_parts, month_after, serial_day
from ..functions.text import make_key, strict_key
from ..operators.aggregate import month_offset_sums, rollup_report, sum_by
from ..operators.filters import any_nonzero, division_gate, report_gate
from ..operators.lookup import checked_lookup, unique_join
from ..operators.sets import union_all
from .measures import conditional_copies

VALUES = ["qty", "nsv_eur", "gsv_eur", "gm_tp_eur", "gm_cp_eur"]
ORDER_MONTHS = 5
BUDGET_MONTHS = 4
UNIT = ["company", "network", "sales_organization", "sales_office", "product_code"]


def typed_rows(
    fact: DataFrame, product_types: DataFrame, prefix: str, scale: int
) -> DataFrame:
    """Fact rows that enter the report.

    Measures are rounded by a decimal cast; a row counts when one of them is not
    zero, its network is not left out and its product has a type.
    """
    decimals = {f"{prefix}_{v}": F.col(f"{prefix}_{v}").cast(f"decimal(18,{scale})")
                for v in VALUES}
    return (
        division_gate(fact).withColumns(decimals)
        .transform(any_nonzero, list(decimals))
        .join(product_types, ["product_code"], "left")
        .transform(report_gate)
    )


def in_month(df: DataFrame, date: str, as_of: str) -> DataFrame:
    """Rows of the month of a day, by a range of dates that reaches the scan."""
    first = F.trunc(day(as_of), "MM")
    return df.where((F.col(date) >= first) & (F.col(date) < F.add_months(first, 1)))


def report_columns(df: DataFrame, source: str, date: str) -> DataFrame:
    """Columns that all three facts share in the report."""
    erp = F.col("flag_erp") == 1
    return df.withColumns({
        "year": F.year(date), "month": F.month(date),
        "order_source": F.when(erp, F.lit("SAP")).otherwise(F.lit("DWH")),
        "first_req_del_date": F.when(erp, F.col("first_req_del_date"))
        .otherwise(F.col("requested_delivery_date")),
        "order_requested_delivery_date": F.col("requested_delivery_date"),
        "requested_year_month": F.date_format("requested_delivery_date", "MMM yyyy"),
        "purchase_group": make_key(" ", "purchase_group_code", "purchase_group_descr"),
        "record_source": F.lit(source),
    })


def order_buckets(
    df: DataFrame, as_of: str, date: str = "first_req_del_date", of: Column | None = None
) -> DataFrame:
    """Order measures by month asked for, as ``ord_qty`` and ``ord_qty_m<n>``.

    A bucket runs from the first of its month to the first of the next; the
    current one also holds everything before it. Rows that are not ``of`` the orders have null
    in all of them. A report that has the day asked for among its keys is dealt into
    buckets after it is summed, so that six times the measures are never grouped.
    """
    starts = [month_after(as_of, i) for i in range(1, ORDER_MONTHS + 2)]
    asked = F.col(date)
    inside = {"": asked < starts[0]}
    inside.update({f"_m{i + 1}": (asked >= starts[i]) & (asked < starts[i + 1])
                   for i in range(ORDER_MONTHS)})
    base = [f"ord_{v}" for v in VALUES]
    renamed = df.withColumnsRenamed({b: f"__{b}" for b in base})
    zero = F.lit(0).cast("decimal(18,4)")
    if of is not None:
        zero = F.when(of, zero)
        inside = {suffix: condition & of for suffix, condition in inside.items()}
    return conditional_copies(renamed, {
        f"{b}{suffix}": (f"__{b}", condition)
        for suffix, condition in inside.items() for b in base
    }, zero).drop(*[f"__{b}" for b in base])


def budget_rows(budget: DataFrame, networks: DataFrame, as_of: str) -> DataFrame:
    """Budget of this month and the next three, per unit and product."""
    monthly = sum_by(
        budget.withColumn("time_id", day_from_parts("year", "month", F.lit(1))),
        [*UNIT, "time_id"], ["qty_sold", "budget_nsv_eur"])
    wide = month_offset_sums(monthly, UNIT, "time_id", ["qty_sold", "budget_nsv_eur"], as_of,
                             BUDGET_MONTHS)
    names = {f"{old}_{i}": f"{new}{'' if i == 0 else f'_m{i}'}"
             for old, new in (("qty_sold", "bdg_qty"), ("budget_nsv_eur", "bdg_nsv_eur"))
             for i in range(BUDGET_MONTHS)}
    left_out = F.col("network").try_cast("int").isin(fixed.EXCLUDED_NETWORKS)
    return (
        wide.where(~left_out).withColumnsRenamed(names)
        .transform(unique_join, networks, ["company", "network"], "budget networks")
        .withColumns({"year": F.year(day(as_of)), "month": F.month(day(as_of)),
                      "record_source": F.lit("BUD")})
    )


SOURCES = {"inv": "INV", "del": "DEL", "ord": "ORD"}
BUDGETS = [f"bdg_{v}{m}" for m in ("", "_m1", "_m2", "_m3") for v in ("qty", "nsv_eur")]
SUMS = [
    *[f"{p}_{v}" for p in ("inv", "del", "ord") for v in VALUES],
    *BUDGETS,
    *[f"ord_{v}_m{i}" for i in range(1, ORDER_MONTHS + 1) for v in VALUES],
]


def report_keys(columns: Sequence[str]) -> Mapping[str, Column]:
    """Key expressions of the report for the columns that are there."""
    keys = {c: F.col(c) for c in columns}
    keys["month"] = F.date_format(F.make_date("year", "month", F.lit(1)), "MMM")
    if "super_group_code" in keys and "super_group_descr" in keys:
        keys.pop("super_group_descr")
        keys["super_group"] = strict_key(" - ", "super_group_code", "super_group_descr")
    return keys


def with_report_texts(rolled: DataFrame, names: DataFrame, order_types: DataFrame, markets: DataFrame) -> DataFrame:
    """Names of the codes of a rolled-up report, so that its texts are never shuffled with the facts.

    ``names`` and ``order_types`` are two-column maps, ``markets`` has the responsibles of
    a company and network. Codes that are numbers become numbers, the day asked for also
    a day number. The director is shown by name alone, so directors of one name are one row.
    What no lookup reads is carried as one value.
    """
    texts = {
        "main_group_descr": ("main_group_code", names), "sale_zone": ("sale_zone_code", names),
        "salesman": ("salesman_code", names), "sale_director": ("sale_director_code", names),
        "rsm": ("rsm_code", names), "order_type": ("order_type_code", order_types),
    }
    sums = [s for s in [*SUMS, *VALUES] if s in rolled.columns]
    read = [*[code for code, _ in texts.values()], "company", "network", "main_group_code", "first_req_del_date"]
    carried = [c for c in rolled.columns if c not in read and c not in sums]
    out = rolled.select(*dict.fromkeys(read), F.struct(*carried).alias("__carried"), *sums)
    for text, (code, mapping) in texts.items():
        out = checked_lookup(out, mapping, code, text, None, text)
    out = unique_join(out, markets, ["company", "network"], "network markets").withColumnsRenamed(fixed.MARKET_NAMES)
    out = out.withColumns({
        "main_group": strict_key(" - ", "main_group_code", "main_group_descr"),
        "salesman_code": F.col("salesman_code").try_cast("double"), "rsm_code": F.col("rsm_code").try_cast("double"),
        "first_req_del_date_num": serial_day("first_req_del_date"),
        "comm_organization_id": F.lit(None).cast("int"),
    }).drop("main_group_descr", "sale_director_code")
    report = rollup_report(out, {c: F.col(c) for c in out.columns if c not in sums}, sums)
    return report.select(*[F.col("__carried").getField(c).alias(c) for c in carried],
                         *[c for c in report.columns if c != "__carried"])


def portfolio(
    orders: DataFrame, budget: DataFrame, deliveries: DataFrame, invoices: DataFrame,
    keys: Sequence[str], as_of: str,
) -> DataFrame:
    """Roll the rows of the current month up to the report keys.

    ``record_source`` has to be among them, so that the rows of a source meet no others: each source
    is summed by itself, its own measures only, and then stacked. A source has its measures in the
    same columns as the others (``VALUES``), see `measures_by_source`.
    """
    if "record_source" not in keys:
        raise ValueError("record_source has to be a key of the report")
    today = day(as_of)
    sources = {"ord": orders, "bdg": budget, "del": deliveries, "inv": invoices}
    types = {f.name: f.dataType for df in sources.values() for f in df.schema.fields if f.name in keys}
    rolled = []
    for prefix, df in sources.items():
        own = BUDGETS if prefix == "bdg" else [f"{prefix}_{v}" for v in VALUES]
        current = df.where((F.col("year") == F.year(today)) & (F.col("month") == F.month(today)))
        full = current.withColumns({k: F.lit(None).cast(kind) for k, kind in types.items() if k not in df.columns})
        rolled.append(rollup_report(full, report_keys(keys), own).withColumnsRenamed(
            {f"{prefix}_{v}": v for v in VALUES} if prefix in SOURCES else {}))
    return union_all(rolled)


def measures_by_source(report: DataFrame, as_of: str) -> DataFrame:
    """Each source's measures under their own names, those of the orders by month asked for."""
    source = F.col("record_source")
    own = report.withColumns({
        f"{prefix}_{v}": F.when(source == tag, F.col(v)) for prefix, tag in SOURCES.items() for v in VALUES}).drop(*VALUES)
    return order_buckets(own, as_of, of=source == SOURCES["ord"])
