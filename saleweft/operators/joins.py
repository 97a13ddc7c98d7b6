"""Joins beyond the lookup.

No join forces a broadcast: sides are broadcast when Spark measures them as
small enough, otherwise both are shuffled by key and adaptive execution splits
hot keys. Where a group is known to be hot, `salted_join` spreads it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fixed
from ..functions.nulls import as_column, is_blank
from ..session import settle
from .columns import quoted
from .lookup import ONCE, checked_lookup, held, spread_join, unique_join, unique_rows, unique_values


def salted_join(
    df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "left", salts: int = 16
) -> DataFrame:
    """Join with the rows of one key spread over several tasks.

    Every row of ``df`` gets a salt from its own content, so a retried task gives
    the same salt; ``other`` is repeated once per salt. Use it where ``other`` is
    small per key and ``df`` holds hot keys. Inner, left, semi and anti joins.
    """
    if how not in {"inner", "left", "leftsemi", "leftanti"}:
        raise ValueError(f"cannot spread a {how} join")
    salt = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(salts)).cast("int")
    repeated = other.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("__salt", salt).join(repeated, [*on, "__salt"], how).drop("__salt")


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in the set."""
    return df.join(keys.select(*on), list(on), "leftsemi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the set."""
    return df.join(keys.select(*on), list(on), "leftanti")


def semi_on_expr(df: DataFrame, other: DataFrame, expr: Column, column: str) -> DataFrame:
    """Rows for which an expression occurs in a column of another frame."""
    values = other.select(quoted(column).alias("__wanted"))
    return df.join(values, expr == F.col("__wanted"), "leftsemi")


def with_needed_keys(history: DataFrame, needed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History plus the keys that facts ask for, ahead of a gap fill."""
    return history.join(needed.select(*keys).distinct(), list(keys), "full")


def latest_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """All rows that carry the newest value of a column within their key; none without a key or a value.

    Each task drops what its own rows already overtake before anything is shuffled. For keys
    that a calendar bounds, ``latest_per_period`` shuffles nothing.
    """
    newest = Window.partitionBy(*map(quoted, keys)).orderBy(quoted(column).desc())
    present = reduce(and_, [quoted(c).isNotNull() for c in [*keys, column]])
    return df.where(present).withColumn("__rank", F.rank().over(newest)).where("__rank = 1").drop("__rank")


def period_map(df: DataFrame, keys: Sequence[str], value: Column) -> Column:
    """An aggregate per period, looked up by a row's own period: a map in a scalar subquery.

    Only for keys that a calendar bounds (years, months, quarters): the map is one value.
    Rows with a null in their keys find nothing. The frame is neither joined nor shuffled.
    """
    period = F.struct(*map(quoted, keys))
    present = reduce(and_, [quoted(k).isNotNull() for k in keys])
    grouped = df.where(present).groupBy(*map(quoted, keys)).agg(value.alias("__value"))
    entries = F.collect_list(F.struct(period.alias("key"), F.col("__value").alias("value")))
    return grouped.agg(F.map_from_entries(entries).alias("periods")).scalar()[period]


def latest_per_period(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Like ``latest_per_key`` for keys that a calendar bounds: a comparison with one looked-up value."""
    return df.where(quoted(column) == period_map(df, keys, F.max(quoted(column))))


def latest_global(df: DataFrame, column: str) -> DataFrame:
    """All rows that carry the newest value of a column in the whole frame."""
    return df.join(df.agg(F.max(column).alias(column)), [column], "leftsemi")


def partial_match(
    df: DataFrame,
    rules: DataFrame,
    on: Mapping[str, str],
    optional: tuple[str, str],
) -> DataFrame:
    """Left join to rules whose last key may be null and then fits everything.

    ``on`` maps columns of the frame to rule columns; ``optional`` is the pair
    for the last key. The rule keys are dropped. Rules must be unique per key.
    """
    mine, theirs = optional
    rule_keys = [*on.values(), theirs]
    values = [c for c in rules.columns if c not in rule_keys]
    table = unique_values(rules, rule_keys, values, "rules").select(
        *[quoted(c).alias(f"__rule_{c}") for c in rule_keys],
        *[F.col("__kept")[v].alias(v) for v in values], ONCE)
    equal = reduce(and_, [as_column(a) == F.col(f"__rule_{b}") for a, b in on.items()])
    last = F.col(f"__rule_{theirs}")
    joined = held(df.join(table, equal & (last.isNull() | (F.col(mine) == last)), "left"))
    return joined.drop(*[f"__rule_{c}" for c in rule_keys])


def days_of_intervals(intervals: DataFrame, start: str, end: str, *values: str) -> DataFrame:
    """One row per day of each closed interval: a day map for an equi-join.

    Its size is bounded by the calendar, so no range join is needed.
    """
    days = F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day")))
    return intervals.where(F.col(start) <= F.col(end)).select(days.alias("day"), *values)


def interval_lookup(
    df: DataFrame, date: str, intervals: DataFrame, start: str, end: str, value: str, dest: str
) -> DataFrame:
    """Value of the interval a date lies in, null outside of all of them.

    Intervals must not overlap; an overlap fails the job.
    """
    days = unique_values(days_of_intervals(intervals, start, end, value), ["day"], [value],
                         "overlapping intervals")
    hits = days.select(F.col("day").alias("__day"), F.col("__kept")[value].alias(dest), ONCE)
    return held(spread_join(df, hits, {"__day": F.col(date)})).drop("__day")


def drop_superseded(
    bulk: DataFrame, delta: DataFrame, keys: Sequence[str], date: str
) -> DataFrame:
    """Drop bulk rows dated up to the last delta of their key."""
    names = [f"__key_{i}" for i in range(len(keys))]
    last = delta.groupBy(*keys).agg(F.max(date).alias("__last")).toDF(*names, "__last")
    return spread_join(bulk, last, {n: F.col(k) for k, n in zip(keys, names)}, "leftanti",
                       extra=F.col(date) <= F.col("__last"))


def date_spine(df: DataFrame, dimension: str, start: Column, end: Column, name: str) -> DataFrame:
    """Every day of a span for each distinct member of a dimension."""
    days = F.explode(F.sequence(start, end, F.expr("interval 1 day")))
    return df.select(dimension).distinct().select(dimension, days.alias(name))


def role_partners(
    partners: DataFrame, roles: Mapping[str, str], role: str, value: Column, keys: Sequence[str]
) -> DataFrame:
    """One row per key with one column per role, in a single pass.

    A role that occurs twice under one key fails the job.
    """
    columns = []
    for name, code in roles.items():
        hit = F.col(role) == code
        twice = F.concat_ws(" ", F.lit(f"partner role {code} occurs more than once:"),
                            *[F.col(k) for k in keys])
        columns.append(
            F.when(F.count(F.when(hit, 1)) > 1, F.raise_error(twice))
            .otherwise(F.max(F.when(hit, value))).alias(name)
        )
    wanted = partners.where(F.col(role).isin(list(roles.values())))
    return wanted.groupBy(*keys).agg(*columns)


def _partner_level(
    partners: DataFrame, keys: Mapping[str, str], prefix: str, roles: Mapping[str, str],
    targets: Mapping[str, tuple[str, bool]], names: DataFrame | None, named: Mapping[str, str],
) -> DataFrame:
    """One row per key with a struct of code and name per role; roles whose name nobody asks for carry none."""
    if names is not None:
        partners = checked_lookup(partners, names, "kunnr", "__name", None, "customer name")
    asked = [roles[r] for target, (r, _) in targets.items() if target in named and r in roles]
    name = F.when(F.col("parvw").isin(asked), F.col("__name")) if names is not None else F.lit(None)
    one = F.struct(F.col("kunnr").alias("code"), name.alias("name"))
    return role_partners(partners, roles, "parvw", one, list(keys)).select(
        *[F.col(old).alias(new) for old, new in keys.items()], *[F.col(r).alias(prefix + r) for r in roles])


def _to_level(df: DataFrame, side: DataFrame, pairs: Mapping[str, Column], spread: bool) -> DataFrame:
    if spread:
        return spread_join(df, side, pairs).drop(*pairs)
    return df.join(side, reduce(and_, [key == F.col(c) for c, key in pairs.items()]), "left").drop(*pairs)


def item_partners(
    df: DataFrame, partners: DataFrame, document: str = "order_number", item: str = "order_line",
    roles: Mapping[str, str] = fixed.PARTNER_ROLES, targets: Mapping[str, tuple[str, bool]] = fixed.PARTNER_TARGETS,
    names: DataFrame | None = None, named: Mapping[str, str] = fixed.PARTNER_NAMES, spread: bool = False,
) -> DataFrame:
    """The partners of an item, for `with_partners`. Without ``spread`` rows that lie by document and item are not shuffled.

    Rows of the document itself are left out: they are what an item falls back to.
    """
    of_items = partners.where(~F.col("posnr").eqNullSafe(F.lit(fixed.HEADER_ITEM)))
    side = _partner_level(of_items, {"vbeln": "__document", "posnr": "__line"}, "__item_", roles, targets, names, named)
    return _to_level(df, side, {"__document": F.col(document), "__line": F.col(item)}, spread)


def document_partners(
    df: DataFrame, partners: DataFrame, document: str = "order_number",
    roles: Mapping[str, str] = fixed.PARTNER_ROLES, targets: Mapping[str, tuple[str, bool]] = fixed.PARTNER_TARGETS,
    names: DataFrame | None = None, named: Mapping[str, str] = fixed.PARTNER_NAMES, spread: bool = False,
) -> DataFrame:
    """The partners of a document, for `with_partners`; best joined where there is one row per document."""
    of_document = partners.where(F.col("posnr") == fixed.HEADER_ITEM)
    side = _partner_level(of_document, {"vbeln": "__document"}, "__doc_", roles, targets, names, named)
    return _to_level(df, side, {"__document": F.col(document)}, spread)


def with_partners(
    df: DataFrame,
    partners: DataFrame,
    document: str = "order_number",
    item: str = "order_line",
    roles: Mapping[str, str] = fixed.PARTNER_ROLES,
    targets: Mapping[str, tuple[str, bool]] = fixed.PARTNER_TARGETS,
    names: DataFrame | None = None,
    named: Mapping[str, str] = fixed.PARTNER_NAMES,
) -> DataFrame:
    """Add one customer per role: that of the item, else that of the document.

    Two joins serve all roles. For some roles a blank at item level also gives
    way to the document. With ``names`` (customer, name) the targets listed in ``named`` get
    their name as well: codes are rows of ``partners``, so one join there names all roles.
    A level that is there already, see `item_partners` and `document_partners`, is not joined again.
    """
    if not any(c.startswith("__item_") for c in df.columns):
        df = item_partners(df, partners, document, item, roles, targets, names, named, True)
    if not any(c.startswith("__doc_") for c in df.columns):
        df = document_partners(df, partners, document, roles, targets, names, named, True)
    picked = {}
    for target, (r, blank) in targets.items():
        if r not in roles:
            continue
        own, head = F.col(f"__item_{r}"), F.col(f"__doc_{r}")
        absent = is_blank(own["code"]) if blank else own["code"].isNull()
        best = F.when(absent, head).otherwise(own)
        picked[target] = best["code"]
        if names is not None and target in named:
            picked[named[target]] = best["name"]
    return df.withColumns(picked).drop(*[f"__{level}_{r}" for level in ("item", "doc") for r in roles])


def role_lookup(
    df: DataFrame, dimension: DataFrame, keys: Sequence[str], prefix: str
) -> DataFrame:
    """Join a dimension, unique by its keys, once more under a role; its columns take the prefix."""
    renamed = dimension.select([quoted(c).alias(prefix + c) for c in dimension.columns])
    return unique_join(df, renamed, [prefix + k for k in keys], f"{prefix}dimension")


def document_facts(df: DataFrame, document: str, **facts: str) -> DataFrame:
    """One row per document with the greatest value of some columns: all that references to it need.

    Written once, slim; every reference then joins it, and the wide rows are read once.
    """
    return settle(df.groupBy(F.col(document).alias("document")).agg(
        *[F.max(column).alias(name) for name, column in facts.items()]), "documents")


def cancelled_lookup(
    df: DataFrame, document: str = "document_code", reference: str = "cancelled_invoice",
    kind: str = "doc_type_code_orig", documents: DataFrame | None = None,
) -> DataFrame:
    """Documents that cancel another take its document type.

    A document is kept when it cancels none (null or empty reference) or when the
    one it cancels is there. ``documents`` are the `document_facts` with a column ``kind``,
    where they are known already.
    """
    if documents is None:
        documents = df.groupBy(F.col(document).alias("document")).agg(F.max(kind).alias("kind"))
    cancelled = documents.select(F.col("document").alias("__cancelled"), F.col("kind").alias("doc_type_code_cancelled"))
    joined = spread_join(df, cancelled, {"__cancelled": F.col(reference)}, blank=True)
    known = F.col("__cancelled").isNotNull()
    return (
        joined.where((F.coalesce(F.col(reference), F.lit("")) == "") | known)
        .withColumn("flag_cancelled_invoice_valid", F.when(known, F.lit(1)))
        .withColumn("doc_type_code", F.coalesce("doc_type_code_cancelled", kind))
        .drop("__cancelled")
    )


def base_attributes(
    df: DataFrame, key: str, base_key: str, attributes: Mapping[str, str]
) -> DataFrame:
    """Attributes of the row that ``base_key`` points to, under new names. The key has to be unique."""
    base = df.where(quoted(key).isNotNull()).select(
        quoted(key).alias("__base"), *[quoted(a).alias(n) for a, n in attributes.items()])
    base = unique_rows(base, ["__base"], "base rows")
    return held(df.join(base, quoted(base_key) == F.col("__base"), "left")).drop("__base")


def reassemble(
    fact: DataFrame, sides: Mapping[str, DataFrame], key: str = "key_fact", source: str = "source"
) -> DataFrame:
    """A fact of several systems with the dimension side of each row's own system.

    The sides are stacked and joined once by system and key, so a column that
    several sides have is filled for the rows of all of them. A key that repeats in
    a side fails the job.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [side.withColumn(source, F.lit(tag)) for tag, side in sides.items()],
    )
    return unique_join(fact, stacked, [source, key], "dimension sides")


def join_change_log(header: DataFrame, item: DataFrame) -> DataFrame:
    """Change items with user, date and time of their header."""
    return item.join(header, ["objectclas", "objectid", "changenr"], "inner")
