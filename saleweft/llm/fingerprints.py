"""SimHash document fingerprints, and search by permuted block tables.

All of it is column expressions. A text's terms are its shingles; a term votes for or
against each bit with its hash, once for every time it occurs, and the sign of the sum
is the bit. Votes of four bits are counted in the lanes of one number, over runs of
terms short enough for a lane.

A search deals every fingerprint into one table per choice of blocks: two fingerprints
within the radius agree on the blocks of at least one choice, so no match is missed.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bucket_count

_LANE, _LANES = 16, 4
_LANE_MASK = sum(1 << (_LANE * k) for k in range(_LANES))
_LANE_VALUE = (1 << _LANE) - 1
_RUN = (1 << (_LANE - 1)) - 1  # the uppermost lane ends at the sign
_ORDER_ROWS, _ORDER_BUCKETS = 5_000, 10_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def simhash64(text: Column, shingle: int = 2) -> Column:
    """A 64-bit fingerprint as a signed long. Null and texts without words give 0.

    Words are lower-cased runs without white space; a text of fewer words than a shingle
    has one term. Equal texts have equal fingerprints. Texts of any length are counted
    whole.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        last = F.greatest(F.size(w) - shingle, F.lit(0))
        return F.when(F.size(w) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(shingle)])))

    return _let(words, lambda w: _let(hashed(w), _signs))


def _signs(hashes: Column) -> Column:
    """The sign of each bit's votes; 0 where there are no hashes."""
    zero = F.array(*[F.lit(0).cast("long")] * _LANE)
    names = [f"v{k}" for k in range(_LANE)]
    start = F.struct(*[F.lit(0).cast("long").alias(n) for n in names])

    def vote(seen: Column, h: Column) -> Column:
        return F.struct(*[(seen[n] + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANE_MASK).cast("long"))).alias(n)
                          for k, n in enumerate(names)])

    def run(r: Column) -> Column:
        return F.aggregate(F.slice(hashes, r * _RUN + 1, F.lit(_RUN)), start, vote,
                           lambda v: F.array(*[v[n] for n in names]))

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / _RUN).cast("int")), run)

    def bits(counts: Column) -> Column:
        def count(b: Column) -> Column:
            lane = F.floor(b / _LANE).cast("int") * _LANE
            return F.aggregate(counts, F.lit(0).cast("long"), lambda s, c: s + _shifted(
                F.get(c, b % _LANE), lane).bitwiseAND(F.lit(_LANE_VALUE).cast("long")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda f, b: f.bitwiseOR(
            F.when(count(b) * 2 > F.size(hashes), _bit(b)).otherwise(F.lit(0).cast("long"))))

    return F.when(hashes.isNull(), F.lit(0).cast("long")).otherwise(_let(runs, bits))


def _shifted(value: Column, by: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, by)


def _bit(b: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), b)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def _marks_up_to(value: Column, marks: list[float]) -> Column:
    """How many of the ascending marks are at most the value; a step of the root of their number."""
    if not marks:
        return F.lit(0)
    step = max(1, round(len(marks) ** 0.5))
    every = F.array(*[F.lit(m) for m in marks])
    coarse = F.size(F.filter(F.array(*[F.lit(m) for m in marks[::step]]), lambda m: m <= value))
    before = F.greatest(coarse - 1, F.lit(0)) * step
    return before + F.size(F.filter(F.slice(every, before + 1, F.lit(step)), lambda m: m <= value))


def with_next(docs: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Each row with ``next``, a struct of ``columns`` of the row after it in descending order.

    After the last row comes the first. Nulls are last; rows equal in ``order`` are alike.
    Rows are dealt into ranges of the first order column, whose bounds are approximate
    quantiles (at most ``_ORDER_BUCKETS``). A range's last row is followed by the head of the
    next one, and there is one head per range.
    """
    key = order[0]
    buckets = min(bucket_count(docs.count(), _ORDER_ROWS), _ORDER_BUCKETS)
    marks = sorted(set(docs.approxQuantile(key, [k / buckets for k in range(1, buckets)], 0.25 / buckets))) if buckets > 1 else []
    bucket = _marks_up_to(F.col(key), marks)
    dealt = docs.withColumn("__bucket", F.coalesce(bucket, F.lit(0))).withColumn(
        "__order", F.struct(*order))
    down = Window.partitionBy("__bucket").orderBy(F.desc("__order"))
    heads = dealt.groupBy("__bucket").agg(F.max("__order").alias("__head"))
    over = Window.orderBy(F.desc("__bucket"))  # one row per range
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select("__bucket", F.coalesce(F.lead("__head").over(over), F.first("__head").over(whole)).alias("__head"))
    found = docs.withColumn("__order", F.struct(*order)).join(
        F.broadcast(after.select(F.col("__bucket").alias("__after"), "__head")), F.col("__order").eqNullSafe(F.col("__head")))
    found = found.groupBy("__after").agg(F.first(F.struct(*columns)).alias("__next_head"))
    linked = dealt.withColumn("__lead", F.lead(F.struct(*columns)).over(down))
    # rows already lie by range; texts are not broadcast, as nothing bounds their size
    return linked.join(found, F.col("__bucket") == F.col("__after")).withColumn(
        "next", F.coalesce("__lead", "__next_head")).drop("__bucket", "__order", "__lead", "__after", "__next_head")


def block_tables(radius: int, blocks: int) -> list[int]:
    """One mask per choice of ``blocks`` - ``radius`` blocks of the 64 bits."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(masks, blocks - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def near_fingerprints(queries: DataFrame, base: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs ``query``, ``found`` of distinct fingerprints within ``radius`` bits.

    Both frames have a column ``fingerprint``. Each pair is made by the first table that
    both agree on and by no other.
    """
    masks = block_tables(radius, blocks)

    def dealt(df: DataFrame, name: str) -> DataFrame:
        tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col(name).bitwiseAND(F.lit(m).cast("long")).alias("key"))
                           for t, m in enumerate(masks)])
        return df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct().select(
            name, F.inline(tables))

    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(t)) for t, m in enumerate(masks)])
    q, b = dealt(queries, "query").alias("q"), dealt(base, "found").alias("b")
    return q.join(b, (F.col("q.t") == F.col("b.t")) & (F.col("q.key") == F.col("b.key"))
                  & (F.bit_count(differ) <= radius) & (first == F.col("q.t"))).select("query", "found")
