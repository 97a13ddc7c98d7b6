"""Embedding whitening with eigenvectors refined in extended precision.

Entries become whole numbers, so the covariance of the distinct vectors can be exact:
each task adds up products of centred whole numbers, cut into limbs that float64
matrix products hold without rounding, and the sums meet in Spark entry by entry. Only
the covariance, whose size depends on the dimension alone, comes to the driver.

Its eigenvectors are computed in float32 and corrected by the iteration of Ogita and
Aishima: with R = I - X'X and S = X'AX, the correction E takes (S + l R) / (l - l')
where two eigenvalues differ by more than their uncertainty, and R / 2 where they do
not; X becomes X + X E. All its products run in extended precision. Eigenvalues that
stay too close are a cluster: the covariance, shifted by the cluster's mean and
projected on its subspace, is a small problem of its own scale, solved the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import settle

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
BLOCK_ROWS = 4096
"""Limbs have 20 bits: a product has 40, and a sum of 4096 of them 52, which float64 holds."""
_LIMB, _PART = 20, 60
_LARGEST = float(1 << 62)
_STEPS = 12


def whole_entries(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * entry) + shift as longs. Products beyond 2**62 are taken as 2**62."""
    def whole(c: Column) -> Column:
        scaled = c.cast("double") * F.lit(float(scale))
        return F.floor(F.least(F.greatest(scaled, F.lit(-_LARGEST)), F.lit(_LARGEST))).cast("long") + F.lit(shift)

    return F.transform(vector, whole)


def finite(vector: Column) -> Column:
    """Whether a vector is there, has an entry, and all its entries are finite numbers."""
    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))

    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, usable)


def exact_products(centred: np.ndarray) -> np.ndarray:
    """The sums of products of every two columns of whole numbers, as Python integers.

    ``centred`` has at most ``BLOCK_ROWS`` rows, of any integer size.
    """
    limbs, rest = [], np.abs(centred)
    sign = np.sign(centred)
    while rest.any():
        limbs.append((sign * (rest & ((1 << _LIMB) - 1))).astype(np.float64))
        rest = rest >> _LIMB
    total = np.zeros((centred.shape[1],) * 2, object)
    for j, a in enumerate(limbs):
        for k, b in enumerate(limbs):
            product = (a.T @ b).astype(np.int64).astype(object)
            total = total + product * (1 << _LIMB * (j + k))
    return total


def _blocks(batch: pa.RecordBatch, column: str) -> Iterator[np.ndarray]:
    """The vectors of a batch, of one length, as rows of a matrix."""
    lists = batch.column(batch.schema.get_field_index(column))
    for at in range(0, len(lists), BLOCK_ROWS):
        part = lists.slice(at, BLOCK_ROWS)
        if len(part):
            yield part.flatten().to_numpy().reshape(len(part), -1)


def _minus(x: np.ndarray, base: np.ndarray, times: int = 1) -> np.ndarray:
    """``times * x - base`` without overflow; as Python integers where 64 bits do not do."""
    largest = max(times * int(np.abs(x).max(initial=0)), max(map(abs, base.tolist()), default=0))
    if largest < 1 << 61:
        return times * x - base.astype(np.int64)
    return times * x.astype(object) - base.astype(object)


def _column_sums(block: np.ndarray) -> np.ndarray:
    """Exact sums of the columns of whole numbers."""
    small = int(np.abs(block).max(initial=0)) < 1 << 48
    return (block if small else block.astype(object)).sum(axis=0).astype(object)


def _added(df: DataFrame, keys: list[str], column: str, entries: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, ...], int]:
    """Exact sums by key over all rows: each task adds up its own, Spark adds the tasks'.

    ``entries`` gives a block's whole numbers as a vector or matrix; its indices are the
    keys. Numbers travel as parts of 60 bits, so that sums of any size stay exact.
    """
    names = [*keys, "part", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in _blocks(batch, column):
                here = entries(block)
                total = here if total is None else total + here
        if total is None:
            return
        rows = []
        for at in np.ndindex(total.shape):
            if list(at) != sorted(at):
                continue  # a product matrix is symmetric
            left, sign, part = abs(int(total[at])), 1 if total[at] >= 0 else -1, 0
            while left or part == 0:
                rows.append((*at, part, sign * (left & ((1 << _PART) - 1))))
                left, part = left >> _PART, part + 1
        yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*rows)], names=names)

    found = df.select(column).mapInArrow(run, ", ".join(f"{n} long" for n in names))
    sums = found.groupBy(*keys, "part").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out: dict[tuple[int, ...], int] = {}
    for r in sums.collect():
        key = tuple(r[k] for k in keys)
        out[key] = out.get(key, 0) + (int(r.value) << _PART * r.part)
    return out


def extended(value: Fraction) -> np.longdouble:
    """A fraction in extended precision."""
    if value == 0:
        return np.longdouble(0)
    up = 64 - (abs(value.numerator).bit_length() - value.denominator.bit_length())
    whole = abs(value.numerator) << up if up >= 0 else abs(value.numerator)
    q = whole // (value.denominator if up >= 0 else value.denominator << -up)
    high, low = q >> 32, q & 0xFFFFFFFF
    out = np.ldexp(np.longdouble(high), 32) + np.longdouble(low)
    return np.ldexp(out if value > 0 else -out, -up)


def _product(*factors: np.ndarray) -> np.ndarray:
    out = factors[0]
    for f in factors[1:]:
        out = out @ f
    return out


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, eigenvectors and the uncertainty below which eigenvalues count as equal.

    The Ogita-Aishima iteration from approximate eigenvectors ``x`` of a symmetric ``a``.
    It stops when a correction no longer gets smaller.
    """
    eye, last = np.eye(len(a), dtype=a.dtype), np.inf
    norm = np.sqrt((a * a).sum())
    while True:
        r, s = eye - _product(x.T, x), _product(x.T, a, x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        doubt = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > doubt
        e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
        size = float(np.abs(e).max(initial=0))
        if not size < last / 2:
            return values, x, float(doubt)
        x, last = x + _product(x, e), size


def eigenvectors(a: np.ndarray, least: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix in extended precision.

    Eigenvalues that the iteration cannot tell apart, or only by less than 1e-5 of the
    largest, are solved as a problem of their own; below ``least`` no difference is left.
    """
    n = len(a)
    eye = np.eye(n, dtype=a.dtype)
    scale = np.abs(a).max(initial=0)
    if least is None:
        least = float(np.finfo(a.dtype).eps * n * scale)
    if n < 2 or scale <= least:
        return np.diag(a).copy(), eye
    start = np.linalg.eigh((a / scale).astype(np.float32))[1].astype(a.dtype)
    values, x, doubt = refined(a, start)
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    close = -np.diff(values) <= max(doubt, 1e-5 * float(np.abs(values).max()))
    edges = np.flatnonzero(~close) + 1
    for part in np.split(np.arange(n), edges):
        if len(part) < 2:
            continue
        v = _orthonormal(x[:, part])
        inner = _product(v.T, a, v)
        middle = np.trace(inner) / len(part)
        inner = (inner + inner.T) / 2 - middle * np.eye(len(part), dtype=a.dtype)
        if len(part) == n and float(np.abs(inner).max()) > 0.5 * float(scale):
            continue  # the shift brings nothing new
        x[:, part] = _product(v, eigenvectors(inner, least)[1])
    x = _orthonormal(x)
    values = np.einsum("ij,ij->j", x, _product(a, x))
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """The nearest orthonormal columns, by steps X (I + R / 2), R = I - X'X."""
    eye = np.eye(x.shape[1], dtype=x.dtype)
    for _ in range(_STEPS):
        r = eye - _product(x.T, x)
        x = x + _product(x, r) / 2
        if np.abs(r).max(initial=0) < 4 * np.finfo(x.dtype).eps:
            break
    return x


@dataclass
class Whitening:
    """What is learnt from the distinct vectors: counts, sums, and the leading components."""

    n: int
    sums: np.ndarray  # Python integers
    values: np.ndarray  # eigenvalues of all components, falling
    axes: np.ndarray  # unit eigenvectors as columns, the leading ones, float64
    trace: np.longdouble

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Centred rows on the components, each over the root of its eigenvalue; NaN where that is zero."""
        centred = _minus(x, self.sums, self.n).astype(np.float64) / self.n
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.values > 0, centred @ self.axes / np.sqrt(np.maximum(self.values, 0)), np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None where it needs more than 63 bits."""
        away = _minus(x, self.sums, self.n)
        if away.dtype != object and float(np.abs(away).max(initial=0)) ** 2 * away.shape[1] < 2.0 ** 62:
            return (away * away).sum(axis=1).tolist()
        away = away.astype(object)
        return [v if v < 1 << 63 else None for v in (away * away).sum(axis=1).tolist()]


def fit_whitening(distinct: DataFrame, column: str = "x", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of distinct vectors of whole numbers, all of one length; None without rows."""
    n = distinct.count()
    if n == 0:
        return None
    sums = _added(distinct, ["i"], column, _column_sums)
    dims = len(sums)
    total = np.array([sums[i,] for i in range(dims)], object)
    base = np.array([s // n for s in total], object)
    moments = _added(distinct, ["i", "j"], column, lambda block: exact_products(_minus(block, base)))
    left = total - n * base
    a = np.empty((dims, dims), np.longdouble)
    for (i, j), m in moments.items():
        a[i, j] = a[j, i] = extended(Fraction(n * m - left[i] * left[j], n * n))
    trace = sum(Fraction(n * moments[i, i] - left[i] ** 2, n * n) for i in range(dims))
    values, axes = eigenvectors(a)
    floor = np.finfo(a.dtype).eps * dims * (np.abs(a).max(initial=0))
    values = np.where(values > floor, values, 0)[:components].astype(np.float64)
    axes = axes[:, :components].astype(np.float64)
    # either sign will do; the largest entry is made positive
    lead = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return Whitening(n, total, values, axes * np.where(lead < 0, -1.0, 1.0), extended(trace))


def identity_error(distinct: DataFrame, model: Whitening, column: str = "x") -> float | None:
    """The largest entry by which the covariance of the whitened distinct vectors misses the identity."""
    kept = np.flatnonzero(model.values > 0)
    if not len(kept):
        return None
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares, plain = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            for block in _blocks(batch, column):
                w = model.whitened(block)[:, kept]
                squares, plain = squares + w.T @ w, plain + w.sum(axis=0)
        table = np.vstack([squares, plain])
        i, j = np.indices(table.shape)
        yield pa.record_batch([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(table.ravel())], names=["i", "j", "value"])

    found = distinct.select(column).mapInArrow(run, "i long, j long, value double")
    table = np.zeros((width + 1, width))
    for r in found.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        table[r.i, r.j] = r.value
    mean = table[-1] / model.n
    return float(np.abs(table[:-1] / model.n - np.outer(mean, mean) - np.eye(width)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable input row and component, numbered from 1 by falling eigenvalue.

    ``vec_id, component, n, deviation, whitened, explained, identity_error``. Entries are
    made whole numbers floor(scale * entry) + shift; the whitening is fitted on the
    distinct vectors, so copies weigh nothing, and applied to every row.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out,
    and so are vectors whose length is not the most frequent one (of equally frequent, the
    longest). Rows that repeat an id stay, a null id stays null. A component without
    variance, such as all of a table of one distinct vector, gives null ``whitened``;
    ``explained`` is null where no component has variance. ``deviation`` is null where it
    needs more than 63 bits. Other columns are not read. An empty table gives an empty table.
    """
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(finite(F.col("v")))
    rows = rows.select("vec_id", whole_entries(F.col("v"), scale, shift).alias("x"))
    distinct = settle(rows.select("x").distinct(), "distinct-vectors")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows, distinct = (df.where(F.size("x") == length.d) for df in (rows, distinct))
    model = fit_whitening(distinct, "x", components)
    error = identity_error(distinct, model)
    width = model.axes.shape[1]
    shares = [float(np.longdouble(v) / model.trace) if model.trace > 0 else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in _blocks(batch, "x"):
                ids = batch.column(0).slice(at, len(block))
                at += len(block)
                each = np.repeat(np.arange(len(block)), width)
                whitened = model.whitened(block).ravel()
                columns = [
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(block))),
                    pa.array(np.full(len(each), model.n)), pa.array(model.deviation(block), pa.int64()).take(pa.array(each)),
                    pa.array(whitened, mask=np.isnan(whitened)), pa.array(shares * len(block), pa.float64()),
                    pa.array([error] * len(each), pa.float64())]
                yield pa.record_batch(columns, names=[f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(run, schema)
