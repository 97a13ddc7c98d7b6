"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are majority votes over word shingles. Distinct fingerprints are dealt
into buckets that share some of their bits. In a bucket they are sorted by Gray
rank, so that neighbours differ in few bits; runs of 16 form leaves and runs of 16
leaves form upper nodes, each with the mask and pattern of the bits all its members
share. A fingerprint is compared with upper nodes first: the differences accumulated
on the shared bits rule out the whole group once they exceed the radius.

Buckets are radius + 1 disjoint bit segments, one of which two fingerprints within the
radius must share, so every link is found; a bucket above ``BUCKET_ROWS`` is split by
radius + 1 segments of its remaining bits, which again loses nothing. After ``_DEPTH``
splits with a radius of 4 a bucket shares over 40 bits, so it has at most some 2**22
distinct fingerprints, whatever the input: that is what one task may have to hold.

Copies collapse before any comparison (a combined aggregate per fingerprint), a
bucket returns links to the smallest member of each of its linked groups, never all
pairs, and nodes whose members are already linked with a fingerprint are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import settle
from .components import connected_components
from .words import (
    bit_counts, find_words, gram_starts, joined, lower_ascii, mix, pack_bits, raw_texts,
    text_chunks, xxh64_spans)

BUCKET_ROWS = 1000
LEAF = 16
_DEPTH = 4


def fingerprint_columns(width: int) -> list[str]:
    return [f"f{k}" for k in range(width)]


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
            width: int = 1) -> DataFrame:
    """``doc_id`` and a fingerprint of 64 * ``width`` bits per row, as signed longs f0, f1, ...

    A-Z is lower-cased, words are runs without ASCII space, shingles are ``shingle``
    words joined by a space, repeats included; a text with fewer words is one
    shingle. A bit is 1 if it is set in over half of the shingles' hashes. The first 64
    bits use XXH64 with seed 42, later ones scramblings of it. Texts without words,
    null texts too, get fingerprint zero.
    """
    names = fingerprint_columns(width)
    schema = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(n, T.LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for part in text_chunks(texts):
                marks = _votes(texts[part], shingle, width)
                ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
                yield pa.record_batch([ids, *[pa.array(m.view(np.int64)) for m in marks]], names=["doc_id", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def with_simhash(docs: DataFrame, out: str, text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``docs`` and its 64-bit fingerprints as signed longs in a column ``out``."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(batch.schema.get_field_index(text_col)))
            marks = [_votes(texts[part], shingle, 1)[0].view(np.int64) for part in text_chunks(texts)]
            column = pa.array(np.concatenate(marks) if marks else np.empty(0, np.int64))
            yield pa.record_batch([*batch.columns, column], names=schema.names)

    return docs.mapInArrow(run, schema)


def shingle_hashes(texts: list[bytes | None], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles, one text after the other, and how many each text has."""
    data, at = joined(texts)
    words = find_words(lower_ascii(data), at)
    # words moved together with one space between them, so that a shingle is one span
    size = words.end - words.start
    step = np.zeros(len(data) + 1, np.int8)
    step[words.start] += 1
    step[words.end + 1] -= 1
    text = words.data[np.cumsum(step[:-1], dtype=np.int8) > 0]
    end = np.cumsum(size + 1) - 1
    start = end - size
    text[end] = 0x20
    starts = gram_starts(words, shingle)
    few = (words.count > 0) & (words.count < shingle)
    first, last = words.first[few], words.first[few] + words.count[few] - 1
    order = np.argsort(np.concatenate([starts, first]), kind="stable")
    begin = np.concatenate([start[starts], start[first]])[order]
    stop = np.concatenate([end[starts + shingle - 1] if len(starts) else starts, end[last]])[order]
    hashes = xxh64_spans(text, begin, stop - begin)
    return hashes, np.where(few, 1, np.maximum(words.count - shingle + 1, 0))


def _votes(texts: list[bytes | None], shingle: int, width: int) -> list[np.ndarray]:
    hashes, count = shingle_hashes(texts, shingle)
    return _marks(hashes, count, width)


def _marks(hashes: np.ndarray, count: np.ndarray, width: int) -> list[np.ndarray]:
    out = []
    for k in range(width):
        h = hashes if k == 0 else mix(hashes + np.uint64(0x9E3779B97F4A7C15 * k & (2 ** 64 - 1)))
        out.append(pack_bits(2 * bit_counts(h, count) > count[:, None]))
    return out


def bit_segments(positions: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, p)) for p in np.array_split(np.array(positions), parts)]


def _bucket_key(names: list[str], positions: list[int], table: int) -> Column:
    masks = [sum(1 << (p % 64) for p in positions if p // 64 == k) for k in range(len(names))]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.xxhash64(F.lit(table), *[F.col(n).bitwiseAND(F.lit(m).cast("long")) for n, m in zip(names, signed) if m])


def fingerprint_links(fingerprints: DataFrame, width: int, radius: int,
                      tables: list[list[int]]) -> DataFrame:
    """Links between distinct fingerprints (columns ``node``, f0, ...) within ``radius`` bits.

    ``tables`` lists the bit positions of each table of buckets: ``radius`` + 1 disjoint
    segments, which make the search exact. Returns ``a`` and ``b``.
    """
    names = fingerprint_columns(width)
    rows = _dealt(fingerprints, names, tables)
    found, paths = [], tables
    for _ in range(_DEPTH):
        large = rows.groupBy("key").count().where(F.col("count") > BUCKET_ROWS).select("key")
        large = settle(large, "large-buckets")
        if large.isEmpty():
            break
        # a bucket's remaining bits are those of no table on its path
        deeper = [bit_segments([p for p in range(64 * width) if p not in set(path)], radius + 1) for path in paths]
        found.append(rows.join(large, "key", "left_anti"))
        rows = _dealt_again(rows.join(large, "key", "left_semi"), names, deeper)
        paths = [path + segment for path, segments in zip(paths, deeper) for segment in segments]
    found.append(rows)
    links = None
    for part in found:
        part = part.select("key", "node", *names).repartition("key").sortWithinPartitions("key")
        part = part.mapInArrow(_group_links(names, radius), "a long, b long")
        links = part if links is None else links.union(part)
    return links


def _dealt(fingerprints: DataFrame, names: list[str], tables: list[list[int]]) -> DataFrame:
    keys = [F.struct(F.lit(t).alias("path"), _bucket_key(names, positions, t).alias("key"))
            for t, positions in enumerate(tables)]
    return fingerprints.select("node", *names, F.inline(F.array(*keys)))


def _dealt_again(rows: DataFrame, names: list[str], deeper: list[list[list[int]]]) -> DataFrame:
    """Each row's bucket split by the segments that its table's path leaves."""
    parts = len(deeper[0])
    choices = None
    for t, segments in enumerate(deeper):
        here = F.array(*[F.struct((F.lit(t) * parts + s).alias("path"),
                                  F.xxhash64("key", _bucket_key(names, positions, s)).alias("key"))
                         for s, positions in enumerate(segments)])
        choices = F.when(F.col("path") == t, here) if choices is None else choices.when(F.col("path") == t, here)
    return rows.withColumn("__deeper", choices).select("node", *names, F.inline("__deeper"))


def _group_links(names: list[str], radius: int):
    """Reads rows sorted by bucket and links each bucket's fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            key, node, *marks = (np.concatenate(c) for c in zip(*parts))
            a, b = linked(key, node, np.stack([m.view(np.uint64) for m in marks]), radius)
            return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            columns = tuple(batch.column(c).to_numpy() for c in ["key", "node", *names])
            key = columns[0]
            if not len(key):
                continue
            held.append(columns)
            if sum(len(h[0]) for h in held) < 100_000 or key[0] == key[-1] and len(held) > 1:
                continue
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if cut == 0:
                continue
            held[-1] = tuple(c[:cut] for c in columns)
            yield links(held)
            held = [tuple(c[cut:] for c in columns)]
        if held:
            yield links(held)

    return run


def gray_rank(marks: np.ndarray) -> np.ndarray:
    """Rank of each fingerprint in the reflected Gray order, most significant row first."""
    out, odd = np.empty_like(marks), np.zeros(marks.shape[1], np.uint64)
    for k in range(len(marks)):
        rank = marks[k].copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        out[k] = np.where(odd == 1, ~rank, rank)
        odd = odd ^ (rank & np.uint64(1))
    return out


def _distance(marks: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    total = np.zeros(len(a), np.uint16)
    for k in range(len(marks)):
        bits = marks[k][a] ^ other[k][b]
        total += np.bitwise_count(bits if mask is None else bits & mask[k][b])
    return total


class _Groups:
    """Linked groups as parent pointers towards the smallest index."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            high, low = np.maximum(self.root[a], self.root[b]), np.minimum(self.root[a], self.root[b])
            apart = high != low
            if not apart.any():
                return
            np.minimum.at(self.root, high[apart], low[apart])
            while True:
                shorter = self.root[self.root]
                if (shorter == self.root).all():
                    break
                self.root = shorter


def linked(key: np.ndarray, node: np.ndarray, marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each member of a linked group of a bucket to the group's smallest node."""
    rank = gray_rank(marks)
    order = np.lexsort((*rank[::-1], key))
    key, node, marks = key[order], node[order], marks[:, order]
    n = len(key)
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    size = np.diff(np.append(first, n))
    alone = np.repeat(size == 1, size)
    if alone.any():
        key, node, marks = key[~alone], node[~alone], marks[:, ~alone]
        n = len(key)
        if not n:
            return node[:0], node[:0]
        first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        size = np.diff(np.append(first, n))
    bucket = np.repeat(np.arange(len(first)), size)
    groups = _Groups(n)
    i = np.flatnonzero(bucket[1:] == bucket[:-1])
    near = _distance(marks, i, marks, i + 1) <= radius
    groups.link(i[near], i[near] + 1)

    leaf = _Level(first, size, LEAF)
    leaf.cover(marks)
    upper = _Level(leaf.first_of, leaf.count_of, LEAF)
    upper.cover(leaf.low, leaf.high)
    per_row = upper.count_of[bucket]
    begin, step = 0, 400_000
    while begin < n:
        end = begin + max(1, int(np.searchsorted(np.cumsum(per_row[begin:]), step)))
        rows = np.arange(begin, min(end, n))
        begin = end
        q, u = _expand(rows, upper.first_of[bucket[rows]], per_row[rows])
        q, u = upper.near(q, u, marks, radius, groups, n, leaf)
        for at in range(0, len(q), 100_000):
            q1, l1 = _expand(q[at:at + 100_000], upper.start[u[at:at + 100_000]], upper.size[u[at:at + 100_000]])
            q1, l1 = leaf.near(q1, l1, marks, radius, groups, n, None)
            for part in range(0, len(q1), 100_000):
                q2, j = _expand(q1[part:part + 100_000], leaf.start[l1[part:part + 100_000]], leaf.size[l1[part:part + 100_000]])
                keep = j > q2
                q2, j = q2[keep], j[keep]
                keep = _distance(marks, q2, marks, j) <= radius
                groups.link(q2[keep], j[keep])
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, groups.root, node)
    target = least[groups.root]
    keep = target != node
    return node[keep], target[keep]


def _expand(query: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each query with each of the ``size`` items from ``start`` on."""
    repeated = np.repeat(query, size)
    within = np.arange(len(repeated)) - np.repeat(np.cumsum(size) - size, size)
    return repeated, np.repeat(start, size) + within


class _Level:
    """Nodes over runs of items that never cross a bucket."""

    def __init__(self, first: np.ndarray, size: np.ndarray, run: int):
        self.count_of = -(-size // run)
        self.first_of = np.cumsum(self.count_of) - self.count_of
        _, within = _expand(first, np.zeros_like(first), self.count_of)
        self.start = np.repeat(first, self.count_of) + within * run
        self.size = np.minimum(np.repeat(first + size, self.count_of) - self.start, run)

    def cover(self, low: np.ndarray, high: np.ndarray | None = None) -> None:
        """The bits all members share: ``pattern`` on ``mask``."""
        self.low = np.bitwise_and.reduceat(low, self.start, axis=1)
        self.high = np.bitwise_or.reduceat(low if high is None else high, self.start, axis=1)
        self.mask, self.pattern = ~(self.low ^ self.high), self.low

    def near(self, query: np.ndarray, node: np.ndarray, marks: np.ndarray, radius: int, groups: _Groups,
             n: int, below: "_Level | None") -> tuple[np.ndarray, np.ndarray]:
        """The pairs that may hold a link not yet known: later rows, within the radius, other group."""
        start, last = self.start[node], self.start[node] + self.size[node] - 1
        if below is not None:
            start, last = below.start[start], below.start[last] + below.size[last] - 1
        keep = last > query
        query, node, start, last = query[keep], node[keep], start[keep], last[keep]
        changes = np.concatenate([[0], np.cumsum(groups.root[1:] != groups.root[:-1])])
        known = (changes[start] == changes[last]) & (groups.root[start] == groups.root[query])
        query, node = query[~known], node[~known]
        keep = _distance(marks, query, self.pattern, node, self.mask) <= radius
        return query[keep], node[keep]


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                          radius: int = 4) -> DataFrame:
    """One row per input row: ``doc_id``, its fingerprint ``f0``, ``component_id`` and ``group``.

    Fingerprints within ``radius`` bits are linked, all of them, and groups are what links
    reach. ``component_id`` is the smallest id in the group, ``group`` its smallest fingerprint.

    Copies, ties and repeated rows share a fingerprint and so a group. Texts without words
    are linked like any other. Rows are linked by their fingerprints alone: rows that share
    an id need not share a group, and a row without an id is linked like any other; a group
    without any id has a null ``component_id``. Other columns are not read. An empty table
    gives an empty table.
    """
    marked = settle(simhash(docs, id_col, text_col, shingle), "fingerprints")
    nodes = settle(marked.groupBy("f0").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = fingerprint_links(nodes.select(F.col("f0").alias("node"), "f0"), 1, radius, bit_segments(list(range(64)), radius + 1))
    reached = connected_components(settle(links, "fingerprint-links"))
    grouped = nodes.join(reached, F.col("f0") == F.col("node"), "left").select(
        F.col("f0").alias("__f0"), "least", F.coalesce("component", "f0").alias("group"))
    grouped = settle(grouped, "fingerprint-groups")
    # written, so that a hot group is shuffled on both sides of the join and can be split
    smallest = settle(grouped.groupBy(F.col("group").alias("__group")).agg(F.min("least").alias("component_id")), "smallest-ids")
    named = grouped.join(smallest, F.col("group") == F.col("__group")).select("__f0", "component_id", "group")
    named = settle(named, "named-groups")
    return marked.join(named, F.col("f0") == F.col("__f0"), "left").select("doc_id", "f0", "component_id", "group")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """``docs`` with exactly one row of each near-duplicate group: that with the smallest id.

    Rows without an id come last, of equal ids the smallest fingerprint counts, and of rows alike in
    both the least hash of the row. All columns stay as they are.
    """
    groups = near_duplicate_groups(docs, id_col, text_col, shingle, radius)
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "f0")).alias("first"))
    first = settle(first.select(F.col("first.f0").alias("__f0"), F.col("first.doc_id").alias("__id")), "first-of-groups")
    marked = with_simhash(docs, "__mark", text_col, shingle).withColumn("__doc", F.col(id_col).cast("long"))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    order = Window.partitionBy("__mark", "__doc").orderBy(F.xxhash64(*plain))
    one = marked.withColumn("__row", F.row_number().over(order)).where("__row = 1")
    same = (F.col("__mark") == F.col("__f0")) & F.col("__doc").eqNullSafe(F.col("__id"))
    return one.join(first, same, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
