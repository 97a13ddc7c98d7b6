"""Substring removal with fixed-block anchors.

Every document is cut into non-overlapping blocks of ``anchor`` words; a window of
2 * anchor - 1 words always holds a whole block of whichever document it is
compared with. The blocks are the index; every rolling run of ``anchor`` words is
a probe. A block that some other place repeats is a shared anchor, and only windows
around shared anchors are extended and compared as a whole. Overlapping repeated
windows make up the maximal exact repeats that are cut out.

Scale: documents are packed into batches of a few megabytes. A batch sends each
distinct probe once, so a passage that a third of all documents repeat costs one
entry per batch, not per document, and no pairs are formed. Probes travel as sorted
32-bit remainders of their bucket; the number of buckets follows the number of
words, so the share of chance hits stays the same at any size, and a chance hit
only costs one more window to compare. Windows are compared by 96 hash bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import (
    list_rows, plane_bytes, plane_values, settle, sorted_bytes, sorted_values)
from .words import (
    Words, find_words, gram_hashes, gram_starts, joined, raw_texts, text_chunks, word_hashes)

BATCH_BYTES = 3 << 20
BUCKET_WORDS = 1 << 20
NO_ID = np.iinfo(np.int64).max

_PROBES = "bucket int, batch long, size int, hashes binary, indexed binary, twice binary"
_SHARED = "batch long, bucket int, shared binary"
_WINDOWS = "bucket int, batch long, size int, hashes binary, extra binary, ids binary"
_EARLIER = "batch long, bucket int, earlier binary, ids binary"


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = 13, keep_spacing: bool = False) -> DataFrame:
    """Remove words covered by a window that a document with a smaller id also has.

    Returns one row per input row: ``row`` (struct of all other columns), ``n_words``,
    ``n_removed``, ``removed`` (word runs first..last) and ``kept`` (kept words joined
    by one space; with ``keep_spacing`` the text as it was without the removed words and the
    white space after them). Windows are judged on the input. Null and empty texts have no
    words. Rows with equal ids do not repeat each other; a null id counts as larger
    than any id, so its row can lose words but takes none from others. Extra columns
    stay in ``row`` whatever their names. An empty table gives an empty table.
    """
    anchor = (window + 1) // 2
    others = [c for c in docs.columns if c != text_col]
    store = settle(_packed(docs, id_col, text_col, others), "substring-batches")
    words = store.agg(F.sum("words")).first()[0] or 0
    bits = max(3, int(np.ceil(np.log2(words / BUCKET_WORDS + 1))))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for body in _bodies(batches):
            yield _emit_probes(body, anchor, bits)

    replies = (store.select("batch", "sizes", "body").mapInArrow(probes, _PROBES)
               .groupBy("bucket").applyInArrow(_find_shared, _SHARED))
    shared = settle(_by_batch(replies, "shared"), "substring-anchors")
    marked = store.join(shared, "batch", "left")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for body in _bodies(batches):
            yield _emit_windows(body, anchor, window, bits)

    earlier = _by_batch(
        marked.select("batch", "sizes", "body", "ids", "shared").mapInArrow(windows, _WINDOWS)
        .groupBy("bucket").applyInArrow(_find_earlier, _EARLIER), "earlier", "ids")
    row_type = store.schema["rows"].dataType.elementType
    out = T.StructType([
        T.StructField("row", row_type), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
        T.StructField("kept", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for body in _bodies(batches):
            yield _cut(body, anchor, window, bits, keep_spacing)

    return marked.join(earlier, "batch", "left").select(
        "batch", "sizes", "body", "ids", "shared", "earlier", "rows").mapInArrow(cut, out)


def _packed(docs: DataFrame, id_col: str, text_col: str, others: list[str]) -> DataFrame:
    """One row per batch of documents: texts in one body, other columns as a list of rows."""
    fields = T.StructType([docs.schema[c] for c in others])
    schema = T.StructType([
        T.StructField("batch", T.LongType()), T.StructField("words", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("body", T.BinaryType()), T.StructField("rows", T.ArrayType(fields))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for part in text_chunks(texts, BATCH_BYTES):
                some, rows = texts[part], batch.slice(part.start, part.stop - part.start)
                data, at = joined(some)
                count = int(find_words(data, at).count.sum())
                sizes = pa.array([len(t) if t else 0 for t in some], pa.int32())
                struct = rows.column("row")
                yield pa.record_batch(
                    [pa.array([number], pa.int64()), pa.array([count], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), rows.column("id")),
                     pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), sizes),
                     pa.array([plane_bytes(data)], pa.binary()), list_rows(struct)],
                    names=["batch", "words", "ids", "sizes", "body", "rows"])
                number += 1

    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.struct(*others).alias("row")).mapInArrow(pack, schema)


def _by_batch(replies: DataFrame, *columns: str) -> DataFrame:
    listed = F.sort_array(F.collect_list(F.struct("bucket", *columns)))
    return replies.groupBy("batch").agg(listed.alias(columns[0]))


class _Body:
    """A batch of the store, its words hashed anew."""

    def __init__(self, row: dict):
        self.row, self.batch = row, row["batch"]
        sizes = np.asarray(row["sizes"], np.int64) + 1
        data = plane_values(row["body"], np.uint8)
        self.words: Words = find_words(data, np.cumsum(sizes) - sizes)
        self.hashes = word_hashes(self.words)
        if "ids" in row:
            self.ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)

    def probes(self, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probe positions, their distinct hashes ascending, and which each has."""
        at = gram_starts(self.words, anchor)
        distinct, which = np.unique(gram_hashes(self.hashes, anchor)[at], return_inverse=True)
        return at, distinct, which

    def candidates(self, anchor: int, window: int, bits: int) -> tuple[np.ndarray, ...]:
        """Windows around shared anchors: positions, distinct hashes, extra bits, which."""
        at, distinct, which = self.probes(anchor)
        known = np.zeros(len(distinct), bool)
        edges = _edges(distinct, bits)
        for reply in self.row["shared"] or []:
            a, b = edges[reply["bucket"]], edges[reply["bucket"] + 1]
            known[a:b] = np.unpackbits(np.frombuffer(reply["shared"], np.uint8), count=b - a)
        hit = np.zeros(len(self.hashes) + 1, np.int64)
        hit[at + 1] = known[which]
        so_far = np.cumsum(hit)
        starts = gram_starts(self.words, window)
        starts = starts[so_far[starts + window - anchor + 1] > so_far[starts]]
        whole, first, which = np.unique(gram_hashes(self.hashes, window, 1)[starts],
                                        return_index=True, return_inverse=True)
        extra = gram_hashes(self.hashes, window, 2)[starts[first]].astype(np.uint32)
        return starts, whole, extra, which

    def own_first(self, starts: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
        """The smallest id in this batch that has each distinct window."""
        out = np.full(n, NO_ID)
        np.minimum.at(out, which, self.ids[self.words.text[starts]])
        return out


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[_Body]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "rows"]
        for i in range(batch.num_rows):
            body = _Body({n: batch.column(n)[i].as_py() for n in names})
            if "rows" in batch.schema.names:
                body.rows = batch.column("rows")[i].values
            yield body


def _edges(ascending: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2**bits buckets begins in ascending hashes."""
    marks = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(ascending, marks), [len(ascending)]])


def _rest(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after the bucket's bits."""
    return (hashes >> np.uint64(32 - bits)).astype(np.uint32)


def _emit_probes(body: _Body, anchor: int, bits: int) -> pa.RecordBatch:
    at, distinct, which = body.probes(anchor)
    block = (at - body.words.first[body.words.text[at]]) % anchor == 0
    indexed = np.bincount(which, block, len(distinct)) > 0
    twice = np.bincount(which, minlength=len(distinct)) > 1
    rest, edges = _rest(distinct, bits), _edges(distinct, bits)
    rows = [(k, body.batch, b - a, sorted_bytes(rest[a:b]), np.packbits(indexed[a:b]).tobytes(),
             np.packbits(twice[a:b]).tobytes())
            for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if b > a]
    return _batch(rows, ["bucket", "batch", "size", "hashes", "indexed", "twice"],
                  [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])


def _find_shared(table: pa.Table) -> pa.Table:
    """The anchors of one bucket that are a block somewhere and stand in another place too."""
    rows = table.to_pylist()
    hashes = np.concatenate([sorted_values(r["hashes"], np.uint32) for r in rows])
    values, which = np.unique(hashes, return_inverse=True)

    def anywhere(flags: str) -> np.ndarray:
        bits = np.concatenate([np.unpackbits(np.frombuffer(r[flags], np.uint8), count=r["size"]) for r in rows])
        return np.bincount(which, bits, len(values)) > 0

    many = np.bincount(which, minlength=len(values)) > 1
    shared = (anywhere("indexed") & (many | anywhere("twice")))[which]
    out, at = [], 0
    for r in rows:
        part = shared[at:at + r["size"]]
        at += r["size"]
        if part.any():
            out.append((r["batch"], r["bucket"], np.packbits(part).tobytes()))
    return pa.Table.from_batches([_batch(out, ["batch", "bucket", "shared"], [pa.int64(), pa.int32(), pa.binary()])])


def _emit_windows(body: _Body, anchor: int, window: int, bits: int) -> pa.RecordBatch:
    starts, whole, extra, which = body.candidates(anchor, window, bits)
    ids, edges = body.own_first(starts, which, len(whole)), _edges(whole, bits)
    rows = [(k, body.batch, b - a, sorted_bytes(whole[a:b]), plane_bytes(extra[a:b]), plane_bytes(ids[a:b]))
            for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if b > a]
    return _batch(rows, ["bucket", "batch", "size", "hashes", "extra", "ids"],
                  [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])


def _find_earlier(table: pa.Table) -> pa.Table:
    """For each batch, its windows that stand in a document with an id below its own first."""
    rows = table.to_pylist()
    hashes = np.concatenate([sorted_values(r["hashes"], np.uint64) for r in rows])
    extra = np.concatenate([plane_values(r["extra"], np.uint32) for r in rows])
    ids = np.concatenate([plane_values(r["ids"], np.int64) for r in rows])
    order = np.lexsort((extra, hashes))
    h, e = hashes[order], extra[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (e[1:] != e[:-1])])
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    first = np.empty(len(ids), np.int64)
    first[order] = least[np.cumsum(new) - 1]
    earlier = first < ids
    out, at = [], 0
    for r in rows:
        part = slice(at, at + r["size"])
        at += r["size"]
        if earlier[part].any():
            out.append((r["batch"], r["bucket"], np.packbits(earlier[part]).tobytes(),
                        plane_bytes(first[part][earlier[part]])))
    return pa.Table.from_batches([_batch(out, ["batch", "bucket", "earlier", "ids"],
                                         [pa.int64(), pa.int32(), pa.binary(), pa.binary()])])


def _cut(body: _Body, anchor: int, window: int, bits: int, keep_spacing: bool) -> pa.RecordBatch:
    words = body.words
    starts, whole, _, which = body.candidates(anchor, window, bits)
    first, edges = body.own_first(starts, which, len(whole)), _edges(whole, bits)
    for reply in body.row["earlier"] or []:
        a, b = edges[reply["bucket"]], edges[reply["bucket"] + 1]
        flags = np.unpackbits(np.frombuffer(reply["earlier"], np.uint8), count=b - a).astype(bool)
        first[a:b][flags] = plane_values(reply["ids"], np.int64)
    repeated = starts[first[which] < body.ids[words.text[starts]]]
    n = len(words.start)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, repeated, 1)
    np.add.at(change, repeated + window, -1)
    gone = np.cumsum(change[:n]) > 0
    n_docs = len(words.count)
    removed = np.bincount(words.text[gone], minlength=n_docs)

    kept = _spaced(body, gone) if keep_spacing else _single_spaced(words, gone)

    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    run_first, run_stop = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    # a run that crosses from one document into the next is two runs
    crossing = np.flatnonzero(gone[1:] & gone[:-1] & (words.text[1:] != words.text[:-1])) + 1 if n else run_first[:0]
    run_first, run_stop = np.sort(np.concatenate([run_first, crossing])), np.sort(np.concatenate([run_stop, crossing]))
    owner = words.text[run_first] if n else run_first
    base = words.first[owner]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array((run_first - base).astype(np.int32)),
                                        pa.array((run_stop - 1 - base).astype(np.int32))], ["first", "last"])
    return pa.record_batch(
        [body.rows, pa.array(words.count), pa.array(removed.astype(np.int64)),
         pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["row", "n_words", "n_removed", "removed", "kept"])


def _single_spaced(words: Words, gone: np.ndarray) -> list[bytes]:
    """Each text's remaining words joined by one space."""
    start, end, n = words.start[~gone], words.end[~gone], len(words.count)
    step = np.zeros(len(words.data) + 1, np.int8)
    step[start] += 1
    step[end + 1] -= 1
    text = words.data[np.cumsum(step[:-1], dtype=np.int8) > 0]
    text[np.cumsum(end - start + 1) - 1] = 0x20
    sizes = np.bincount(words.text[~gone], end - start + 1, n).astype(np.int64)
    return _split(text, sizes)


def _spaced(body: _Body, gone: np.ndarray) -> list[bytes]:
    """Each text without the removed words and the white space after them."""
    words = body.words
    sizes = np.asarray(body.row["sizes"], np.int64) + 1
    stop = np.cumsum(sizes)
    after = np.append(words.start[1:], len(words.data))
    after = np.minimum(after, stop[words.text] - 1) if len(words.text) else after[:0]
    step = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(step, words.start[gone], 1)
    np.add.at(step, after[gone], -1)
    out = np.cumsum(step[:-1], dtype=np.int8) > 0
    removed = np.bincount(words.text[gone], (after - words.start)[gone], len(sizes)).astype(np.int64)
    return _split(words.data[~out], sizes - removed)


def _split(data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Texts of the given sizes, each without its last byte, the separator."""
    raw, stop = data.tobytes(), np.cumsum(sizes)
    return [raw[a:b - 1] if b > a else b"" for a, b in zip((stop - sizes).tolist(), stop.tolist())]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
