"""Packing by cutting-stock column generation.

Token sequences are cut into full pieces of the capacity and one rest each. Rests are
counted by length class; the classes and their counts are all the driver sees, and
their number depends on the capacity only. A linear program over patterns (how many
rests of each class one sequence holds) is solved by column generation: the basis is
kept square, its dual prices go into a knapsack by dynamic programming, and the
pattern it finds enters the basis until none is worth more than a sequence. Patterns
are rounded down to whole sequences, the counts left over are packed by best fit.

Documents are ranked in their class without a sort of the whole class, and a rank
says which pattern, sequence and place a document takes.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import distributed_rank, settle, spread_key, worker_memory
from .words import find_words, joined, raw_texts, text_chunks, word_hashes

END_ID = 2
_MEMO_WORDS = 600_000
CHUNK_BYTES = 6 << 20

_TOKENS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordIds(dict):
    """Ids of texts, as little-endian bytes, from remembered ids of their parts between spaces.

    The vocabulary drops white space and never merges across it, so parts can be encoded
    apart. New parts are cut into the tokenizer's own pre-tokens, which are encoded
    together in one call and told apart by their word-end tokens. Parts beyond the Latin
    blocks, where lower-casing or composing could differ, are encoded one by one. At a
    fixed size the memory forgets all words but those of the chunk at hand.
    """

    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
    END_MARK = "</w>"
    LAST_PLAIN = "\u024f"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pieces = regex.compile(self.PIECES)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(self.END_MARK)]] = True

    @classmethod
    def of(cls, path: str) -> WordIds:
        """One memory per worker process, kept from task to task."""
        return worker_memory(("packing", path), lambda: cls(path))

    def encode_one(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, parts: list[str], every: list[str]) -> None:
        if len(self) > _MEMO_WORDS:
            kept = {w: self[w] for w in every if w in self}
            self.clear()
            self.update(kept)
        cut = {}
        for part in parts:
            low = part.lower()
            if not low.isascii() and max(part) > self.LAST_PLAIN:
                self[part] = self.encode_one(part)
            elif low.isalpha():
                cut[part] = [low]
            elif low[:-1].isalpha() and not low[-1].isalnum() and not low[-1].isspace():
                cut[part] = [low[:-1], low[-1]]
            else:
                cut[part] = self.pieces.findall(low)
        new, piece_ids = sorted(set().union(*cut.values())), {}
        if new:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(new):
                data, at = ids.tobytes(), [0, *(4 * stops).tolist()]
                piece_ids.update((p, data[i:j]) for p, i, j in zip(new, at, at[1:]))
            else:
                piece_ids.update((p, self.encode_one(p)) for p in new)
        for part, pieces in cut.items():
            self[part] = b"".join([piece_ids[p] for p in pieces])

    def encode(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """Ids of each text. Per chunk, each distinct word is looked up once."""
        for part in text_chunks(texts, CHUNK_BYTES):
            data, at = joined(texts[part])
            words = find_words(data, at)
            _, first, which = np.unique(word_hashes(words), return_index=True, return_inverse=True)
            raw = data.tobytes()
            distinct = [raw[i:j].decode() for i, j in zip(words.start[first].tolist(), words.end[first].tolist())]
            found = list(map(self.get, distinct))
            if None in found:
                self.learn([w for w, f in zip(distinct, found) if f is None], distinct)
                found = list(map(self.get, distinct))
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids = np.frombuffer(b"".join(found), "<u4")
            place, count = (np.cumsum(size) - size)[which], size[which]
            stop = np.cumsum(count)
            ids = ids[np.repeat(place - stop + count, count) + np.arange(int(count.sum()))].tobytes()
            total = np.bincount(words.text, count, len(words.count)).astype(np.int64) * 4
            end = np.cumsum(total)
            yield from (ids[i:j] for i, j in zip((end - total).tolist(), end.tolist()))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, start, length, ids_crc32, doc_tokens``.

    A document's ids are those of its text followed by id 2; a null text is empty. The
    vocabulary file is named by ``tokenizer`` and must be reachable by every executor.
    """
    step = 4 * capacity
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds.of(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), known.encode(raw_texts(batch.column(1)))):
                ids += end
                total = len(ids) // 4
                rows += [(doc_id, at // 4, min(step, len(ids) - at) // 4, zlib.crc32(ids[at:at + step]), total)
                         for at in range(0, len(ids), step)]
            columns = zip(*rows) if rows else [[]] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.record_batch([pa.array(list(c), pa.int64()) for c in columns], names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, _TOKENS)


def solve_patterns(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """Patterns and how often the linear program uses them, by column generation."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(counts, float)
    for _ in range(50 * k):
        prices = np.linalg.solve(basis.T, np.ones(k))
        column, worth = _knapsack(sizes, prices, capacity)
        if worth <= 1 + 1e-9:
            break
        used = np.linalg.solve(basis, need)
        rate = np.linalg.solve(basis, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(rate > 1e-9, np.maximum(used, 0) / rate, np.inf)
        basis[:, int(np.argmin(ratio))] = column
    used = np.linalg.solve(basis, need)
    return [(tuple(int(v) for v in basis[:, j]), max(0.0, float(used[j]))) for j in range(k)]


def _knapsack(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The most valuable set of lengths that fits, repeats allowed, by dynamic programming."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    length, price = np.array(sizes), np.asarray(prices)
    for room in range(1, capacity + 1):
        n = int(np.searchsorted(length, room, "right"))
        best[room] = best[room - 1]
        if n:
            value = best[room - length[:n]] + price[:n]
            top = int(np.argmax(value))
            if value[top] > best[room] + 1e-12:
                best[room], taken[room] = value[top], top
    column, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            column[taken[room]] += 1
            room -= sizes[taken[room]]
    return column, float(best[capacity])


def whole_patterns(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole numbers of sequences by pattern ({class: rests}) that place every rest."""
    if not sizes:
        return []
    left, out = list(counts), []
    for pattern, often in solve_patterns(sizes, counts, capacity):
        times = int(often + 1e-6)
        held = [(c, a) for c, a in enumerate(pattern) if a]
        times = min([times, *[left[c] // a for c, a in held]]) if held else 0
        if times:
            out.append((dict(held), times))
            for c, a in held:
                left[c] -= a * times
    while any(left):  # longest first; a bin's pattern is used as often as it fits
        room, held = capacity, {}
        for c in range(len(sizes) - 1, -1, -1):
            a = min(left[c], room // sizes[c])
            if a:
                held[c], room = a, room - a * sizes[c]
        times = min(left[c] // a for c, a in held.items())
        out.append((held, times))
        for c, a in held.items():
            left[c] -= a * times
    return out


def pack(pieces: DataFrame, capacity: int = 4096, unit: int = 16) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens.

    Full pieces take a sequence each. Lengths are classed by ``unit`` tokens rounded up,
    so a sequence never overflows. Every piece lies in one sequence, offsets have no
    gaps, sequence ids start at 0. Repeated rows are pieces of their own. No pieces
    give no sequences.
    """
    rests = pieces.where(F.col("length") < capacity)
    full = pieces.where(F.col("length") >= capacity)
    classed = rests.withColumn("__class", F.ceil(F.col("length") / unit).cast("int"))
    histogram = {r["__class"]: r["count"] for r in classed.groupBy("__class").count().collect()}
    sizes = sorted(histogram)
    plan = whole_patterns(sizes, [histogram[s] for s in sizes], capacity // unit)

    # for each class, the ranks at which its patterns begin
    first_rank: dict[int, list[int]] = {s: [] for s in sizes}
    taken = dict.fromkeys(sizes, 0)
    meaning: dict[int, list[tuple[int, int]]] = {s: [] for s in sizes}
    sequences = 0
    for held, times in plan:
        for c, each in held.items():
            size = sizes[c]
            first_rank[size].append(taken[size])
            meaning[size].append((sequences, each))
            taken[size] += each * times
        sequences += times

    columns = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for size, rank in zip(batch.column("__class").to_pylist(), batch.column("__rank").to_pylist()):
                k = bisect_right(first_rank[size], rank) - 1
                base, each = meaning[size][k]
                out.append(base + (rank - first_rank[size][k]) // each)
            yield pa.record_batch([*[batch.column(c) for c in columns], pa.array(out, pa.int64())],
                                  names=[*columns, "sequence_id"])

    rows = sum(histogram.values())
    order = F.struct(spread_key(4, "doc_id", "start", "ids_crc32").alias("u"), "doc_id", "start", "ids_crc32")
    ranked = distributed_rank(classed, ["__class"], order, "__rank", rows)
    placed = ranked.mapInArrow(place, T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType())]))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start").rowsBetween(
        Window.unboundedPreceding, -1)
    packed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    n_full = full.count()
    order = F.struct(spread_key(4, "doc_id", "start", "ids_crc32").alias("u"), "doc_id", "start", "ids_crc32")
    whole = distributed_rank(full.withColumn("__all", F.lit(0)), ["__all"], order, "__rank", n_full)
    whole = whole.select(*columns, (F.col("__rank") + sequences).alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"))
    return packed.union(whole)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack all documents; one row per piece, other columns are not read.

    Pieces are written to the shared folder first, because the histogram, the ranks and
    the result all read them.
    """
    return pack(settle(token_pieces(docs, tokenizer, capacity, id_col, text_col), "pieces"), capacity)


def sequence_tokens(docs: DataFrame, packed: DataFrame, tokenizer: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``sequence_id`` and its ``ids``, read off the documents by the packed pieces.

    A sequence has at most the capacity of ids; ids of documents must be unique here.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds.of(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            texts = known.encode(raw_texts(batch.column("text")))
            ids = [np.frombuffer(t + end, "<u4")[s:s + n].astype(np.int32)
                   for t, s, n in zip(texts, *(batch.column(c).to_pylist() for c in ("start", "length")))]
            yield pa.record_batch([batch.column("sequence_id"), batch.column("offset"),
                                   pa.array(ids, pa.list_(pa.int32()))], names=["sequence_id", "offset", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = texts.join(packed.select("doc_id", "start", "length", "sequence_id", "offset"), "doc_id").mapInArrow(
        run, "sequence_id long, offset long, ids array<int>")
    return parts.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
