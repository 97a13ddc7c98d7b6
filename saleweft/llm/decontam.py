"""Benchmark decontamination by greedy string tiling.

Benchmark items are indexed by the hashes of their runs of ``least`` words; every run of
a document is looked up (Karp-Rabin). Hits on one diagonal, the same shift between item
and document, join to maximal matches. The longest match is marked, its words cannot be
marked again, what is left of cut matches goes back, and so on down to ``least`` words. The
share of an item's words under tiles is its coverage; because tiles may stand in any
order, reordered passages count in full.

The benchmark is a stated set of queries. It is worked through in blocks of a bounded
number of words, each of which travels to all tasks; documents are not shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .licenses import WORD_BYTES
from .words import Words, find_words, gram_hashes, gram_starts, joined, lower_ascii, raw_texts, text_chunks, word_hashes

LEAST_WORDS = 5
COVERAGE = 0.5
BLOCK_WORDS = 1_000_000


UNSPACED = {
    0xE0: range(0xB8, 0xBC), 0xE1: [*range(0x80, 0x83), 0x9E, 0x9F], 0xE3: range(0x81, 0xC0),
    **{lead: range(0x80, 0xC0) for lead in range(0xE4, 0xEA)},
}
"""First and second bytes of three-byte characters of scripts without spaces: Thai, Lao, Burmese, Khmer, kana, Han."""


def cut_words(data: np.ndarray, text_start: np.ndarray) -> Words:
    """Runs of word bytes; a character of a script without spaces is a word of its own."""
    after = np.append(data[1:], np.uint8(0))
    alone = np.zeros(len(data), bool)
    if (data >= 0xE0).any():
        table = np.zeros((256, 256), bool)
        for lead, following in UNSPACED.items():
            table[lead, list(following)] = True
        alone = table[data, after]
    if not alone.any():
        return find_words(data, text_start, WORD_BYTES)
    inside = WORD_BYTES[data]
    cut = alone.copy()
    cut[3:] |= alone[:-3]
    before = np.append(False, inside[:-1])
    start = np.flatnonzero(inside & (~before | cut))
    end = np.flatnonzero(np.append(before & (~inside | cut), inside[-1:]))
    text = np.searchsorted(text_start, start, "right") - 1
    return Words(data, start, end, text, np.bincount(text, minlength=len(text_start)).astype(np.int64))


@dataclass
class Runs:
    """Runs of one length in some of a block's items, ascending by hash: item, place in the item."""

    words: int
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray


@dataclass
class ItemIndex:
    """A block of items: ids, word counts, and their runs. An item's runs have ``least`` words, or all it has."""

    ids: list[int | None]
    sizes: np.ndarray
    runs: list[Runs]


def _index(ids: list[int | None], texts: list[bytes], least: int) -> ItemIndex:
    data, at = joined(texts)
    words = cut_words(lower_ascii(data), at)
    hashes, runs = word_hashes(words), []
    length = np.where(words.count > 1, np.minimum(words.count, least), 0)
    for n in np.unique(length[length > 0]).tolist():
        starts = gram_starts(words, n)
        starts = starts[length[words.text[starts]] == n]
        grams = gram_hashes(hashes, n)[starts]
        order = np.argsort(grams, kind="stable")
        owner = words.text[starts]
        runs.append(Runs(n, grams[order], owner[order], (starts - words.first[owner])[order]))
    return ItemIndex(ids, words.count, runs)


def item_blocks(benchmark: DataFrame, least: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[ItemIndex]:
    """The benchmark's items, one index per block of about ``BLOCK_WORDS`` words."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    # a character is a word in some scripts, three bytes long
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")) + F.floor((F.octet_length("text") - F.length("text")) / 2))).first()[0] or 0
    blocks = max(1, -(-words // BLOCK_WORDS))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
        if part.num_rows:
            yield _index(part.column("id").to_pylist(), raw_texts(part.column("text").combine_chunks()), least)


def tile(matches: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles of maximal matches ``(item place, document place, words)``, longest first.

    Ties go to the earlier place in the item, then in the document.
    """
    heap = [(-n, i, j) for i, j, n in matches]
    heapq.heapify(heap)
    in_item, in_text, tiles = set(), set(), []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = [i + k not in in_item and j + k not in in_text for k in range(n)]
        if all(free):
            tiles.append((i, j, n))
            in_item.update(range(i, i + n))
            in_text.update(range(j, j + n))
            continue
        k = 0
        while k < n:
            m = k
            while m < n and free[m]:
                m += 1
            if m - k >= least:
                heapq.heappush(heap, (k - m, i + k, j + k))
            k = max(m, k) + 1
    return tiles


def _leaks(texts: list[bytes | None], index: ItemIndex, coverage: float) -> list[tuple]:
    """``(text, item, coverage, tiles)`` of the pairs that reach the coverage."""
    data, at = joined(texts)
    words = cut_words(lower_ascii(data), at)
    hashes = word_hashes(words)
    found = [f for runs in index.runs for f in _leaks_by_runs(words, hashes, index, runs, coverage)]
    return sorted(found, key=lambda f: f[:2])


def _leaks_by_runs(words: Words, word: np.ndarray, index: ItemIndex, runs: Runs, coverage: float) -> list[tuple]:
    """The same for the items whose runs have one length."""
    least = runs.words
    starts = gram_starts(words, least)
    hashes = gram_hashes(word, least)[starts] if len(starts) else np.zeros(0, np.uint64)
    low, high = (np.searchsorted(runs.hashes, hashes, side) for side in ("left", "right"))
    size = high - low
    hit = np.flatnonzero(size)
    if not len(hit):
        return []
    size, low = size[hit], low[hit]
    entry = np.repeat(low - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    spot = np.repeat(starts[hit], size)
    text, item, i = words.text[spot], runs.item[entry], runs.place[entry]
    j = spot - words.first[text]
    # runs of hits along a diagonal
    order = np.lexsort((i, j - i, item, text))
    text, item, i, j = text[order], item[order], i[order], j[order]
    new = np.ones(len(i), bool)
    new[1:] = ((text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (j[1:] - i[1:] != j[:-1] - i[:-1])
               | (i[1:] != i[:-1] + 1))
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(i))) + least - 1
    text, item, i, j = text[begin], item[begin], i[begin], j[begin]
    pair = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (item[1:] != item[:-1])]))
    out = []
    for a, b in zip(pair.tolist(), [*pair[1:].tolist(), len(text)]):
        needed = coverage * index.sizes[item[a]] - 1e-9
        under = np.zeros(int(index.sizes[item[a]]), bool)
        for k in range(a, b):
            under[i[k]:i[k] + length[k]] = True
        if under.sum() < needed:  # no tiling covers more than all matches do
            continue
        tiles = tile(list(zip(i[a:b].tolist(), j[a:b].tolist(), length[a:b].tolist())), least)
        covered = sum(n for _, _, n in tiles)
        if covered >= needed:
            out.append((int(text[a]), int(item[a]), covered / int(index.sizes[item[a]]), sorted(tiles)))
    return out


_TILES = "array<struct<item_at: int, text_at: int, words: int>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least: int = LEAST_WORDS, coverage: float = COVERAGE) -> DataFrame:
    """Pairs ``doc_id, item_id, coverage, tiles`` of at least ``coverage`` of an item's words.

    Words are runs of ASCII letters and digits, lower-cased, and bytes beyond ASCII; a
    character of a script without spaces is a word. An item with fewer than ``least`` words is
    matched as a whole; a single word proves nothing and matches nothing. An item without an id counts, its pairs have a null ``item_id``; null
    texts and texts without words match nothing. Equal texts leak alike, repeated rows repeat their
    pairs, equal items are items of their own. Whole texts are read; other columns are
    not. An empty table on either side gives no pairs.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for index in item_blocks(benchmark, least):
        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, ids = raw_texts(batch.column("text")), batch.column("doc_id")
                for part in text_chunks(texts):
                    found = _leaks(texts[part], index, coverage)
                    tiles = pa.array([[{"item_at": a, "text_at": b, "words": n} for a, b, n in f[3]] for f in found],
                                     pa.list_(pa.struct([(c, pa.int32()) for c in ("item_at", "text_at", "words")])))
                    yield pa.record_batch(
                        [ids.take(pa.array([part.start + f[0] for f in found], pa.int64())),
                         pa.array([index.ids[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64()), tiles],
                        names=["doc_id", "item_id", "coverage", "tiles"])

        pairs = slim.mapInArrow(run, f"doc_id long, item_id long, coverage double, tiles {_TILES}")
        out = pairs if out is None else out.union(pairs)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"doc_id long, item_id long, coverage double, tiles {_TILES}")
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least: int = LEAST_WORDS,
                  coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, that reach the coverage of no item."""
    schema = T.StructType(docs.schema.fields)
    for index in item_blocks(benchmark, least):
        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = raw_texts(batch.column(batch.schema.get_field_index(text_col)))
                clean = np.ones(len(texts), bool)
                for part in text_chunks(texts):
                    clean[[part.start + f[0] for f in _leaks(texts[part], index, coverage)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
