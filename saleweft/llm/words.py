"""Array helpers on UTF-8 text inside a task: words, word hashes, shingle hashes.

Texts of one Arrow batch are cut into chunks of a few megabytes. A chunk is one
byte array in which every text is followed by a separator, so that no word
spans two texts. All functions work on whole chunks, without a loop per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 2 << 20

SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False
"""Bytes of words ``[^\\x20\\x09-\\x0D]+``."""

_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_LONG_WORD = 256


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a chunk: byte positions, the text each belongs to, and words per text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    count: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of the first word of each text."""
        return np.cumsum(self.count) - self.count


def text_chunks(texts: list[bytes | None], most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of a list of texts of about ``most`` bytes; a longer text stands alone."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts))


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column. Memory that earlier batches left is given back."""
    pa.default_memory_pool().release_unused()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array of all texts, each followed by a space, and where each starts."""
    data = np.frombuffer(b" ".join([t or b"" for t in texts]) + b" ", np.uint8)
    sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    return data, np.cumsum(sizes) - sizes


def find_words(data: np.ndarray, text_start: np.ndarray, word_bytes: np.ndarray = SPACE_SEPARATED) -> Words:
    """Maximal runs of word bytes."""
    inside = word_bytes[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    text = np.searchsorted(text_start, start, "right") - 1
    return Words(data, start, end, text, np.bincount(text, minlength=len(text_start)).astype(np.int64))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def lanes(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """At each position the value of the bytes from there on; the end is padded with zeros."""
    width = np.dtype(kind).itemsize
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    return np.ndarray((len(data) + 1,), kind, padded, strides=(1,))


_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    size = words.end - words.start
    h = size.astype(np.uint64) * _C1
    view = lanes(words.data)
    todo = np.arange(len(size))
    for k in range(_LONG_WORD // 8):
        if not len(todo):
            break
        lane = view[words.start[todo] + 8 * k] & _KEEP[np.minimum(size[todo] - 8 * k, 8)]
        h[todo] = mix(h[todo] ^ lane) + _C1
        todo = todo[size[todo] > 8 * (k + 1)]
    raw = words.data
    for i in todo:  # very long words
        h[i] = xxhash.xxh64_intdigest(raw[words.start[i]:words.end[i]].tobytes(), 1)
    return h


def gram_hashes(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions have none."""
    m = max(0, len(hashes) - n + 1)
    out = np.full(m, np.uint64(seed) + _C2)
    for k in range(n):
        out = (out ^ hashes[k:k + m]) * _C1
        out ^= out >> np.uint64(29)
    return mix(out)


def gram_starts(words: Words, n: int) -> np.ndarray:
    """Positions from which n words stand in one text."""
    m = max(0, len(words.text) - n + 1)
    return np.flatnonzero(words.text[:m] == words.text[n - 1:])


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579,
    2870177450012600261))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64_spans(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte spans. Spans of equal size are hashed together."""
    out = np.empty(len(start), np.uint64)
    if not len(start):
        return out
    eight, four = lanes(data), lanes(data, "<u4")
    short = size <= _LONG_WORD
    order = np.flatnonzero(short)
    order = order[np.argsort(size[order].astype(np.uint16), kind="stable")]
    edges = np.flatnonzero(np.diff(size[order])) + 1
    s = np.uint64(seed)
    with np.errstate(over="ignore"):
        for part in np.split(order, edges):
            if not len(part):
                continue
            n, at = int(size[part[0]]), start[part]
            done = 0
            if n >= 32:
                acc = [np.full(len(part), v) for v in (s + _P1 + _P2, s + _P2, s, s - _P1)]
                while done + 32 <= n:
                    acc = [_round(a, eight[at + done + 8 * i]) for i, a in enumerate(acc)]
                    done += 32
                h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
                for a in acc:
                    h = (h ^ _round(np.zeros_like(a), a)) * _P1 + _P4
            else:
                h = np.full(len(part), s + _P5)
            h = h + np.uint64(n)
            while done + 8 <= n:
                h = _rotl(h ^ _round(np.zeros_like(h), eight[at + done]), 27) * _P1 + _P4
                done += 8
            if done + 4 <= n:
                h = _rotl(h ^ (four[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
                done += 4
            while done < n:
                h = _rotl(h ^ (data[at + done].astype(np.uint64) * _P5), 11) * _P1
                done += 1
            h = (h ^ (h >> np.uint64(33))) * _P2
            h = (h ^ (h >> np.uint64(29))) * _P3
            out[part] = h ^ (h >> np.uint64(32))
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + size[i]].tobytes(), seed)
    return out


_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def bit_counts(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many of each text's hashes have each bit set: one row of 64 counts per text.

    ``count`` says how many consecutive hashes belong to each text. Eight bits are
    counted at once in the bytes of a word, over runs of at most 255 hashes.
    """
    out = np.zeros((len(count), 64), np.int64)
    if not len(hashes):
        return out
    runs = -(-count // 255)
    first = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(count)), runs)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = first[owner] + 255 * within
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    per_run = np.empty((len(starts), 64), np.int64)
    for k in range(8):
        total = np.add.reduceat(_SPREAD[octets[:, k]], starts)
        per_run[:, 8 * k:8 * k + 8] = total.view(np.uint8).reshape(-1, 8)
    filled = np.flatnonzero(runs)
    out[filled] = np.add.reduceat(per_run, (np.cumsum(runs) - runs)[filled], axis=0)
    return out


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of 64 truth values as unsigned 64-bit numbers, column b as bit b."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
