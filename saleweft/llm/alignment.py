"""Alignment of two tokenizers' tokens by the bytes they cover.

A byte-level vocabulary (``tokenizers``) reads a space and the text, a SentencePiece
vocabulary reads the text and adds that space itself, so both cover the same bytes.
The libraries' spans are coarse cuts: character offsets of the first, byte spans of the
second. Where several tokens share a character, or a byte-fallback token has an empty
span, the tokens' decoded bytes say where each ends. Byte offsets at which tokens of both
end cut the text into groups; every token pair of a group is a link.

Texts are encoded in segments. Neither vocabulary joins the two sides of a space that
stands alone between two other characters (checked when the files are loaded; else a
segment is a whole text), so a segment's groups hold wherever it occurs and are worked
out once. A worker remembers segments up to a fixed number.

How many documents hold an id pair linked is counted over the corpus. Each batch of
documents is written once, with its distinct pairs; only those pairs, not the links of
each document, are shuffled to be counted and back to their batch. A pair occurs once
per batch at most, so no key is hot however frequent its tokens are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import plane_bytes, plane_values, settle, worker_memory
from .words import raw_texts, text_chunks

BATCH_BYTES = 2 << 20
MEMO_SEGMENTS = 450_000

PLAIN_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
LINK_COLUMNS = ["n_best", "count_sum"]
PIECE = attrgetter("id", "begin", "end")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(0x100 + k): b for k, b in enumerate(others)}}


@dataclass
class Segment:
    """Groups of one segment: where each ends in bytes, and the ids of both sides in it."""

    ends: list[int]
    a: list[list[int]]
    b: list[list[int]]


class Tokenizers:
    """Both vocabularies, with each token's bytes."""

    # a space between two characters that are no white space to either library
    ALONE = re.compile(r"(?<=\S) (?=\S)")
    PROBE = "é ﬁ ① 　x  y Å Å"

    def __init__(self, byte_level: str, pieces: str):
        import json
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(names)]
        rules = json.loads(self.a.to_str())
        before = rules["pre_tokenizer"] or {}
        apart = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        kept = self.b.normalize(self.PROBE) == "▁" + self.PROBE.replace(" ", "▁")
        self.local = bool(apart and rules["normalizer"] is None and kept
                          and not any("▁" in p.lstrip("▁") for p in names))

    def segments(self, text: str) -> list[str]:
        """Parts of a text; each stands after a space."""
        return self.ALONE.split(text) if self.local else [text]

    def align(self, parts: list[str]) -> list[Segment | None]:
        """The groups of each part with the space before it; None where either side's bytes differ from it."""
        encoded = self.a.encode_batch([" " + p for p in parts], add_special_tokens=False)
        spans = self.b.encode(parts, return_type="proto", num_threads=1)
        return [self._groups((" " + part).encode(), e, s.pieces) for part, e, s in zip(parts, encoded, spans)]

    def _groups(self, data: bytes, encoded, pieces) -> Segment | None:
        a_ids, b_ids = encoded.ids, [p.id for p in pieces]
        a_parts, b_parts = [self.a_bytes[i] for i in a_ids], [self.b_bytes[i] for i in b_ids]
        if b"".join(a_parts) != data or b"".join(b_parts) != data:
            return None
        offsets = encoded.offsets
        if len(data) != offsets[-1][1]:  # characters of several bytes
            place = [0, *np.cumsum([len(c.encode()) for c in data.decode()]).tolist()]
            offsets = [(place[s], place[e]) for s, e in offsets]
        a_ends = refined_ends(offsets, a_parts)
        # spans of the second side start behind the space that it adds
        b_ends = refined_ends([(p.begin + 1, p.end + 1) for p in pieces], b_parts)
        groups, j, at = Segment([], [], []), 0, 0
        shared = sorted(set(a_ends) & set(b_ends))
        for end in shared:
            i = at
            while a_ends[at] < end:
                at += 1
            at += 1
            k = j
            while b_ends[j] < end:
                j += 1
            j += 1
            groups.ends.append(end)
            groups.a.append(a_ids[i:at])
            groups.b.append(b_ids[k:j])
        return groups


def refined_ends(spans: list[tuple[int, int]], parts: list[bytes]) -> list[int]:
    """Where each token ends. A span's end counts unless the token shares bytes with the next or covers none."""
    ends, at = [], 0
    for k, (_, end) in enumerate(spans):
        shared = k + 1 < len(spans) and spans[k + 1][0] < end
        at = at + len(parts[k]) if shared or end != at + len(parts[k]) else end
        ends.append(at)
    return ends


def refined_array(spans: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``refined_ends`` of many tokens whose bytes are known to be those of the text."""
    begin, end = spans[:, 0], spans[:, 1]
    exact = np.cumsum(size)
    shared = np.append(begin[1:] < end[:-1], False)
    return np.where(shared | (end - size != exact - size), exact, end)


class Memory(dict):
    """Numbers of known segments, and what is known of each, in arrays by number."""

    LINE = 128

    def __init__(self, tokenizers: Tokenizers):
        super().__init__()
        self.tokenizers = tokenizers
        self.width = len(tokenizers.b_bytes)
        sides = tokenizers.a_bytes, tokenizers.b_bytes
        self.length = [np.array(list(map(len, side)), np.int64) for side in sides]
        # an id's text within a group and as the last of its side of it
        self.inner, self.last = ([np.array([f"{i}{end}" for i in range(len(side))], object) for side, end in zip(sides, ends)]
                                 for ends in ((",", ","), ("|", ";")))
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.text: list[str] = []
        self.sizes = np.empty((0, 4), np.int64)  # tokens of both sides, groups, links
        self.links = np.empty(0, np.int64)
        self.broken: set[int] = set()

    def learn(self, parts: list[str]) -> None:
        """Aligns parts that are not yet known: together where they can stand side by side, else one by one."""
        plain = [p for p in parts if p and p.strip() == p] if self.tokenizers.local else []
        lines = [plain[k:k + self.LINE] for k in range(0, len(plain), self.LINE)]
        self._learn_lines(lines)
        alone = [p for p in parts if p not in self]
        sizes, links = [], []
        for part, groups in zip(alone, self.tokenizers.align(alone)):
            self[part] = len(self.text)
            if groups is None:
                self.broken.add(len(self.text))
                self.text.append("")
                sizes.append((0, 0, 0, 0))
                continue
            self.text.append(";".join([f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in zip(groups.a, groups.b)]))
            pairs = [i * self.width + j for a, b in zip(groups.a, groups.b) for i in a for j in b]
            sizes.append((sum(map(len, groups.a)), sum(map(len, groups.b)), len(groups.ends), len(pairs)))
            links += pairs
        self._keep(np.array(sizes, np.int64).reshape(-1, 4), np.array(links, np.int64))

    def _keep(self, sizes: np.ndarray, links: np.ndarray) -> None:
        self.sizes = np.concatenate([self.sizes, sizes])
        self.links = np.concatenate([self.links, links])

    def _learn_lines(self, lines: list[list[str]]) -> None:
        """Many segments in one text each; a line that is not given back byte by byte is left to be learnt one by one."""
        both = self.tokenizers
        texts = [" ".join(line) for line in lines]
        encoded = both.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        known: list[str] = []
        parts: list[list[np.ndarray]] = []
        base = 0
        for line, text, e in zip(lines, texts, encoded):
            pieces = both.b.encode(text, return_type="proto", num_threads=1).pieces
            data = (" " + text).encode()
            # rows of id, begin, end of either side
            spans = np.fromiter(chain.from_iterable(map(PIECE, pieces)), np.int64).reshape(-1, 3)
            a, b = np.array(e.ids), spans[:, 0]
            if b"".join(map(both.a_bytes.__getitem__, e.ids)) != data or b"".join(map(both.b_bytes.__getitem__, b.tolist())) != data:
                continue
            offsets = np.fromiter(chain.from_iterable(e.offsets), np.int64).reshape(-1, 2)
            if len(data) > len(text) + 1:  # characters of several bytes
                first = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
                offsets = np.append(np.flatnonzero(first), len(data))[offsets]
            # spans of the second side start behind the space that it adds
            ends = [refined_array(offsets, self.length[0][a]), refined_array(spans[:, 1:] + 1, self.length[1][b])]
            stop = np.cumsum([len(p.encode()) + 1 for p in line])
            parts.append([a, ends[0] + base, b, ends[1] + base, stop + base])
            known += line
            base += len(data)
        if not known:
            return
        a, a_end, b, b_end, stop = (np.concatenate(c) for c in zip(*parts))
        ends = np.zeros((2, base + 1), bool)
        ends[0, a_end] = ends[1, b_end] = True
        both_end = ends.all(axis=0)
        if not both_end[stop].all():
            return
        cuts = np.flatnonzero(both_end)
        of_a, of_b, owner = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end), np.searchsorted(stop, cuts)
        n_a, n_b = np.bincount(of_a), np.bincount(of_b)
        first_b = np.cumsum(n_b) - n_b
        times = n_b[of_a]
        other = np.arange(int(times.sum())) + np.repeat(first_b[of_a] - np.cumsum(times) + times, times)
        links = np.repeat(a, times).astype(np.int64) * self.width + b[other]
        # ids in the order of their text: a group's first side, then its second
        words = np.empty(len(a) + len(b), object)
        for ids, of, place, side in ((a, of_a, np.arange(len(a)) + first_b[of_a], 0),
                                     (b, of_b, np.arange(len(b)) + np.cumsum(n_a)[of_b], 1)):
            ends_group = np.append(of[1:] != of[:-1], True)
            words[place] = np.where(ends_group, self.last[side][ids], self.inner[side][ids])
        tokens = np.bincount(owner, n_a + n_b, len(stop)).astype(np.int64)
        end = np.cumsum(tokens).tolist()
        words = words.tolist()
        self.update(zip(known, range(len(self.text), len(self.text) + len(known))))
        self.text += ["".join(words[i:j])[:-1] for i, j in zip([0, *end], end)]
        counts = [np.bincount(owner, w, len(stop)).astype(np.int64) for w in (n_a, n_b, np.ones(len(cuts)), n_a * n_b)]
        self._keep(np.stack(counts, axis=1), links)

    def groups(self, number: int) -> Iterator[tuple[int, list[int], list[int]]]:
        """Bytes and both sides' ids of each group of a segment."""
        for group in self.text[number].split(";"):
            a, b = (list(map(int, side.split(","))) for side in group.split("|"))
            yield int(self.length[0][a].sum()), a, b

    def numbers(self, texts: list[bytes | None]) -> list[list[int]]:
        """The segments of each text by number; none for a text without tokens."""
        if len(self) > MEMO_SEGMENTS:
            self.forget()
        parts = [self.tokenizers.segments(t) if t else [] for t in map(decoded, texts)]
        found = [list(map(self.get, p)) for p in parts]
        new = {w for p, f in zip(parts, found) if None in f for w, k in zip(p, f) if k is None}
        if new:
            self.learn(list(new))
            found = [list(map(self.get, p)) if None in f else f for p, f in zip(parts, found)]
        return [f if self.broken.isdisjoint(f) else [] for f in found] if self.broken else found


def decoded(text: bytes | None) -> str:
    """A text's characters; empty where its bytes are not UTF-8, which no vocabulary gives back."""
    try:
        return (text or b"").decode()
    except UnicodeDecodeError:
        return ""


def memory_of(byte_level: str, pieces: str) -> Memory:
    """The memory of this worker process, kept from task to task."""
    return worker_memory(("alignment", byte_level, pieces), lambda: Memory(Tokenizers(byte_level, pieces)))


def token_groups(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per group: ``doc_id, group, start, end, a_ids, b_ids``, offsets in bytes of a space and the text.

    Texts without tokens (null, empty, not given back byte by byte) have no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memory_of(byte_level, pieces)
        for batch in batches:
            texts, ids = raw_texts(batch.column(1)), batch.column(0).to_pylist()
            for part in text_chunks(texts, BATCH_BYTES):
                rows = []
                for doc_id, numbers in zip(ids[part], known.numbers(texts[part])):
                    at = 0
                    every = (g for k in numbers for g in known.groups(k))
                    for k, (size, a, b) in enumerate(every):
                        rows.append((doc_id, k, at, at + size, a, b))
                        at += size
                columns = list(zip(*rows)) if rows else [[]] * 6
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * 2
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    names = ["doc_id", "group", "start", "end", "a_ids", "b_ids"]
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, group long, start long, end long, a_ids array<int>, b_ids array<int>")


_BATCH = ("batch long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, groups_sha256 array<string>, pairs array<long>, holders array<long>, "
          "sizes binary, places binary, times binary")


def aligned_batches(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Rows of about 2 MB of documents: results of each, the batch's id pairs and which document links which how often.

    ``pairs`` ascends and holds a id * width + b id; ``holders`` says how many of the batch's
    documents link each. ``sizes``, ``places`` and ``times`` are each document's number of
    pairs, their places in ``pairs`` and how often it links each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memory_of(byte_level, pieces)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for part in text_chunks(texts, BATCH_BYTES):
                found = known.numbers(texts[part])
                plain, sha, linked = _summary(known, found)
                row = [pa.array([number]), *[_one(c) for c in (batch.column(0)[part.start:part.stop], *plain.T, sha, *linked[:2])],
                       *[pa.array([plane_bytes(c)], pa.binary()) for c in linked[2:]]]
                yield pa.record_batch(row, names=[f.split()[0] for f in _BATCH.split(", ")])
                number += 1

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, _BATCH)


def _one(values) -> pa.ListArray:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _summary(known: Memory, found: list[list[int]]) -> tuple[np.ndarray, list[str], list[np.ndarray]]:
    """Per document: counts and the hash of its groups; and the links of all documents."""
    sha = [hashlib.sha256(";".join(map(known.text.__getitem__, f)).encode()).hexdigest() if f else "" for f in found]
    count = np.fromiter(map(len, found), np.int64, len(found))
    owner = np.repeat(np.arange(len(found)), count)
    number = np.fromiter(chain.from_iterable(found), np.int64, len(owner))
    plain = np.stack([np.bincount(owner, known.sizes[number, k], len(found)).astype(np.int64) for k in range(4)], axis=1)
    size = known.sizes[:, 3]
    first, each = (np.cumsum(size) - size)[number], size[number]
    stop = np.cumsum(each)
    links = known.links[np.arange(int(each.sum())) + np.repeat(first - stop + each, each)]
    pairs, place = np.unique(links, return_inverse=True)
    holds, times = np.unique(np.repeat(owner, each) * max(len(pairs), 1) + place, return_counts=True)
    holder, place = np.divmod(holds, max(len(pairs), 1))
    return plain, sha, [pairs, np.bincount(place, minlength=len(pairs)).astype(np.int64),
                        np.bincount(holder, minlength=len(found)).astype(np.int64), place, times.astype(np.int64)]


def link_counts(batches: DataFrame, width: int) -> DataFrame:
    """``pair, a_id, b_id, n`` documents that link it, ``best``: whether that is its a id's highest count."""
    each = batches.select(F.inline(F.arrays_zip("pairs", "holders"))).toDF("pair", "holders")
    counts = each.groupBy("pair").agg(F.sum("holders").alias("n"))
    a_id = F.floor(F.col("pair") / F.lit(width)).cast("long")
    # an a id has at most as many pairs as the other vocabulary has entries
    highest = F.max("n").over(Window.partitionBy("a_id"))
    return counts.withColumn("a_id", a_id).select(
        "pair", "a_id", (F.col("pair") - F.col("a_id") * F.lit(width)).alias("b_id"), "n",
        (F.col("n") == highest).alias("best"))


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` are links whose pair is held by the most documents of all pairs of its first
    id, ``count_sum`` the sum of those counts over the links; a row counts as a document,
    whether or not its id is null or repeats. Null and empty texts, and texts whose tokens'
    bytes are not the space and the text, have zeros and an empty hash. Other columns are
    not read. An empty table gives an empty table. The vocabulary files must be reachable
    by every executor.
    """
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    batches = settle(aligned_batches(docs, byte_level, pieces, id_col, text_col), "aligned-batches")
    counts = settle(link_counts(batches, width), "link-counts")
    each = batches.select("batch", F.posexplode("pairs").alias("place", "pair"))
    known = each.join(counts.select("pair", "n", "best"), "pair").groupBy(F.col("batch").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("known"))
    joined = batches.join(known, F.col("batch") == F.col("of"), "left").select(
        *PLAIN_COLUMNS, "groups_sha256", "sizes", "places", "times",
        F.col("known.n").alias("n"), F.col("known.best").alias("best"))
    schema = ", ".join(f"{c} long" for c in [*PLAIN_COLUMNS, *LINK_COLUMNS]) + ", groups_sha256 string"
    return joined.mapInArrow(_resolved, schema)


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for k in range(len(rows)):
            row = rows.slice(k, 1)
            one = {c: row.column(row.schema.get_field_index(c)) for c in row.schema.names}
            size, place, times = (plane_values(one[c][0].as_py(), np.int64) for c in ("sizes", "places", "times"))
            n = np.zeros(0, np.int64) if one["n"][0].as_py() is None else one["n"].flatten().to_numpy()
            best = np.zeros(0, bool) if not len(n) else one["best"].flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(size)), size)
            totals = [np.bincount(owner, minlength=len(size)) * 0 for _ in LINK_COLUMNS]
            for total, worth in zip(totals, (best[place].astype(np.int64), n[place]) if len(n) else ()):
                np.add.at(total, owner, worth * times)
            yield pa.record_batch(
                [*[one[c].flatten() for c in PLAIN_COLUMNS], *map(pa.array, totals), one["groups_sha256"].flatten()],
                names=[*PLAIN_COLUMNS, *LINK_COLUMNS, "groups_sha256"])
