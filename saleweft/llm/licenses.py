"""Licence notices through a positional rare-token index.

Notices and phrases are word templates. How many documents use each of their words is
counted over all documents; a template's rarest words (highest inverse document
frequency) are its postings: word, template, place in the template. Two of them are the
rarest of its mandatory key phrase, so a file with the whole phrase proposes it whatever the
counts are. Every place where such a word stands in a file proposes a start, the places of a
template's postings are intersected on that start, and what remains must hold the key
phrase word by word.
Phrases have one posting, their rarest word, so every place of a phrase is proposed.

The index is made of the templates and is small; the files are read in one pass after
the counts, each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .words import Words, find_words, joined, lower_ascii, raw_texts, text_chunks, word_hashes

RARE_WORDS = 3
NEEDED_VOTES = 2

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
"""Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing."""

PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

TEMPLATES = [  # label, words of the notice, mandatory key phrase
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2",
     "gnu general public license version 2"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
     "general public license as published by the free software foundation either version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
     "general public license as published by the free software foundation either version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "permission to use copy modify and or distribute this software"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
]


@dataclass
class Template:
    label: str
    hashes: np.ndarray
    key_at: int
    key_size: int
    phrase: bool
    postings: list[tuple[int, int]]
    needed: int


def _hash_words(words: list[str]) -> np.ndarray:
    data, at = joined([" ".join(words).encode()])
    return word_hashes(find_words(data, at, WORD_BYTES))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[slice, Words, np.ndarray]]:
    texts = raw_texts(batch.column("text"))
    for part in text_chunks(texts):
        data, at = joined(texts[part])
        words = find_words(lower_ascii(data), at, WORD_BYTES)
        yield part, words, word_hashes(words)


def _places(hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the wanted words, and which of the (ascending) wanted each is."""
    which = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
    at = np.flatnonzero(wanted[which] == hashes)
    return at, which[at]


def word_documents(docs: DataFrame, words: list[str], text_col: str = "text") -> dict[str, int]:
    """How many documents use each of a short list of words."""
    words = sorted(set(words))
    hashes = _hash_words(words)
    order = np.argsort(hashes)
    wanted = hashes[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for _, text, found in _chunks(batch):
                at, which = _places(found, wanted)
                pairs = np.unique(text.text[at] * len(wanted) + which)
                seen += np.bincount(pairs % len(wanted), minlength=len(wanted))
        yield pa.record_batch([pa.array(np.arange(len(wanted))), pa.array(seen)], names=["word", "documents"])

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word long, documents long")
    total = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("documents").alias("n")).collect()}
    return {words[int(order[w])]: int(n) for w, n in total.items()}


def build_index(counts: dict[str, int], phrases: list = PHRASES, templates: list = TEMPLATES) -> list[Template]:
    """Templates with their postings, the words that the fewest documents use."""
    out = []
    for label, text, key, phrase in [*((a, b, b, True) for a, b in phrases), *((a, b, c, False) for a, b, c in templates)]:
        words, key_words = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(key_words)] == key_words)
        rarest = sorted(range(len(words)), key=lambda i: (counts.get(words[i], 0), i))
        inside = [i for i in rarest if at <= i < at + len(key_words)][:1 if phrase else NEEDED_VOTES]
        more = [] if phrase else [i for i in rarest if i not in inside][:RARE_WORDS - len(inside)]
        postings = [(int(_hash_words([words[i]])[0]), i) for i in [*inside, *more]]
        out.append(Template(label, _hash_words(words), at, len(key_words), phrase, postings, len(inside)))
    return out


_MATCH = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
    T.StructField("words", T.LongType()), T.StructField("share", T.DoubleType())]))


def find_licences(docs: DataFrame, index: list[Template], text_col: str = "text") -> DataFrame:
    """One row per input row: ``row`` (all columns but the text), ``n_words``, ``phrases``, ``notices``.

    ``phrases`` has every place of every phrase, ``notices`` every verified template with
    the share of its words that stand in place; both name the first word's position.
    Whole texts are read; null and empty texts have no words and no matches. Repeated
    rows give repeated results, an empty table an empty one. Other columns stay in
    ``row`` whatever their names.
    """
    wanted = np.unique(np.array([h for t in index for h, _ in t.postings], np.uint64))
    others = [c for c in docs.columns if c != text_col]
    row = T.StructType([docs.schema[c] for c in others])
    schema = T.StructType([T.StructField("row", row), T.StructField("n_words", T.LongType()),
                           T.StructField("phrases", _MATCH), T.StructField("notices", _MATCH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, hashes in _chunks(batch):
                phrases, notices = _matches(words, hashes, index, wanted)
                n = part.stop - part.start
                yield pa.record_batch(
                    [batch.column("row").slice(part.start, n), pa.array(words.count),
                     _column(phrases, n), _column(notices, n)], names=["row", "n_words", "phrases", "notices"])

    return docs.select(F.struct(*others).alias("row"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _matches(words: Words, hashes: np.ndarray, index: list[Template], wanted: np.ndarray) -> tuple[list, list]:
    at, which = _places(hashes, wanted)
    found: tuple[list, list] = ([], [])
    first, total = words.first, len(hashes)
    for template in index if len(at) else []:
        places = [at[which == np.searchsorted(wanted, np.uint64(h))] - i for h, i in template.postings]
        starts, votes = np.unique(np.concatenate(places), return_counts=True)
        starts = starts[votes >= template.needed]
        key = starts[(starts + template.key_at >= 0) & (starts + template.key_at + template.key_size <= total)]
        if not len(key):
            continue
        spot = key[:, None] + template.key_at + np.arange(template.key_size)
        wording = template.hashes[template.key_at:template.key_at + template.key_size]
        one_text = words.text[spot[:, 0]] == words.text[spot[:, -1]]
        good = key[(hashes[spot] == wording).all(axis=1) & one_text]
        owner = words.text[good + template.key_at]
        spot = good[:, None] + np.arange(len(template.hashes))
        inside = (spot >= 0) & (spot < total)
        spot = np.clip(spot, 0, max(total - 1, 0))
        there = inside & (hashes[spot] == template.hashes) & (words.text[spot] == owner[:, None])
        share = there.mean(axis=1) if len(good) else np.zeros(0)
        begin = np.maximum(good - first[owner], 0)
        found[not template.phrase].extend(zip(owner.tolist(), [template.label] * len(good), begin.tolist(),
                                              [len(template.hashes)] * len(good), share.tolist()))
    return found


def _column(matches: list[tuple], n: int) -> pa.ListArray:
    matches = sorted(matches)
    owner = np.array([m[0] for m in matches], np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    names = ["label", "first", "words", "share"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64()]
    columns = [pa.array([m[k + 1] for m in matches], kind) for k, kind in enumerate(kinds)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, names))


def scan_licences(docs: DataFrame, text_col: str = "text",
                  phrases: list = PHRASES, templates: list = TEMPLATES) -> DataFrame:
    """Count the words, build the index, find the licences."""
    vocabulary = [w for _, text, *_ in [*phrases, *templates] for w in text.split()]
    index = build_index(word_documents(docs, vocabulary, text_col), phrases, templates)
    return find_licences(docs, index, text_col)
