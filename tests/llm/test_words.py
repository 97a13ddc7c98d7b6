"""Array helpers against plain code."""

from __future__ import annotations

import numpy as np
import xxhash

from saleweft.llm import words as w

from .conftest import words_of

TEXTS = [b"", None, b" a  b\n", "é 日本 語".encode(), b"q" * 3000, b"one two three four five " * 80, b"\t\x0b\x0c\r"]


def test_words_are_the_pattern_s_words():
    data, at = w.joined(TEXTS)
    found = w.find_words(data, at)
    spelled = [data[a:b].tobytes().decode() for a, b in zip(found.start, found.end)]
    assert spelled == [x for t in TEXTS for x in words_of((t or b"").decode())]
    assert found.count.tolist() == [len(words_of((t or b"").decode())) for t in TEXTS]


def test_equal_words_and_only_they_have_equal_hashes():
    data, at = w.joined(TEXTS + [b"qq", b"q", b"four"])
    found = w.find_words(data, at)
    hashes = w.word_hashes(found).tolist()
    spelled = [data[a:b].tobytes() for a, b in zip(found.start, found.end)]
    assert len(set(hashes)) == len(set(spelled)) == len(set(zip(hashes, spelled)))


def test_spans_hash_as_the_library_hashes_them():
    random = np.random.default_rng(0)
    data = random.integers(0, 256, 5000).astype(np.uint8)
    size = np.concatenate([np.arange(300), [0, 1, 31, 32, 33, 1000]])
    start = random.integers(0, 4000, len(size))
    expected = [xxhash.xxh64_intdigest(data[a:a + n].tobytes(), 42) for a, n in zip(start, size)]
    assert w.xxh64_spans(data, start, size).tolist() == expected


def test_bit_counts_of_long_and_empty_texts():
    random = np.random.default_rng(1)
    count = np.array([0, 3, 0, 255, 256, 1000, 0])
    hashes = random.integers(0, 2 ** 63, count.sum()).astype(np.uint64)
    got, at = w.bit_counts(hashes, count), 0
    for row, n in zip(got, count):
        part = hashes[at:at + n].tolist()
        at += n
        assert row.tolist() == [sum(h >> b & 1 for h in part) for b in range(64)]


def test_chunks_hold_every_text_once():
    parts = list(w.text_chunks([b"x" * n for n in (5, 0, 50, 1, 1)], 10))
    assert [i for p in parts for i in range(p.start, p.stop)] == [0, 1, 2, 3, 4]
    assert list(w.text_chunks([])) == []
