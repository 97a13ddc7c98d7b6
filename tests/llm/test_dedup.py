"""Substring removal, near-duplicates and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from saleweft.llm import neardup
from saleweft.llm.components import connected_components
from saleweft.llm.neardup import bit_segments, fingerprint_links, first_of_groups, gray_rank, near_duplicate_groups
from saleweft.llm.substring import cut_repeats

from .conftest import Links, lower_az, words_of


def brute_cut(rows, window=13):
    """Per row: words, and which of them go."""
    first = {}
    split = [(i, words_of(t)) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            seen = first.get(tuple(w[k:k + window]))
            if seen is not None and (i is None or seen < i):
                gone[k:k + window] = [True] * window
        out.append((i, w, gone))
    return out


def as_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_cut_equals_brute_force_on_awkward_rows(messy, messy_rows):
    got = as_rows(cut_repeats(messy), "row.doc_id", "n_words", "n_removed", "kept")
    expected = [(i, len(w), sum(g), " ".join(x for x, gone in zip(w, g) if not gone))
                for i, w, g in brute_cut([(r[0], r[1]) for r in messy_rows])]
    assert got == sorted(expected, key=repr)


def test_cut_keeps_other_columns_and_names_the_runs(messy):
    cut = cut_repeats(messy)
    assert cut.schema["row"].dataType.names == [c for c in messy.columns if c != "text"]
    for r in cut.collect():
        assert sum(s.last - s.first + 1 for s in r.removed) == r.n_removed
        assert r.row.kept == "k" and r.row.n_words == 7


def test_cut_with_spacing_leaves_clean_texts_alone(messy, messy_rows):
    texts = {r[0]: r[1] for r in messy_rows if r[0] is not None}
    for r in cut_repeats(messy, keep_spacing=True).where("row.doc_id is not null").collect():
        if r.n_removed == 0:
            assert r.kept == (texts[r.row.doc_id] or "")
        else:
            assert len(words_of(r.kept)) == r.n_words - r.n_removed


def test_cut_of_nothing(nothing):
    assert cut_repeats(nothing).count() == 0


@pytest.mark.parametrize("window", [3, 8])
def test_cut_with_other_windows(spark, window):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    got = as_rows(cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=window),
                  "row.doc_id", "n_removed")
    assert got == sorted(((i, sum(g)) for i, _, g in brute_cut(rows, window)), key=repr)


def brute_mark(text, n):
    w = words_of(lower_az(text))
    grams = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(marks, radius):
    links, items = Links(), sorted(marks.items())
    for k, (a, x) in enumerate(items):
        for b, y in items[k:]:
            if bin(x ^ y).count("1") <= radius:
                links.link(a, b)
    return {i: links.find(i) for i in marks}


def unsigned(value):
    return value & (1 << 64) - 1


def test_groups_equal_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    marks = {r.doc_id: brute_mark(r.text, 4) for r in rows if len(r.text or "") < 20_000}
    got = {r.doc_id: r for r in near_duplicate_groups(documents).collect()}
    assert all(unsigned(got[i].f0) == m for i, m in marks.items())
    all_marks = {i: unsigned(r.f0) for i, r in got.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_groups(all_marks, 4)


def test_groups_of_awkward_rows(messy, messy_rows):
    got = near_duplicate_groups(messy).collect()
    assert len(got) == len(messy_rows)
    of = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert of[2] == of[3] == of[4] == 2 and of[15] == 1 and of[14] == 13 and of[9] == of[8]
    assert [r.component_id for r in got if r.doc_id is None and r.f0 == 0] == [2]
    assert unsigned(next(r.f0 for r in got if r.doc_id == 5)) == brute_mark("word", 4)


def test_groups_of_nothing(nothing):
    assert near_duplicate_groups(nothing).count() == 0


def crowded(rng, n):
    centre = [rng.getrandbits(64) for _ in range(6)]
    marks = {i: rng.choice(centre) ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randint(0, 4))}) for i in range(n)}
    return marks


def test_large_buckets_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 20)
    marks = crowded(random.Random(5), 400)
    distinct = {}
    for i, m in marks.items():
        distinct.setdefault(m, i)
    frame = spark.createDataFrame([(i, m - (1 << 64) if m >> 63 else m) for m, i in distinct.items()], "node long, f0 long")
    links = fingerprint_links(frame, 1, 4, bit_segments(list(range(64)), 5))
    assert links.where("a = b").count() == 0
    groups = {r.node: r.component for r in connected_components(links).collect()}
    expected = brute_groups({i: m for m, i in distinct.items()}, 4)
    assert {i: groups.get(i, i) for i in expected} == expected


def test_linking_skips_nothing_in_one_dense_bucket():
    marks = crowded(random.Random(9), 1500)
    distinct = {m: i for i, m in reversed(marks.items())}
    node = np.array(list(distinct.values()))
    a, b = neardup.linked(np.zeros(len(node), np.int64), node, np.array([list(distinct)], np.uint64), 4)
    links = Links()
    for x, y in zip(a.tolist(), b.tolist()):
        links.link(x, y)
    assert len(a) < len(node)
    assert {i: links.find(i) for i in node.tolist()} == brute_groups({i: m for m, i in distinct.items()}, 4)


def test_gray_neighbours_differ_in_one_bit():
    codes = np.arange(64, dtype=np.uint64) ^ (np.arange(64, dtype=np.uint64) >> np.uint64(1))
    assert gray_rank(codes[None]).ravel().tolist() == list(range(64))
    numbers = [0, 1, (1 << 64) - 1, 1 << 64, (1 << 64) + 1, (1 << 127) + 12345, (1 << 128) - 1]
    wide = [n ^ n >> 1 for n in numbers]
    words = np.array([[c >> 64 for c in wide], [c & (1 << 64) - 1 for c in wide]], np.uint64)
    assert [(int(h) << 64) + int(low) for h, low in gray_rank(words).T] == numbers


def test_first_of_groups_keeps_one_row_of_each(documents):
    rows = {r.doc_id: r for r in documents.collect()}
    groups = {r.doc_id: r.component_id for r in near_duplicate_groups(documents).collect()}
    kept = first_of_groups(documents)
    assert kept.columns == documents.columns
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == set(groups.values()) and all(rows[i] == r for i, r in got.items()) and len(got) < len(rows)


def varied(rng, words, n):
    at = rng.randrange(len(words) - n)
    return words[:at] + [f"x{rng.getrandbits(40)}" for _ in range(n)] + words[at + n:]


def test_rows_go_not_ids(spark):
    """An id may stand for several texts, rows may have no id, and whole rows may repeat."""
    rng = random.Random(12)
    a, b, c, d = ([f"w{rng.getrandbits(30)}" for _ in range(400)] for _ in range(4))
    near = varied(rng, a, 1)
    rows = [(1, a), (5, a), (5, b), (5, b), (7, near), (None, c), (None, c), (9, c), (None, d), (None, d), (None, near)]
    rows = [(i, " ".join(w), {"k": "v"}) for i, w in rows] + [(20, "", None), (21, None, None), (None, " ", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tags map<string, string>").repartition(3)
    assert abs(brute_mark(" ".join(a), 4) ^ brute_mark(" ".join(near), 4)).bit_count() <= 4
    got = sorted(((r.doc_id, r.text) for r in first_of_groups(frame).collect()), key=repr)
    text = {k: " ".join(w) for k, w in zip("abcd", (a, b, c, d))}
    assert got == sorted([(1, text["a"]), (5, text["b"]), (9, text["c"]), (None, text["d"]), (20, "")], key=repr)


def test_a_long_chain_of_unlike_documents_is_one_group(spark, monkeypatch):
    """Neighbours in the chain link, others do not; 3,000 links end in one component."""
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 100)
    rng, mark, marks = random.Random(1), 0, []
    for k in range(3000):
        for b in rng.sample(range(64), 4):
            mark ^= 1 << b
        marks.append(mark)
    frame = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in set(marks)], "f0 long").selectExpr("f0 AS node", "f0")
    links = fingerprint_links(frame, 1, 4, bit_segments(list(range(64)), 5))
    assert connected_components(links).select("component").distinct().count() == 1


def test_components_of_random_links(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)]
    pairs += [(5000, k) for k in range(5001, 5400)] + [(7, 7), (None, 4), (4, None)]
    links = Links()
    for a, b in pairs:
        if a is not None and b is not None:
            links.link(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {n: c for n, c in got.items()} == {n: links.find(n) for n in got}
    assert set(links.up) <= set(got)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_are_collapsed_before_they_are_dealt(documents):
    copies = documents.withColumn("doc_id", F.col("doc_id") + 1_000_000).union(documents)
    of = {r.doc_id: r.component_id for r in near_duplicate_groups(copies).collect()}
    assert all(of[i + 1_000_000] == of[i] for i in of if i < 1_000_000)
