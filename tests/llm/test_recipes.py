"""Exact copies by chunk recipes, against plain comparison of texts."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from saleweft.llm.recipes import chunk_table, chunks, exact_copies, recipes, verified_words

from .conftest import lower_az


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower_az(t), []).append(i)
    out = []
    for i, t in rows:
        same = groups[lower_az(t)]
        keep = max((x for x in same if x is not None), default=None)
        out.append((i, keep, len(same), hashlib.sha256(lower_az(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(rows, frame, **options):
    got = exact_copies(frame, **options).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected(rows)
    kept = [(r.text_sha256, r.doc_id) for r in got if r.kept]
    assert len(kept) == len({s for s, _ in kept}) == len({lower_az(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_awkward_rows(messy, messy_rows):
    check([(r[0], r[1]) for r in messy_rows], messy)


def test_nothing(nothing):
    assert exact_copies(nothing).collect() == []


def test_only_a_to_z_are_folded(spark):
    rows = [(1, "ÉTÉ Straße ΣΑΣ İ K"), (2, "Été Straße ΣΑΣ İ K"), (3, "ÉtÉ STRAßE ΣΑΣ İ k"),
            (4, "été straße σας i̇ k"), (5, "PLAIN"), (6, "plain"), (7, "ﬁ Ⅷ Ⓐ Ж"), (8, "ﬁ ⅷ ⓐ ж")]
    check(rows, spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("bits", [64, 4])
def test_documents_whatever_the_length_of_identifiers(documents, bits):
    """With 4 bits a hash, chunks share identifiers until they are long enough."""
    check([(r.doc_id, r.text) for r in documents.collect()], documents, bits=bits)


def test_identifiers_grow_until_no_two_contents_share_one(documents):
    assert verified_words(documents) == 2
    words = verified_words(documents, bits=4)
    assert words > 2
    table = chunk_table(documents, words, bits=4).collect()
    assert len({tuple(r.identifier) for r in table}) == len({r.chunk for r in table}) == len(table)


def test_chunks_are_the_text_and_follow_its_content(spark):
    rng = random.Random(5)
    body = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz é日 ") for _ in range(20_000))
    rows = [(0, body), (1, "something else before it, " + body), (2, "日" * 5000), (3, ""), (4, "x")]
    cut = {r.k: [bytes(c, "latin-1") for c in r.c] for r in
           spark.createDataFrame(rows, "k int, text string").select("k", chunks(F.col("text")).alias("c")).collect()}
    for k, text in rows:
        assert b"".join(cut[k]) == text.encode() and all(0 < len(c) <= 4096 for c in cut[k])
        assert all(len(c) >= 256 for c in cut[k][:-1])
    assert len(set(cut[0]) & set(cut[1])) > 0.9 * len(cut[0]) > 10
    assert max(map(len, cut[2])) == 4096


def test_recipes_are_lists_of_chunk_identifiers(documents):
    known = {tuple(r.identifier): r.chunk for r in chunk_table(documents).collect()}
    texts = {r.doc_id: lower_az(r.text) for r in documents.collect()}
    for r in recipes(documents).collect():
        parts = [known[tuple(r.recipe[k:k + 2])] for k in range(0, len(r.recipe), 2)]
        assert "".join(parts).encode("latin-1") == texts[r.doc_id].encode()


def test_copies_spread_over_tasks(spark):
    """Six of seven rows are copies; with slices no key of the joins has more than a few of them."""
    rows = [(k, "the same text" if k % 7 else f"text {k}") for k in range(7000)]
    check(rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_no_python_in_the_plan(documents):
    plan = exact_copies(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
