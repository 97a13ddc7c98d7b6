"""Token alignment against whole texts encoded and compared byte by byte."""

from __future__ import annotations

import base64
import hashlib
import random
from bisect import bisect_left
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from saleweft.llm import alignment
from saleweft.llm.alignment import Tokenizers, align_tokenizers, token_groups

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as ranks:
            self.a_bytes = {int(i): base64.b64decode(t) for t, i in map(bytes.split, ranks)}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        data = (" " + text).encode()
        sides = [], []
        for ids, of, side in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes.__getitem__, sides[0]),
                              (self.b.encode(text), self.b_bytes, sides[1])):
            at = 0
            for i in ids:
                at += len(of(i))
                side.append((at, i))
            if b"".join(map(of, ids)) != data:
                return []
        cuts = sorted({e for e, _ in sides[0]} & {e for e, _ in sides[1]})
        parts = [[[] for _ in cuts] for _ in sides]
        for part, side in zip(parts, sides):
            for end, i in side:
                part[bisect_left(cuts, end)].append(i)
        return list(zip([0, *cuts], cuts, *parts))

    def rows(self, documents):
        groups = [self.groups(t) for _, t in documents]
        links = [Counter((i, j) for _, _, a, b in g for i in a for j in b) for g in groups]
        count = Counter(p for found in links for p in found)
        best = Counter()
        for (i, _), n in count.items():
            best[i] = max(best[i], n)
        out = []
        for (doc_id, _), g, found in zip(documents, groups, links):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for _, _, a, b in g)
            out.append((doc_id, sum(len(a) for _, _, a, _ in g), sum(len(b) for *_, b in g), len(g), sum(found.values()),
                        sum(m for p, m in found.items() if count[p] == best[p[0]]),
                        sum(m * count[p] for p, m in found.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
        return sorted(out, key=repr)


@pytest.fixture(scope="module")
def plain():
    return Plain()


AWKWARD = [
    "two  spaces   and\ttabs \n lines", " leading", "trailing ", " ", " x 　 y z", "日本語 のテキスト 한국어", "𐍈𐍈x 𐍈",
    "emoji 👩‍👩‍👧 ok", "typed ▁ mark", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "it's don't I'LL we've", "a\x00b \x1c c\x85d",
    "ﬁ ① Å Å é é", "1234567890 3.14 -- !!! ...", "x" * 3000, "don't'll  's", "​ zero", "café au lait", "\n\n\n", "a \u0085 b",
    "� ﻿ bom", "mixed line  para"]


def test_awkward_texts(spark, plain):
    rng = random.Random(8)
    letters = "ab é日́ \t\n'▁𐍈.1  　<>"
    texts = AWKWARD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    rows = list(enumerate(texts)) + [(5, "two words"), (5, "two words"), (None, "two words"), (None, None), (900, ""), (901, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = align_tokenizers(frame, *PATHS)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == plain.rows(rows)
    spans = sorted((tuple(r) for r in token_groups(frame, *PATHS).where("doc_id < 900").collect() if r.doc_id != 5), key=repr)
    expected = [(i, k, *g) for i, t in rows if i is not None and i != 5 and i < 900 for k, g in enumerate(plain.groups(t))]
    assert spans == sorted(expected, key=repr)


def test_awkward_rows(messy, messy_rows, plain):
    got = align_tokenizers(messy, *PATHS)
    assert sorted(map(tuple, got.collect()), key=repr) == plain.rows([(r[0], r[1]) for r in messy_rows])


def test_nothing(nothing):
    assert align_tokenizers(nothing, *PATHS).collect() == [] and token_groups(nothing, *PATHS).collect() == []


def test_all_documents(documents, plain):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(map(tuple, align_tokenizers(documents, *PATHS).collect()), key=repr) == plain.rows(rows)


def test_segments_are_used_and_whole_texts_give_the_same(spark, documents, plain, monkeypatch):
    both = Tokenizers(*PATHS)
    assert both.local and both.segments("a b  c d") == ["a", "b  c", "d"]
    some = [(r.doc_id, r.text) for r in documents.limit(40).collect()]
    texts = [t.encode() for _, t in some]
    known, whole = alignment.Memory(both), alignment.Memory(Tokenizers(*PATHS))
    whole.tokenizers.local = False
    by_segment, by_text = known.numbers(texts), whole.numbers(texts)
    for a, b in zip(by_segment, by_text):
        assert ";".join(known.text[k] for k in a) == ";".join(whole.text[k] for k in b)


def test_a_small_memory_forgets_and_is_right(spark, monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_SEGMENTS", 3)
    known = alignment.Memory(Tokenizers(*PATHS))
    first = [known.text[k] for k in known.numbers([b"one two three four"])[0]]
    known.numbers([b"five six seven eight"])
    assert len(known) == 4 and [known.text[k] for k in known.numbers([b"one two three four"])[0]] == first


def test_bytes_that_are_no_text_have_no_tokens():
    known = alignment.Memory(Tokenizers(*PATHS))
    assert known.numbers([b"\xff\xfe", None, b"", b"ok"])[:3] == [[], [], []]
