"""Fingerprints, licences, WARC and decontamination."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from saleweft.llm import decontam, warc
from saleweft.llm.decontam import find_leaks, tile, without_leaks
from saleweft.llm.fingerprints import near_fingerprints, simhash64, with_next
from saleweft.llm.licenses import PHRASES, TEMPLATES, scan_licences
from saleweft.llm.queries import QUERIES
from saleweft.session import scratch_path

from .conftest import lower_az

PLAIN_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return PLAIN_WORDS.findall(lower_az(text))


# fingerprints

def test_edits_and_likenesses_of_all_documents(spark, documents, folder):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = {r.doc_id: r for r in QUERIES["op9_fingerprints"](spark, folder).collect()}
    order = sorted(texts, reverse=True)
    marks = {i: int(r.fingerprint, 16) for i, r in rows.items()}
    for k, i in enumerate(order):
        after = order[(k + 1) % len(order)]
        cut = len(texts[i]) // 3
        edited = texts[i][:len(texts[i]) - cut] + texts[after][:cut]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == 1 - (marks[i] ^ int(r.edited_fingerprint, 16)).bit_count() / 64
        assert r.near_next == 1 - (marks[i] ^ marks[after]).bit_count() / 64
        near = sum((m ^ marks[i]).bit_count() <= 3 for m in marks.values())
        assert r.n_near == (near if i % 100 == 0 else None)
    assert sum(r.near_edited > r.near_next for r in rows.values()) > 0.95 * len(rows)


def test_fingerprints_are_signed_votes(spark):
    texts = ["a b c d a b", "", None, "one", " ".join(f"w{k}" for k in range(70_000))]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string").withColumn("mark", simhash64(F.col("text")))
    pairs = frame.select("k", "mark", F.posexplode(F.split("text", " ")).alias("p", "w"))
    following = pairs.alias("x").join(pairs.alias("y"), (F.col("x.k") == F.col("y.k")) & (F.col("y.p") == F.col("x.p") + 1))
    hashes = following.select("x.k", F.xxhash64("x.w", "y.w").alias("h"))
    votes = hashes.groupBy("k").agg(F.count("*").alias("n"), *[
        F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1).cast("long"))).alias(f"b{b}") for b in range(64)]).collect()
    marks = {r.k: r["mark"] & (1 << 64) - 1 for r in frame.collect()}
    assert {0, 4} <= {v.k for v in votes}
    for v in votes:
        assert marks[v.k] == sum(1 << b for b in range(64) if 2 * v[f"b{b}"] > v.n)
    assert marks[1] == marks[2] == 0 and marks[3] != 0


def test_block_tables_miss_nothing(spark):
    base = [((k * 0x9E3779B97F4A7C15) ^ (k << 7)) & (1 << 63) - 1 for k in range(40)]
    base += [m ^ (1 << b) ^ (1 << (b + 20)) ^ (1 << 62) for m in base[:20] for b in (0, 13, 31)]
    base += [m ^ 0b1111 for m in base[:5]]
    frame = spark.createDataFrame([(m,) for m in base], "fingerprint long")
    got = sorted(tuple(r) for r in near_fingerprints(frame, frame, radius=3).collect())
    assert got == sorted({(a, b) for a in base for b in base if (a ^ b).bit_count() <= 3})


def test_next_rows_of_awkward_rows(messy, nothing, messy_rows, monkeypatch):
    from saleweft.llm import fingerprints

    monkeypatch.setattr(fingerprints, "_ORDER_ROWS", 4)
    rows = with_next(messy.withColumn("tie", F.xxhash64("text")), ["doc_id", "tie"], ["doc_id"]).collect()
    ids = sorted((r[0] for r in messy_rows if r[0] is not None), reverse=True) + [None, None]
    assert sorted(((r.doc_id, r.next.doc_id) for r in rows), key=repr) == sorted(zip(ids, ids[1:] + ids[:1]), key=repr)
    assert with_next(nothing, ["doc_id", "text"], ["doc_id"]).count() == 0


def test_one_document_is_its_own_next(spark):
    frame = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert with_next(frame, ["doc_id"], ["text"]).first().next.text == "a b c"


# licences

def test_licences_equal_a_plain_search(spark, documents, folder):
    texts = {r.doc_id: plain_words(r.text) for r in documents.collect()}
    for r in QUERIES["op6_license_scan"](spark, folder).collect():
        w = texts[r.doc_id]
        places = [(k, label) for label, p in PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        labels = {label for _, label in places}
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_every_notice_is_found_and_its_key_phrase_is_needed(spark):
    notices = [f"Some text. {text.upper()}! And more." for _, text, _ in TEMPLATES]
    broken = [text.replace(key.split()[-1], "other", 1) if key.split()[-1] not in text.split()[:1] else "" for _, text, key in TEMPLATES]
    rows = list(enumerate(notices + broken))
    got = {r.row.doc_id: {m.label for m in r.notices} for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (label, text, _) in enumerate(TEMPLATES):
        assert label in got[k], text
        assert label not in got[len(TEMPLATES) + k] or text.split().count(TEMPLATES[k][2].split()[-1]) > 1


def test_licences_of_awkward_rows(messy, nothing, messy_rows):
    found = scan_licences(messy)
    assert found.schema["row"].dataType.names == [c for c in messy.columns if c != "text"]
    got = sorted(((r.row.doc_id, r.n_words, len(r.phrases)) for r in found.collect()), key=repr)
    assert got == sorted(((r[0], len(plain_words(r[1])), 0) for r in messy_rows), key=repr)
    assert scan_licences(nothing).count() == 0


# archives

PAGES = "page_id long, url string, html string, record_id string, kept long, block string"


def page_rows():
    big, other = "é<p>日本</p>\r\n\r\nWARC/1.0\r\n" * 3000, "x" * 1000
    html = [None, "", "short", "short", big, big, other, other, other, "y" * 999, "y" * 999, "a\nb" * 20_000]
    rows = [(k, None if k % 5 == 0 else f"http://h/{k}\r\n x", t, "c", 1, "b") for k, t in enumerate(html)]
    return [*rows, (None, "u", big, "c", 1, "b"), (None, None, "z" * 2000, "c", 1, "b"), (6, "again", other, "c", 1, "b"),
            (6, "again", other, "c", 1, "b")]


def test_archives_round_trip(spark):
    rows = page_rows()
    path = scratch_path(spark, "test-archive")
    warc.write_archive(spark.createDataFrame(rows, PAGES).repartition(3), path, "2024-01-01T00:00:00Z", segment=700)
    got = warc.read_archive(spark, path).withColumn("page_id", warc.page_id_of(F.col("record_id"))).withColumn(
        "refers", warc.page_id_of(F.col("refers_to"))).collect()
    assert len(got) == len(rows) and not [r.problem for r in got if r.problem]
    kept = {}
    for i, _, html, *_ in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            kept[html] = max(kept.get(html, i), i)
    expected = sorted((i, h.encode(), None) if kept.get(h, i) == i else (i, b"", kept[h])
                      for i, h in ((i, h or "") for i, _, h, *_ in rows if i is not None))
    assert sorted((r.page_id, bytes(r.payload), r.refers) for r in got if r.page_id is not None) == expected
    assert sorted((r.record_type, r.refers or 0) for r in got if r.page_id is None) == [("response", 0), ("revisit", 5)]


def test_broken_segments_are_named(spark):
    def page(k, html):
        return warc._records({"page_id": k, "url": "u", "html": html, "digest": "d", "kept": None, "row": 0}, "now", 300)

    whole, missing, repeated, last, first = (page(k, "z" * 1500) for k in range(5))
    records = [*whole[::-1], *missing[:2], *missing[3:], *repeated, repeated[2], *last[:-1], *first[1:]]
    path = scratch_path(spark, "test-broken")
    spark.createDataFrame([(r.decode(),) for r in records], "record string").repartition(4).write.option(
        "lineSep", warc.END).option("compression", "gzip").text(path)
    got = {(r.record_id or "none").split(":")[2 if r.record_id else 0]: (r.problem, r.payload) for r in warc.read_archive(spark, path).collect()}
    assert got["0"][0] is None and bytes(got["0"][1]) == b"z" * 1500
    assert got["1"][0] == got["2"][0] == got["3"][0] == "segment missing or repeated" and got["none"][0] == "no first segment"
    assert all(got[k][1] is None for k in "123")


def test_broken_framing_is_named():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert warc.decode_block(head + b"3;x=1\r\nabc\r\n0\r\n\r\n") == (b"abc", None)
    assert warc.decode_block(head + b"3\r\nabcd\r\n0\r\n\r\n")[1] == "chunk cut short"
    assert warc.decode_block(head + b"zz\r\n")[1] == "bad chunk size"
    assert warc.decode_block(b"HTTP/1.1 200 OK\r\n\r\nabc") == (b"abc", None)
    assert warc.decode_block(b"nothing")[1] == "no HTTP head"


def test_an_empty_archive(spark):
    path = scratch_path(spark, "test-empty")
    warc.write_archive(spark.createDataFrame([], PAGES), path, "now")
    assert warc.read_archive(spark, path).count() == 0


# decontamination

def brute_tiles(a, b, least):
    """Greedy string tiling, the plain way: longest match first, ties by place."""
    used_a, used_b, tiles = set(), set(), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]
                       and i + n not in used_a and j + n not in used_b):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append((i, j, n))
        used_a.update(range(i, i + n))
        used_b.update(range(j, j + n))


@pytest.mark.parametrize("seed", range(8))
def test_tiling_covers_what_plain_tiling_covers(seed):
    import random

    rng = random.Random(seed)
    item = [rng.choice("abc") for _ in range(24)]
    text = [rng.choice("abc") for _ in range(60)] + item[12:] + item[:12]
    found = decontam._leaks([" ".join(text).encode()], decontam._index([1], [" ".join(item).encode()], 3), 0.0)
    expected = brute_tiles(item, text, 3)
    assert [f[3] for f in found] == [sorted(expected)]


def test_tiles_do_not_overlap_and_split_matches_return():
    assert tile([(0, 0, 10), (5, 20, 12)], 3) == [(5, 20, 12), (0, 0, 5)]


def test_reordered_passages_are_caught_and_others_left(spark):
    item = " ".join(f"w{k}" for k in range(40))
    w = item.split()
    texts = [f"before {item} after", "x " + " ".join(w[20:]) + " y z " + " ".join(w[:20]), " ".join(w[:15]), " ".join(w[::-1]),
             item.upper().replace(" ", ", "), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "w1"), (9, None), (None, item), (10, "")], "item_id long, text string")
    pairs = {r.doc_id: r for r in find_leaks(docs, bench).collect()}
    assert set(pairs) == {0, 1, 4} and pairs[1].coverage == 1 and len(pairs[1].tiles) == 2
    assert sorted(r.doc_id for r in without_leaks(docs, bench).collect()) == [2, 3, 5, 6]
    assert find_leaks(docs, bench.where("false")).count() == 0
    assert without_leaks(docs, bench.where("false")).count() == len(texts)


def test_items_in_blocks_give_the_same_pairs(spark, documents, folder, monkeypatch):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = sorted((r.doc_id, r.item_id) for r in find_leaks(documents, bench).collect())
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 500)
    assert whole and sorted((r.doc_id, r.item_id) for r in find_leaks(documents, bench).collect()) == whole
    texts = {r.doc_id: f" {' '.join(plain_words(r.text))} " for r in documents.collect()}
    inside = {(i, b.item_id) for b in bench.collect() for i, t in texts.items() if f" {' '.join(plain_words(b.text))} " in t}
    assert inside <= set(whole)


def test_leaks_of_awkward_rows(spark, messy, nothing, messy_rows, passage):
    bench = spark.createDataFrame([(1, passage), (1, passage)], "item_id long, text string")
    having = sorted((r[0] for r in messy_rows if r[1] and passage in r[1]), key=repr)
    assert sorted((r.doc_id for r in find_leaks(messy, bench).collect()), key=repr) == sorted(having * 2, key=repr)
    clean = without_leaks(messy, bench)
    assert clean.columns == messy.columns and clean.count() == len(messy_rows) - len(having)
    assert find_leaks(nothing, bench).count() == 0 and without_leaks(nothing, bench).count() == 0


def test_short_items_items_without_an_id_and_scripts_without_spaces(spark):
    """Items of two words and more are looked for, whatever their id or script; one word is no leak."""
    han = "我们今天去学校学习新的课程内容然后回家吃饭睡觉"
    thai = "ประเทศไทยมีอาหารอร่อยมากมายและผู้คนใจดี"
    bench = spark.createDataFrame([(1, "capital of France"), (None, "one two three four five six seven eight"), (3, han), (4, thai), (5, "..."),
                                   (6, "Zugspitze")], "item_id long, text string")
    texts = ["the capital of France is big", "the capital in France", f"intro {han[4:18]} more", han[:5], "x " + thai[:30],
             "zero one two three four five six", "nine ten", "auf der Zugspitze oben", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in find_leaks(docs, bench).collect()}
    assert set(got) == {(0, 1), (2, 3), (4, 4), (5, None)}
    assert got[0, 1].coverage == 1 and got[2, 3].tiles[0].words == 14 and got[5, None].coverage == 6 / 8
    assert sorted(r.doc_id for r in without_leaks(docs, bench).collect()) == [1, 3, 6, 7, 8]


def test_words_of_mixed_scripts():
    texts = ["Plain 12 wörds", "日本語、テキスト abc漢字x", "", "한국어 문장", "กข ก"]
    data, at = decontam.joined([t.encode() for t in texts])
    words = decontam.cut_words(decontam.lower_ascii(data), at)
    got = [[] for _ in texts]
    for a, b, t in zip(words.start, words.end, words.text):
        got[t].append(bytes(data[a:b]).decode())
    assert got == [["Plain", "12", "wörds"], [*"日本語、", *"テキスト", "abc", *"漢字", "x"], [], ["한국어", "문장"], ["ก", "ข", "ก"]]


def contains(words, phrase):
    return any(words[k:k + len(phrase)] == phrase for k in range(len(words) - len(phrase) + 1))


def test_all_labels_equal_a_plain_search(spark, documents):
    """Every template whose key phrase stands in a text, and no other, however common its words are."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(10_000 + k, f"start {text} end") for k, (_, text, _) in enumerate(TEMPLATES)]
    rows += [(20_000 + k, f"start {key} end") for k, (*_, key) in enumerate(TEMPLATES)]
    rows += [(30_000 + k, " ".join(key.split()[:-1])) for k, (*_, key) in enumerate(TEMPLATES)]
    rows += [(40_000 + k, "license public gnu free software mit version 3") for k in range(300)]  # frequent words
    found = scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.row.doc_id: {m.label for m in r.notices} for r in found}
    for i, text in rows:
        words = plain_words(text or "")
        assert got[i] == {label for label, _, key in TEMPLATES if contains(words, key.split())}, (i, text[:80])
    assert got[20_000 + len(TEMPLATES) - 1] == {"unlicense"}
