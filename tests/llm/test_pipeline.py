"""The pipeline's stages, one after the other, against brute force, and the registered queries."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from saleweft.llm.queries import ORACLES, QUERIES
from saleweft.session import settle
from tests.oracle import database, table

from .conftest import Links, words_of
from .test_dedup import brute_cut, brute_mark


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        docs = settle(stage(spark, docs, folder))
        out.append(docs)
    return out


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_all_stages_but_the_last_keep_the_columns(stages):
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_each_stage_does_what_it_says(stages):
    raw, clean, single, cut, unleaked, packed = stages
    assert ids(clean) <= ids(raw) and ids(single) < ids(clean) and ids(unleaked) < ids(cut)
    texts = {r.doc_id: r.text for r in clean.collect()}
    kept = ids(single)
    for text in set(texts.values()):
        holders = [i for i in texts if texts[i] == text]
        assert len(kept & set(holders)) <= 1
    expected = {i: [x for x, gone in zip(w, g) if not gone]
                for i, w, g in brute_cut([(r.doc_id, r.text) for r in single.collect()])}
    for r in cut.collect():
        assert words_of(r.text) == expected[r.doc_id] and r.n_chars == len(r.text)
    assert ids(packed) == ids(unleaked)


def test_run_is_all_stages(spark, folder, stages):
    got = pipeline.run(spark, folder)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


@pytest.mark.parametrize("k", range(5))
def test_stages_take_awkward_rows_and_none(spark, folder, messy, nothing, messy_rows, k):
    name, stage = pipeline.STAGES[k]
    got = stage(spark, messy, folder)
    if k < 4:
        assert got.columns == messy.columns
        assert k == 1 or got.count() == len(messy_rows)
    else:
        assert got.count() >= len(messy_rows)
    assert stage(spark, nothing, folder).count() == 0


def test_near_duplicates_of_awkward_rows(spark, folder, messy, messy_rows):
    kept = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, messy, folder).collect()]
    marks = [(r[0], r[1], brute_mark(r[1], 4)) for r in messy_rows]
    links = Links()
    for _, _, a in marks:
        for _, _, b in marks:
            if (a ^ b).bit_count() <= 4:
                links.link(a, b)
    groups = {}
    for i, t, m in marks:
        groups.setdefault(links.find(m), []).append((i is None, i, t))
    assert len(kept) == len(groups)
    assert sorted(i for i, _ in kept) == sorted(min(g[:2] for g in same)[1] for same in groups.values())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, folder, name):
    out = QUERIES[name](spark, folder)
    cursor = database(folder).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(out.columns)
    assert table(out.columns, out.collect()) == table(columns, cursor.fetchall())


def test_one_query_for_each_operator_and_the_pipeline():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
