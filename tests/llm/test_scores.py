"""Toxicity and quality: held-out accuracy, fitting, awkward rows."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleweft.llm import toxicity
from saleweft.llm.quality import fit_bradley_terry, fit_quality, score_quality
from saleweft.llm.queries import QUERIES
from saleweft.llm.toxicity import fit_toxicity, score_toxicity

LARGE = "/root/testdata/sf0.1"


def held_out(spark, name, label):
    scored = QUERIES[name](spark, LARGE).where("held_out")
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    rows = scored.join(labels, "doc_id").select("score", "predicted", label).collect()
    return (np.array([r[k] for r in rows]) for k in range(3))


def test_toxicity_on_held_out_labels(spark):
    score, predicted, label = held_out(spark, "op1_toxicity", "toxic")
    assert predicted[label == 1].mean() > 0.55 and predicted[label == 0].mean() < 0.03
    assert ((score >= 0.5) == predicted).all() and score.min() >= 0 and score.max() <= 1


def test_quality_on_held_out_labels(spark):
    score, predicted, label = held_out(spark, "op3_quality", "quality")
    assert (predicted == label).mean() > 0.98 and ((score >= 0.3) == predicted).all()


@pytest.fixture(scope="module")
def tables(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("fit, score", [(fit_toxicity, score_toxicity), (fit_quality, score_quality)])
def test_scores_of_awkward_rows(messy, nothing, messy_rows, tables, fit, score):
    model = fit(*tables)
    scored = score(messy, model, out="result")
    assert scored.columns == [*messy.columns, "result"]
    rows = scored.collect()
    assert len(rows) == len(messy_rows) and all(0 <= r.result <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text or "", set()).add(r.result)
    assert all(len(v) == 1 for v in by_text.values())
    assert score(nothing, model, out="result").count() == 0


@pytest.mark.parametrize("fit, score", [(fit_toxicity, score_toxicity), (fit_quality, score_quality)])
def test_a_clashing_column_is_an_error(messy, tables, fit, score):
    """``messy`` has a column ``score`` of its own."""
    with pytest.raises(ValueError, match="choose another name"):
        score(messy, fit(*tables))


def test_toxic_windows_equal_plain_compression(tables):
    """Every window's saving and every text's figures, window by window."""
    docs, labels = tables
    model = fit_toxicity(docs, labels)
    meter = toxicity._Meter(model.ordinary, model.toxic)
    texts = [r.text.encode() for r in docs.limit(40).collect()] + [b"", b"you stupid idiot, worthless scum", b"one"]
    saved, owner = meter.saved(texts)
    grams = {bytes(model.toxic[k:k + 5]) for k in range(len(model.toxic) - 4)} - {
        bytes(model.ordinary[k:k + 5]) for k in range(len(model.ordinary) - 4)}
    expected = []
    for t, text in enumerate(texts):
        body = b" " + b"".join(bytes([c | 32]) if 65 <= c <= 90 else bytes([c]) for c in text) + b" "
        words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", body)]
        starts = range(0, max(len(words) - toxicity.WINDOW_WORDS, 0) + toxicity.WINDOW_STEP, toxicity.WINDOW_STEP) if words else ()
        for k in starts:
            if k and k - toxicity.WINDOW_STEP + toxicity.WINDOW_WORDS >= len(words):
                break
            window = body[words[k][0] - 1:words[min(k + toxicity.WINDOW_WORDS, len(words)) - 1][1] + 1]
            sizes = [len(c.compress(window)) for c in (meter.plain, meter.both)]
            shared = any(window[i:i + 5] in grams for i in range(len(window)))
            expected.append((t, sizes[0] - sizes[1] if shared else 0))
    got = sorted(zip(owner.tolist(), saved.tolist()))
    assert [g for g in got if g[1]] == sorted(e for e in expected if e[1]) and len(got) >= sum(e[1] != 0 for e in expected)
    scores = model.scorer()(texts)
    for t in range(len(texts)):
        here = [s for o, s in expected if o == t] or [0]
        figures = [1, min(max(here), 24) / 8, np.log1p(sum(s >= model.threshold for s in here))]
        assert abs(scores[t] - 1 / (1 + np.exp(-(figures @ model.weights)))) < 1e-12


@pytest.mark.parametrize("fit, score", [(fit_toxicity, score_toxicity), (fit_quality, score_quality)])
def test_without_examples_of_both_kinds_scores_are_zero(messy, tables, fit, score):
    docs, labels = tables
    for some in (labels.where("false"), labels.withColumn("toxic", F.lit(1)).withColumn("quality", F.lit(1)),
                 labels.withColumn("toxic", F.lit(None).cast("int")).withColumn("quality", F.lit(None).cast("int"))):
        model = fit(docs, some)
        assert model is None and score(messy, model, out="result").agg(F.max("result")).first()[0] == 0


def test_held_out_labels_are_not_used(tables):
    docs, labels = tables
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = fit_toxicity(docs, labels), fit_toxicity(docs, flipped)
    assert a.toxic == b.toxic and a.threshold == b.threshold and (a.weights == b.weights).all()


def test_toxic_words_are_caught_and_clean_text_is_left(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels)
    clean = "The council met on Tuesday to talk about the new bridge over the river and its cost. " * 4
    rows = [(1, clean), (2, clean + "You are a stupid worthless idiot, pathetic scum."), (3, None)]
    got = {r.doc_id: r.score for r in score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[2] > 0.5 > got[1] and got[3] < 0.5


def test_preferences_recover_the_order():
    random = np.random.default_rng(2)
    x = random.normal(size=(400, 3))
    worth = x @ np.array([2.0, -1.0, 0.0])
    a, b = random.integers(0, 400, 4000), random.integers(0, 400, 4000)
    wins = random.random(4000) < 1 / (1 + np.exp(worth[b] - worth[a]))
    weights = fit_bradley_terry(np.where(wins[:, None], x[a] - x[b], x[b] - x[a]))
    assert np.allclose(weights, [2, -1, 0], atol=0.25)
