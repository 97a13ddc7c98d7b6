"""Documents with every awkward case, and small helpers."""

from __future__ import annotations

import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, key long, node long, batch long, score double, shard int, kept string, "
          "component_id long, f0 long, n_words long, item_id long, id string, u long")
EXTRA = ("r", 1, 2, 3, 0.5, 4, "k", 5, 6, 7, 8, "i", 9)


def lower_az(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words_of(text):
    return WORDS.findall(text or "")


@pytest.fixture(scope="session")
def passage():
    return " ".join(f"Passage{k}" for k in range(60))


@pytest.fixture(scope="session")
def messy_rows(passage):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows and ids."""
    long_text = " ".join(f"w{k % 997}x{k}" for k in range(30_000))
    texts = [
        (1, "One two three four five six seven"), (2, None), (3, ""), (4, " \n\t "), (5, "word"),
        (6, f"Before all {passage} after it"), (7, f"Another start\n{passage}\nanother end"),
        (7, f"Another start\n{passage}\nanother end"), (8, passage), (9, passage), (None, f"No id {passage}"),
        (None, None), (10, long_text), (11, long_text + " tail"), (12, "é 日本 語   Σ'S don't <|endoftext|>"),
        (13, "same same same same same same same same same same same same same same same same"),
        (14, "same same same same same same same same same same same same same same same same"),
        (15, "One two three four five six seven"), (16, "x" * 70_000), (-17, passage + " minus"),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else "hot", None if t is None else len(t), *EXTRA)
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


class Links:
    """Union-find, the plain way."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
