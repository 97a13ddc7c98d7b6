"""How a query, its source views and its oracle are registered."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import prod
from string import Formatter

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleweft.session import configure, scratch_path, settle

from .views import VIEWS

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


# Doubles are rounded on both sides before they are compared. The two engines
# break exact ties differently, so both first move values off a tie.
NUDGE = 1.000000000001

# Rows of a given table that a view repeats are dealt out so that a task makes about so many.
REPEATED_ROWS = 1_000_000


_FRAMES: dict[tuple[str, str], dict[str, DataFrame | int]] = {}


class Tables:
    """The given tables, and source tables derived from them by a view's SQL.

    Frames are plans, not data; they are kept per session so that the files of a
    table are listed once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder
        self._frames = _FRAMES.setdefault((spark.sparkContext.applicationId, folder), {})
        self._written: frozenset[str] = frozenset()

    def written(self, *names: str) -> Tables:
        """The same tables, of which the named derived ones are written when they are first read.

        For a query whose other tables are built on them many times: each use of a plan groups the given
        tables again. What is written is kept for this query alone.
        """
        out = Tables(self.spark, self.folder)
        out._frames = {n: f for n, f in self._frames.items() if n not in VIEWS}
        out._written = frozenset(names)
        return out

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def _load(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = spark_text(VIEWS[name])
        most = {n: repeats(VIEWS[name], n) for n in references(text)}
        frame = self.spark.sql(text, **{n: self._spread(n, times) if times > 4 else self.get(n) for n, times in most.items()})
        return settle(frame, name) if name in self._written else frame

    def _spread(self, name: str, most: int) -> DataFrame:
        """A table in as many tasks as the rows made of it need.

        Its file may be too small for Spark to split, while a view makes dozens of rows of each of
        its rows: one task would make, sort and aggregate them all. Footers tell the number of rows.
        The same holds for a view that groups a given table: its partitions are sized by the rows before
        they are repeated, so the given table is dealt out by the keys it is grouped by.
        """
        if name in BASE_TABLES:
            frame, tasks = self.get(name), self._tasks(name, most)
            return frame.repartition(tasks) if tasks > 1 else frame
        text = VIEWS[name]
        tables, keys = references(text), re.search(GROUPED, text)
        if name in self._written or keys is None or len(tables) > 1 or tables[0] not in BASE_TABLES:
            return self.get(name)
        tasks = self._tasks(tables[0], most)
        if tasks <= 1:
            return self.get(name)
        given = self.get(tables[0]).repartition(tasks, *re.findall(r"\w+", keys["keys"]))
        return self.spark.sql(spark_text(text), **{tables[0]: given})

    def _tasks(self, name: str, most: int) -> int:
        count = f"{name} count"
        if count not in self._frames:
            self._frames[count] = self.get(name).count()
        return -(-self._frames[count] * most // REPEATED_ROWS)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


LISTS = r",\s*\(VALUES (?P<rows>.*?)\) AS (?P<name>\w+)\((?P<columns>[^)]*)\)"


# A view that groups the rows of a table by some of its columns and does nothing afterwards.
GROUPED = r"GROUP BY (?P<keys>\w+(?:, *\w+)*)\s*$"


def repeats(text: str, name: str = "") -> int:
    """How many rows a view makes at most of one row it reads, or reads of one table: its lists multiplied, per select the most."""
    return max(prod(len(re.findall(r"\([^()]*\)", m["rows"])) for m in re.finditer(LISTS, part, re.DOTALL))
               for part in text.split("UNION ALL") if not name or f"{{{name}}}" in part)


def spark_text(text: str) -> str:
    """Turn ``, (VALUES ...) AS t(c)`` into a lateral view: no join, rows repeat in place."""

    def lateral(match: re.Match) -> str:
        rows = re.sub(r"(^|,\s*)\(", r"\1struct(", match["rows"].strip())
        return f" LATERAL VIEW inline(array({rows})) {match['name']} AS {match['columns']}"

    return re.sub(LISTS, lateral, text, flags=re.DOTALL)


def references(text: str) -> list[str]:
    """Names in braces, in order of first use."""
    names = [n for _, n, _, _ in Formatter().parse(text) if n]
    return list(dict.fromkeys(names))


def view_order(names: Sequence[str]) -> list[str]:
    """The derived views a text needs, each after those it is built on."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in done:
            return
        for inner in references(VIEWS[name]):
            visit(inner)
        done.append(name)

    for name in names:
        visit(name)
    return done


def plain(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def used_views(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_]\w*", sql))
    return [v for v in VIEWS if v in words]


def oracle_text(sql: str, rounds: dict[str, int]) -> str:
    """The oracle with the views it names in front, and its doubles rounded."""
    sql = sql.strip()
    ctes = [f"{v} AS ({plain(VIEWS[v]).strip()})" for v in view_order(used_views(sql))]
    if sql[:5].lower() == "with ":
        head, sql = _split_with(sql)
        ctes.append(head)
    if rounds:
        parts = ", ".join(f"round({c} * {NUDGE!r}, {d}) + 0.0e0 AS {c}" for c, d in rounds.items())
        sql = f"SELECT * REPLACE ({parts}) FROM (\n{sql}\n) AS answer"
    return ("WITH " + ",\n".join(ctes) + "\n" + sql) if ctes else sql


def _split_with(sql: str) -> tuple[str, str]:
    """The common table expressions of a text, and the select that follows them."""
    depth, position = 0, 5
    for match in re.finditer(r"[()]|\bSELECT\b", sql, re.IGNORECASE):
        token = match.group()
        if token == "(":
            depth += 1
        elif token == ")":
            depth -= 1
        elif depth == 0:
            position = match.start()
            break
    return sql[5:position].strip(), sql[position:]


@dataclass(frozen=True)
class Registered:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    rounds: dict[str, int]

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        out = self.build(Tables(spark, folder))
        for column, digits in self.rounds.items():
            value = F.col(column).cast("double") * NUDGE
            out = out.withColumn(column, F.round(value, digits) + F.lit(0.0))
        return out


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None, rounds: str = "", digits: int = 4):
    """Register a query; ``rounds`` lists double columns as ``a b:4``."""
    parsed = {}
    for item in rounds.split():
        column, _, places = item.partition(":")
        parsed[column] = int(places) if places else digits

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Registered(
            name, build, None if sql is None else oracle_text(sql, parsed), parsed)
        return build

    return register
