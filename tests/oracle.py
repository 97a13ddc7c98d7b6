"""Compare registered queries with their oracles: ``python -m tests.oracle sf0.001 [names]``."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from workload import load_all
from workload.registry import BASE_TABLES

DATA = "/root/testdata"


def session(cpus: str = "8", shuffles: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("saleweft")
        .config("spark.sql.shuffle.partitions", shuffles)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/saleweft-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in BASE_TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return db


def normal(value: object) -> object:
    """A value both engines give alike; floats stay exact."""
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, str)):
        return repr(value)
    if isinstance(value, Decimal):
        return f"decimal {value.normalize()}"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [normal(v) for v in value]
    return str(value)


def table(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, db, name: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    registered = load_all()[name]
    out = registered(spark, folder)
    rows = out.collect()
    if registered.sql is None:
        return None
    cursor = db.execute(registered.sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(out.columns):
        return f"columns {sorted(out.columns)} against {sorted(columns)}"
    ours, theirs = table(out.columns, rows), table(columns, expected)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    if not ours:
        return "no rows"
    if ours != theirs:
        names = sorted(columns)
        for a, b in zip(ours, theirs):
            if a != b:
                diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
                key = {n: x for n, x in list(zip(names, a))[:6]}
                return f"differs: {diff} in {key}"
    return None


def main() -> None:
    folder = f"{DATA}/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark, db = session(), database(folder)
    names = [n for n in load_all() if not wanted or any(n.startswith(w) for w in wanted)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, name, folder)
        except Exception as error:  # noqa: BLE001 - report every query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
