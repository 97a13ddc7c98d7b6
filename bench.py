"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query is run
once to warm up the session's code and then timed; its whole result is computed
and thrown away (``noop``), so nothing passes through the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from workload import load_all  # noqa: E402

HEADLINE = [
    "flagship_margin_by_nation",
    "j01_checked_lookup", "j13_partial_match", "j14_interval_lookup", "j15_drop_superseded",
    "j19_partner_roles", "a10_condition_pivot", "a15_unpivot_months", "a17_report_rollup",
    "w01_dedup_ordered", "w03_fill_both_ways", "w09_merge_by_priority", "i03_upsert",
    "i03_upsert_unique_store", "q03_duplicate_errors", "q04_old_date_check",
    "b06_order_status", "b12_unit_costs", "b14_order_fact", "b15_delivery_fact",
    "b16_invoice_fact", "b17_legacy_facts", "b21_portfolio", "b22_budget", "b26_block_events",
    "b27_product_master",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("saleweft-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    registered = load_all()
    seconds: dict[str, float] = {}
    for name in wanted:
        for timed in (False, True):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
