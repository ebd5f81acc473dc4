"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the timed runs per query (after one that is not timed). A run
builds the DataFrame and works it off whole into a sink that keeps nothing.
The load of the warehouse behind the ``dwh_``, ``qa_`` and ``rpt_`` queries is
timed as ``load_warehouse``, likewise after a load that is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tallyloom.plans import registry
from tallyloom.plans.warehouse import load_warehouse
from tallyloom.session import configure
from tallyloom.sources.tables import work_folder
from tallyloom.sources.testdata import TestTables

HEADLINE = [
    "mkt_conversion",
    "mkt_paid_unpaid_events",
    "mkt_country_event",
    "mkt_rollup3",
    "mkt_grand_total",
    "ins_geo_event",
    "ins_country",
    "ins_affiliation",
    "dwh_dim_affiliation",
    "dwh_people",
    "dwh_fact_v2",
    "dwh_fact_incremental",
    "qa_load_readiness",
    "qa_unloaded",
    "rpt_country_lists",
    "rpt_award_detail",
    "cmp_last_touch_revenue",
    "cmp_award_country_funnel",
    "cmp_nonresponders_six_mailers",
    "j13_latest_touch",
]


def timed(query, spark: SparkSession, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyloom-bench-"))
        .config("spark.sql.shuffle.partitions", cpus)
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds: dict[str, float] = {}
    if any(name.startswith(("dwh_", "qa_", "rpt_")) for name in names):
        stored = registry.loaded(TestTables(spark, folder))
        started = time.perf_counter()
        load_warehouse(spark, stored.staging, work_folder(spark, "bench"))
        seconds["load_warehouse"] = round(time.perf_counter() - started, 3)
    for name in names:
        timed(queries[name], spark, folder)
        seconds[name] = round(statistics.median(timed(queries[name], spark, folder) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name,
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
