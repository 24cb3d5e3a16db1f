"""Times the headline queries and prints one JSON line.

Each query runs to the end into a sink that discards its rows; the second of two runs counts,
so class loading and compilation are not measured. The load from archives to Gold runs once.
"""

from __future__ import annotations

import json
import os
import time
from datetime import timedelta

from pyspark.sql import SparkSession

from repo_pulse.operators import catalog
from repo_pulse.plans import jobs
from repo_pulse.session import configure, scratch_dir
from repo_pulse.sources.lakehouse import Lakehouse
from repo_pulse.workload import derived
from repo_pulse.workload.queries import QUERIES

HEADLINE = (
    "bronze_archive_scan",
    "bronze_parse",
    "bronze_rejects",
    "bronze_payload_text",
    "silver_events",
    "classify_events",
    "classify_large_catalog",
    "daily_activity",
    "daily_activity_from_lines",
    "check_complete_hours",
    "check_valid_metrics",
    "event_mix",
    "technology_ranking",
    "distinct_actors",
    "serving_upsert",
)


def session() -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cores)
        .getOrCreate()
    )


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    raw = derived.raw_zone(spark, sf_dir)
    seconds = {}
    for name in HEADLINE:
        def run(query=QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = timed(run)

    index = catalog.index(catalog.default(spark))
    first, last = derived.date_bounds(spark, sf_dir)
    # The last events may be delivered in the first hour of the day after.
    last += timedelta(days=1)
    lake = Lakehouse(spark, scratch_dir(spark, "bench"), "bench_")
    seconds["raw_to_gold"] = timed(lambda: jobs.backfill(lake, raw, first, last, index))
    events = derived.table(spark, sf_dir, "events").count()
    if lake.read_bronze().count() != events:
        raise RuntimeError("the load is short of events")
    seconds["raw_to_gold_again"] = timed(lambda: jobs.backfill(lake, raw, first, last, index))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": int(os.environ.get("BENCH_CPUS", "8")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
