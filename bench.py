"""Times the headline queries; prints one JSON line: the median of three runs of each, and its first run apart."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import SparkSession

from cairnfield import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Runs after the first.
RUNS = 3
HEADLINE = [
    "theil_sen_full",
    "theil_sen_yearly",
    "breakpoint1_mae",
    "year_median",
    "obs_dedup_mean",
    "tasseled_cap_auto",
    "dilate3",
    "gaussian",
    "components4",
    "object_zonal",
    "object_change",
    "regional_stats",
    "fishnet_join",
    "mosaic_overlay",
    "stale_outputs",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries.QUERIES["year_median"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # starts the JVM's code
    first, took = {}, {}

    def seconds(name: str) -> float:
        began = time.perf_counter()
        queries.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    for name in HEADLINE:
        first[name] = round(seconds(name), 3)
        took[name] = round(median(seconds(name) for _ in range(RUNS)), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "first_runs": first, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
