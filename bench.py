"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores.
Results go to a no-op sink, so that all rows are computed and none collected.
One untimed query first starts the JVM's compilers and the Python workers. "queries"
has each query's first run, "warm" the median of the two after it, each built anew.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = (
    "mask_table_customer",
    "mask_standard_str",
    "mask_standard_int",
    "mask_standard_double",
    "mask_full_name",
    "mask_email",
    "masked_join_orders_customer",
    "dict_new_entries",
    "dict_overlay",
    "dict_first_wins",
    "mask_collisions",
    "rules_invalid",
    "catalog_normalized",
    "mask_job",
    "mask_key_permuted",
    "mask_job_collisions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["mask_standard_str"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds, warm = {}, {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - started, 3))
        seconds[name], warm[name] = runs[0], round(statistics.median(runs[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "warm": warm,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
