"""Times the headline queries and prints one JSON line.

Every query is read from parquet to its last row (``noop`` sink) on
``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``. ``queries`` holds the median of the timed
runs after one warm-up run; ``plain`` holds, for comparison, the same areas composed the
straightforward way: left joins, a separate aggregation of baseline and runs, and a key
skeleton joined back.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workloads import plain  # noqa: E402
from workloads.queries import QUERIES, Inputs  # noqa: E402

HEADLINE = (
    "aae_areas",
    "op_areas",
    "ip_daycase",
    "ip_maternity",
    "ip_wards",
    "ip_procedures_and_theatres",
    "ip_all_areas_one_pass",
    "aae_areas_large_baseline",
    "op_areas_large_baseline",
    "ip_all_areas_large_baseline",
    "version_asof",
    "reconcile_runs",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("capplan-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        # the JVM compiles no method above this size; let Spark split such stages instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build, inputs: Inputs) -> float:
    def once() -> float:
        start = time.perf_counter()
        build(inputs).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(RUNS)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    inputs = Inputs(spark, sf_dir)
    times = {name: seconds(QUERIES[name], inputs) for name in HEADLINE}
    compared = {name: seconds(build, inputs) for name, build in plain.AREAS.items()}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "plain": compared,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
