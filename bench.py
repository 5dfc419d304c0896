"""Time every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`build_star` is the whole path from the source tables to the stored star; the
other entries run on the stored star, each to a sink that discards the rows.
BENCH_ONLY (comma-separated) limits the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from fieldlake.plans.lake import Lake  # noqa: E402
from fieldlake.registry import all_queries  # noqa: E402


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldlake-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = session(cpus)

    def timed(work) -> float:
        start = time.perf_counter()
        work()
        return round(time.perf_counter() - start, 3)

    times = {"build_star": timed(lambda: Lake.of(spark, source).star())}
    for name, query in all_queries().items():
        if not only or name in only:
            times[name] = timed(lambda: drain(query(spark, source)))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": source.rstrip("/").rsplit("sf", 1)[-1],
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
