"""Time the headline queries and print one JSON line.

Each query runs over the whole tables in ``$BENCH_SF_DIR`` and its rows go to a sink that discards
them, so the time covers planning and computing all of the result. The first pass warms up the JVM
and is reported apart as ``first_pass``; the second pass counts. ``$BENCH_DEFAULTS=1`` leaves the session's
tuning settings out.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from testbed.queries import QUERIES

HEADLINES = ("purchase_topk", "buyorder_topk", "purchase_documents", "buyorder_documents", "frequency_pruning")

TUNED = {
    # Batch work: collect for throughput, and skip the small first-level map, which item pairs overflow.
    "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
    # The generated classes of all queries together; the default would drop them between passes.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def timed(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cobasket-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if os.environ.get("BENCH_DEFAULTS") != "1":
        builder = builder.config(map=TUNED)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    first_pass = timed(spark, sf_dir)
    seconds = timed(spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_pass": first_pass,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
