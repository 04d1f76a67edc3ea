"""Time every query on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from orderline_kpi.plans.queries import QUERIES


def main() -> None:
    tables_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, tables_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    wanted = sys.argv[1:] or list(QUERIES)
    seconds("shipping_mode_performance")  # start-up of the JVM, not of a query
    times = {name: seconds(name) for name in wanted}
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(tables_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
