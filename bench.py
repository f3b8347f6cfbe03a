"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from bazaarlake import registry  # noqa: E402
from bazaarlake.session import configure  # noqa: E402

HEADLINE = (
    "silver_orders",
    "silver_order_items",
    "silver_payments",
    "dim_customer",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "mart_sales_performance",
    "mart_product_performance",
    "mart_customer_rfm",
    "mart_pipeline_quality",
    "dq_relationships",
    "event_counts_5min",
    "ops_series",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    # Start the JVM outside the clock.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    # Every run starts from the sample files; the first one also compiles the plans, so the better counts.
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    for name in wanted:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "runs": runs,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
