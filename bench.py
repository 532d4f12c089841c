"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS: local cores (default: all)
BENCH_REPEATS: runs per query, the best counts (default 2)

``raw_zone`` maps the source tables to the dirty raw tables and writes them;
``star_build`` is the transform of those: everything cleaned, the star written. Both
are timed once, cold, and are part of ``value``. The queries then read the written
zones, as they do in production.
"""

from __future__ import annotations

import json
import os
import time

from skeinmart.plans import snapshot
from skeinmart.plans.catalogue import registry
from skeinmart.session import local_session

HEADLINE = [
    "clean_orders", "clean_customers", "clean_products", "fact_orders", "dim_date", "clean_rows_removed",
    "dedupe_keep_first", "price_median_by_category",
    "q01_monthly_revenue", "q02_top_products", "q03_customer_lifetime_value", "q04_new_vs_repeat",
    "q05_revenue_by_category", "q06_order_value_trend", "q07_status_breakdown", "q08_day_of_week",
    "q09_top_months", "q10_top_products_ranked", "q11_top_customers", "q12_category_revenue",
    "q13_status_counts", "q14_table_counts",
    "mart_joined", "mart_monthly", "mart_top_names", "mart_category", "mart_clv", "mart_clv_histogram",
    "mart_status", "mart_product_perf", "mart_clv_top15", "kpi_active", "kpi_all",
    "quality_report", "quality_stats_by_table", "inject_nulls", "load_verify_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "bench")
    spark.range(1000).count()  # start the executor threads
    times: dict[str, float] = {}

    for name, build in (("raw_zone", snapshot.raw_tables), ("star_build", snapshot.star_tables)):
        start = time.perf_counter()
        build(spark, sf_dir)
        times[name] = time.perf_counter() - start

    queries = registry()
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = best
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
