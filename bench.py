"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then three times; the best time counts. Results
go to Spark's ``noop`` sink, which computes every row and column and keeps none.
"""

from __future__ import annotations

import json
import os
import time

from orderloom.catalog import QUERIES
from orderloom.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "r1_monthly_revenue",
    "r2_monthly_by_customer",
    "r4_revenue_by_segment",
    "r6_top_products_by_revenue",
    "r9_customer_lifetime_value",
    "r13_customer_ranking",
    "r14_product_ranking",
    "r16_monthly_customer_totals",
    "w5_upsert",
    "w7_scd2_merge",
    "w10_snapshot_diff",
    "w12_fact_sales",
    "w17_daily_sales",
    "w19_rfm_segments",
    "j6_five_table_join",
    "j11_temporal_join",
    "j18_batch_lookup",
    "o2_top_k",
    "o4_keyset_page",
    "p7_half_open_year",
    "n5_running_sum_rows",
    "k4_consistent_hash_ring",
    "k6_moved_by_ring",
    "h4_closure_table",
    "q10_report",
    "v1_latest_image",
    "v10_replay_to_time",
    "v11_missing_ranges",
    "v16_counter_rate",
    "v18_alert_hold_time",
    "v22_request_counter",
    "m1_statement_digest",
]


def run(spark, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS) if CPUS.isdigit() else 8, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = round(min(run(spark, name) for _ in range(3)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
