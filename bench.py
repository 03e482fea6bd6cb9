"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Each query runs
to the end of its whole result (a ``noop`` write), best of ``$BENCH_RUNS``.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clipyard.plans.registry import QUERIES  # noqa: E402
from clipyard.session import local_session, ship_package  # noqa: E402

HEADLINE = [
    "terms_author",
    "match_topic",
    "match_url",
    "match_all_1000",
    "minhash_bits",
    "near_duplicates",
    "near_duplicates_lsh",
    "near_duplicate_counts",
    "bucket_minima_512",
    "similar_to",
    "site_articles",
    "page_links",
    "fetch_outcomes",
    "crawl_frontier",
    "crawl_articles",
    "index_upsert",
    "route_messages",
    "log_route",
    "index_pattern_scan",
    "stream_index",
    "stream_logs",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, shuffle_partitions=cpus, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
