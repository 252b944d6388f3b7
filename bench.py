"""Time the headline queries: seconds each, the median of three runs after a warm-up run.

Reads $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfmark.queries import QUERIES  # noqa: E402
from shelfmark.session import SessionSpec, build_session  # noqa: E402

HEADLINE = [
    "by_year",
    "shipments_by_year",
    "price_stats",
    "top_rated",
    "top_subjects",
    "dedup_documents",
    "dedup_events",
    "dedup_lines",
    "cast_safe",
    "product_cards",
    "listed_works",
    "page_articles",
    "landing_csv",
    "csv_roundtrip",
    "json_roundtrip",
    "silver_web_table",
    "silver_csv_table",
    "silver_api_table",
    "gold_top_rated_books",
    "gold_books_by_year",
    "gold_price_stats_by_rating",
    "gold_top_subjects_table",
    "table_quality",
    "medallion_status",
]
RUNS = 3


def seconds(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        SessionSpec(
            app_name="bench",
            master=f"local[{cpus}]",
            extra={
                "spark.ui.enabled": "false",
                "spark.driver.memory": "8g",
                "spark.sql.shuffle.partitions": cpus,
            },
        )
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, name, folder)
        times[name] = round(
            statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median seconds of the headline queries, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
