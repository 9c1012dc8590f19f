"""Time the headline queries once each and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` (comma separated, or ``all``) the queries.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from opsledger.catalog import all_queries

HEADLINE = [
    "d1_normalise_bank_lines", "d3_posting_detail", "d13_combine_policies_facility", "d13_combine_policies_sheet",
    "d16_d18_collections_report", "d19_sheet_report", "d21_visit_wait_time", "d22_status_time_summary", "d23_contact_feed",
    "d24_document_feed", "d25_document_sla", "d26_fee_schedule_long", "d28_target_load", "d29_range_purge", "k5_upsert_by_key",
    "k10_incremental_batch_ingest", "x8_clean_text",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = all_queries()
    asked = os.environ.get("BENCH_QUERIES")
    names = list(queries) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("opsledger-bench") \
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g") \
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false") \
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").agg({"o_orderkey": "max"}).collect()  # start the JVM's readers
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
