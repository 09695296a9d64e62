"""Times the headline queries and prints one line of JSON."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from regwatch.plans import registered

HEADLINES = ("c3_change_log", "c8_change_events", "c9_diff_runs", "g4_run_verdict", "m1_word_idf", "m5_national_candidates", "k1_predecessor_exact", "k3_existing_operator", "q7_count_deviation", "x10_filter_waterfall", "w8_report_for_all", "a2_source_rollup")


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
    spark = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = registered()[0], {}
    spark.range(1000).selectExpr("sum(id)").collect()
    for name in HEADLINES:
        began = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
