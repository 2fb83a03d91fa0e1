"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from headerflow.plans import registry

HEADLINE = [
    "report_summary", "score_headers", "method_vote", "best_header", "segment_pages", "context_correction", "harmonize", "resolve_by_support",
    "split_manifest", "range_join_groups", "fleet_summary", "circuit_breaker", "legacy_vote", "scale_vote_lev", "sanitize_filename",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
