"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("market_overview", "dedupe_first", "missing_rules", "outliers_iqr", "cap_values", "keyword_dummies",
            "split_exact", "ols_fit", "model_scores", "comparable_listings", "nearest_category", "training_run",
            "analysis_run", "group_importance_full", "prediction_run")


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from lodestay.sources.staging import drop_staged
    from lodestay.workload import QUERIES

    QUERIES["market_overview"](spark, os.path.join(os.path.dirname(sf_dir), "sf0.001")).collect()
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        times[name] = round(time.perf_counter() - started, 3)
        drop_staged(spark)
    spark.stop()
    print(json.dumps({"metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
