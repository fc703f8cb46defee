"""Runs the headline queries and prints one JSON line: seconds for each, and their sum."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tallyforge.queries import QUERIES

HEADLINE = ["summary_by_state", "top_committees", "crosstab_by_year", "report_reconcile", "name_as_of", "interval_treasurer", "dedup_keep_first", "filter_new_rows", "upsert_do_update", "surrogate_registry", "transactions_family", "persons_family", "validate_errors", "blocking_pairs", "connected_components_", "em_train_score", "golden_record", "employer_history", "associations_distinct", "builder_date"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, wall clock", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
