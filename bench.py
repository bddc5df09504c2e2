"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Query results are fully
computed by a write to Spark's noop sink. `ingest_baseline_rows` is the whole ingestion run (CSV read,
cleaning, monthly Parquet, statistics, metadata) over about as many rows as the published baseline
kept: the test transactions as CSV, repeated under new ids. Its CSV is written before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendgrain.catalog.queries import QUERIES  # noqa: E402
from spendgrain.plans.ingestion import run_ingestion  # noqa: E402
from spendgrain.plans.refresh import run_features  # noqa: E402
from spendgrain.sources.scratch import scratch_folder  # noqa: E402
from spendgrain.sources.testdata import dirty_transactions  # noqa: E402

HEADLINE = (
    "customer_features",
    "quarterly_features",
    "payment_features",
    "state_features",
    "ml_training_features",
    "ml_training_features_alt",
    "customer_cohorts",
    "customer_retention",
    "distribution_maps",
    "clean_transactions",
    "dedup_keep_first",
    "cleaning_report",
    "ingestion_stats",
    "dq_report",
)
BASELINE_ROWS = 952_793
RUNS = 3


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_time(action) -> float:
    action()
    return statistics.median(timed(action) for _ in range(RUNS))


def baseline_csv(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    rows = dirty_transactions(spark, sf_dir)
    n = rows.count()
    copies = max(1, round(BASELINE_ROWS / n))
    repeated = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    ids = F.concat_ws("-", "Transaction_ID", "copy")
    folder = scratch_folder(spark, "bench-csv")
    repeated.withColumn("Transaction_ID", ids).drop("copy", "seq").write.option("header", True).csv(folder)
    return folder, n * copies


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spendgrain-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        # Skips recording the Python call site of every column operation.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or [*HEADLINE, "ingest_baseline_rows", "features_baseline_rows"]
    times: dict[str, float] = {}
    for name in HEADLINE:
        if name in chosen:
            times[name] = round(median_time(lambda name=name: noop(QUERIES[name](spark, sf_dir))), 3)
    extra: dict[str, float | int] = {}
    if "ingest_baseline_rows" in chosen:
        csv, rows = baseline_csv(spark, sf_dir)
        root = scratch_folder(spark, "bench-store")
        seconds = median_time(lambda: run_ingestion(spark, csv, root))
        times["ingest_baseline_rows"] = round(seconds, 3)
        extra = {"ingest_rows": rows, "ingest_rows_per_sec": round(rows / seconds)}
        if "features_baseline_rows" in chosen:
            times["features_baseline_rows"] = round(median_time(lambda: run_features(spark, root)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                **extra,
            }
        )
    )


if __name__ == "__main__":
    main()
