"""Time the headline work at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from salespect.functions.staging import drop_staged  # noqa: E402
from salespect.operators.quality import run_all_checks  # noqa: E402
from salespect.plans.batch import run_batch, write_metrics  # noqa: E402
from salespect.plans.queries import QUERIES  # noqa: E402
from salespect.plans.sinks import write_table  # noqa: E402
from salespect.sources.star import STAR_SETTINGS, raw_transactions  # noqa: E402

HEADLINES = (
    "enriched",
    "customer_metrics",
    "product_metrics",
    "daily_metrics",
    "country_metrics",
    "hourly_patterns",
    "customer_sequence",
    "country_top_products",
    "dq_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="salespect-bench-")
    seconds: dict[str, float] = {}

    def timed(name: str, action):
        begin = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - begin, 3)
        return result

    # The whole batch from a raw table on disk, cold: the published workload.
    raw_path = f"{work}/raw"
    raw_rows = write_table(raw_transactions(spark, sf_dir), raw_path).rows
    raw = spark.read.parquet(raw_path)
    batch = timed("batch_total", lambda: run_batch(raw, f"{work}/out", STAR_SETTINGS))
    for stage, value in batch["stage_seconds"].items():
        seconds[f"batch_{stage}"] = value

    lines = spark.read.parquet(f"{work}/out/enriched_data")
    timed("quality_checks", lambda: run_all_checks(lines, STAR_SETTINGS).collect())
    timed("metric_tables", lambda: write_metrics(lines, f"{work}/again", STAR_SETTINGS))

    # Single queries, each from the star tables.
    for name in HEADLINES:
        timed(
            name,
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "batch_total_seconds",
                "value": seconds["batch_total"],
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "raw_rows": raw_rows,
                "raw_rows_per_second": round(raw_rows / seconds["batch_total"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
