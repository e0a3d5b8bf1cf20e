"""The full batch: raw lines to enriched table, quality report and metric tables."""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.staging import drop_staged, staged
from salespect.operators.countries import country_metrics
from salespect.operators.customers import customer_base, finish_customers
from salespect.operators.daily import daily_metrics
from salespect.operators.enrich import enrich_by_month
from salespect.operators.hourly import hourly_patterns
from salespect.operators.products import finish_products, product_base
from salespect.operators.quality import run_all_checks, summarize_checks
from salespect.operators.reports import run_summary
from salespect.plans.run_log import append_run
from salespect.plans.sinks import (
    Written,
    as_json_row,
    partition_columns,
    read_table,
    write_json,
    write_quality_report,
    write_table,
)
from salespect.sources.readers import (
    CORRUPT,
    load_csv_folder,
    load_main_csv,
    quarantine_report,
    split_corrupt,
    with_reason,
)


class QualityError(RuntimeError):
    """Raised on failed quality checks when the run is told to stop on them."""


@dataclass
class Stages:
    """Wall-clock time by stage, and the stage at work."""

    seconds: dict[str, float] = field(default_factory=dict)
    current: str = "start"

    @contextmanager
    def stage(self, name: str):
        self.current, begin = name, time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = round(time.monotonic() - begin, 3)


def _finished_from_base(base: Callable, finish: Callable, label: str, cfg: Settings):
    """A table whose base aggregate is stored first: quantiles and ranks read it repeatedly."""
    return lambda lines: finish(staged(base(lines, cfg), label), cfg)


def _metric_builders(cfg: Settings) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Per metric table a function from the lines to the table."""
    return {
        "customer_metrics": _finished_from_base(customer_base, finish_customers, "customers", cfg),
        "product_metrics": _finished_from_base(product_base, finish_products, "products", cfg),
        "daily_metrics": lambda lines: daily_metrics(lines, cfg),
        "country_metrics": lambda lines: country_metrics(lines, cfg),
        "hourly_patterns": lambda lines: hourly_patterns(lines, cfg),
    }


METRIC_TABLES = tuple(_metric_builders(Settings()))


def _write_metric(name: str, lines: DataFrame, output: str, cfg: Settings) -> tuple[Written, DataFrame]:
    table = _metric_builders(cfg)[name](lines)
    written = write_table(table, f"{output}/{name}", partition_columns(name), cfg)
    return written, read_table(lines.sparkSession, written.path, table)


def write_metrics(
    lines: DataFrame, output: str, cfg: Settings = Settings(), jobs: int = len(METRIC_TABLES)
) -> dict[str, tuple[Written, DataFrame]]:
    """Compute and write the metric tables, up to `jobs` of them at a time, and scan what was written.

    The jobs are independent scans of the same table; submitting them together
    lets small ones fill executors that large ones leave idle.
    """
    with ThreadPoolExecutor(max_workers=jobs) as pool:
        written = pool.map(lambda name: _write_metric(name, lines, output, cfg), METRIC_TABLES)
        return dict(zip(METRIC_TABLES, written))


def _check_quality(lines: DataFrame, output: str, cfg: Settings) -> tuple[DataFrame, Row]:
    """Run and report the checks; returns the stored check rows and their summary."""
    checks = staged(run_all_checks(lines, cfg), "checks")
    verdict = summarize_checks(checks)
    write_quality_report(checks, verdict, f"{output}/quality_report")
    return checks, verdict.first()


def run_batch(
    raw: DataFrame,
    output: str,
    cfg: Settings = Settings(),
    *,
    jobs: int = len(METRIC_TABLES),
    run_log: str | None = None,
    stop_on_errors: bool = False,
) -> dict:
    """Run everything on raw lines and return the run record.

    Lines read with the text of malformed ones are split first: the malformed
    lines become the table `quarantine` and are counted in the record.
    The enriched table is computed and written once; all later stages scan it
    with only the columns they need. The quality checks run beside the metric
    tables, since failed ones are reported without stopping the run; on request
    they run first and stop it. The staged intermediate tables stay until the
    caller drops them.
    """
    spark = raw.sparkSession
    stages, begin = Stages(), time.monotonic()
    record: dict = {"status": "started", "start_time": datetime.now().isoformat()}
    read = Observation()
    try:
        with stages.stage("transformation"):
            path = f"{output}/enriched_data"
            if CORRUPT in raw.columns:
                raw, malformed = split_corrupt(raw)
                record["rows_quarantined"] = write_table(with_reason(malformed), f"{output}/quarantine", cfg=cfg).rows
                report = quarantine_report(spark.read.parquet(f"{output}/quarantine"))
                write_json(report, f"{output}/quarantine_report")
            counted = raw.observe(read, F.count(F.lit(1)).alias("rows"))
            enriched = enrich_by_month(counted, cfg)
            rows = write_table(enriched, path, partition_columns("enriched_data"), cfg, rebalance=False).rows
            lines = read_table(spark, path, enriched)
        with stages.stage("quality_and_metrics"), ThreadPoolExecutor(1) as beside:
            checking = beside.submit(_check_quality, lines, output, cfg)
            if stop_on_errors and not checking.result()[1].quality_passed:
                raise QualityError(f"{checking.result()[1].failed} quality checks failed")
            written = write_metrics(lines, output, cfg, jobs)
            checks, quality = checking.result()
        with stages.stage("report"):
            verdict = summarize_checks(checks)
            tables = {n: table for n, (_, table) in written.items()}
            summary = run_summary(
                tables["customer_metrics"],
                tables["product_metrics"],
                tables["daily_metrics"],
                tables["country_metrics"],
                verdict,
            )
            failed = checks.filter("status = 'failed'")
            failed = failed.agg(F.collect_list(F.struct("check", "message"))).scalar()
            write_json(
                summary.select(
                    "*",
                    failed.alias("failed_checks"),
                    F.current_timestamp().alias("execution_time"),
                    F.current_date().alias("execution_date"),
                    F.lit(time.monotonic() - begin).alias("pipeline_duration_seconds"),
                    F.lit(record.get("rows_quarantined", 0)).cast("long").alias("rows_quarantined"),
                ),
                f"{output}/summary_report",
            )
        seconds = time.monotonic() - begin
        # Where no line is left, adaptive execution drops the scan together with its metrics.
        rows_read = read.get["rows"] if rows else raw.count()
        record |= {
            "status": "completed",
            "rows_read": rows_read,
            "rows_processed": rows,
            "retained_percent": 100.0 * rows / rows_read if rows_read else 0.0,
            "rows_written": {n: w.rows for n, (w, _) in written.items()},
            "throughput_records_per_second": rows / seconds,
            "quality_passed": quality.quality_passed,
            "quality_score": quality.quality_score,
        }
        return record
    except Exception as error:
        record |= {
            "status": "failed",
            "failed_stage": stages.current,
            "error_type": type(error).__name__,
            "error": str(error),
        }
        raise
    finally:
        record |= {
            "end_time": datetime.now().isoformat(),
            "total_duration_seconds": round(time.monotonic() - begin, 3),
            "stage_seconds": stages.seconds,
        }
        write_json(as_json_row(spark, record), f"{output}/run_result")
        if run_log:
            append_run(spark, run_log, record)


def main() -> None:
    parser = argparse.ArgumentParser(description="Retail transaction analytics")
    parser.add_argument("source", help="folder with the CSV files")
    parser.add_argument("output", help="folder for the result tables")
    parser.add_argument("--run-log", help="folder of the run log")
    parser.add_argument("--jobs", type=int, default=len(METRIC_TABLES), help="metric tables computed at a time")
    parser.add_argument("--stop-on-errors", action="store_true")
    parser.add_argument("--main-file-only", action="store_true", help="read the folder's main file and name the others")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("salespect").getOrCreate()
    try:
        if args.main_file_only:
            raw, left_out = load_main_csv(spark, args.source)
            for row in left_out.toLocalIterator():
                print(f"left out: {row.path}")
        else:
            raw = load_csv_folder(spark, args.source)
        record = run_batch(
            raw,
            args.output,
            jobs=args.jobs,
            run_log=args.run_log,
            stop_on_errors=args.stop_on_errors,
        )
    finally:
        drop_staged(spark)
    print(json.dumps(record, indent=2))


if __name__ == "__main__":
    main()
