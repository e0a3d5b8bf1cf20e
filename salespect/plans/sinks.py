"""Parquet, JSON and text outputs."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salespect.config import Settings

# Partition columns of each output table.
PARTITION_COLUMNS = {
    "enriched_data": ("year", "month"),
    "customer_metrics": ("country",),
    "product_metrics": (),
    "daily_metrics": ("year", "month"),
    "country_metrics": (),
    "hourly_patterns": ("day_of_week",),
}


@dataclass(frozen=True)
class Written:
    path: str
    rows: int


def partition_columns(name: str) -> tuple[str, ...]:
    """Columns to split a table's folder by, whatever its size."""
    return PARTITION_COLUMNS.get(name, ())


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cfg: Settings = Settings(),
    rebalance: bool = True,
) -> Written:
    """Overwrite a Parquet table in one pass, counting its rows on the way.

    Rows are rebalanced rather than repartitioned: each folder gets few files,
    yet a folder that holds much of the data is split over many tasks, and small
    tables end up in few files. File sizes follow from bytes, by the advisory
    partition size of adaptive execution. A frame that comes rebalanced is
    written as it is.
    """
    shaped = df.hint("rebalance", *partition_by) if rebalance else df
    seen = Observation()
    (
        shaped.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", cfg.max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return Written(path, seen.get["rows"])


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A written table with the columns, types and order it was written with, partition columns included."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def write_json(df: DataFrame, path: str) -> None:
    """Write a small frame (reports of a few rows) as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def quality_text(checks: DataFrame, summary: DataFrame, generated: datetime) -> str:
    """Readable quality report. Only check rows, some twenty, reach the driver."""
    totals = summary.first()
    found = checks.filter("status <> 'passed'").orderBy("status", "group", "check").collect()
    lines = [
        "Data quality report",
        f"Generated: {generated.isoformat(timespec='seconds')}",
        f"Quality score: {totals.quality_score:.1f}%",
        "",
        f"{totals.total_checks} checks: {totals.passed} passed, "
        f"{totals.failed} failed, {totals.warnings} warnings",
    ]
    for status, title in (("failed", "Failed checks"), ("warning", "Warnings")):
        rows = [r for r in found if r.status == status]
        if rows:
            lines += ["", title]
        for row in rows:
            lines.append(f"- {row.check}: {row.message}")
            if status == "failed" and row.metrics:
                lines.append(f"  {json.dumps(row.metrics, sort_keys=True)}")
    return "\n".join(lines)


def write_quality_report(
    checks: DataFrame, summary: DataFrame, path: str, generated: datetime | None = None
) -> str:
    """Write the report as text and the check rows as JSON below `path`; return the text."""
    text = quality_text(checks, summary, generated or datetime.now())
    spark: SparkSession = checks.sparkSession
    lines = spark.createDataFrame([(text,)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{path}/text")
    write_json(checks, f"{path}/json")
    return text


def as_json_row(spark: SparkSession, record: dict) -> DataFrame:
    """A one-row frame of a flat-or-nested record, typed by Spark's JSON reader."""

    def plain(value):
        return value.isoformat() if isinstance(value, (date, datetime)) else str(value)

    text = json.dumps(record, default=plain)
    lines = spark.createDataFrame([(text,)], "value string")
    schema = spark.range(1).select(F.schema_of_json(F.lit(text))).first()[0]
    return lines.select(F.from_json("value", schema).alias("record")).select("record.*")
