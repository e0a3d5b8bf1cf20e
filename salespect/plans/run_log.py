"""Log of runs: one JSON record each, summarised by reading the log as a table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The record of a run. Fields are only ever added at the end: older records read as NULL there.
RUN_FIELDS = {
    "run_time": "timestamp",
    "status": "string",
    "total_duration_seconds": "double",
    "rows_processed": "bigint",
    "quality_score": "double",
    "failed_stage": "string",
    "error": "string",
    "execution_date": "date",
    "start_time": "string",
    "end_time": "string",
    "rows_read": "bigint",
    "rows_quarantined": "bigint",
    "rows_written": "map<string,bigint>",
    "retained_percent": "double",
    "throughput_records_per_second": "double",
    "stage_seconds": "map<string,double>",
    "quality_passed": "boolean",
    "error_type": "string",
}
RUN_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RUN_FIELDS.items())


def append_run(spark: SparkSession, folder: str, record: dict, run_time: datetime | None = None) -> None:
    """Append one run's record as a JSON line; what the record does not have is NULL."""
    moment = run_time or datetime.now()
    values = {"run_time": moment, "execution_date": moment.date(), **record}
    row = tuple(values.get(n) for n in RUN_FIELDS)
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").json(folder)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).json(folder)


def run_history(runs: DataFrame, days: int = 7, as_of: Column | None = None) -> DataFrame:
    """One row over the runs of the last days: counts by outcome, durations of completed runs, rows and stages.

    slowest_stage is the stage of most seconds in all, failing_stage the one
    that failed most often; ties go to the smaller name.
    """
    now = F.current_timestamp() if as_of is None else as_of
    recent = runs.filter(F.col("run_time") > now - F.make_dt_interval(days=F.lit(days)))
    done = F.col("status") == "completed"
    duration = F.when(done, F.coalesce("total_duration_seconds", F.lit(0.0)))
    none = F.lit(0.0)
    stages = recent.select(F.explode("stage_seconds").alias("stage", "seconds")).groupBy("stage").agg(F.sum("seconds").alias("n"))
    failing = recent.filter(F.col("failed_stage").isNotNull()).groupBy(F.col("failed_stage").alias("stage")).agg(F.count(F.lit(1)).alias("n"))

    def leading(counts: DataFrame) -> Column:
        return counts.agg(F.min_by("stage", F.struct(-F.col("n"), F.col("stage")))).scalar()

    return recent.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(done).alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.coalesce(F.avg(duration), none).alias("avg_duration"),
        F.coalesce(F.min(duration), none).alias("min_duration"),
        F.coalesce(F.max(duration), none).alias("max_duration"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_read", "rows_processed", "rows_quarantined")],
        F.max("execution_date").alias("last_execution_date"),
    ).withColumns({"slowest_stage": leading(stages), "failing_stage": leading(failing)})
