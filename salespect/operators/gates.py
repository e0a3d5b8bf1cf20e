"""Gates around a run: source size, output presence, freshness and volume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespect.sources.files import list_files

# Gate limits.
MIN_SOURCE_BYTES = int(0.1 * 1024 * 1024)
MAX_AGE_HOURS = 24
MIN_CUSTOMERS = 100
MIN_PRODUCTS = 10


def _status(passed: Column) -> Column:
    return F.when(passed, "passed").otherwise("failed").alias("status")


def source_size_gate(files: DataFrame, min_bytes: int = MIN_SOURCE_BYTES) -> DataFrame:
    return files.select("path", "length", _status(F.col("length") >= min_bytes))


def output_presence(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """Number of Parquet files below root for each expected table."""
    files = list_files(spark, root, "*.parquet", recursive=True)
    table = F.regexp_extract("path", r".*/(" + "|".join(tables) + r")/", 1)
    found = files.groupBy(table.alias("table")).agg(F.count(F.lit(1)).alias("n"))
    expected = spark.createDataFrame([(t,) for t in tables], "table string")
    count = F.coalesce("n", F.lit(0))
    return expected.join(found, "table", "left").select(
        "table", count.alias("file_count"), _status(count > 0)
    )


def file_freshness(
    spark: SparkSession, path: str, as_of: Column | None = None, max_hours: float = MAX_AGE_HOURS
) -> DataFrame:
    """Age of the newest Parquet file of a table."""
    now = F.current_timestamp() if as_of is None else as_of
    newest = F.max("modificationTime")
    hours = (F.unix_timestamp(now) - F.unix_timestamp(newest)) / 3600
    return list_files(spark, path, "*.parquet", recursive=True).agg(
        newest.alias("newest_file"),
        hours.alias("age_hours"),
        _status(F.coalesce(hours <= max_hours, F.lit(False))),
    )


def data_freshness(df: DataFrame, as_of: Column, max_days: int = 1) -> DataFrame:
    """Age of the newest invoice date; a date after `as_of` is a mistake and fails."""
    newest = F.max("invoice_date")
    age = F.datediff(as_of, newest)
    return df.agg(
        newest.alias("newest_date"),
        age.alias("age_days"),
        _status(F.coalesce(age.between(0, max_days), F.lit(False))),
    )


def volume_gate(
    summary: DataFrame, min_customers: int = MIN_CUSTOMERS, min_products: int = MIN_PRODUCTS
) -> DataFrame:
    customers, products = F.col("total_customers"), F.col("total_products")
    return summary.select(
        "total_customers",
        "total_products",
        _status((customers >= min_customers) & (products >= min_products)),
    )
