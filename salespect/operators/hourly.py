"""Hour-by-weekday sales patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.columns import cents, day_name, flag
from salespect.functions.distinct import grouped


def _all_cells():
    """All rows of the aggregate: at most 24 x 7, so one task holds them easily."""
    return Window.partitionBy()


def hourly_totals(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Aggregates, shares and rates per (hour, weekday); grand totals are sums of these rows."""
    amount = F.col("total_price")
    measures = {
        "transaction_count": F.count(F.lit(1)),
        "_cents": F.sum(cents(amount)),
        "unique_customers": "customer_id",
        "unique_products": "product_id",
        "total_items": F.sum("quantity"),
        "revenue_stddev": F.stddev_samp(amount),
        "high_value_transactions": F.count_if(F.col("is_high_value") == 1),
        "international_transactions": F.count_if(F.col("is_international") == 1),
    }
    cells = grouped(df, ("hour", "day_of_week"), measures, cfg.exact_distinct)
    count, hour = F.col("transaction_count"), F.col("hour")
    # Periods of the day.
    period = (
        F.when(hour.between(6, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(18, 21), "Evening")
        .otherwise("Night")
    )
    return cells.withColumns(
        {
            "total_revenue": F.col("_cents") / 100,
            "avg_transaction_value": F.col("_cents") / 100 / count,
            "transaction_share": count / F.sum(count).over(_all_cells()) * 100,
            "revenue_share": F.col("_cents") / F.sum("_cents").over(_all_cells()) * 100,
            "avg_items_per_transaction": F.col("total_items") / count,
            "high_value_rate": F.col("high_value_transactions") / count,
            "international_rate": F.col("international_transactions") / count,
            "day_name": day_name(F.col("day_of_week")),
            "time_period": period,
        }
    ).drop("_cents")


def with_peak_hours(cells: DataFrame) -> DataFrame:
    """Mark the hours whose total over all weekdays reaches the upper quartile of the hours."""
    per_hour = Window.partitionBy("hour")
    once = F.row_number().over(per_hour.orderBy("day_of_week")) == 1
    return (
        cells.withColumn("_hour_total", F.sum("transaction_count").over(per_hour))
        .withColumn("_once", F.when(once, F.col("_hour_total")))
        .withColumn("_bar", F.percentile_approx("_once", 0.75).over(_all_cells()))
        .withColumn("is_peak_hour", flag(F.col("_hour_total") >= F.col("_bar")))
        .drop("_hour_total", "_once", "_bar")
    )


def hourly_patterns(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return hourly_totals(df, cfg).transform(with_peak_hours)
