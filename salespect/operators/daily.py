"""Daily time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.columns import (
    cents,
    day_name,
    flag,
    money_avg,
    money_sum,
    rate,
)
from salespect.functions.distinct import grouped
from salespect.schema import UNKNOWN


def _by_day():
    """Order of the selling days.

    There is one row per day and the valid years bound their number, so ordering
    them in one task is cheap at any data size.
    """
    return Window.orderBy("invoice_date")


def daily_totals(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    amount = F.col("total_price")
    measures = {
        "total_orders": "invoice_no",
        "unique_customers": "customer_id",
        "unique_products_sold": "product_id",
        "total_revenue": money_sum(amount),
        "avg_order_value": money_avg(amount),
        "max_order_value": F.max(amount),
        "revenue_stddev": F.stddev_samp(amount),
        "total_items_sold": F.sum("quantity"),
        "international_orders": F.sum("is_international"),
        "high_value_orders": F.count_if(F.col("is_high_value") == 1),
        "identified_orders": F.count_if(F.col("customer_id") != UNKNOWN),
    }
    totals = grouped(df, ("invoice_date",), measures, cfg.exact_distinct)
    day, orders = F.col("invoice_date"), F.col("total_orders")
    return totals.withColumns(
        {
            "avg_items_per_order": rate(F.col("total_items_sold"), orders),
            "international_rate": rate(F.col("international_orders"), orders),
            "high_value_rate": rate(F.col("high_value_orders"), orders),
            "customer_identification_rate": rate(F.col("identified_orders"), orders),
            "day_of_week": F.dayofweek(day),
            "day_name": day_name(F.dayofweek(day)),
            "is_weekend": flag(F.dayofweek(day).isin(1, 7)),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "year": F.year(day),
            "week_of_year": F.weekofyear(day),
        }
    )


def with_moving_averages(days: DataFrame) -> DataFrame:
    """Averages over the last 7 and 30 selling days."""
    week, month = _by_day().rowsBetween(-6, 0), _by_day().rowsBetween(-29, 0)
    revenue = cents(F.col("total_revenue"))

    def revenue_mean(window):
        return F.sum(revenue).over(window) / 100 / F.count(revenue).over(window)

    return days.withColumns(
        {
            "revenue_ma7": revenue_mean(week),
            "revenue_ma30": revenue_mean(month),
            "orders_ma7": F.avg("total_orders").over(week),
            "orders_ma30": F.avg("total_orders").over(month),
            "customers_ma7": F.avg("unique_customers").over(week),
        }
    )


def with_growth(days: DataFrame) -> DataFrame:
    """Change in percent against the previous selling day."""

    def growth(today: str, yesterday: str):
        step = (F.col(today) - F.col(yesterday)) / F.col(yesterday) * 100
        return F.when(F.col(yesterday) > 0, step).otherwise(F.lit(0.0))

    return days.withColumns(
        {
            "revenue_yesterday": F.lag("total_revenue").over(_by_day()),
            "orders_yesterday": F.lag("total_orders").over(_by_day()),
        }
    ).withColumns(
        {
            "daily_growth": growth("total_revenue", "revenue_yesterday"),
            "order_growth": growth("total_orders", "orders_yesterday"),
        }
    )


def daily_metrics(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return daily_totals(df, cfg).transform(with_moving_averages).transform(with_growth)
