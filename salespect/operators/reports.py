"""Profiles, top lists, retention and the run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salespect.functions.columns import cents, distinct_count


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row: size, nulls of every column, distinct customers and products."""
    measures = [F.count(F.lit(1)).alias("row_count")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    for label, names in (
        ("unique_customers", ("CustomerID", "customer_id")),
        ("unique_products", ("StockCode", "product_id")),
    ):
        measures += [distinct_count(c, exact).alias(label) for c in names if c in df.columns]
    return df.agg(*measures)


def top_customers(customers: DataFrame, k: int = 5) -> DataFrame:
    return (
        customers.orderBy(F.desc("total_spent"), "customer_id", "country")
        .limit(k)
        .select("customer_id", "total_spent", "customer_segment")
    )


def top_products(products: DataFrame, k: int = 5) -> DataFrame:
    return (
        products.orderBy(F.desc("total_revenue"), "product_id", "product_description")
        .limit(k)
        .select("product_id", "total_revenue", "unique_customers")
    )


def retain_days(df: DataFrame, days: int, as_of: Column, date_column: str = "invoice_date") -> DataFrame:
    """Rows of the last `days` days.

    By invoice date, on a table with year and month columns, the month that the
    first day implies is a condition of its own, so folders by month are pruned.
    """
    first = F.date_sub(as_of, days)
    kept = df.filter(F.col(date_column) > first)
    if date_column != "invoice_date" or not {"year", "month"} <= set(df.columns):
        return kept
    year, month = F.col("year"), F.col("month")
    return kept.filter((year > F.year(first)) | ((year == F.year(first)) & (month >= F.month(first))))


def run_summary(
    customers: DataFrame,
    products: DataFrame,
    days: DataFrame,
    countries: DataFrame,
    quality: DataFrame,
) -> DataFrame:
    """One row: the quality counts with sizes and extremes of the metric tables."""
    count = F.count(F.lit(1))
    spent = F.col("total_spent")
    found = customers.agg(
        F.struct(
            count.alias("n"),
            F.max(spent).alias("top"),
            (F.sum(cents(spent)) / 100 / F.count(spent)).alias("mean"),
        )
    ).scalar()
    sold = products.agg(F.struct(count.alias("n"), F.max("total_revenue").alias("top"))).scalar()
    return quality.select(
        "*",
        found["n"].alias("total_customers"),
        found["top"].alias("top_customer_spent"),
        found["mean"].alias("avg_customer_spent"),
        sold["n"].alias("total_products"),
        sold["top"].alias("top_product_revenue"),
        days.agg(count).scalar().alias("total_days"),
        countries.agg(count).scalar().alias("total_countries"),
    )
