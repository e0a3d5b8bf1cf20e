"""Purchase order of each customer's lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ties within a minute are settled by these columns, so numbering is repeatable.
LINE_ORDER = (
    "invoice_datetime",
    "invoice_no",
    "product_id",
    "quantity",
    "unit_price",
    "product_description",
    "country",
)


def with_customer_sequence(df: DataFrame) -> DataFrame:
    """Add customer_purchase_number and days_since_first_purchase to clean lines.

    One placeholder customer can own a large part of all lines, so lines are
    numbered within (customer, minute) and shifted by the customer's earlier
    minutes. Per customer only the counts per minute are brought together, whose
    number the valid years bound.
    """
    lines = df.withColumn("_minute", F.date_trunc("minute", "invoice_datetime"))
    slot = ["customer_id", "_minute"]
    earlier = (
        Window.partitionBy("customer_id")
        .orderBy("_minute")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    minutes = (
        lines.groupBy(*slot)
        .agg(F.count(F.lit(1)).alias("_lines"))
        .select(
            *slot,
            F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"),
            F.min("_minute").over(Window.partitionBy("customer_id")).alias("_first"),
        )
    )
    within = Window.partitionBy(*slot).orderBy(*LINE_ORDER)
    return (
        lines.withColumn("_place", F.row_number().over(within))
        .join(minutes, slot)
        .withColumns(
            {
                "customer_purchase_number": F.col("_before") + F.col("_place"),
                "days_since_first_purchase": F.datediff("invoice_date", F.to_date("_first")),
            }
        )
        .drop("_minute", "_place", "_before", "_first")
    )
