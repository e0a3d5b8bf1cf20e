"""Customer value classes, for DataFrame and SQL use."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from salespect.functions.columns import ladder

# Spending classes.
VALUE_CLASSES = [(1000, "High"), (500, "Medium")]
LOWEST_CLASS = "Low"


def classify_customer_value(total_spent: Column) -> Column:
    return ladder(total_spent, VALUE_CLASSES, LOWEST_CLASS)


def register_sql_functions(spark: SparkSession) -> None:
    """Make classify_customer_value callable from SQL; Spark inlines its body."""
    branches = " ".join(f"WHEN total_spent >= {b} THEN '{label}'" for b, label in VALUE_CLASSES)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION classify_customer_value(total_spent DOUBLE) "
        f"RETURNS STRING RETURN CASE {branches} ELSE '{LOWEST_CLASS}' END"
    )
