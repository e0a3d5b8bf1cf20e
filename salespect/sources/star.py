"""Raw invoice lines derived from the star-schema tables.

Every line item becomes one raw transaction. Missing customers, quantities and
descriptions, varying descriptions, returns and unreadable dates are derived
from the keys, so every rule has something to act on at every scale.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.schema import INVOICE_TIME_FORMAT

STAR_SETTINGS = Settings(
    first_year=1996,
    last_year=2000,
    high_value_threshold=1000.0,
    bulk_order_threshold=40,
    total_countries=25,
    vintage_text="red",
    christmas_text="blue",
    gift_pattern="widget|gear",
    as_of=date(2000, 6, 30),
)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines, dealt by the invoice number they come with, so that work per invoice needs no further exchange."""
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    home = F.create_map(
        *map(F.lit, (0, "United Kingdom", 1, "EIRE", 2, "Channel Islands"))
    )
    countries = table("nation").select(
        "n_nationkey",
        F.coalesce(F.try_element_at(home, F.col("n_nationkey")), F.col("n_name")).alias("Country"),
    )
    key = F.col("o_orderkey")
    moment = F.col("o_orderdate") + F.make_dt_interval(
        hours=(key * 7 % 24).cast("int"), mins=(key * 13 % 60).cast("int")
    )
    invoices = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(countries, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("string").alias("InvoiceNo"),
            F.when(key % 997 == 0, F.lit("invalid"))
            .otherwise(F.date_format(moment, INVOICE_TIME_FORMAT))
            .alias("InvoiceDate"),
            F.when(key % 10 != 0, F.col("o_custkey").cast("string")).alias("CustomerID"),
            "Country",
        )
    )
    order, part, line = F.col("InvoiceNo").cast("long"), F.col("l_partkey"), F.col("l_linenumber")
    name = F.upper("p_name")
    variant = (line == 7) & (part % 10 == 1)
    quantity = F.when(order % 499 != 0, F.col("l_quantity").cast("int"))
    returned = (F.col("l_returnflag") == "R") & (line == 1)
    return (
        table("lineitem")
        .withColumn("InvoiceNo", F.col("l_orderkey").cast("string"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(invoices, "InvoiceNo")
        .select(
            "InvoiceNo",
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.when(variant, F.concat(name, F.lit(" SET")))
            .when(part % 20 != 0, name)
            .alias("Description"),
            F.when(returned, -quantity).otherwise(quantity).alias("Quantity"),
            "InvoiceDate",
            (F.floor(F.col("l_extendedprice") / F.col("l_quantity")) / 100)
            .cast("double")
            .alias("UnitPrice"),
            "CustomerID",
            "Country",
        )
    )
