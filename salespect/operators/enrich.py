"""Business and text flags on clean transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.columns import flag, ladder
from salespect.operators.clean import clean, clean_base, standardize, with_derived
from salespect.schema import UNKNOWN


def with_order_size(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    # Size labels.
    steps = [
        (cfg.bulk_order_threshold, "Bulk"),
        (cfg.large_order_threshold, "Large"),
        (cfg.medium_order_threshold, "Medium"),
    ]
    return df.withColumn("order_size", ladder(F.col("quantity"), steps, "Small"))


def with_price_category(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    # Price labels.
    steps = [
        (cfg.premium_price_threshold, "Premium"),
        (cfg.standard_price_threshold, "Standard"),
        (cfg.economy_price_threshold, "Economy"),
    ]
    return df.withColumn("price_category", ladder(F.col("unit_price"), steps, "Budget"))


def with_value_flags(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    at_home = F.col("country").isin(*cfg.home_countries)
    return df.withColumns(
        {
            "is_high_value": flag(F.col("total_price") >= cfg.high_value_threshold),
            "is_uk": flag(at_home),
            "is_international": flag(~at_home),
            "is_identified_customer": flag(F.col("customer_id") != UNKNOWN),
        }
    )


def with_text_flags(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    text = F.lower("product_description")
    return df.withColumns(
        {
            "is_vintage": flag(text.contains(cfg.vintage_text)),
            "is_christmas": flag(text.contains(cfg.christmas_text)),
            "is_gift": flag(text.rlike(cfg.gift_pattern)),
        }
    )


def with_business_flags(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return (
        df.transform(with_order_size, cfg)
        .transform(with_price_category, cfg)
        .transform(with_value_flags, cfg)
        .transform(with_text_flags, cfg)
    )


def enrich_by_month(raw: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The enriched table with its rows rebalanced by month, for a write in folders by year and month.

    The exchange carries the base columns and one month number; the other
    columns are derived behind it, by the tasks that write.
    """
    base = clean_base(standardize(raw), cfg)
    moment = F.col("invoice_datetime")
    shaped = base.withColumn("_month", F.year(moment) * 100 + F.month(moment)).hint("rebalance", "_month")
    return from_base(shaped.drop("_month"), cfg)


def from_base(base: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Clean base lines with everything that derives from them."""
    return base.transform(with_derived).transform(with_business_flags, cfg)


def enrich(raw: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Raw lines to the enriched transaction table all metrics read."""
    return standardize(raw).transform(clean, cfg).transform(with_business_flags, cfg)
