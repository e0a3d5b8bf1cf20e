"""Standardise and clean raw transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespect.config import Settings
from salespect.functions.columns import flag
from salespect.schema import (
    INVOICE_TIME_FORMAT,
    NO_DESCRIPTION,
    STANDARD_NAMES,
    UNKNOWN,
)

LINE_KEYS = ("invoice_no", "product_id", "invoice_date")
CRITICAL_COLUMNS = ("invoice_no", "product_id", "quantity", "unit_price")


def standardize(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(STANDARD_NAMES)


def with_invoice_datetime(df: DataFrame) -> DataFrame:
    """Add the parsed invoice time; text that does not parse gives NULL."""
    if isinstance(df.schema["invoice_date"].dataType, T.StringType):
        parsed = F.try_to_timestamp(F.col("invoice_date"), F.lit(INVOICE_TIME_FORMAT))
    else:
        parsed = F.col("invoice_date").cast("timestamp")
    return df.withColumn("invoice_datetime", parsed)


def in_invoice_years(cfg: Settings) -> Column:
    """One membership test, so that the pushed-down filter parses the text only once."""
    return F.year("invoice_datetime").isin(*range(cfg.first_year, cfg.last_year + 1))


def parse_dates(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Replace the raw date text by a date, keeping only readable rows of the valid years."""
    return (
        with_invoice_datetime(df)
        .filter(in_invoice_years(cfg))
        .withColumn("invoice_date", F.to_date("invoice_datetime"))
    )


def dedup(df: DataFrame, keys: Sequence[str] = LINE_KEYS) -> DataFrame:
    """Keep one row per key, the same one for any partitioning of the input.

    The survivor is the first by quantity and price (highest first), then by
    every other column. Spark trims each map task to one row per key before the
    shuffle (window group limit), so a heavily copied key stays small.
    """
    others = [c for c in df.columns if c not in (*keys, "invoice_datetime")]
    first = [c for c in ("quantity", "unit_price") if c in others]
    rest = [c for c in others if c not in first]
    order = [F.col(c).desc_nulls_last() for c in first]
    order += [F.col(c).asc_nulls_last() for c in rest]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_copy", F.row_number().over(window)).filter("_copy = 1").drop("_copy")
        if order
        else df.dropDuplicates(list(keys))
    )


def fill_nulls(df: DataFrame) -> DataFrame:
    return df.fillna(
        {
            "customer_id": UNKNOWN,
            "product_description": NO_DESCRIPTION,
            "country": UNKNOWN,
        }
    )


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    return df.dropna(subset=list(CRITICAL_COLUMNS))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: null count and share, from a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot("_rows", df.columns, "column_name", "null_count").select(
        "column_name",
        "null_count",
        F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("_rows")), F.lit(0.0)).alias(
            "null_percent"
        ),
    )


def with_total_price(df: DataFrame) -> DataFrame:
    return df.withColumn("total_price", F.round(F.col("quantity") * F.col("unit_price"), 2))


def with_calendar(df: DataFrame) -> DataFrame:
    day = F.col("invoice_date")
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            "hour": F.hour("invoice_datetime"),
            "day_of_week": F.dayofweek(day),
            "quarter": F.quarter(day),
            "week_of_year": F.weekofyear(day),
        }
    )


def with_time_flags(df: DataFrame) -> DataFrame:
    hour, weekday = F.col("hour"), F.col("day_of_week")
    # Parts of the day and the week.
    return df.withColumns(
        {
            "is_weekend": flag(weekday.isin(1, 7)),
            "is_morning": flag(hour.between(6, 11)),
            "is_afternoon": flag(hour.between(12, 17)),
            "is_evening": flag(hour.between(18, 23)),
            "is_business_hours": flag(hour.between(9, 16) & weekday.between(2, 6)),
        }
    )


def valid_lines(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    quantity, price = F.col("quantity"), F.col("unit_price")
    return df.filter(
        (quantity > 0)
        & (quantity < cfg.quantity_cap)
        & (price > 0)
        & (price < cfg.price_cap)
        & (F.col("total_price") > 0)
        & F.col("invoice_date").isNotNull()
    )


def clean_base(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Standardised raw lines to clean lines without what derives from them: the date text goes, its time stays.

    Duplicates go before invalid rows do, so an invalid copy can displace a
    valid one. Conditions on the key columns alone (date, years, missing keys)
    remove whole key groups; they run first and keep those rows out of the
    shuffle.
    """
    keyed = (
        with_invoice_datetime(df)
        .filter(in_invoice_years(cfg))
        .dropna(subset=["invoice_no", "product_id"])
    )
    return (
        dedup(keyed)
        .transform(fill_nulls)
        .transform(drop_critical_nulls)
        .transform(with_total_price)
        .transform(valid_lines, cfg)
        .drop("invoice_date", "total_price")
    )


def with_derived(base: DataFrame) -> DataFrame:
    """Clean base lines with date, total, calendar and flags; the date stands where its text stood."""
    names = [c for c in base.columns if c != "invoice_datetime"]
    at = names.index("quantity") + 1 if "quantity" in names else len(names)
    dated = base.withColumn("invoice_date", F.to_date("invoice_datetime"))
    ordered = dated.select(*names[:at], "invoice_date", *names[at:], "invoice_datetime")
    return ordered.transform(with_total_price).transform(with_calendar).transform(with_time_flags)


def clean(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Standardised raw lines to clean lines."""
    lines = clean_base(df, cfg).transform(with_derived)
    first = [c for c in df.columns if c in lines.columns]
    return lines.select(*first, *[c for c in lines.columns if c not in first])
