"""Thresholds and switches, passed explicitly to the operators that need them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Settings:
    # Business thresholds.
    high_value_threshold: float = 100.0
    bulk_order_threshold: int = 100
    large_order_threshold: int = 20
    medium_order_threshold: int = 5
    premium_price_threshold: float = 50.0
    standard_price_threshold: float = 10.0
    economy_price_threshold: float = 5.0
    first_year: int = 2010
    last_year: int = 2012
    price_cap: float = 10000.0
    quantity_cap: int = 10000
    home_countries: tuple[str, ...] = ("United Kingdom", "EIRE", "Channel Islands")
    total_countries: int = 38
    vintage_text: str = "vintage"
    christmas_text: str = "christmas"
    gift_pattern: str = "gift|present"
    # Quality thresholds.
    min_rows: int = 1000
    max_rows: int = 10_000_000
    max_duplicate_rate: float = 0.05
    min_customer_coverage: float = 0.5
    price_tolerance: float = 0.01
    opening_hour: int = 6
    closing_hour: int = 22
    max_unusual_hour_rate: float = 0.1
    max_customer_rows: int = 1000
    max_customer_spend: float = 100_000.0
    min_date_density: float = 0.3
    max_gap_days: int = 7
    iqr_factor: float = 1.5
    max_outlier_rate: float = 0.05
    max_country_share: float = 0.8

    # Reference date for "future" and "recent"; None means the day the job runs.
    as_of: date | None = None
    # Leave the placeholder customer out of the customer table.
    exclude_unknown: bool = False
    # None gives exact quantiles; an accuracy switches to percentile_approx.
    quantile_accuracy: int | None = None
    # False replaces exact distinct counts with HyperLogLog sketches.
    exact_distinct: bool = True
    # Greatest number of rows of an output file; 0 leaves file sizes to the rebalanced partitions.
    max_records_per_file: int = 0
