"""Named queries over the star-schema tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespect.functions.classify import register_sql_functions
from salespect.functions.order_stats import selected_quantile_frame
from salespect.functions.staging import staged, staging_path
from salespect.operators import (
    clean,
    countries,
    customers,
    daily,
    enrich,
    gates,
    hourly,
    products,
    quality,
    reports,
    sequence,
)
from salespect.plans.batch import run_batch
from salespect.plans.run_log import read_runs, run_history
from salespect.plans.sinks import partition_columns, read_table, write_table
from salespect.schema import RAW_SCHEMA
from salespect.sources.readers import (
    CORRUPT,
    quarantine_report,
    read_csv,
    read_json,
    read_parquet,
    split_corrupt,
    spread,
    with_reason,
)
from salespect.sources.star import STAR_SETTINGS, raw_transactions

# Averages and deviations of doubles differ in their last bits with row order.
ROUNDED = {
    "order_value_stddev": 6,
    "order_consistency": 6,
    "price_volatility": 6,
    "revenue_stddev": 6,
    "revenue_volatility": 6,
    "std_quantity": 6,
    "std_price": 6,
    "avg_price": 8,
    "avg_unit_price": 8,
    "price_range": 6,
    "popularity_score": 8,
}


class Inputs:
    """The transaction table at its stages, for one data folder."""

    cfg = STAR_SETTINGS

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return raw_transactions(self.spark, self.sf_dir)

    @cached_property
    def standard(self) -> DataFrame:
        return clean.standardize(self.raw)

    @cached_property
    def parsed(self) -> DataFrame:
        return clean.parse_dates(self.standard, self.cfg)

    @cached_property
    def clean(self) -> DataFrame:
        return clean.clean(self.standard, self.cfg)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.with_business_flags(self.clean, self.cfg)

    @cached_property
    def stored(self) -> DataFrame:
        """The enriched table, written once for queries that read it several times."""
        return staged(self.enriched, "enriched")

    @cached_property
    def customers(self) -> DataFrame:
        return staged(customers.customer_base(self.stored, self.cfg), "customers")

    @cached_property
    def products(self) -> DataFrame:
        return staged(products.product_base(self.stored, self.cfg), "products")


def _present(df: DataFrame) -> DataFrame:
    """Dates and times as text and noisy doubles rounded, so engines compare equal."""

    def shown(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif field.name in ROUNDED:
            value = F.round(value, ROUNDED[field.name])
        return value.alias(field.name)

    return df.select(*map(shown, df.schema))


def _country_metrics_flat(i: Inputs) -> DataFrame:
    """Country metrics with the top products spelled out, since engines print arrays differently."""
    top = F.transform(
        "top_3_products",
        lambda p: F.concat_ws(":", p["product_id"], F.format_string("%.2f", p["revenue"])),
    )
    return countries.country_metrics(i.enriched, i.cfg).withColumn(
        "top_3_products", F.concat_ws(",", top)
    )


def _product_popularity(i: Inputs) -> DataFrame:
    """Only the base columns are written and meet the counts; the others are derived behind the join."""
    base = staged(clean.clean_base(i.standard, i.cfg), "base")
    popular = enrich.from_base(products.with_product_popularity(base), i.cfg)
    columns = [c for c in popular.columns if c != "product_popularity"]
    return popular.select(*columns, "product_popularity")


def _run_summary(i: Inputs) -> DataFrame:
    checks = quality.run_all_checks(i.stored, i.cfg)
    return reports.run_summary(
        staged(customers.customer_base(i.stored, i.cfg), "customers"),
        staged(products.product_base(i.stored, i.cfg), "products"),
        daily.daily_totals(i.stored, i.cfg),
        i.stored.groupBy("country").count(),
        quality.summarize_checks(checks),
    )


def _batch_report(i: Inputs) -> DataFrame:
    """The summary the full batch leaves on disk."""
    output = staging_path(i.spark, "batch")
    run_batch(i.raw, output, i.cfg)
    return i.spark.read.json(f"{output}/summary_report").drop(
        *("execution_time", "execution_date", "pipeline_duration_seconds", "failed_checks"), "rows_quarantined"
    )


def _written(i: Inputs, label: str, **options: str) -> str:
    """The raw lines as files of the given kind."""
    path = staging_path(i.spark, label)
    i.raw.write.options(**options).format(label).save(path)
    return path


def _scan_csv(i: Inputs) -> DataFrame:
    path = _written(i, "csv", header="true", escape='"', emptyValue="")
    good, _ = split_corrupt(read_csv(i.spark, path))
    return clean.standardize(good)


def _scan_gzip(i: Inputs) -> DataFrame:
    path = _written(i, "csv", header="true", escape='"', emptyValue="", compression="gzip")
    return clean.standardize(spread(read_csv(i.spark, path)).drop(CORRUPT))


def _scan_json(i: Inputs) -> DataFrame:
    return clean.standardize(read_json(i.spark, _written(i, "json"), schema=RAW_SCHEMA))


def _enriched_table(i: Inputs) -> DataFrame:
    """The enriched table as written by month and read back."""
    path = staging_path(i.spark, "enriched_table")
    table = enrich.enrich_by_month(i.raw, i.cfg)
    write_table(table, path, partition_columns("enriched_data"), i.cfg, rebalance=False)
    return read_table(i.spark, path, table)


def _retained_table(i: Inputs) -> DataFrame:
    """The last days of the table in folders by month."""
    return reports.retain_days(_enriched_table(i), 365, F.lit(i.cfg.as_of))


def _quarantine(i: Inputs) -> DataFrame:
    """Reasons of malformed lines, from CSV files in which some numbers are none."""
    key = F.col("InvoiceNo").cast("long")
    damaged = i.raw.withColumns(
        {
            "Quantity": F.when(key % 89 == 0, "many").otherwise(F.col("Quantity").cast("string")),
            "UnitPrice": F.when(key % 97 == 0, "free").otherwise(F.col("UnitPrice").cast("string")),
        }
    )
    path = staging_path(i.spark, "csv")
    damaged.write.options(header="true", escape='"', emptyValue="").csv(path)
    _, bad = split_corrupt(read_csv(i.spark, path))
    return quarantine_report(with_reason(bad))


def _run_history(i: Inputs) -> DataFrame:
    """History over a log of runs, one per order of a customer group, written and read as a log."""
    orders = i.spark.read.parquet(f"{i.sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    failed = key % 5 == 0
    runs = orders.filter(key % 7 == 0).select(
        F.col("o_orderdate").cast("timestamp").alias("run_time"),
        F.col("o_orderdate").cast("date").alias("execution_date"),
        F.when(failed, "failed").otherwise("completed").alias("status"),
        (key % 600).cast("double").alias("total_duration_seconds"),
        F.when(~failed, key).alias("rows_processed"),
        (key * 2).alias("rows_read"),
        (key % 11).alias("rows_quarantined"),
        F.create_map(F.lit("transformation"), (key % 60).cast("double"), F.lit("report"), (key % 8).cast("double")).alias("stage_seconds"),
        F.when(failed, F.element_at(F.array(F.lit("transformation"), F.lit("report")), (key % 2 + 1).cast("int"))).alias("failed_stage"),
    )
    path = staging_path(i.spark, "runs")
    runs.write.json(path)
    as_of = F.lit(i.cfg.as_of).cast("timestamp")
    return run_history(read_runs(i.spark, path), 400, as_of)


def _volume_gate(i: Inputs) -> DataFrame:
    sizes = i.enriched.agg(
        F.count_distinct("customer_id", "country").alias("total_customers"),
        F.count_distinct("product_id", "product_description").alias("total_products"),
    )
    return gates.volume_gate(sizes)


def _classified(i: Inputs) -> DataFrame:
    register_sql_functions(i.spark)
    return i.customers.select(
        "customer_id",
        "country",
        "total_spent",
        F.expr("classify_customer_value(total_spent)").alias("value_class"),
    )


def _spoiled(i: Inputs) -> DataFrame:
    """Stored lines whose columns came in the wrong types, with values that cannot be read."""

    def text(column: str, bad: Column, instead: str) -> Column:
        return F.when(bad, instead).otherwise(F.col(column).cast("string"))

    lines = i.stored.withColumns(
        {
            "quantity": text("quantity", F.col("quantity") % 13 == 0, "n/a"),
            "unit_price": text("unit_price", F.col("product_id").endswith("7"), "12,50"),
            "total_price": F.col("total_price").cast("string"),
            "hour": text("hour", F.col("hour") == 13, "n/a"),
            "invoice_date": text("invoice_date", F.col("day") == 31, "soon"),
            "country": F.array("country"),
            "customer_id": F.struct(F.col("customer_id").alias("id")),
        }
    )
    return staged(lines, "spoiled")


def _check_rows(i: Inputs) -> DataFrame:
    return quality.run_all_checks(i.stored, i.cfg).select("group", "check", "status", "severity")


def _dq_summary(i: Inputs) -> DataFrame:
    summary = quality.summarize_checks(quality.run_all_checks(i.stored, i.cfg))
    info = quality.dataset_info(i.stored)
    info = info.select(F.struct(*info.columns)).scalar()
    return summary.withColumn("info", info).select(*summary.columns, "info.*")


def _basic_check(check: str, *measures: str) -> Callable[[Inputs], DataFrame]:
    """Measurements of the basic pass together with the outcome of a check."""

    def build(i: Inputs) -> DataFrame:
        stats = quality.line_stats(i.stored, i.cfg).select(*measures)
        return _with_status(stats, quality.basic_checks(i.stored, i.cfg), check)

    return build


def _business_rules(i: Inputs) -> DataFrame:
    suspicious = quality.suspicious_customers(i.stored, i.cfg).agg(F.count(F.lit(1))).scalar()
    stats = quality.line_stats(i.stored, i.cfg).select(
        "price_mismatches", "unusual_hours", suspicious.alias("suspicious_customers")
    )
    return _with_status(stats, quality.basic_checks(i.stored, i.cfg), "business_rules")


def _quantiles(i: Inputs) -> DataFrame:
    shares = {"total_price": (0.25, 0.5, 0.75)}
    row = selected_quantile_frame(i.stored, shares)
    return row.select(*[F.col("total_price")[n].alias(f"p{p}") for n, p in enumerate((25, 50, 75))])


def _with_status(stats: DataFrame, checks: DataFrame, check: str) -> DataFrame:
    return stats.withColumn("status", checks.filter(F.col("check") == check).select("status").scalar())


_STEPS: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources
    "scan_parquet": lambda i: read_parquet(i.spark, f"{i.sf_dir}/orders.parquet"),
    "scan_csv": _scan_csv,
    "scan_csv_gzip": _scan_gzip,
    "scan_json": _scan_json,
    "profile": lambda i: reports.profile(i.raw),
    # cleaning and enrichment
    "standardize": lambda i: i.standard,
    "dedup": lambda i: clean.dedup(i.standard),
    "fill_nulls": lambda i: clean.fill_nulls(i.standard),
    "drop_critical_nulls": lambda i: clean.drop_critical_nulls(i.standard),
    "null_profile": lambda i: clean.null_profile(i.standard),
    "parse_dates": lambda i: i.parsed,
    "valid_filter": lambda i: clean.valid_lines(clean.with_total_price(i.parsed), i.cfg),
    "clean": lambda i: i.clean,
    "calendar_features": lambda i: clean.with_calendar(i.parsed),
    "time_flags": lambda i: clean.with_time_flags(clean.with_calendar(i.parsed)),
    "order_size": lambda i: enrich.with_order_size(i.standard, i.cfg),
    "price_category": lambda i: enrich.with_price_category(i.standard, i.cfg),
    "business_flags": lambda i: enrich.with_value_flags(
        clean.with_total_price(clean.fill_nulls(i.standard)), i.cfg
    ),
    "product_text_flags": lambda i: enrich.with_text_flags(i.standard, i.cfg),
    "enriched": lambda i: i.enriched,
    "customer_sequence": lambda i: sequence.with_customer_sequence(i.stored),
    "product_popularity": _product_popularity,
    "retention_table": _retained_table,
    "quarantine": _quarantine,
    "run_history": _run_history,
    "retention": lambda i: reports.retain_days(i.enriched, 365, F.lit(i.cfg.as_of)),
    # customers
    "customer_metrics": lambda i: customers.customer_metrics(i.stored, i.cfg),
    "customer_segments": lambda i: customers.segment_customers(i.customers, i.cfg).select(
        *("customer_id", "country", "value_segment", "frequency_segment", "customer_segment")
    ),
    "customer_segments_basic": lambda i: customers.segment_customers_basic(
        i.customers, i.cfg
    ).select("customer_id", "country", "customer_segment"),
    "customer_rank": lambda i: customers.rank_customers(i.customers).select(
        *("customer_id", "country", "total_spent", "revenue_rank", "revenue_percentile")
    ),
    "top_customers": lambda i: reports.top_customers(
        customers.segment_customers(i.customers, i.cfg)
    ),
    "classify_customer_value": _classified,
    # products
    "product_metrics": lambda i: products.product_metrics(i.stored, i.cfg),
    "product_category": lambda i: products.categorize_products(i.products, i.cfg).select(
        *("product_id", "product_description", "product_category")
    ),
    "product_rank": lambda i: products.rank_products(i.products).select(
        *("product_id", "product_description", "revenue_rank"),
        *("popularity_rank", "revenue_percentile"),
    ),
    "top_products": lambda i: reports.top_products(products.product_base(i.stored, i.cfg)),
    # time series
    "daily_totals": lambda i: daily.daily_totals(i.stored, i.cfg),
    "daily_metrics": lambda i: daily.daily_metrics(i.stored, i.cfg),
    "daily_moving_avg": lambda i: daily.with_moving_averages(
        daily.daily_totals(i.stored, i.cfg)
    ).select(
        *("invoice_date", "revenue_ma7", "revenue_ma30"),
        *("orders_ma7", "orders_ma30", "customers_ma7"),
    ),
    "daily_growth": lambda i: daily.with_growth(daily.daily_totals(i.stored, i.cfg)).select(
        *("invoice_date", "revenue_yesterday", "daily_growth"),
        *("orders_yesterday", "order_growth"),
    ),
    # countries
    "country_metrics": _country_metrics_flat,
    "country_rank": lambda i: countries.rank_countries(
        countries.country_totals(i.enriched, i.cfg)
    ).select("country", "revenue_rank", "customer_rank", "market_tier"),
    "country_top_products": lambda i: countries.top_products_by_country(i.enriched),
    "grand_totals": lambda i: countries.grand_totals(i.enriched, i.cfg),
    # hours
    "hourly_patterns": lambda i: hourly.hourly_patterns(i.stored, i.cfg),
    "peak_hours": lambda i: hourly.with_peak_hours(hourly.hourly_totals(i.stored, i.cfg)).select(
        "hour", "day_of_week", "transaction_count", "is_peak_hour"
    ),
    "quantiles": _quantiles,
    # data quality
    "dq_row_count": _basic_check("row_count", "row_count"),
    "dq_nulls": lambda i: quality.line_stats(i.standard, i.cfg).select(
        "row_count", *[f"null_{c}" for c in clean.CRITICAL_COLUMNS]
    ),
    "dq_customer_coverage": _basic_check("customer_coverage", "row_count", "known_customers"),
    "dq_ranges": _basic_check(
        "ranges",
        *("min_quantity", "max_quantity", "avg_quantity", "std_quantity"),
        *("nonpositive_quantity", "extreme_quantity"),
        *("min_price", "max_price", "avg_price", "std_price"),
        *("nonpositive_price", "extreme_price"),
    ),
    "dq_ranges_raw": lambda i: quality.line_stats(i.standard, i.cfg).select(
        *("min_quantity", "max_quantity", "nonpositive_quantity", "extreme_quantity"),
        *("min_price", "max_price", "nonpositive_price", "extreme_price"),
    ),
    "dq_business_rules": _business_rules,
    "dq_duplicates": lambda i: _with_status(
        quality.duplicate_stats(i.stored), quality.duplicate_checks(i.stored, i.cfg), "duplicates"
    ),
    "dq_duplicates_raw": lambda i: quality.duplicate_stats(staged(i.standard, "standard")),
    "dq_consistency": lambda i: quality.inconsistent_products(i.enriched),
    "dq_dates": lambda i: _with_status(
        quality.date_stats(i.stored, i.cfg), quality.date_checks(i.stored, i.cfg), "dates"
    ),
    "dq_time_gaps": lambda i: quality.date_stats(i.enriched, i.cfg).select(
        "gap_count", "max_gap_days"
    ),
    "dq_outliers": lambda i: quality.outlier_stats(i.stored, i.cfg),
    "dq_distribution": lambda i: quality.country_counts(i.enriched),
    "dq_concentration": lambda i: quality.concentration_stats(i.enriched),
    "dq_checks": _check_rows,
    "dq_bad_types": lambda i: quality.run_all_checks(_spoiled(i), i.cfg).select(
        "group", "check", "status", "severity"
    ),
    "dq_unreadable": lambda i: quality.unreadable_stats(_spoiled(i)),
    "dq_summary": _dq_summary,
    # reports and gates
    "enriched_table": _enriched_table,
    "run_summary": _run_summary,
    "batch_report": _batch_report,
    "freshness": lambda i: gates.data_freshness(i.enriched, F.lit(i.cfg.as_of)),
    "volume_gate": _volume_gate,
}


def _query(step: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _present(step(Inputs(spark, sf_dir)))


QUERIES = {name: _query(step) for name, step in _STEPS.items()}
