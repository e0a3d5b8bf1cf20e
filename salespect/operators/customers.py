"""Customer metrics, segments and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.columns import ladder, money_avg, money_sum, rate
from salespect.functions.distinct import grouped
from salespect.functions.order_stats import quantiles, ranked_values, with_global_rank
from salespect.functions.staging import staged
from salespect.schema import UNKNOWN


def customer_base(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Aggregates and rates per (customer, country).

    What is called an order value or rate counts invoice lines against
    invoices, so a rate can exceed 1.
    """
    if cfg.exclude_unknown:
        df = df.filter(F.col("customer_id") != UNKNOWN)
    amount = F.col("total_price")
    measures = {
        "total_orders": "invoice_no",
        "unique_products": "product_id",
        "total_spent": money_sum(amount),
        "total_items": F.sum("quantity"),
        "avg_order_value": money_avg(amount),
        "first_order_date": F.min("invoice_date"),
        "last_order_date": F.max("invoice_date"),
        "active_days": "invoice_date",
        "high_value_orders": F.sum("is_high_value"),
        "order_value_stddev": F.stddev_samp(amount),
        "max_order_value": F.max(amount),
        "weekend_orders": F.count_if(F.col("is_weekend") == 1),
    }
    totals = grouped(df, ("customer_id", "country"), measures, cfg.exact_distinct)
    orders, lifetime = F.col("total_orders"), F.col("customer_lifetime_days")
    spread = F.col("order_value_stddev") / F.col("avg_order_value")
    return totals.withColumn(
        "customer_lifetime_days", F.datediff("last_order_date", "first_order_date") + 1
    ).withColumns(
        {
            "order_frequency": rate(orders, lifetime) * 30,
            "avg_basket_size": rate(F.col("total_items"), orders),
            "high_value_rate": rate(F.col("high_value_orders"), orders),
            "weekend_order_rate": rate(F.col("weekend_orders"), orders),
            "order_consistency": F.when(
                F.col("order_value_stddev").isNotNull() & (F.col("avg_order_value") > 0), 1 - spread
            ).otherwise(F.lit(0.0)),
        }
    )


def _with_levels(
    customers: DataFrame, cfg: Settings, ranked: DataFrame | None
) -> tuple[DataFrame, Column]:
    """Value and frequency level of each customer, and the median frequency."""
    wanted = {"total_spent": (0.25, 0.5, 0.75), "order_frequency": (0.5, 0.75)}
    bars = quantiles(customers, wanted, cfg, ranked)
    spent_25, spent_50, spent_75 = bars["total_spent"]
    often_50, often_75 = bars["order_frequency"]
    # Level names.
    value = ladder(
        F.col("total_spent"),
        [(spent_75, "High"), (spent_50, "Medium"), (spent_25, "Low")],
        "Very Low",
    )
    frequency = ladder(
        F.col("order_frequency"), [(often_75, "Frequent"), (often_50, "Regular")], "Occasional"
    )
    levelled = customers.withColumns({"value_segment": value, "frequency_segment": frequency})
    return levelled, often_50


def _segment(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    return F.coalesce(*[F.when(rule, label) for rule, label in rules], F.lit(otherwise))


def _at(value: str, frequency: str) -> Column:
    return (F.col("value_segment") == value) & (F.col("frequency_segment") == frequency)


def segment_customers(
    customers: DataFrame, cfg: Settings = Settings(), ranked: DataFrame | None = None
) -> DataFrame:
    """Nine segments by value, frequency, order count and lifetime; the first rule that holds wins."""
    levelled, often_50 = _with_levels(customers, cfg, ranked)
    lifetime = F.col("customer_lifetime_days")
    # Segments in order of precedence.
    rules = [
        (_at("High", "Frequent"), "Champions"),
        (_at("High", "Regular"), "Loyal Customers"),
        (_at("Medium", "Frequent"), "Potential Loyalists"),
        (_at("High", "Occasional"), "Big Spenders"),
        (_at("Medium", "Regular"), "Promising"),
        (F.col("total_orders") == 1, "New Customers"),
        ((lifetime > 180) & (F.col("order_frequency") < often_50), "At Risk"),
        (lifetime > 365, "Can't Lose Them"),
    ]
    return levelled.withColumn("customer_segment", _segment(rules, "Needs Attention"))


def segment_customers_basic(
    customers: DataFrame, cfg: Settings = Settings(), ranked: DataFrame | None = None
) -> DataFrame:
    """The earlier six-segment scheme."""
    levelled, _ = _with_levels(customers, cfg, ranked)
    # Segments in order of precedence.
    rules = [
        (_at("High", "Frequent"), "Champions"),
        (_at("High", "Regular"), "Loyal Customers"),
        (_at("Medium", "Frequent"), "Potential Loyalists"),
        (F.col("total_orders") == 1, "New Customers"),
        (F.col("customer_lifetime_days") > 180, "At Risk"),
    ]
    return levelled.withColumn("customer_segment", _segment(rules, "Needs Attention"))


def rank_customers(customers: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    if ranked is None:
        ranked = ranked_values(customers, ["total_spent"])
    return with_global_rank(customers, ranked, "total_spent", "revenue_rank", "revenue_percentile")


def finish_customers(base: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Segments and ranks on a stored customer base."""
    ranked = ranked_values(base, ["total_spent", "order_frequency"])
    return rank_customers(segment_customers(base, cfg, ranked), ranked)


def customer_metrics(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return finish_customers(staged(customer_base(df, cfg), "customers"), cfg)
