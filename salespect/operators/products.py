"""Product metrics, portfolio classes, ranks and popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.columns import money_sum, rate
from salespect.functions.distinct import grouped
from salespect.functions.joins import join_spread
from salespect.functions.order_stats import quantiles, ranked_values, with_global_rank
from salespect.functions.staging import staged


def product_base(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Aggregates and rates per (product, description)."""
    price = F.col("unit_price")
    measures = {
        "transaction_count": F.count(F.lit(1)),
        "order_count": "invoice_no",
        "unique_customers": "customer_id",
        "total_quantity_sold": F.sum("quantity"),
        "total_revenue": money_sum(F.col("total_price")),
        "avg_unit_price": F.avg(price),
        "price_volatility": F.stddev_samp(price),
        "countries_sold_to": "country",
        "international_orders": F.sum("is_international"),
        "min_price": F.min(price),
        "max_price": F.max(price),
        "avg_quantity_per_transaction": F.avg("quantity"),
    }
    totals = grouped(df, ("product_id", "product_description"), measures, cfg.exact_distinct)
    orders, customers = F.col("order_count"), F.col("unique_customers")
    return totals.withColumns(
        {
            "avg_quantity_per_order": rate(F.col("total_quantity_sold"), orders),
            "revenue_per_customer": rate(F.col("total_revenue"), customers),
            "international_rate": rate(F.col("international_orders"), orders),
            "popularity_score": customers * F.ln(orders + 1),
            "price_range": F.col("max_price") - F.col("min_price"),
            "market_penetration": F.col("countries_sold_to") / F.lit(float(cfg.total_countries)),
        }
    )


def categorize_products(
    products: DataFrame, cfg: Settings = Settings(), ranked: DataFrame | None = None
) -> DataFrame:
    """Portfolio class by whether revenue and reach are in the top fifth."""
    wanted = {"total_revenue": (0.8,), "unique_customers": (0.8,)}
    bars = quantiles(products, wanted, cfg, ranked)
    (revenue_bar,), (reach_bar,) = bars["total_revenue"], bars["unique_customers"]
    # Portfolio classes.
    earns, reaches = F.col("total_revenue") >= revenue_bar, F.col("unique_customers") >= reach_bar
    return products.withColumn(
        "product_category",
        F.when(earns, F.when(reaches, "Star").otherwise("Cash Cow")).otherwise(
            F.when(reaches, "Question Mark").otherwise("Dog")
        ),
    )


def rank_products(products: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    if ranked is None:
        ranked = ranked_values(products, ["total_revenue", "popularity_score"])
    by_revenue = with_global_rank(
        products, ranked, "total_revenue", "revenue_rank", "revenue_percentile"
    )
    return with_global_rank(by_revenue, ranked, "popularity_score", "popularity_rank")


def finish_products(base: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Portfolio classes and ranks on a stored product base."""
    ranked = ranked_values(base, ["total_revenue", "unique_customers", "popularity_score"])
    return rank_products(categorize_products(base, cfg, ranked), ranked)


def product_metrics(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return finish_products(staged(product_base(df, cfg), "products"), cfg)


def with_product_popularity(df: DataFrame) -> DataFrame:
    """Add how many lines each line's product has; a product of very many lines is joined in pieces."""
    lines = df.groupBy("product_id").agg(F.count(F.lit(1)).alias("product_popularity"))
    return join_spread(df, lines, "product_id", "product_popularity")
