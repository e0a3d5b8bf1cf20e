"""Country metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.columns import cents, distinct_count, ladder
from salespect.functions.staging import staged


def grand_totals(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return df.agg(
        (F.sum(cents(F.col("total_price"))) / 100).alias("total_revenue"),
        distinct_count("customer_id", cfg.exact_distinct).alias("total_customers"),
    )


def top_products_by_country(df: DataFrame, k: int = 3) -> DataFrame:
    """The k best-selling products of each country, one row each.

    Lines are summed per (country, product) first, and each task trims its
    share to k rows per country before the final ranking, so the size of a
    country does not matter.
    """
    revenue = df.groupBy("country", "product_id").agg(
        F.sum(cents(F.col("total_price"))).alias("_cents")
    )
    best_first = Window.partitionBy("country").orderBy(F.desc("_cents"), F.asc("product_id"))
    return (
        revenue.withColumn("product_rank", F.row_number().over(best_first))
        .filter(F.col("product_rank") <= k)
        .select("country", "product_rank", "product_id", (F.col("_cents") / 100).alias("revenue"))
    )


def _as_array(best: DataFrame, k: int) -> DataFrame:
    """Ranked products as one array of (product_id, revenue) per country, best first."""
    ranked = best.groupBy("country").agg(
        F.sort_array(F.collect_list(F.struct("product_rank", "product_id", "revenue"))).alias("_top")
    )
    return ranked.select(
        "country",
        F.transform(
            "_top", lambda p: F.struct(p["product_id"].alias("product_id"), p["revenue"].alias("revenue"))
        ).alias(f"top_{k}_products"),
    )


def top_products_array(df: DataFrame, k: int = 3) -> DataFrame:
    return _as_array(top_products_by_country(df, k), k)


# What the levels of country_levels are keyed by, besides the country; the last level is the country alone.
LEVELS = ("product_id", "customer_id", "invoice_no")
WHOLE = len(LEVELS)


def country_levels(df: DataFrame) -> DataFrame:
    """Rows per (country, product), (country, customer), (country, invoice) and country, from one pass over the lines.

    `level` is the column that a row is keyed by, `key` its value. Every country
    metric follows from these rows: distinct counts from the number of rows of a
    level, the best products from the first, sums from the last, whose few rows
    alone carry them all; the others hold nothing but the products' revenue.
    Squares are summed in whole cents too, so deviations do not depend on order.
    """
    line = cents(F.col("total_price"))
    base = df.select(
        "country",
        *LEVELS,
        line.alias("_cents"),
        "quantity",
        "invoice_date",
        (F.col("is_high_value") == 1).alias("_high"),
        (F.col("order_size") == "Bulk").alias("_bulk"),
    )
    def whole(value):
        return F.when(F.col("level") == WHOLE, value)

    names = [*[F.col(c).cast("string") for c in LEVELS], F.lit(None).cast("string")]
    keys = F.posexplode(F.array(*names)).alias("level", "key")
    sold = (F.col("level") == 0) | (F.col("level") == WHOLE)
    square = F.col("_cents").cast("decimal(19,0)") * F.col("_cents").cast("decimal(19,0)")
    return (
        base.select("*", keys)
        .groupBy("country", "level", "key")
        .agg(
            F.sum(F.when(sold, F.col("_cents"))).alias("_cents"),
            F.sum(whole(square)).alias("_squares"),
            F.count(whole(F.col("_cents"))).alias("_lines"),
            F.sum(whole(F.col("quantity"))).alias("total_items"),
            F.min(whole(F.col("invoice_date"))).alias("first_order_date"),
            F.max(whole(F.col("invoice_date"))).alias("last_order_date"),
            F.count_if(whole(F.col("_high"))).alias("high_value_orders"),
            F.count_if(whole(F.col("_bulk"))).alias("bulk_orders"),
        )
    )


def _level(column: str):
    return F.col("level") == LEVELS.index(column)


def _best_products(levels: DataFrame, k: int) -> DataFrame:
    """The k best-selling products of each country; each task trims its share before the final ranking."""
    best_first = Window.partitionBy("country").orderBy(F.desc("_cents"), F.asc("key"))
    return (
        levels.filter(_level("product_id"))
        .select("country", "key", "_cents")
        .withColumn("product_rank", F.row_number().over(best_first))
        .filter(F.col("product_rank") <= k)
        .select("country", "product_rank", F.col("key").alias("product_id"), (F.col("_cents") / 100).alias("revenue"))
    )


def _totals(levels: DataFrame, cfg: Settings) -> DataFrame:
    """Aggregates and rates per country, rolled up from the levels."""

    def distinct(column: str):
        return F.count_if(_level(column) & F.col("key").isNotNull())

    per_country = levels.groupBy("country").agg(
        distinct("invoice_no").alias("total_orders"),
        distinct("customer_id").alias("unique_customers"),
        distinct("product_id").alias("unique_products"),
        F.sum(F.when(F.col("level") == WHOLE, F.col("_cents"))).alias("_cents"),
        F.sum("_squares").alias("_squares"),
        F.sum("_lines").alias("_lines"),
        F.sum("total_items").alias("total_items"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.sum("high_value_orders").alias("high_value_orders"),
        F.sum("bulk_orders").alias("bulk_orders"),
    )
    # Distinct customers do not add up over countries; their rows are few beside the lines.
    customers = levels.filter(_level("customer_id")).agg(distinct_count("key", cfg.exact_distinct)).scalar()
    revenue = levels.filter(F.col("level") == WHOLE).agg(F.sum("_cents") / 100).scalar()
    # Squares about a whole number next to the mean, in whole numbers: nothing cancels out.
    middle, lines = F.expr("_cents div _lines").cast("decimal(19,0)"), F.col("_lines").cast("decimal(19,0)")
    about = F.col("_squares") - middle * F.col("_cents") * 2 + middle * middle * lines
    rest = (F.col("_cents") - middle * lines).cast("double")
    spread = F.greatest(about.cast("double") - rest * rest / F.col("_lines"), F.lit(0.0))
    return (
        per_country.withColumn("total_revenue", F.col("_cents") / 100)
        .withColumns(
            {
                "revenue_volatility": F.when(F.col("_lines") > 1, F.sqrt(spread / (F.col("_lines") - 1)) / 100),
                "avg_order_value": F.col("total_revenue") / F.col("_lines"),
                "avg_customer_value": F.col("total_revenue") / F.col("unique_customers"),
                "market_days": F.datediff("last_order_date", "first_order_date") + 1,
                "revenue_share": F.col("total_revenue") / revenue * 100,
                "customer_share": F.col("unique_customers") / customers * 100,
                "high_value_rate": F.col("high_value_orders") / F.col("total_orders"),
                "bulk_order_rate": F.col("bulk_orders") / F.col("total_orders"),
            }
        )
        .withColumn("daily_revenue_avg", F.col("total_revenue") / F.col("market_days"))
        .drop("_cents", "_squares", "_lines")
    )


def country_totals(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Aggregates and rates per country. Calling this writes the levels they are rolled up from."""
    return _totals(staged(country_levels(df), "countries"), cfg)


def rank_countries(totals: DataFrame) -> DataFrame:
    """Ranks and market tier. One row per country, so a single sort is enough."""
    # Tiers by revenue share in percent.
    tiers = [(10, "Tier 1"), (5, "Tier 2"), (1, "Tier 3")]
    return totals.withColumns(
        {
            "revenue_rank": F.dense_rank().over(Window.orderBy(F.desc("total_revenue"))),
            "customer_rank": F.dense_rank().over(Window.orderBy(F.desc("unique_customers"))),
            "market_tier": ladder(F.col("revenue_share"), tiers, "Tier 4"),
        }
    )


def country_metrics(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Totals, shares, ranks and the top three products of each country, from one pass over the lines.

    Calling this writes the levels that all of them are rolled up from.
    """
    levels = staged(country_levels(df), "countries")
    ranked = _totals(levels, cfg).transform(rank_countries)
    return ranked.join(_as_array(_best_products(levels, 3), 3), "country", "left")
