import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.classify import classify_customer_value, register_sql_functions
from salespect.functions.staging import staged
from salespect.operators import countries, customers, daily, hourly, products, reports
from salespect.operators.sequence import LINE_ORDER, with_customer_sequence

CUSTOMER_SCHEMA = (
    "customer_id string, country string, total_spent double, total_orders long, "
    "order_frequency double, customer_lifetime_days int"
)


def by(frame, *key):
    return {tuple(r[k] for k in key): r for r in frame.collect()}


# --- customers ---------------------------------------------------------------


def test_customer_numbers(raw):
    from salespect.operators.enrich import enrich

    lines = enrich(
        raw(
            {"InvoiceNo": "1", "StockCode": "A", "Quantity": 10, "UnitPrice": 20.0},
            {"InvoiceNo": "1", "StockCode": "B", "Quantity": 1, "UnitPrice": 10.0},
            {"InvoiceNo": "2", "StockCode": "A", "InvoiceDate": "6/11/2011 9:00"},
            {"InvoiceNo": "3", "CustomerID": None},
        )
    )
    found = by(customers.customer_metrics(lines), "customer_id")
    row = found[("C1",)]
    assert (row.total_orders, row.unique_products, row.active_days) == (2, 2, 2)
    assert (row.total_spent, row.total_items, row.max_order_value) == (216.0, 13, 200.0)
    assert row.avg_order_value == pytest.approx(72.0)
    assert (row.first_order_date, row.last_order_date) == (date(2011, 6, 1), date(2011, 6, 11))
    assert row.customer_lifetime_days == 11
    assert row.order_frequency == pytest.approx(2 / 11 * 30)
    assert (row.avg_basket_size, row.high_value_rate, row.weekend_order_rate) == (6.5, 0.5, 0.5)
    assert row.order_consistency == pytest.approx(1 - row.order_value_stddev / 72.0)
    assert (row.revenue_rank, row.revenue_percentile) == (1, 0.0)
    other = found[("Unknown",)]
    assert (other.order_value_stddev, other.order_consistency) == (None, 0.0)
    assert (other.revenue_rank, other.revenue_percentile) == (2, 100.0)
    without = customers.customer_metrics(lines, Settings(exclude_unknown=True))
    assert [r.customer_id for r in without.collect()] == ["C1"]


def test_segments_follow_levels_computed_by_sorting(spark):
    """A grid of spending and frequency: each level from the sorted values, each segment from the rules in words."""
    grid = [(i, j) for i in range(1, 12) for j in range(1, 8)]
    rows = [(f"{i}-{j}", "x", 13.7 * i * i, 1 + (i + j) % 4, j * 0.9, 37 * j) for i, j in grid]
    frame = spark.createDataFrame(rows, CUSTOMER_SCHEMA)

    def bar(column, share):
        values = sorted(r[column] for r in rows)
        return values[math.ceil(share * len(values)) - 1]

    found = by(customers.segment_customers(frame), "customer_id")
    basic = by(customers.segment_customers_basic(frame), "customer_id")
    for r in rows:
        spent, often = [sum(r[c] >= bar(c, s) for s in shares) for c, shares in ((2, (0.25, 0.5, 0.75)), (4, (0.5, 0.75)))]
        row = found[(r[0],)]
        assert row.value_segment == ("Very Low", "Low", "Medium", "High")[spent]
        assert row.frequency_segment == ("Occasional", "Regular", "Frequent")[often]
        if spent == 3:
            assert row.customer_segment == ("Big Spenders", "Loyal Customers", "Champions")[often]
        if spent == 3 and often:
            assert basic[(r[0],)].customer_segment == row.customer_segment
    assert len({r.customer_segment for r in found.values()}) >= 6


def test_every_segment_rule(spark):
    """Quartiles of spending are 5, 20 and 30, the frequency bars 5 and 8."""
    filler = [(f"f{i}", "x", s, 2, f, 10) for i, (s, f) in enumerate([(10, 5), (20, 5), (30, 5)])]
    cases = {
        "Champions": (30.0, 2, 8.0, 10),
        "Loyal Customers": (30.0, 2, 5.0, 10),
        "Big Spenders": (30.0, 2, 1.0, 10),
        "Potential Loyalists": (20.0, 2, 8.0, 10),
        "Promising": (20.0, 2, 5.0, 10),
        "New Customers": (5.0, 1, 1.0, 400),
        "At Risk": (5.0, 2, 1.0, 181),
        "Can't Lose Them": (5.0, 2, 9.0, 366),
        "Needs Attention": (5.0, 2, 9.0, 365),
    }
    rows = [(k, "x", *v) for k, v in cases.items()]
    rows += [(n, c, float(s), o, float(f), d) for n, c, s, o, f, d in filler]
    frame = spark.createDataFrame(rows, CUSTOMER_SCHEMA)
    found = by(customers.segment_customers(frame), "customer_id")
    bars = sorted(r[2] for r in rows), sorted(r[4] for r in rows)
    assert [bars[0][i] for i in (2, 5, 8)] == [5.0, 20.0, 30.0]
    assert [bars[1][i] for i in (5, 8)] == [5.0, 8.0]
    assert {k: found[(k,)].customer_segment for k in cases} == {k: k for k in cases}
    basic = by(customers.segment_customers_basic(frame), "customer_id")
    assert basic[("Big Spenders",)].customer_segment == "Needs Attention"
    assert basic[("At Risk",)].customer_segment == "At Risk"
    assert basic[("Can't Lose Them",)].customer_segment == "At Risk"


def test_customer_value_classes(spark):
    register_sql_functions(spark)
    frame = spark.sql("SELECT explode(array(NULL, 499.99D, 500D, 999.99D, 1000D)) AS v")
    pairs = frame.select(
        classify_customer_value(F.col("v")), F.expr("classify_customer_value(v)")
    ).collect()
    assert [tuple(p) for p in pairs] == [
        *(("Low", "Low"), ("Low", "Low")),
        *(("Medium", "Medium"), ("Medium", "Medium"), ("High", "High")),
    ]


# --- products ----------------------------------------------------------------


def test_product_numbers(sample):
    found = products.product_metrics(sample)
    for row in found.collect():
        assert row.revenue_per_customer == pytest.approx(row.total_revenue / row.unique_customers)
        assert row.min_price <= row.avg_unit_price <= row.max_price
        assert 0 < row.market_penetration <= 4 / 38
        assert row.product_category in ("Star", "Cash Cow", "Question Mark", "Dog")
    best = found.orderBy(F.desc("total_revenue")).first()
    assert best.revenue_rank == 1 and best.revenue_percentile == 0.0
    assert found.agg(F.sum("transaction_count")).first()[0] == sample.count()


def test_portfolio_quadrants(spark):
    rows = [("Star", 100.0, 100), ("Cash Cow", 100.0, 1), ("Question Mark", 1.0, 100)]
    rows += [(f"Dog{i}", 1.0, 1) for i in range(4)]
    frame = spark.createDataFrame(rows, "product_id string, total_revenue double, unique_customers long")
    found = by(products.categorize_products(frame), "product_id")
    assert {k[0]: r.product_category for k, r in found.items() if not k[0].startswith("Dog")} == {
        n: n for n in ("Star", "Cash Cow", "Question Mark")
    }
    assert found[("Dog0",)].product_category == "Dog"


def test_product_popularity(sample):
    wrong = (
        products.with_product_popularity(sample)
        .groupBy("product_id")
        .agg(F.count("*").alias("n"), F.max("product_popularity").alias("p"))
        .filter("n <> p")
    )
    assert wrong.count() == 0


# --- days --------------------------------------------------------------------


def test_daily_series(raw):
    from salespect.operators.enrich import enrich

    lines = enrich(
        raw(
            *[
                {"InvoiceNo": str(d), "InvoiceDate": f"6/{d}/2011 10:00", "Quantity": d}
                for d in range(1, 11)
            ]
        )
    )
    rows = daily.daily_metrics(lines).orderBy("invoice_date").collect()
    assert [r.total_revenue for r in rows] == [3.0 * d for d in range(1, 11)]
    assert rows[0].revenue_ma7 == 3.0 and rows[9].revenue_ma7 == pytest.approx(21.0)
    assert rows[9].revenue_ma30 == pytest.approx(16.5)
    assert (rows[0].revenue_yesterday, rows[0].daily_growth, rows[0].order_growth) == (None, 0.0, 0.0)
    assert rows[1].daily_growth == pytest.approx(100.0)
    assert (rows[0].day_name, rows[3].day_name, rows[3].is_weekend) == ("Wednesday", "Saturday", 1)
    assert rows[0].customer_identification_rate == 1.0


# --- countries ---------------------------------------------------------------


def test_country_levels_give_the_same_as_grouping_the_lines(sample):
    rows = {r.country: r for r in countries.country_metrics(sample.repartition(5)).collect()}
    direct = sample.groupBy("country").agg(
        F.count_distinct("invoice_no").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("product_id").alias("goods"),
        F.sum("quantity").alias("items"),
        F.stddev_samp("total_price").alias("deviation"),
        F.avg("total_price").alias("mean"),
        F.sum("is_high_value").alias("high"),
        F.count_if(F.col("order_size") == "Bulk").alias("bulk"),
    )
    for d in direct.collect():
        r = rows[d.country]
        assert (r.total_orders, r.unique_customers, r.unique_products, r.total_items) == (d.orders, d.customers, d.goods, d["items"])
        assert (r.high_value_orders, r.bulk_orders) == (d.high, d.bulk)
        assert r.revenue_volatility == pytest.approx(d.deviation, rel=1e-9) and r.avg_order_value == pytest.approx(d.mean)
        top = countries.top_products_by_country(sample).filter(F.col("country") == d.country).orderBy("product_rank")
        assert [(p.product_id, p.revenue) for p in r.top_3_products] == [(t.product_id, t.revenue) for t in top.collect()]


def test_equal_amounts_deviate_by_nothing(sample):
    flat = sample.withColumn("total_price", F.lit(98765.43))
    assert {r.revenue_volatility for r in countries.country_metrics(flat).collect()} == {0.0}
    single = countries.country_metrics(flat.limit(1)).first()
    assert single.revenue_volatility is None and single.customer_share == 100.0


def test_country_shares_and_tiers(sample):
    rows = countries.country_metrics(sample).collect()
    assert len(rows) == 4
    assert sum(r.revenue_share for r in rows) == pytest.approx(100.0)
    ordered = sorted(rows, key=lambda r: -r.total_revenue)
    assert [r.revenue_rank for r in ordered] == [1, 2, 3, 4]
    assert {r.market_tier for r in rows} == {"Tier 1"}
    for row in rows:
        assert len(row.top_3_products) == 3
        revenue = [p.revenue for p in row.top_3_products]
        assert revenue == sorted(revenue, reverse=True)


def test_top_products_against_plain_python(sample):
    revenue = {}
    for r in sample.select("country", "product_id", "total_price").collect():
        key = (r.country, r.product_id)
        revenue[key] = revenue.get(key, 0) + round(r.total_price * 100)
    for country in {c for c, _ in revenue}:
        mine = sorted(((-v, p) for (c, p), v in revenue.items() if c == country))[:3]
        found = countries.top_products_by_country(sample).filter(F.col("country") == country)
        assert [(r.product_id, r.revenue) for r in found.orderBy("product_rank").collect()] == [
            (p, -v / 100) for v, p in mine
        ]


def test_ties_in_top_products_go_by_product(raw):
    from salespect.operators.enrich import enrich

    lines = enrich(raw(*[{"StockCode": s} for s in "DBCA"]))
    found = countries.top_products_by_country(lines).orderBy("product_rank").collect()
    assert [r.product_id for r in found] == ["A", "B", "C"]


# --- hours -------------------------------------------------------------------


def test_hourly_shares_and_periods(sample):
    rows = hourly.hourly_patterns(sample).collect()
    assert sum(r.transaction_share for r in rows) == pytest.approx(100.0)
    assert sum(r.revenue_share for r in rows) == pytest.approx(100.0)
    periods = {r.hour: r.time_period for r in rows}
    assert {h: periods[h] for h in (5, 6, 12, 18, 21, 22)} == {
        **{5: "Night", 6: "Morning", 12: "Afternoon"},
        **{18: "Evening", 21: "Evening", 22: "Night"},
    }


def test_peak_hours_reach_the_upper_quartile(spark):
    cells = [(h, d, h + 1) for h in range(8) for d in (1, 2)]
    frame = spark.createDataFrame(cells, "hour int, day_of_week int, transaction_count long")
    found = hourly.with_peak_hours(frame)
    peaks = {r.hour for r in found.filter("is_peak_hour = 1").collect()}
    assert peaks == {5, 6, 7} and found.count() == len(cells)


# --- sequence ----------------------------------------------------------------


def test_purchase_sequence_against_plain_python(sample):
    lines = sample.collect()
    expected = {}
    for customer in {r.customer_id for r in lines}:
        own = [r for r in lines if r.customer_id == customer]
        own.sort(key=lambda r: tuple(r[c] for c in LINE_ORDER))
        first = min(r.invoice_date for r in own)
        for n, r in enumerate(own, 1):
            expected[(r.invoice_no, r.product_id)] = (n, (r.invoice_date - first).days)
    found = with_customer_sequence(sample).collect()
    assert {
        (r.invoice_no, r.product_id): (r.customer_purchase_number, r.days_since_first_purchase)
        for r in found
    } == expected
    assert max(r.customer_purchase_number for r in found) > len(lines) / 3


# --- shared properties -------------------------------------------------------

TABLES = {
    "customers": customers.customer_metrics,
    "products": products.product_metrics,
    "daily": daily.daily_metrics,
    "countries": countries.country_metrics,
    "hourly": hourly.hourly_patterns,
    "sequence": lambda df, cfg: with_customer_sequence(df),
}


@pytest.mark.parametrize("name", TABLES)
def test_no_lines_give_no_rows(sample, name):
    assert TABLES[name](sample.limit(0), Settings()).count() == 0


@pytest.mark.parametrize("name", TABLES)
def test_results_do_not_depend_on_partitioning(sample, name, rows_of):
    def result(partitions):
        table = TABLES[name](staged(sample.repartition(partitions), "shuffled"), Settings())
        # Deviations and plain averages of doubles may differ in the last bits.
        noisy = [c for c, t in table.dtypes if t == "double"]
        return rows_of(table.withColumns({c: F.round(c, 6) for c in noisy}))

    assert result(1) == result(7)


def test_approximate_distinct_counts_on_request(sample):
    close = customers.customer_base(sample, Settings(exact_distinct=False))
    exact = customers.customer_base(sample)
    pairs = close.alias("a").join(exact.alias("b"), ["customer_id", "country"])
    far = pairs.filter("abs(a.total_orders - b.total_orders) > 0.2 * b.total_orders")
    assert far.count() == 0


# --- reports -----------------------------------------------------------------


def test_top_lists(sample):
    best = reports.top_customers(customers.customer_metrics(sample), 2).collect()
    assert len(best) == 2 and best[0].total_spent >= best[1].total_spent
    assert reports.top_products(products.product_base(sample), 5).count() == 5


def test_retention_keeps_the_last_days(spark):
    frame = spark.sql("SELECT explode(sequence(date'2011-01-01', date'2011-01-31')) invoice_date")
    kept = reports.retain_days(frame, 7, F.lit(date(2011, 1, 31)))
    assert kept.count() == 7


@pytest.mark.parametrize("days", [0, 5, 45, 400])
def test_retention_reads_only_the_months_it_keeps(spark, tmp_path, days):
    span = spark.sql("SELECT explode(sequence(date'2010-11-03', date'2012-02-20')) invoice_date")
    table = span.withColumns({"year": F.year("invoice_date"), "month": F.month("invoice_date")})
    table.write.partitionBy("year", "month").parquet(str(tmp_path / "t"))
    kept = reports.retain_days(spark.read.parquet(str(tmp_path / "t")), days, F.lit(date(2012, 1, 10)))
    first = date(2012, 1, 10) - timedelta(days=days)
    assert kept.count() == span.filter(F.col("invoice_date") > F.lit(first)).count()
    text = kept._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters") : text.index("PushedFilters")]
    assert "year" in filters and "month" in filters
    months = {r.f for r in kept.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(months) == (2012 - first.year) * 12 + 2 - first.month + (1 if first.day < 31 else 0)


def test_profile(raw):
    row = reports.profile(raw({}, {"Description": None, "CustomerID": "C2"})).first()
    assert (row.row_count, row.null_Description, row.null_Country) == (2, 1, 0)
    assert (row.unique_customers, row.unique_products) == (2, 1)
