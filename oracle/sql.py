"""Independent SQL for every registered query, for DuckDB over the same tables."""

from __future__ import annotations

import re

RAW = """
raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_linenumber = 7 AND l_partkey % 10 = 1 THEN upper(p_name) || ' SET'
              WHEN l_partkey % 20 <> 0 THEN upper(p_name) END AS product_description,
         CASE WHEN l_orderkey % 499 = 0 THEN NULL
              WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -CAST(l_quantity AS INTEGER)
              ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CASE WHEN o_orderkey % 997 = 0 THEN 'invalid'
              ELSE strftime(o_orderdate + to_hours(CAST(o_orderkey * 7 % 24 AS BIGINT))
                                        + to_minutes(CAST(o_orderkey * 13 % 60 AS BIGINT)),
                            '%-m/%-d/%Y %-H:%M') END AS invoice_date,
         floor(l_extendedprice / l_quantity) / 100 AS unit_price,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE n_nationkey WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'EIRE'
              WHEN 2 THEN 'Channel Islands' ELSE n_name END AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

SINGLE = """
single AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY invoice_no, product_id, invoice_date
      ORDER BY quantity DESC NULLS LAST, unit_price DESC NULLS LAST,
               product_description NULLS LAST, customer_id NULLS LAST, country NULLS LAST) AS copy
    FROM raw) WHERE copy = 1
)"""


def _timed(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * REPLACE (CAST(moment AS DATE) AS invoice_date), moment AS invoice_datetime FROM (
    SELECT *, try_strptime(invoice_date, '%m/%d/%Y %H:%M') AS moment FROM {source})
  WHERE year(moment) BETWEEN 1996 AND 2000
)"""


FILLED = """
filled AS (
  SELECT * REPLACE (coalesce(customer_id, 'Unknown') AS customer_id,
                    coalesce(product_description, 'No Description') AS product_description,
                    coalesce(country, 'Unknown') AS country)
  FROM timed
  WHERE invoice_no IS NOT NULL AND product_id IS NOT NULL
    AND quantity IS NOT NULL AND unit_price IS NOT NULL
)"""

CALENDAR = """
  CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
  CAST(day(invoice_date) AS INTEGER) AS day, CAST(hour(invoice_datetime) AS INTEGER) AS hour,
  CAST(dayofweek(invoice_date) + 1 AS INTEGER) AS day_of_week,
  CAST(quarter(invoice_date) AS INTEGER) AS quarter,
  CAST(weekofyear(invoice_date) AS INTEGER) AS week_of_year"""

TIME_FLAGS = """
  CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour >= 6 AND hour < 12 THEN 1 ELSE 0 END AS is_morning,
  CASE WHEN hour >= 12 AND hour < 18 THEN 1 ELSE 0 END AS is_afternoon,
  CASE WHEN hour >= 18 AND hour < 24 THEN 1 ELSE 0 END AS is_evening,
  CASE WHEN hour >= 9 AND hour < 17 AND day_of_week BETWEEN 2 AND 6 THEN 1 ELSE 0 END
    AS is_business_hours"""

VALID = """quantity > 0 AND quantity < 10000 AND unit_price > 0 AND unit_price < 10000
    AND invoice_date IS NOT NULL AND total_price > 0"""

PRICED = "SELECT *, round(quantity * unit_price, 2) AS total_price FROM"

CLEANED = f"""
cleaned AS (
  SELECT *, {TIME_FLAGS} FROM (
    SELECT *, {CALENDAR} FROM ({PRICED} filled) WHERE {VALID})
)"""

ORDER_SIZE = """
  CASE WHEN quantity >= 40 THEN 'Bulk' WHEN quantity >= 20 THEN 'Large'
       WHEN quantity >= 5 THEN 'Medium' ELSE 'Small' END AS order_size"""
PRICE_CATEGORY = """
  CASE WHEN unit_price >= 50 THEN 'Premium' WHEN unit_price >= 10 THEN 'Standard'
       WHEN unit_price >= 5 THEN 'Economy' ELSE 'Budget' END AS price_category"""
HOME = "('United Kingdom', 'EIRE', 'Channel Islands')"
VALUE_FLAGS = f"""
  CASE WHEN total_price >= 1000 THEN 1 ELSE 0 END AS is_high_value,
  CASE WHEN country IN {HOME} THEN 1 ELSE 0 END AS is_uk,
  CASE WHEN country NOT IN {HOME} THEN 1 ELSE 0 END AS is_international,
  CASE WHEN customer_id <> 'Unknown' THEN 1 ELSE 0 END AS is_identified_customer"""
TEXT_FLAGS = """
  CASE WHEN lower(product_description) LIKE '%red%' THEN 1 ELSE 0 END AS is_vintage,
  CASE WHEN lower(product_description) LIKE '%blue%' THEN 1 ELSE 0 END AS is_christmas,
  CASE WHEN lower(product_description) LIKE '%widget%'
         OR lower(product_description) LIKE '%gear%' THEN 1 ELSE 0 END AS is_gift"""

LINES = f"""
lines AS (
  SELECT *, {ORDER_SIZE}, {PRICE_CATEGORY}, {VALUE_FLAGS}, {TEXT_FLAGS} FROM cleaned
)"""

MONEY = "CAST(sum(CAST(round(total_price * 100) AS BIGINT)) AS DOUBLE) / 100"

CUSTOMERS = f"""
customers AS (
  SELECT *,
    CAST(total_orders AS DOUBLE) / customer_lifetime_days * 30 AS order_frequency,
    CAST(total_items AS DOUBLE) / total_orders AS avg_basket_size,
    CAST(high_value_orders AS DOUBLE) / total_orders AS high_value_rate,
    CAST(weekend_orders AS DOUBLE) / total_orders AS weekend_order_rate,
    CASE WHEN order_value_stddev IS NOT NULL AND avg_order_value > 0
         THEN 1 - order_value_stddev / avg_order_value ELSE 0 END AS order_consistency
  FROM (
    SELECT customer_id, country,
      count(DISTINCT invoice_no) AS total_orders, count(DISTINCT product_id) AS unique_products,
      {MONEY} AS total_spent, CAST(sum(quantity) AS BIGINT) AS total_items,
      {MONEY} / count(*) AS avg_order_value,
      min(invoice_date) AS first_order_date, max(invoice_date) AS last_order_date,
      count(DISTINCT invoice_date) AS active_days,
      CAST(sum(is_high_value) AS BIGINT) AS high_value_orders,
      stddev_samp(total_price) AS order_value_stddev, max(total_price) AS max_order_value,
      count(*) FILTER (is_weekend = 1) AS weekend_orders,
      CAST(datediff('day', min(invoice_date), max(invoice_date)) + 1 AS INTEGER)
        AS customer_lifetime_days
    FROM lines GROUP BY customer_id, country)
)"""

LEVELS = """
bars AS (
  SELECT quantile_disc(total_spent, 0.25) AS s25, quantile_disc(total_spent, 0.5) AS s50,
         quantile_disc(total_spent, 0.75) AS s75, quantile_disc(order_frequency, 0.5) AS f50,
         quantile_disc(order_frequency, 0.75) AS f75
  FROM customers
),
levels AS (
  SELECT *,
    CASE WHEN total_spent >= s75 THEN 'High' WHEN total_spent >= s50 THEN 'Medium'
         WHEN total_spent >= s25 THEN 'Low' ELSE 'Very Low' END AS value_segment,
    CASE WHEN order_frequency >= f75 THEN 'Frequent' WHEN order_frequency >= f50 THEN 'Regular'
         ELSE 'Occasional' END AS frequency_segment
  FROM customers, bars
)"""

SEGMENT = """
  CASE WHEN value_segment = 'High' AND frequency_segment = 'Frequent' THEN 'Champions'
       WHEN value_segment = 'High' AND frequency_segment = 'Regular' THEN 'Loyal Customers'
       WHEN value_segment = 'Medium' AND frequency_segment = 'Frequent' THEN 'Potential Loyalists'
       WHEN value_segment = 'High' THEN 'Big Spenders'
       WHEN value_segment = 'Medium' AND frequency_segment = 'Regular' THEN 'Promising'
       WHEN total_orders = 1 THEN 'New Customers'
       WHEN customer_lifetime_days > 180 AND order_frequency < f50 THEN 'At Risk'
       WHEN customer_lifetime_days > 365 THEN 'Can''t Lose Them'
       ELSE 'Needs Attention' END AS customer_segment"""

PRODUCTS = f"""
products AS (
  SELECT *,
    CAST(total_quantity_sold AS DOUBLE) / order_count AS avg_quantity_per_order,
    total_revenue / unique_customers AS revenue_per_customer,
    CAST(international_orders AS DOUBLE) / order_count AS international_rate,
    unique_customers * ln(order_count + 1) AS popularity_score,
    max_price - min_price AS price_range,
    countries_sold_to / 25.0::DOUBLE AS market_penetration
  FROM (
    SELECT product_id, product_description, count(*) AS transaction_count,
      count(DISTINCT invoice_no) AS order_count, count(DISTINCT customer_id) AS unique_customers,
      CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, {MONEY} AS total_revenue,
      avg(unit_price) AS avg_unit_price, stddev_samp(unit_price) AS price_volatility,
      count(DISTINCT country) AS countries_sold_to,
      CAST(sum(is_international) AS BIGINT) AS international_orders,
      min(unit_price) AS min_price, max(unit_price) AS max_price,
      avg(quantity) AS avg_quantity_per_transaction
    FROM lines GROUP BY product_id, product_description)
)"""

CATEGORY = """
  CASE WHEN total_revenue >= (SELECT quantile_disc(total_revenue, 0.8) FROM products)
       THEN CASE WHEN unique_customers >= (SELECT quantile_disc(unique_customers, 0.8) FROM products)
                 THEN 'Star' ELSE 'Cash Cow' END
       ELSE CASE WHEN unique_customers >= (SELECT quantile_disc(unique_customers, 0.8) FROM products)
                 THEN 'Question Mark' ELSE 'Dog' END END AS product_category"""

PRODUCT_RANKS = """
  dense_rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank,
  dense_rank() OVER (ORDER BY popularity_score DESC) AS popularity_rank,
  percent_rank() OVER (ORDER BY total_revenue DESC) * 100 AS revenue_percentile"""

DAY_NAME = """
  CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
       WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday'
       ELSE 'Saturday' END AS day_name"""

DAYS = f"""
days AS (
  SELECT *, {DAY_NAME},
    CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
    CAST(total_items_sold AS DOUBLE) / total_orders AS avg_items_per_order,
    CAST(international_orders AS DOUBLE) / total_orders AS international_rate,
    CAST(high_value_orders AS DOUBLE) / total_orders AS high_value_rate,
    CAST(identified_orders AS DOUBLE) / total_orders AS customer_identification_rate
  FROM (
    SELECT invoice_date, count(DISTINCT invoice_no) AS total_orders,
      count(DISTINCT customer_id) AS unique_customers,
      count(DISTINCT product_id) AS unique_products_sold,
      {MONEY} AS total_revenue, {MONEY} / count(*) AS avg_order_value,
      max(total_price) AS max_order_value, stddev_samp(total_price) AS revenue_stddev,
      CAST(sum(quantity) AS BIGINT) AS total_items_sold,
      CAST(sum(is_international) AS BIGINT) AS international_orders,
      count(*) FILTER (is_high_value = 1) AS high_value_orders,
      count(*) FILTER (customer_id <> 'Unknown') AS identified_orders,
      CAST(dayofweek(invoice_date) + 1 AS INTEGER) AS day_of_week,
      CAST(month(invoice_date) AS INTEGER) AS month,
      CAST(quarter(invoice_date) AS INTEGER) AS quarter,
      CAST(year(invoice_date) AS INTEGER) AS year,
      CAST(weekofyear(invoice_date) AS INTEGER) AS week_of_year
    FROM lines GROUP BY invoice_date)
)"""


def _mean_over(cents: str, rows: int) -> str:
    frame = f"(ORDER BY invoice_date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(sum({cents}) OVER {frame} AS DOUBLE) / 100 / count(*) OVER {frame}"


_REVENUE_CENTS = "CAST(round(total_revenue * 100) AS BIGINT)"
MOVING = f"""
  {_mean_over(_REVENUE_CENTS, 7)} AS revenue_ma7,
  {_mean_over(_REVENUE_CENTS, 30)} AS revenue_ma30,
  avg(total_orders) OVER (ORDER BY invoice_date ROWS 6 PRECEDING) AS orders_ma7,
  avg(total_orders) OVER (ORDER BY invoice_date ROWS 29 PRECEDING) AS orders_ma30,
  avg(unique_customers) OVER (ORDER BY invoice_date ROWS 6 PRECEDING) AS customers_ma7"""

GROWTH = """
grown AS (
  SELECT *,
    CASE WHEN revenue_yesterday > 0
         THEN (total_revenue - revenue_yesterday) / revenue_yesterday * 100 ELSE 0 END
      AS daily_growth,
    CASE WHEN orders_yesterday > 0
         THEN CAST(total_orders - orders_yesterday AS DOUBLE) / orders_yesterday * 100 ELSE 0 END
      AS order_growth
  FROM (SELECT *, lag(total_revenue) OVER (ORDER BY invoice_date) AS revenue_yesterday,
               lag(total_orders) OVER (ORDER BY invoice_date) AS orders_yesterday FROM days)
)"""

COUNTRIES = f"""
country_sums AS (
  SELECT country, count(DISTINCT invoice_no) AS total_orders,
    count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products,
    {MONEY} AS total_revenue, {MONEY} / count(*) AS avg_order_value,
    CAST(sum(CAST(round(total_price * 100) AS BIGINT)) AS BIGINT) AS cents,
    CAST(sum(quantity) AS BIGINT) AS total_items,
    min(invoice_date) AS first_order_date, max(invoice_date) AS last_order_date,
    count(*) FILTER (is_high_value = 1) AS high_value_orders,
    count(*) FILTER (order_size = 'Bulk') AS bulk_orders,
    stddev_samp(total_price) AS revenue_volatility
  FROM lines GROUP BY country
),
countries AS (
  SELECT * EXCLUDE (cents), total_revenue / unique_customers AS avg_customer_value,
    CAST(datediff('day', first_order_date, last_order_date) + 1 AS INTEGER) AS market_days,
    total_revenue / (datediff('day', first_order_date, last_order_date) + 1) AS daily_revenue_avg,
    total_revenue / (SELECT CAST(sum(cents) AS DOUBLE) / 100 FROM country_sums) * 100
      AS revenue_share,
    CAST(unique_customers AS DOUBLE) / (SELECT count(DISTINCT customer_id) FROM lines) * 100
      AS customer_share,
    CAST(high_value_orders AS DOUBLE) / total_orders AS high_value_rate,
    CAST(bulk_orders AS DOUBLE) / total_orders AS bulk_order_rate
  FROM country_sums
)"""

COUNTRY_RANKS = """
  CAST(dense_rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank,
  CAST(dense_rank() OVER (ORDER BY unique_customers DESC) AS INTEGER) AS customer_rank,
  CASE WHEN revenue_share >= 10 THEN 'Tier 1' WHEN revenue_share >= 5 THEN 'Tier 2'
       WHEN revenue_share >= 1 THEN 'Tier 3' ELSE 'Tier 4' END AS market_tier"""

BEST = f"""
best AS (
  SELECT country, product_id, revenue,
    CAST(row_number() OVER (PARTITION BY country ORDER BY revenue DESC, product_id) AS INTEGER)
      AS product_rank
  FROM (SELECT country, product_id, {MONEY} AS revenue FROM lines GROUP BY country, product_id)
  QUALIFY product_rank <= 3
)"""

CELLS = f"""
cells AS (
  SELECT *, {DAY_NAME},
    CASE WHEN hour >= 6 AND hour < 12 THEN 'Morning' WHEN hour >= 12 AND hour < 18 THEN 'Afternoon'
         WHEN hour >= 18 AND hour < 22 THEN 'Evening' ELSE 'Night' END AS time_period,
    CAST(transaction_count AS DOUBLE) / (SELECT count(*) FROM lines) * 100 AS transaction_share,
    CAST(cents AS DOUBLE) /
      (SELECT CAST(sum(CAST(round(total_price * 100) AS BIGINT)) AS DOUBLE) FROM lines) * 100
      AS revenue_share,
    CAST(total_items AS DOUBLE) / transaction_count AS avg_items_per_transaction,
    CAST(high_value_transactions AS DOUBLE) / transaction_count AS high_value_rate,
    CAST(international_transactions AS DOUBLE) / transaction_count AS international_rate
  FROM (
    SELECT hour, day_of_week, count(*) AS transaction_count, {MONEY} AS total_revenue,
      {MONEY} / count(*) AS avg_transaction_value,
      CAST(sum(CAST(round(total_price * 100) AS BIGINT)) AS BIGINT) AS cents,
      count(DISTINCT customer_id) AS unique_customers,
      count(DISTINCT product_id) AS unique_products,
      CAST(sum(quantity) AS BIGINT) AS total_items, stddev_samp(total_price) AS revenue_stddev,
      count(*) FILTER (is_high_value = 1) AS high_value_transactions,
      count(*) FILTER (is_international = 1) AS international_transactions
    FROM lines GROUP BY hour, day_of_week)
),
hours AS (SELECT hour, sum(transaction_count) AS hour_total FROM cells GROUP BY hour),
peaks AS (
  SELECT cells.* EXCLUDE (cents),
    CASE WHEN hour_total >= (SELECT quantile_disc(hour_total, 0.75) FROM hours) THEN 1 ELSE 0 END
      AS is_peak_hour
  FROM cells JOIN hours USING (hour)
)"""


def _outliers(column: str) -> str:
    return f"""
  SELECT '{column}' AS column_name, min(low) AS lower_bound, min(high) AS upper_bound,
         count(*) FILTER ({column} < low OR {column} > high) AS outlier_count,
         CAST(count(*) FILTER ({column} < low OR {column} > high) AS DOUBLE) / count(*)
           AS outlier_rate
  FROM lines, (
    SELECT CAST(q1 - (q3 - q1) * 1.5 AS DOUBLE) AS low, CAST(q3 + (q3 - q1) * 1.5 AS DOUBLE) AS high
    FROM (SELECT CAST(quantile_disc({column}, 0.25) AS DOUBLE) AS q1,
                 CAST(quantile_disc({column}, 0.75) AS DOUBLE) AS q3 FROM lines))"""


OUTLIERS = "outliers AS (" + " UNION ALL ".join(
    map(_outliers, ("quantity", "unit_price", "total_price"))
) + ")"

KEYS = """
keys AS (
  SELECT count(*) AS n FROM lines GROUP BY invoice_no, product_id, invoice_datetime
)"""

SPENDERS = f"""
spenders AS (
  SELECT customer_id FROM lines WHERE customer_id <> 'Unknown' GROUP BY customer_id
  HAVING count(*) > 1000 OR {MONEY} > 100000
)"""

VARIED = """
varied AS (
  SELECT product_id, count(DISTINCT product_description) AS description_count
  FROM lines GROUP BY product_id HAVING count(DISTINCT product_description) > 1
)"""

DATES = """
dates AS (
  SELECT min(invoice_date) AS min_date, max(invoice_date) AS max_date,
    count(*) AS unique_dates,
    CAST(datediff('day', min(invoice_date), max(invoice_date)) AS INTEGER) AS date_range_days,
    CAST(coalesce(sum(n) FILTER (invoice_date > DATE '2000-06-30'), 0) AS BIGINT) AS future_rows,
    count(*) FILTER (gap > 7) AS gap_count,
    CAST(coalesce(max(gap) FILTER (gap > 7), 0) AS INTEGER) AS max_gap_days,
    CAST(count(*) AS DOUBLE) / datediff('day', min(invoice_date), max(invoice_date))
      AS date_density
  FROM (SELECT *, datediff('day', lag(invoice_date) OVER (ORDER BY invoice_date), invoice_date) AS gap
        FROM (SELECT invoice_date, count(*) AS n FROM lines GROUP BY invoice_date))
)"""

SHARES = """
shares AS (
  SELECT count(*) AS country_count, CAST(sum(n) AS BIGINT) AS row_count,
         (SELECT country FROM (SELECT country, count(*) AS n FROM lines GROUP BY country)
          ORDER BY n DESC, country LIMIT 1) AS top_country,
         max(n) AS top_count, CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS top_share
  FROM (SELECT country, count(*) AS n FROM lines GROUP BY country)
)"""

STATS = f"""
stats AS (
  SELECT count(*) AS row_count,
    count(*) FILTER (customer_id <> 'Unknown') AS known_customers,
    min(quantity) AS min_quantity, max(quantity) AS max_quantity, avg(quantity) AS avg_quantity,
    stddev_samp(quantity) AS std_quantity,
    count(*) FILTER (quantity <= 0) AS nonpositive_quantity,
    count(*) FILTER (quantity > 10000) AS extreme_quantity,
    min(unit_price) AS min_price, max(unit_price) AS max_price, avg(unit_price) AS avg_price,
    stddev_samp(unit_price) AS std_price,
    count(*) FILTER (unit_price <= 0) AS nonpositive_price,
    count(*) FILTER (unit_price > 10000) AS extreme_price,
    count(*) FILTER (abs(total_price - quantity * unit_price) > 0.01) AS price_mismatches,
    count(*) FILTER (hour < 6 OR hour > 22) AS unusual_hours,
    (SELECT count(*) FROM spenders) AS suspicious_customers
  FROM lines
)"""

ROW_COUNT_STATUS = """
  CASE WHEN row_count < 1000 THEN 'failed' WHEN row_count > 10000000 THEN 'warning'
       ELSE 'passed' END"""
COVERAGE_STATUS = """
  CASE WHEN CAST(known_customers AS DOUBLE) / row_count < 0.5 THEN 'warning' ELSE 'passed' END"""
RANGES_STATUS = """
  CASE WHEN nonpositive_quantity + extreme_quantity + nonpositive_price + extreme_price > 0
       THEN 'failed' ELSE 'passed' END"""
RULES_STATUS = """
  CASE WHEN price_mismatches > 0 OR suspicious_customers > 0
         OR CAST(unusual_hours AS DOUBLE) / row_count > 0.1 THEN 'warning' ELSE 'passed' END"""
DATES_STATUS = """
  CASE WHEN future_rows > 0 OR date_density < 0.3 THEN 'failed'
       WHEN year(min_date) < 1996 OR year(max_date) > 2000 THEN 'warning' ELSE 'passed' END"""
DUPLICATES = """
duplicates AS (
  SELECT (SELECT count(*) FROM lines) AS total_records,
         (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM keys) AS key_duplicates,
         (SELECT count(*) FROM lines) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lines))
           AS complete_duplicates
)"""
KEY_RATE = "CAST(key_duplicates AS DOUBLE) / total_records"
DUPLICATES_STATUS = f"""
  CASE WHEN {KEY_RATE} > 0.05 THEN 'failed' WHEN {KEY_RATE} > 0 THEN 'warning' ELSE 'passed' END"""


def _check(group: str, check: str, status: str, source: str) -> str:
    return f"SELECT '{group}' AS \"group\", '{check}' AS \"check\", {status} AS status FROM {source}"


# The lines as read when columns came in wrong types: what cannot be read is NULL.
SPOILED = """
lines AS (
  SELECT * REPLACE (
    CAST(CASE WHEN quantity % 13 <> 0 THEN quantity END AS DOUBLE) AS quantity,
    CASE WHEN product_id NOT LIKE '%7' THEN unit_price END AS unit_price,
    CASE WHEN hour <> 13 THEN hour END AS hour,
    CASE WHEN day <> 31 THEN invoice_date END AS invoice_date,
    '[' || country || ']' AS country,
    '{' || customer_id || '}' AS customer_id)
  FROM plain
)"""

CHECKS = (
    "checks AS (SELECT *, CASE status WHEN 'failed' THEN 'error' WHEN 'warning' THEN 'warning' "
    "ELSE 'info' END AS severity FROM ("
    + " UNION ALL ".join(
        [
            _check("Basic Checks", "row_count", ROW_COUNT_STATUS, "stats"),
            _check("Basic Checks", "schema", "'passed'", "stats"),
            _check("Basic Checks", "duplicates", DUPLICATES_STATUS, "duplicates"),
            *[
                _check(
                    "Data Integrity",
                    f"nulls:{c}",
                    f"CASE WHEN (SELECT count(*) FROM lines WHERE {c} IS NULL) > 0 "
                    "THEN 'failed' ELSE 'passed' END",
                    "stats",
                )
                for c in ("invoice_no", "product_id", "quantity", "unit_price")
            ],
            *[
                _check("Data Integrity", f"type:{c}", "'passed'", "stats")
                for c in ("quantity", "unit_price", "total_price")
            ],
            _check("Data Integrity", "customer_coverage", COVERAGE_STATUS, "stats"),
            _check("Business Rules", "ranges", RANGES_STATUS, "stats"),
            _check("Business Rules", "business_rules", RULES_STATUS, "stats"),
            _check(
                "Business Rules",
                "consistency",
                "CASE WHEN (SELECT count(*) FROM varied) > 0 THEN 'warning' ELSE 'passed' END",
                "stats",
            ),
            _check("Time Series", "dates", DATES_STATUS, "dates"),
            _check(
                "Time Series",
                "time_gaps",
                "CASE WHEN gap_count > 0 THEN 'warning' ELSE 'passed' END",
                "dates",
            ),
            _check(
                "Statistical Checks",
                "distribution",
                "CASE WHEN top_share > 0.8 THEN 'warning' ELSE 'passed' END",
                "shares",
            ),
            "SELECT 'Statistical Checks', 'outliers:' || column_name, 'warning' FROM outliers "
            "WHERE outlier_rate > 0.05",
            "SELECT 'Statistical Checks', 'outliers', 'passed' "
            "WHERE NOT EXISTS (SELECT 1 FROM outliers WHERE outlier_rate > 0.05)",
        ]
    )
    + "))"
)

VERDICT = """
verdict AS (
  SELECT count(*) AS total_checks, count(*) FILTER (status = 'passed') AS passed,
         count(*) FILTER (status = 'failed') AS failed,
         count(*) FILTER (status = 'warning') AS warnings,
         count(*) FILTER (status = 'passed') * 100.0::DOUBLE / count(*) AS quality_score,
         count(*) FILTER (status = 'failed' AND severity = 'error') = 0 AS quality_passed
  FROM checks
)"""

# --- assembling --------------------------------------------------------------

TO_CLEAN = [RAW, SINGLE, _timed("single", "timed"), FILLED, CLEANED]
TO_LINES = [*TO_CLEAN, LINES]
TO_CHECKS = [
    *TO_LINES,
    *(SPENDERS, STATS, KEYS, DUPLICATES, VARIED, DATES, OUTLIERS, SHARES, CHECKS, VERDICT),
]
# Text columns warn of their type, and unreadable dates fail.
SPOILED_CHECKS = re.sub(
    r"('type:\w+' AS \"check\", )'passed'", r"\1'warning'", CHECKS
).replace(DATES_STATUS, "'failed'")
TO_SPOILED = [
    *TO_CLEAN,
    LINES.replace("lines AS", "plain AS", 1),
    SPOILED,
    *(SPENDERS, STATS, KEYS, DUPLICATES, VARIED, DATES, OUTLIERS, SHARES, SPOILED_CHECKS),
]
PARSED = [RAW, _timed("raw", "parsed")]

WHEN = "strftime(invoice_date, '%Y-%m-%d') AS invoice_date"
WHEN_BOTH = (
    f"{WHEN}, strftime(invoice_datetime, '%Y-%m-%d %H:%M:%S') AS invoice_datetime"
)
SPAN = (
    "strftime(first_order_date, '%Y-%m-%d') AS first_order_date, "
    "strftime(last_order_date, '%Y-%m-%d') AS last_order_date"
)
MIN_MAX = (
    "strftime(min_date, '%Y-%m-%d') AS min_date, strftime(max_date, '%Y-%m-%d') AS max_date"
)


def _sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _lines_as(select: str) -> str:
    return _sql(TO_LINES, select)


ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) "
    "FROM orders",
    "scan_csv": _sql([RAW], "SELECT * FROM raw"),
    "scan_csv_gzip": _sql([RAW], "SELECT * FROM raw"),
    "scan_json": _sql([RAW], "SELECT * FROM raw"),
    "profile": _sql(
        [RAW],
        """SELECT count(*) AS row_count,
          count(*) FILTER (invoice_no IS NULL) AS "null_InvoiceNo",
          count(*) FILTER (product_id IS NULL) AS "null_StockCode",
          count(*) FILTER (product_description IS NULL) AS "null_Description",
          count(*) FILTER (quantity IS NULL) AS "null_Quantity",
          count(*) FILTER (invoice_date IS NULL) AS "null_InvoiceDate",
          count(*) FILTER (unit_price IS NULL) AS "null_UnitPrice",
          count(*) FILTER (customer_id IS NULL) AS "null_CustomerID",
          count(*) FILTER (country IS NULL) AS "null_Country",
          count(DISTINCT customer_id) AS unique_customers,
          count(DISTINCT product_id) AS unique_products FROM raw""",
    ),
    "standardize": _sql([RAW], "SELECT * FROM raw"),
    "dedup": _sql([RAW, SINGLE], "SELECT * FROM single"),
    "fill_nulls": _sql(
        [RAW],
        """SELECT * REPLACE (coalesce(customer_id, 'Unknown') AS customer_id,
          coalesce(product_description, 'No Description') AS product_description,
          coalesce(country, 'Unknown') AS country) FROM raw""",
    ),
    "drop_critical_nulls": _sql(
        [RAW],
        """SELECT * FROM raw WHERE invoice_no IS NOT NULL AND product_id IS NOT NULL
          AND quantity IS NOT NULL AND unit_price IS NOT NULL""",
    ),
    "null_profile": _sql(
        [RAW],
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, "
            f"count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*) AS null_percent FROM raw"
            for c in (
                *("invoice_no", "product_id", "product_description", "quantity"),
                *("invoice_date", "unit_price", "customer_id", "country"),
            )
        ),
    ),
    "parse_dates": _sql(PARSED, f"SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}) FROM parsed"),
    "valid_filter": _sql(
        PARSED,
        f"SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}) FROM ({PRICED} parsed) WHERE {VALID}",
    ),
    "clean": _sql(TO_CLEAN, f"SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}) FROM cleaned"),
    "calendar_features": _sql(
        PARSED, f"SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}), {CALENDAR} FROM parsed"
    ),
    "time_flags": _sql(
        PARSED,
        f"SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}), {TIME_FLAGS} "
        f"FROM (SELECT *, {CALENDAR} FROM parsed)",
    ),
    "order_size": _sql([RAW], f"SELECT *, {ORDER_SIZE} FROM raw"),
    "price_category": _sql([RAW], f"SELECT *, {PRICE_CATEGORY} FROM raw"),
    "business_flags": _sql(
        [RAW],
        f"""SELECT *, {VALUE_FLAGS} FROM ({PRICED} (
          SELECT * REPLACE (coalesce(customer_id, 'Unknown') AS customer_id,
          coalesce(product_description, 'No Description') AS product_description) FROM raw))""",
    ),
    "product_text_flags": _sql([RAW], f"SELECT *, {TEXT_FLAGS} FROM raw"),
    "enriched": _lines_as(f"SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}) FROM lines"),
    "enriched_table": _lines_as(f"SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}) FROM lines"),
    "customer_sequence": _lines_as(
        f"""SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}),
          row_number() OVER (PARTITION BY customer_id ORDER BY invoice_datetime, invoice_no,
            product_id, quantity, unit_price, product_description, country)
            AS customer_purchase_number,
          CAST(datediff('day', min(invoice_date) OVER (PARTITION BY customer_id), invoice_date)
            AS INTEGER) AS days_since_first_purchase FROM lines"""
    ),
    "product_popularity": _lines_as(
        f"""SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}),
          count(*) OVER (PARTITION BY product_id) AS product_popularity FROM lines"""
    ),
    "retention": _lines_as(
        f"""SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}) FROM lines
          WHERE invoice_date > DATE '2000-06-30' - 365"""
    ),
    "retention_table": _lines_as(
        f"""SELECT * EXCLUDE (moment) REPLACE ({WHEN_BOTH}) FROM lines
          WHERE invoice_date > DATE '2000-06-30' - 365"""
    ),
    "quarantine": _sql(
        [RAW],
        """SELECT field || ' is not a number' AS reason, field, count(*) AS line_count FROM (
             SELECT CASE WHEN CAST(invoice_no AS BIGINT) % 89 = 0 THEN 'Quantity'
                         WHEN CAST(invoice_no AS BIGINT) % 97 = 0 THEN 'UnitPrice' END AS field
             FROM raw) WHERE field IS NOT NULL GROUP BY field""",
    ),
    "run_history": """
        WITH runs AS (
          SELECT o_orderkey AS k, o_orderdate, o_orderkey % 5 = 0 AS bad FROM orders
          WHERE o_orderkey % 7 = 0
            AND o_orderdate > CAST(DATE '2000-06-30' AS TIMESTAMP) - INTERVAL 400 DAY),
        stages AS (
          SELECT 'transformation' AS stage, sum(k % 60) AS n FROM runs
          UNION ALL SELECT 'report', sum(k % 8) FROM runs),
        failing AS (
          SELECT CASE k % 2 WHEN 0 THEN 'transformation' ELSE 'report' END AS stage, count(*) AS n
          FROM runs WHERE bad GROUP BY ALL)
        SELECT count(*) AS total_runs, count(*) FILTER (NOT bad) AS successful_runs,
          count(*) FILTER (bad) AS failed_runs,
          coalesce(avg(k % 600) FILTER (NOT bad), 0) AS avg_duration,
          coalesce(CAST(min(k % 600) FILTER (NOT bad) AS DOUBLE), 0) AS min_duration,
          coalesce(CAST(max(k % 600) FILTER (NOT bad) AS DOUBLE), 0) AS max_duration,
          CAST(coalesce(sum(k * 2), 0) AS BIGINT) AS rows_read,
          CAST(coalesce(sum(k) FILTER (NOT bad), 0) AS BIGINT) AS rows_processed,
          CAST(coalesce(sum(k % 11), 0) AS BIGINT) AS rows_quarantined,
          strftime(max(o_orderdate), '%Y-%m-%d') AS last_execution_date,
          (SELECT stage FROM stages ORDER BY n DESC, stage LIMIT 1) AS slowest_stage,
          (SELECT stage FROM failing ORDER BY n DESC, stage LIMIT 1) AS failing_stage
        FROM runs""",
    "customer_metrics": _sql(
        [*TO_LINES, CUSTOMERS, LEVELS],
        f"""SELECT * EXCLUDE (s25, s50, s75, f50, f75) REPLACE ({SPAN},
            round(order_value_stddev, 6) AS order_value_stddev,
            round(order_consistency, 6) AS order_consistency), {SEGMENT},
          dense_rank() OVER (ORDER BY total_spent DESC) AS revenue_rank,
          percent_rank() OVER (ORDER BY total_spent DESC) * 100 AS revenue_percentile
          FROM levels""",
    ),
    "customer_segments": _sql(
        [*TO_LINES, CUSTOMERS, LEVELS],
        f"SELECT customer_id, country, value_segment, frequency_segment, {SEGMENT} FROM levels",
    ),
    "customer_segments_basic": _sql(
        [*TO_LINES, CUSTOMERS, LEVELS],
        """SELECT customer_id, country,
          CASE WHEN value_segment = 'High' AND frequency_segment = 'Frequent' THEN 'Champions'
               WHEN value_segment = 'High' AND frequency_segment = 'Regular' THEN 'Loyal Customers'
               WHEN value_segment = 'Medium' AND frequency_segment = 'Frequent'
               THEN 'Potential Loyalists'
               WHEN total_orders = 1 THEN 'New Customers'
               WHEN customer_lifetime_days > 180 THEN 'At Risk'
               ELSE 'Needs Attention' END AS customer_segment FROM levels""",
    ),
    "customer_rank": _sql(
        [*TO_LINES, CUSTOMERS],
        """SELECT customer_id, country, total_spent,
          dense_rank() OVER (ORDER BY total_spent DESC) AS revenue_rank,
          percent_rank() OVER (ORDER BY total_spent DESC) * 100 AS revenue_percentile
          FROM customers""",
    ),
    "top_customers": _sql(
        [*TO_LINES, CUSTOMERS, LEVELS],
        f"""SELECT customer_id, total_spent, {SEGMENT} FROM levels
          ORDER BY total_spent DESC, customer_id, country LIMIT 5""",
    ),
    "classify_customer_value": _sql(
        [*TO_LINES, CUSTOMERS],
        """SELECT customer_id, country, total_spent,
          CASE WHEN total_spent >= 1000 THEN 'High' WHEN total_spent >= 500 THEN 'Medium'
               ELSE 'Low' END AS value_class FROM customers""",
    ),
    "product_metrics": _sql(
        [*TO_LINES, PRODUCTS],
        f"""SELECT * REPLACE (round(price_volatility, 6) AS price_volatility,
            round(avg_unit_price, 8) AS avg_unit_price, round(price_range, 6) AS price_range,
            round(popularity_score, 8) AS popularity_score),
          {CATEGORY}, {PRODUCT_RANKS} FROM products""",
    ),
    "product_category": _sql(
        [*TO_LINES, PRODUCTS],
        f"SELECT product_id, product_description, {CATEGORY} FROM products",
    ),
    "product_rank": _sql(
        [*TO_LINES, PRODUCTS],
        f"SELECT product_id, product_description, {PRODUCT_RANKS} FROM products",
    ),
    "top_products": _sql(
        [*TO_LINES, PRODUCTS],
        """SELECT product_id, total_revenue, unique_customers FROM products
          ORDER BY total_revenue DESC, product_id, product_description LIMIT 5""",
    ),
    "daily_totals": _sql(
        [*TO_LINES, DAYS],
        f"SELECT * REPLACE ({WHEN}, round(revenue_stddev, 6) AS revenue_stddev) FROM days",
    ),
    "daily_metrics": _sql(
        [*TO_LINES, DAYS, GROWTH],
        f"SELECT * REPLACE ({WHEN}, round(revenue_stddev, 6) AS revenue_stddev), {MOVING} FROM grown",
    ),
    "daily_moving_avg": _sql([*TO_LINES, DAYS], f"SELECT {WHEN}, {MOVING} FROM days"),
    "daily_growth": _sql(
        [*TO_LINES, DAYS, GROWTH],
        f"""SELECT {WHEN}, revenue_yesterday, daily_growth, orders_yesterday, order_growth
          FROM grown""",
    ),
    "country_metrics": _sql(
        [*TO_LINES, COUNTRIES, BEST],
        f"""SELECT countries.* REPLACE ({SPAN},
            round(revenue_volatility, 6) AS revenue_volatility), {COUNTRY_RANKS},
          (SELECT string_agg(product_id || ':' || printf('%.2f', revenue), ',' ORDER BY product_rank)
           FROM best WHERE best.country = countries.country) AS top_3_products FROM countries""",
    ),
    "country_rank": _sql(
        [*TO_LINES, COUNTRIES], f"SELECT country, {COUNTRY_RANKS} FROM countries"
    ),
    "country_top_products": _sql([*TO_LINES, BEST], "SELECT * FROM best"),
    "grand_totals": _lines_as(
        f"SELECT {MONEY} AS total_revenue, count(DISTINCT customer_id) AS total_customers FROM lines"
    ),
    "hourly_patterns": _sql(
        [*TO_LINES, CELLS],
        "SELECT * REPLACE (round(revenue_stddev, 6) AS revenue_stddev) FROM peaks",
    ),
    "peak_hours": _sql(
        [*TO_LINES, CELLS], "SELECT hour, day_of_week, transaction_count, is_peak_hour FROM peaks"
    ),
    "quantiles": _lines_as(
        "SELECT quantile_disc(total_price, 0.25) AS p25, quantile_disc(total_price, 0.5) AS p50, "
        "quantile_disc(total_price, 0.75) AS p75 FROM lines"
    ),
    "dq_row_count": _sql(
        TO_CHECKS, f"SELECT row_count, {ROW_COUNT_STATUS} AS status FROM stats"
    ),
    "dq_nulls": _sql(
        [RAW],
        """SELECT count(*) AS row_count,
          count(*) FILTER (invoice_no IS NULL) AS null_invoice_no,
          count(*) FILTER (product_id IS NULL) AS null_product_id,
          count(*) FILTER (quantity IS NULL) AS null_quantity,
          count(*) FILTER (unit_price IS NULL) AS null_unit_price FROM raw""",
    ),
    "dq_customer_coverage": _sql(
        TO_CHECKS, f"SELECT row_count, known_customers, {COVERAGE_STATUS} AS status FROM stats"
    ),
    "dq_ranges": _sql(
        TO_CHECKS,
        f"""SELECT min_quantity, max_quantity, avg_quantity, round(std_quantity, 6) AS std_quantity,
          nonpositive_quantity, extreme_quantity, min_price, max_price,
          round(avg_price, 8) AS avg_price, round(std_price, 6) AS std_price,
          nonpositive_price, extreme_price, {RANGES_STATUS} AS status FROM stats""",
    ),
    "dq_ranges_raw": _sql(
        [RAW],
        """SELECT min(quantity) AS min_quantity, max(quantity) AS max_quantity,
          count(*) FILTER (quantity <= 0) AS nonpositive_quantity,
          count(*) FILTER (quantity > 10000) AS extreme_quantity,
          min(unit_price) AS min_price, max(unit_price) AS max_price,
          count(*) FILTER (unit_price <= 0) AS nonpositive_price,
          count(*) FILTER (unit_price > 10000) AS extreme_price FROM raw""",
    ),
    "dq_business_rules": _sql(
        TO_CHECKS,
        f"""SELECT price_mismatches, unusual_hours, suspicious_customers,
          {RULES_STATUS} AS status FROM stats""",
    ),
    "dq_duplicates": _sql(
        TO_CHECKS,
        f"""SELECT *, CAST(complete_duplicates AS DOUBLE) / total_records AS complete_dup_rate,
          {KEY_RATE} AS key_dup_rate, {DUPLICATES_STATUS} AS status FROM duplicates""",
    ),
    "dq_duplicates_raw": _sql(
        [RAW],
        f"""SELECT *, CAST(complete_duplicates AS DOUBLE) / total_records AS complete_dup_rate,
          {KEY_RATE} AS key_dup_rate FROM (
            SELECT (SELECT count(*) FROM raw) AS total_records,
              (SELECT count(*) FROM raw) - (SELECT count(*) FROM (
                 SELECT DISTINCT invoice_no, product_id, invoice_date FROM raw)) AS key_duplicates,
              (SELECT count(*) FROM raw) - (SELECT count(*) FROM (
                 SELECT DISTINCT * FROM raw)) AS complete_duplicates)""",
    ),
    "dq_consistency": _sql([*TO_LINES, VARIED], "SELECT * FROM varied"),
    "dq_dates": _sql(
        TO_CHECKS, f"SELECT * REPLACE ({MIN_MAX}), {DATES_STATUS} AS status FROM dates"
    ),
    "dq_time_gaps": _sql([*TO_LINES, DATES], "SELECT gap_count, max_gap_days FROM dates"),
    "dq_outliers": _sql([*TO_LINES, OUTLIERS], "SELECT * FROM outliers"),
    "dq_distribution": _lines_as(
        """SELECT country, count(*) AS line_count FROM lines GROUP BY country
          ORDER BY line_count DESC, country LIMIT 5"""
    ),
    "dq_concentration": _sql([*TO_LINES, SHARES], "SELECT * FROM shares"),
    "dq_checks": _sql(TO_CHECKS, "SELECT * FROM checks"),
    "dq_bad_types": _sql(TO_SPOILED, "SELECT * FROM checks"),
    "dq_unreadable": _sql(
        [*TO_CLEAN, LINES],
        """SELECT count(*) AS row_count,
          count(*) FILTER (quantity % 13 = 0) AS unreadable_quantity,
          count(*) FILTER (product_id LIKE '%7') AS unreadable_unit_price,
          0::BIGINT AS unreadable_total_price,
          count(*) FILTER (hour = 13) AS unreadable_hour,
          count(*) FILTER (day = 31) AS unreadable_invoice_date,
          0::BIGINT AS unreadable_invoice_datetime, 0::BIGINT AS unreadable_invoice_no,
          0::BIGINT AS unreadable_product_id, 0::BIGINT AS unreadable_product_description,
          0::BIGINT AS unreadable_customer_id, 0::BIGINT AS unreadable_country
          FROM lines""",
    ),
    "dq_summary": _sql(
        TO_CHECKS,
        """SELECT verdict.*, (SELECT count(*) FROM lines) AS row_count, 31 AS column_count,
          (SELECT strftime(min(invoice_date), '%Y-%m-%d') FROM lines) AS min_date,
          (SELECT strftime(max(invoice_date), '%Y-%m-%d') FROM lines) AS max_date FROM verdict""",
    ),
    "run_summary": _sql(
        [*TO_CHECKS, CUSTOMERS, PRODUCTS],
        """SELECT verdict.*, (SELECT count(*) FROM customers) AS total_customers,
          (SELECT max(total_spent) FROM customers) AS top_customer_spent,
          (SELECT CAST(sum(CAST(round(total_spent * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*)
           FROM customers) AS avg_customer_spent,
          (SELECT count(*) FROM products) AS total_products,
          (SELECT max(total_revenue) FROM products) AS top_product_revenue,
          (SELECT count(DISTINCT invoice_date) FROM lines) AS total_days,
          (SELECT count(DISTINCT country) FROM lines) AS total_countries FROM verdict""",
    ),
    "freshness": _lines_as(
        """SELECT strftime(max(invoice_date), '%Y-%m-%d') AS newest_date,
          CAST(datediff('day', max(invoice_date), DATE '2000-06-30') AS INTEGER) AS age_days,
          CASE WHEN datediff('day', max(invoice_date), DATE '2000-06-30') BETWEEN 0 AND 1
               THEN 'passed' ELSE 'failed' END AS status FROM lines"""
    ),
    "volume_gate": _sql(
        [*TO_LINES, CUSTOMERS, PRODUCTS],
        """SELECT *, CASE WHEN total_customers >= 100 AND total_products >= 10
               THEN 'passed' ELSE 'failed' END AS status
          FROM (SELECT (SELECT count(*) FROM customers) AS total_customers,
                       (SELECT count(*) FROM products) AS total_products)""",
    ),
}
ORACLE["batch_report"] = ORACLE["run_summary"]
