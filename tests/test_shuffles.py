"""What the large shuffles carry, and that leaner ones give the same results."""

import re
from itertools import product

from pyspark.sql import functions as F

from salespect.functions import staging
from salespect.functions.distinct import grouped
from salespect.functions.staging import staged
from salespect.operators import countries, daily, hourly
from salespect.operators import quality as q
from salespect.plans import queries
from salespect.sources.star import raw_transactions


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def measures():
    return {"lines": F.count(F.lit(1)), "a_values": "a", "total": F.sum("b"), "b_values": "b", "days": "d"}


def test_distinct_counts_equal_one_aggregation_with_nulls_and_repeats(spark):
    values = list(product((None, "x", "y"), (None, "p"), (None, "1", "2"), (None, 0.0, -0.0, 3.5), (None, "2020-01-01", "2020-01-02")))
    rows = spark.createDataFrame(values + values[::5], "k string, l string, a string, b double, d string")
    frame = staged(rows.withColumn("d", F.col("d").cast("date")).filter("l IS NULL OR a IS NULL OR k = 'x'"), "distinct")
    found = grouped(frame, ("k", "l"), measures())
    wanted = frame.groupBy("k", "l").agg(*[(F.count_distinct(m) if isinstance(m, str) else m).alias(n) for n, m in measures().items()])
    assert found.columns == wanted.columns and found.dtypes == wanted.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_distinct_counts_expand_no_line_and_carry_no_sums(spark):
    frame = staged(spark.range(50).selectExpr("string(id % 3) AS k", "string(id) AS a", "id * 0.5D AS b", "id AS d"), "lean")
    text = plan(grouped(frame, ("k",), measures()))
    assert "Expand" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(_k#\d+, [abd]#\d+", text)) == 3


def test_few_repeated_keys_shuffle_no_whole_line(spark):
    line = "string(id % 990) AS invoice_no, 'p' AS product_id, 'noon' AS invoice_date, id % 995 AS quantity"
    frame = staged(spark.range(1000).selectExpr(*line.split(", ")), "lines")
    stats = q.duplicate_stats(frame)
    assert stats.select("total_records", "key_duplicates", "complete_duplicates").first() == (1000, 10, 0)
    assert "SortMergeJoin" not in plan(stats) and "BroadcastHashJoin" in plan(stats)


def test_duplicates_where_a_key_column_has_no_type(spark):
    frame = spark.createDataFrame([("1", 2), ("1", 2), ("1", 3)], "invoice_no string, quantity int").withColumn("product_id", F.lit(None))
    assert q.duplicate_stats(frame).select("key_duplicates", "complete_duplicates").first() == (2, 1)


def _small_star(spark, folder):
    tables = {
        "nation": spark.sql("SELECT 0L AS n_nationkey, 'A' AS n_name UNION ALL SELECT 5L, 'E'"),
        "customer": spark.sql("SELECT id AS c_custkey, IF(id = 1, 5L, 0L) AS c_nationkey FROM range(3)"),
        "part": spark.sql("SELECT id AS p_partkey, 'red box' AS p_name FROM range(4)"),
        "orders": spark.sql("SELECT id AS o_orderkey, id % 4 AS o_custkey, timestamp_ntz '1998-02-03' AS o_orderdate FROM range(1, 9)"),
        "lineitem": spark.sql(
            "SELECT IF(id = 0, NULL, id % 9) AS l_orderkey, IF(id = 3, NULL, id % 5) AS l_partkey, 1L AS l_linenumber, "
            "2.0D AS l_quantity, 600.0D + id AS l_extendedprice, 'N' AS l_returnflag FROM range(40)"
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")


def test_lines_are_dealt_once_by_invoice(spark, tmp_path):
    """With large parts the deduplication reuses the exchange of the join with the invoices."""
    _small_star(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries.Inputs(spark, str(tmp_path)).clean)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.search(r"Exchange hashpartitioning\(\w+#\d+, \w+#\d+, \w+#\d+", text)
    lines = raw_transactions(spark, str(tmp_path))
    wanted = sum(1 for i in range(40) if i != 3 and i % 9 and i % 9 % 4 != 3 and i % 5 < 4)
    assert lines.count() == wanted


def test_popularity_query_joins_base_columns_only(spark, tmp_path):
    _small_star(spark, tmp_path)
    table = queries.QUERIES["product_popularity"](spark, str(tmp_path))
    assert not re.search(r"is_gift|order_size|year", re.search(r"ReadSchema: struct<([^>]*invoice_no[^>]*)>", plan(table)).group(1))
    counts = {r.product_id: r.n for r in table.groupBy("product_id").agg(F.count("*").alias("n")).collect()}
    assert counts and all(r.product_popularity == counts[r.product_id] for r in table.collect())
    assert table.columns[-1] == "product_popularity" and "is_gift" in table.columns


def test_country_sums_lie_on_one_row_per_country(sample):
    levels = countries.country_levels(sample)
    assert levels.filter("level = 3").count() == levels.select("country").distinct().count()
    others = levels.filter("level < 3").agg(F.count("_squares"), F.sum("_lines"), F.count("total_items"), F.count("last_order_date")).first()
    assert others == (0, 0, 0, 0)


def test_writes_side_by_side_leave_the_session_as_it_was(spark):
    before = spark.conf.get(staging.CLEANUP, None)
    first, second = staging._cleaned_up(spark), staging._cleaned_up(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(staging.CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(staging.CLEANUP, None) == before


def test_days_and_hours_expand_no_line(sample):
    lines = staged(sample, "lines")
    assert "Expand" not in plan(daily.daily_totals(lines)) + plan(hourly.hourly_totals(lines))
