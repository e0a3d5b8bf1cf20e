import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.order_stats import (
    quantile_frame,
    quantiles,
    ranked_values,
    selected_quantile_frame,
    with_global_rank,
)
from salespect.functions import joins, order_stats
from salespect.functions.staging import staged
from salespect.operators import customers, products, quality

RANDOM = random.Random(7)
CASES = {
    "spread": [RANDOM.lognormvariate(5, 3) for _ in range(3000)],
    "tied": [float(n % 7) for n in range(1000)],
    "one value": [4.5] * 500,
    "hot value": [1.0] * 700 + [RANDOM.random() for _ in range(1300)],
    "negative": [RANDOM.gauss(0, 10) for _ in range(500)],
    "single row": [3.0],
}


@pytest.mark.parametrize("case", CASES)
def test_ranks_equal_the_window_functions(spark, case):
    frame = spark.createDataFrame([(v,) for v in CASES[case]], "v double")
    ours = with_global_rank(frame, ranked_values(frame, ["v"]), "v", "dense", "percent")
    by_value = Window.orderBy(F.desc("v"))
    wrong = ours.withColumn("d", F.dense_rank().over(by_value)).withColumn(
        "p", F.percent_rank().over(by_value) * 100
    ).filter("d <> dense OR abs(p - percent) > 1e-12")
    assert ours.count() == len(CASES[case]) and wrong.count() == 0


@pytest.mark.parametrize("case", CASES)
def test_quantiles_equal_sorting(spark, case):
    values, shares = sorted(CASES[case]), (0.0001, 0.25, 0.5, 0.8, 1.0)
    frame = spark.createDataFrame([(v,) for v in CASES[case]], "v double")
    row = quantile_frame(ranked_values(frame, ["v"]), {"v": shares}).first()
    assert row.v == [values[math.ceil(s * len(values)) - 1] for s in shares]
    assert selected_quantile_frame(frame, {"v": shares}).first().v == row.v


@pytest.mark.parametrize("case", CASES)
def test_a_coarse_sketch_still_gives_exact_quantiles(spark, monkeypatch, case):
    """With brackets of a few percent most rows lie outside and are only counted."""
    monkeypatch.setattr(order_stats, "SKETCH_ACCURACY", 50)
    values, shares = sorted(CASES[case]), (0.01, 0.1, 0.25, 0.5, 0.51, 0.97, 1.0)
    rows = [(v, -v) for v in CASES[case]] + [(None, None)] * 40
    frame = spark.createDataFrame(rows, "v double, w double").repartition(5)
    row = selected_quantile_frame(frame, {"v": shares, "w": [0.25, 0.75]}).first()
    assert row.v == [values[math.ceil(s * len(values)) - 1] for s in shares]
    negative = sorted(-v for v in values)
    assert row.w == [negative[math.ceil(s * len(values)) - 1] for s in (0.25, 0.75)]


def test_several_columns_at_once(spark):
    frame = spark.range(1, 101).select("id", (F.col("id") * -2).alias("w"))
    found = quantile_frame(ranked_values(frame, ["id", "w"]), {"id": [0.5], "w": [0.25]}).first()
    assert (found.id, found.w) == ([50.0], [-152.0])


def test_nulls_are_left_out(spark):
    frame = spark.createDataFrame([(None,), (1.0,), (2.0,)], "v double")
    ours = with_global_rank(frame, ranked_values(frame, ["v"]), "v", "dense")
    assert {(r.v, r.dense) for r in ours.collect()} == {(2.0, 1), (1.0, 2), (None, None)}


def test_no_rows(spark):
    frame = spark.createDataFrame([], "v double")
    (low,) = quantiles(frame, {"v": [0.25]})["v"]
    assert frame.select(low).count() == 0
    assert with_global_rank(frame, ranked_values(frame, ["v"]), "v", "dense").count() == 0


def test_approximate_quantiles_on_request(spark):
    frame = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"))
    (median,) = quantiles(frame, {"v": [0.5]}, Settings(quantile_accuracy=10000))["v"]
    assert spark.range(1).select(median).first()[0] == 500.0


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_selection_takes_one_narrow_shuffle(spark):
    frame = staged(spark.range(5000).select(F.col("id").cast("double").alias("v"), F.col("id").alias("w")), "numbers")
    text = plan(selected_quantile_frame(frame, {"v": [0.25, 0.75]}))
    main = text[: text.index("Subquery")] if "Subquery" in text else text
    assert "rangepartitioning" not in text and main.count("Exchange hashpartitioning(slot") <= 2
    assert set(__import__("re").findall(r"ReadSchema: struct<([^>]*)>", text)) == {"v:double"}


HALF = [(n, 7.0 if n % 2 else float(n % 90)) for n in range(2000)]


def test_half_of_the_rows_on_one_value(spark, monkeypatch):
    """Ranks and counts reach a hot value's rows in pieces, none of them above its share."""
    monkeypatch.setattr(joins, "PIECE_ROWS", 100)
    frame = spark.createDataFrame(HALF, "id long, v double").repartition(6)
    ours = with_global_rank(frame, ranked_values(frame, ["v"]), "v", "dense", "percent")
    by_value = Window.orderBy(F.desc("v"))
    wrong = ours.filter(F.col("dense") != 0).withColumn("d", F.dense_rank().over(by_value)).filter("d <> dense")
    assert ours.count() == len(HALF) and wrong.count() == 0 and ours.columns == ["v", "id", "dense", "percent"]
    popular = products.with_product_popularity(frame.withColumn("product_id", F.col("v").cast("string")))
    counts = {r.product_id: r.n for r in popular.groupBy("product_id").agg(F.count("*").alias("n")).collect()}
    assert all(counts[r.product_id] == r.product_popularity for r in popular.collect())
    facts = frame.groupBy("v").agg(F.count("*").alias("n"))
    dealt = joins.join_spread(frame, facts, "v", "n")
    text = plan(dealt)
    assert "_piece" in text.split("Join", 1)[1].split("\n")[0]


def test_pieces_are_even(spark, monkeypatch):
    monkeypatch.setattr(joins, "PIECE_ROWS", 100)
    frame = spark.createDataFrame(HALF, "id long, v double")
    facts = frame.groupBy("v").agg(F.count("*").alias("n"))
    pieces = F.pmod(F.xxhash64("id", "v"), F.ceil(F.col("n") / joins.PIECE_ROWS))
    sizes = frame.join(facts, "v").filter("v = 7").groupBy(pieces.alias("p")).count().agg(F.max("count")).first()[0]
    assert sizes < 2 * joins.PIECE_ROWS


def test_thresholds_are_part_of_the_plan(spark, sample, monkeypatch):
    """Building segments, classes and outlier bounds starts no job; finished tables stage their ranks only."""
    base = staged(customers.customer_base(sample), "customers")
    goods = staged(products.product_base(sample), "products")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        built = [customers.segment_customers(base), customers.segment_customers_basic(base), products.categorize_products(goods), quality.outlier_stats(sample)]
        assert not tracker.getJobIdsForGroup("building")
        assert all("ubquery" in plan(frame) for frame in built)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    labels = []
    monkeypatch.setattr(order_stats, "staged", lambda frame, label: labels.append(label) or staged(frame, label))
    customers.finish_customers(base)
    assert labels == ["value_counts", "ranked_values"]
