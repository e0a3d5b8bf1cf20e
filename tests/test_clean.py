from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.schema import RAW_SCHEMA
from salespect.operators import clean as c
from salespect.operators.enrich import enrich, with_text_flags, with_value_flags


def test_standardize_ignores_absent_columns(spark):
    frame = spark.createDataFrame([("1", 5)], "InvoiceNo string, Other int")
    assert c.standardize(frame).columns == ["invoice_no", "Other"]


def test_invalid_lines_go(raw):
    lines = raw(
        {"InvoiceNo": "1"},
        {"InvoiceNo": "2", "Quantity": -3},
        {"InvoiceNo": "3", "UnitPrice": 0.0},
        {"InvoiceNo": "4", "Quantity": 0},
    )
    assert [r.invoice_no for r in enrich(lines).collect()] == ["1"]


@pytest.mark.parametrize(
    ("text", "moment"),
    [
        ("12/1/2010 8:26", datetime(2010, 12, 1, 8, 26)),
        ("1/15/2011 14:30", datetime(2011, 1, 15, 14, 30)),
        ("12/31/2011 23:59", datetime(2011, 12, 31, 23, 59)),
    ],
)
def test_date_parts(raw, text, moment):
    row = enrich(raw({"InvoiceDate": text})).first()
    assert row.invoice_datetime == moment and row.invoice_date == moment.date()
    assert (row.year, row.month, row.day, row.hour) == (
        *(moment.year, moment.month, moment.day),
        moment.hour,
    )
    assert row.quarter == (moment.month + 2) // 3
    assert row.day_of_week == moment.isoweekday() % 7 + 1
    assert row.week_of_year == moment.isocalendar().week


def test_unreadable_and_foreign_years_go(raw):
    lines = raw(
        {"InvoiceDate": "invalid"},
        {"InvoiceDate": None},
        {"InvoiceDate": "12/31/2009 23:59"},
        {"InvoiceDate": "1/1/2013 0:00"},
        {"InvoiceDate": "1/1/2010 0:00"},
    )
    assert [r.invoice_date for r in enrich(lines).collect()] == [date(2010, 1, 1)]


def test_typed_dates_are_accepted(spark):
    lines = spark.sql(
        "SELECT '1' invoice_no, 'A' product_id, timestamp'2011-06-01 10:00' invoice_date"
    )
    assert c.parse_dates(lines).first().invoice_datetime == datetime(2011, 6, 1, 10)


@pytest.mark.parametrize(
    ("hour", "flags"),
    [
        (5, (0, 0, 0, 0)),
        (6, (1, 0, 0, 0)),
        (9, (1, 0, 0, 1)),
        (12, (0, 1, 0, 1)),
        (16, (0, 1, 0, 1)),
        (17, (0, 1, 0, 0)),
        (18, (0, 0, 1, 0)),
        (23, (0, 0, 1, 0)),
    ],
)
def test_time_flags_on_a_wednesday(raw, hour, flags):
    row = enrich(raw({"InvoiceDate": f"6/1/2011 {hour}:00"})).first()
    assert (row.is_morning, row.is_afternoon, row.is_evening, row.is_business_hours) == flags
    assert row.is_weekend == 0


def test_weekend(raw):
    row = enrich(raw({"InvoiceDate": "6/4/2011 10:00"})).first()
    assert (row.is_weekend, row.is_business_hours) == (1, 0)


def test_business_flags_at_their_bounds(raw):
    """Every bound of size and price, from just below it, with the labels found by counting bounds reached."""
    sizes = ("Small", "Medium", "Large", "Bulk")
    prices = ("Budget", "Economy", "Standard", "Premium")
    cases = [(q, p / 100, land) for q in (4, 5, 19, 20, 99, 100) for p in (499, 500, 999, 1000, 4999, 5000) for land in ("EIRE", "Peru")]
    lines = raw(*[{"InvoiceNo": str(n), "Quantity": q, "UnitPrice": p, "Country": land} for n, (q, p, land) in enumerate(cases)])
    found = {int(r.invoice_no): r for r in enrich(lines).collect()}
    for n, (quantity, price, land) in enumerate(cases):
        row = found[n]
        assert row.order_size == sizes[sum(quantity >= b for b in (5, 20, 100))]
        assert row.price_category == prices[sum(price >= b for b in (5, 10, 50))]
        assert (row.is_uk, row.is_international) == ((1, 0) if land == "EIRE" else (0, 1))
        assert row.is_high_value == int(round(quantity * price, 2) >= 100)


def test_unknown_country_is_neither_home_nor_abroad(spark):
    frame = spark.sql("SELECT CAST(NULL AS string) country, 1.0D total_price, 'Unknown' customer_id")
    row = with_value_flags(frame).first()
    assert (row.is_uk, row.is_international, row.is_identified_customer) == (0, 0, 0)


@pytest.mark.parametrize("column", RAW_SCHEMA.names)
def test_a_null_is_filled_or_costs_the_line(raw, column):
    rows = enrich(raw({}, {"InvoiceNo": "other", column: None})).collect()
    filled = {"Description": ("product_description", "No Description"), "CustomerID": ("customer_id", "Unknown"), "Country": ("country", "Unknown")}
    if column not in filled:
        assert [r.invoice_no for r in rows] == ["1"]
    else:
        name, value = filled[column]
        assert {r.invoice_no: r[name] for r in rows}["other"] == value
        assert all(r.is_identified_customer == (r.customer_id != "Unknown") for r in rows)


def test_only_lines_within_the_limits_stay(raw):
    """Quantity and price around both of their limits; copies of each line add nothing."""
    edges = [-3, 0, 1, 9999, 10000]
    lines = [{"InvoiceNo": f"{q}/{p}", "Quantity": q, "UnitPrice": float(p)} for q in edges for p in edges]
    kept = {r.invoice_no for r in enrich(raw(*lines, *lines)).collect()}
    assert kept == {f"{q}/{p}" for q in (1, 9999) for p in (1, 9999)}
    assert enrich(raw({"Quantity": 1, "UnitPrice": 0.004})).count() == 0


def test_survivor_is_the_largest_copy_and_may_be_invalid(raw):
    copies = raw({"Quantity": 2}, {"Quantity": 7}, {"Quantity": None})
    assert enrich(copies).first().quantity == 7
    displaced = raw({"Quantity": 2}, {"Quantity": 20000})
    assert enrich(displaced).count() == 0


def test_dedup_does_not_depend_on_partitioning(raw, rows_of):
    lines = c.standardize(
        raw(*[{"InvoiceNo": str(n % 5), "Quantity": n % 7, "CustomerID": f"C{n}"} for n in range(200)])
    )
    results = [rows_of(c.dedup(lines.repartition(p))) for p in (1, 3, 8)]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 5


def test_text_flags(raw):
    lines = raw(
        {"StockCode": "1", "Description": "VINTAGE Clock"},
        {"StockCode": "2", "Description": "red Christmas star"},
        {"StockCode": "3", "Description": "Gift wrap"},
        {"StockCode": "4", "Description": "small PRESENT"},
        {"StockCode": "5", "Description": "plain mug"},
    )
    found = {
        r.product_id: (r.is_vintage, r.is_christmas, r.is_gift) for r in enrich(lines).collect()
    }
    assert found == {
        "1": (1, 0, 0),
        "2": (0, 1, 0),
        "3": (0, 0, 1),
        "4": (0, 0, 1),
        "5": (0, 0, 0),
    }


def test_missing_description_has_no_text_flags(spark):
    row = with_text_flags(spark.sql("SELECT CAST(NULL AS string) product_description")).first()
    assert (row.is_vintage, row.is_christmas, row.is_gift) == (0, 0, 0)


def test_thresholds_come_from_the_settings(raw):
    cfg = Settings(high_value_threshold=50.0, bulk_order_threshold=10)
    lines = raw(
        {"InvoiceNo": "1", "Quantity": 10, "UnitPrice": 15.0},
        {"InvoiceNo": "2", "Quantity": 4, "UnitPrice": 10.0},
    )
    enriched = enrich(lines, cfg)
    assert enriched.agg(F.sum("is_high_value")).first()[0] == 1
    assert enriched.filter("order_size = 'Bulk'").count() == 1


def test_null_profile(raw):
    profile = {
        r.column_name: (r.null_count, r.null_percent)
        for r in c.null_profile(c.standardize(raw({}, {"CustomerID": None}))).collect()
    }
    assert profile["customer_id"] == (1, 50.0)
    assert profile["invoice_no"] == (0, 0.0)


def test_blank_lines_give_an_empty_table(raw):
    lines = raw({"InvoiceNo": "", "Quantity": -1, "InvoiceDate": "invalid", "CustomerID": ""})
    assert enrich(lines).count() == 0
