"""Properties of physical plans that decide whether the jobs scale."""

import re

import pytest

from salespect.config import Settings
from salespect.functions import order_stats
from salespect.functions.staging import staged
from salespect.operators import clean, countries, customers, daily, enrich, hourly, products
from salespect.operators import quality as q
from salespect.operators.sequence import with_customer_sequence

CFG = Settings()


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(sample):
    return staged(sample, "lines")


def builders(lines):
    return {
        "customer_base": customers.customer_base(lines, CFG),
        "customer_metrics": customers.customer_metrics(lines, CFG),
        "product_metrics": products.product_metrics(lines, CFG),
        "daily": daily.daily_metrics(lines, CFG),
        "countries": countries.country_metrics(lines, CFG),
        "hourly": hourly.hourly_patterns(lines, CFG),
        "sequence": with_customer_sequence(lines),
        "popularity": products.with_product_popularity(lines),
        **{f"checks {part.checks[-1]}": part.build() for part in q.check_parts(lines, CFG)},
    }


def test_no_python_workers_and_no_cross_joins(lines):
    for name, frame in builders(lines).items():
        text = plan(frame)
        assert not re.search(r"Python|ArrowEval|CartesianProduct|NestedLoop", text), name


def test_metrics_read_only_their_columns(lines):
    text = plan(countries.top_products_by_country(lines))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "country",
        "product_id",
        "total_price",
    ]


def test_year_filters_reach_the_scan(lines):
    text = plan(lines.filter("year = 2011").transform(countries.top_products_by_country))
    assert "PushedFilters: [IsNotNull(year), EqualTo(year,2011)]" in text


def test_dedup_trims_before_the_shuffle(raw):
    text = plan(clean.dedup(clean.standardize(raw({}))))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_key_conditions_run_before_the_dedup_shuffle(raw):
    text = plan(enrich.enrich(raw({})))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "try_to_timestamp" in below
    assert text.count("Exchange hashpartitioning") == 1


def test_top_products_trim_before_the_ranking_shuffle(lines):
    assert "Partial" in plan(countries.top_products_by_country(lines)).split("WindowGroupLimit", 1)[1]


def test_global_ranks_never_order_everything_in_one_task(lines, monkeypatch):
    """Single-partition steps may only see one row per range, never the values."""
    frames = []
    monkeypatch.setattr(order_stats, "staged", lambda frame, label: frames.append(frame) or staged(frame, label))
    order_stats.ranked_values(lines, ["total_price"])
    ranked = frames[-1]
    assert "SinglePartition" not in plan(ranked)
    partitioned = re.findall(r"windowspecdefinition\((column_name#\d+, range#\d+)", plan(ranked))
    assert partitioned


def test_sequence_numbers_lines_within_minutes(lines):
    text = plan(with_customer_sequence(lines))
    numbering = re.search(r"row_number\(\) windowspecdefinition\(([^)]*?) ASC", text).group(1)
    assert "customer_id" in numbering and "_minute" in numbering


def test_line_measurements_take_one_scan(lines):
    assert plan(q.line_stats(lines, CFG)).count("FileScan") == 1


def test_duplicate_check_shuffles_keys_only(lines):
    text = plan(q.duplicate_stats(lines))
    key_scan = text[text.rindex("FileScan") :]
    schema = re.search(r"ReadSchema: struct<([^>]*)>", key_scan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "invoice_datetime",
        "invoice_no",
        "product_id",
    ]



def test_countries_clean_the_lines_once(raw, monkeypatch):
    """Totals, shares and best products read the staged levels; only those see the deduplication."""
    frames = []
    monkeypatch.setattr(countries, "staged", lambda frame, label: frames.append(frame) or staged(frame, label))
    table = countries.country_metrics(enrich.enrich(raw({}, {"InvoiceNo": "2"})))
    copies = r"Window \[row_number\(\) windowspecdefinition\(invoice_no"
    assert [len(re.findall(copies, plan(frame))) for frame in frames] == [1]
    assert not re.search(copies, plan(table)) and "Expand" not in plan(frames[0])
    assert table.first().total_orders == 2


def test_the_enriched_write_exchanges_base_columns_only(raw):
    """Behind the deduplication: eight columns and a month number cross, the other two dozen are derived after."""
    text = plan(enrich.enrich_by_month(raw({})))
    head = text[: text.index("Exchange hashpartitioning(_month")]
    carried = re.search(r"Exchange hashpartitioning\(_month.*\n\s*\+- .*?Project \[(.*)\]", text).group(1)
    assert carried.count("#") - carried.count(" AS ") <= 12 and "is_high_value" in head
    assert not re.search(r"is_\w+#|order_size#|year#", carried)
    assert enrich.enrich_by_month(raw({})).columns == enrich.enrich(raw({})).columns
