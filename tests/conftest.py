from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from salespect.operators.enrich import enrich  # noqa: E402
from salespect.schema import RAW_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Build raw lines; each row overrides a plain valid line."""
    plain = {
        "InvoiceNo": "1",
        "StockCode": "A",
        "Description": "MUG",
        "Quantity": 2,
        "InvoiceDate": "6/1/2011 10:00",
        "UnitPrice": 3.0,
        "CustomerID": "C1",
        "Country": "France",
    }

    def build(*overrides: dict):
        rows = [tuple({**plain, **o}[n] for n in RAW_SCHEMA.names) for o in overrides]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build


@pytest.fixture(scope="session")
def sample(spark):
    """Enriched lines of a small shop: 40 customers, one of them with most lines."""
    rows = []
    for n in range(1200):
        customer = None if n % 3 else f"C{n % 40}"
        rows.append(
            (
                str(n // 4),
                f"P{n % 17}",
                f"ITEM {n % 17}" if n % 50 else None,
                1 + n % 120,
                f"{1 + n % 12}/{1 + n // 36 % 28}/{2010 + n % 3} {n % 24}:{n % 60:02d}",
                round(0.5 + n % 89, 2),
                customer,
                ("United Kingdom", "EIRE", "France", "Spain")[(n // 4) % 4],
            )
        )
    return enrich(spark.createDataFrame(rows, RAW_SCHEMA)).cache()


@pytest.fixture
def rows_of():
    def collect(frame):
        return sorted((tuple(r) for r in frame.select(sorted(frame.columns)).collect()), key=repr)

    return collect


AS_OF = date(2013, 1, 1)
NOW = datetime(2013, 1, 1, 12)
