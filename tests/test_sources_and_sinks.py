import gzip
import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.staging import CLEANUP, drop_staged, release, shared_folder, staged
from salespect.operators import gates
from salespect.operators.quality import run_all_checks, summarize_checks
from salespect.plans import run_log, sinks, sizing
from salespect.plans.batch import METRIC_TABLES, QualityError, run_batch
from salespect.schema import RAW_SCHEMA, STANDARD_SCHEMA
from salespect.sources import files, readers

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
GOOD = '1,A,"MUG, ""BLUE""",2,6/1/2011 10:00,3.5,C1,France\n'
NOW = datetime(2013, 1, 8, 12)


# --- files -------------------------------------------------------------------


def listing(spark, *entries):
    rows = [(f"file:/in/{name}", size, NOW) for name, size in entries]
    return spark.createDataFrame(rows, "path string, length long, modificationTime timestamp")


@pytest.mark.parametrize(
    ("names", "chosen"),
    [
        ([("sales.csv", 9), ("data.csv", 1), ("ecommerce_data.csv", 1)], "ecommerce_data.csv"),
        ([("sales.csv", 9), ("my_data.csv", 1)], "my_data.csv"),
        ([("SALES_2011.csv", 1), ("transactions.csv.gz", 1)], "transactions.csv.gz"),
        ([("a.csv", 1), ("b.csv", 5)], "b.csv"),
    ],
)
def test_main_file(spark, names, chosen):
    assert files.main_file(listing(spark, *names)).first().path == f"file:/in/{chosen}"


def test_list_files(spark, tmp_path):
    for name in ("a.csv", "b.csv.gz", "c.txt"):
        (tmp_path / name).write_bytes(b"x" * 10)
    found = files.list_files(spark, str(tmp_path), files.CSV_GLOB)
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in found.collect()) == [
        ("a.csv", 10),
        ("b.csv.gz", 10),
    ]


# --- readers -----------------------------------------------------------------


def test_csv_dialect(spark, tmp_path):
    (tmp_path / "data.csv").write_text(HEADER + GOOD + "2,B,,x,6/2/2011 9:00,1.0,,France\n")
    first, second = readers.load_csv_folder(spark, str(tmp_path)).orderBy("InvoiceNo").collect()
    assert first.Description == 'MUG, "BLUE"' and first.UnitPrice == 3.5
    assert (second.Description, second.Quantity, second.CustomerID) == (None, None, None)


def test_malformed_lines_are_quarantined(spark, tmp_path):
    bad = "2,B,MUG,many,6/2/2011 9:00,1.0,C1,France"
    (tmp_path / "data.csv").write_text(HEADER + GOOD + bad + "\n")
    good, quarantine = readers.split_corrupt(readers.read_csv(spark, str(tmp_path)))
    assert good.dtypes == [(f.name, f.dataType.simpleString()) for f in RAW_SCHEMA]
    assert good.count() == 1 and quarantine.count() == 1
    assert [r[readers.CORRUPT] for r in quarantine.collect()] == [bad]


def test_gzip_csv(spark, tmp_path):
    with gzip.open(tmp_path / "sales.csv.gz", "wt") as out:
        out.write(HEADER + GOOD * 50)
    lines = readers.load_csv_folder(spark, str(tmp_path), partitions=3)
    assert lines.count() == 50 and lines.rdd.getNumPartitions() == 3


@pytest.mark.parametrize("load", [readers.load_csv_folder, readers.load_main_csv])
def test_missing_input(spark, tmp_path, load):
    with pytest.raises(FileNotFoundError):
        load(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        load(spark, str(tmp_path / "empty"))


def test_every_file_of_a_folder_is_read(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"part-{n}.csv").write_text(HEADER + GOOD * n)
    (tmp_path / "notes.txt").write_text("no table\n")
    assert readers.load_csv_folder(spark, str(tmp_path)).count() == 3
    main, left_out = readers.load_main_csv(spark, str(tmp_path))
    assert main.count() == 2 and [r.path.rsplit("/", 1)[1] for r in left_out.collect()] == ["part-1.csv"]


def test_parquet_schemas_are_merged(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "k=1"))
    spark.range(2).withColumn("extra", F.lit("x")).write.parquet(str(tmp_path / "k=2"))
    assert set(readers.read_parquet(spark, str(tmp_path)).columns) == {"id", "extra", "k"}
    nested = readers.read_parquet(spark, str(tmp_path), recursive=True)
    assert set(nested.columns) == {"id", "extra"} and nested.count() == 4


def test_json_lines_and_documents(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "doc.json").write_text('[\n{"a": 1},\n{"a": 2}\n]')
    assert readers.read_json(spark, str(tmp_path / "lines.json")).count() == 2
    assert readers.read_json(spark, str(tmp_path / "doc.json"), multiline=True).count() == 2


def test_jdbc_options():
    login = {"url": "jdbc:x", "user": "u", "password": "p"}
    plain = readers.jdbc_options(login, "SELECT 1")
    assert plain["dbtable"] == "(SELECT 1) as subquery" and plain["fetchsize"] == "10000"
    assert plain["driver"] == "org.postgresql.Driver" and "numPartitions" not in plain
    parts = {"partitionColumn": "id", "lowerBound": "7", "upperBound": "900", "numPartitions": "4"}
    assert parts.items() <= readers.jdbc_options({**login, **parts}, "SELECT 1").items()
    with pytest.raises(ValueError, match="lowerBound, upperBound"):
        readers.jdbc_options({**login, "partitionColumn": "id", "numPartitions": "4"}, "SELECT 1")


def test_schema_report(spark):
    frame = spark.createDataFrame([], STANDARD_SCHEMA)
    assert readers.schema_is_valid(frame) and readers.schema_report(frame).count() == 0
    odd = frame.withColumn("extra", F.lit(1)).withColumn("quantity", F.lit(1.0)).drop("product_id")
    assert not readers.schema_is_valid(odd)
    found = {r.column_name: r.status for r in readers.schema_report(odd).collect()}
    assert found == {"product_id": "failed", "extra": "warning", "quantity": "warning"}


# --- sinks -------------------------------------------------------------------


@pytest.mark.parametrize("rows", [10, 100_001])
def test_layout_and_types_do_not_depend_on_size(spark, tmp_path, rows):
    table = spark.range(rows).select("id", F.lit("044").alias("country"), (F.col("id") % 7).alias("n"))
    written = sinks.write_table(table, str(tmp_path / "t"), sinks.partition_columns("customer_metrics"))
    assert [f.name for f in (tmp_path / "t").iterdir() if f.is_dir()] == ["country=044"]
    back = sinks.read_table(spark, written.path, table)
    assert back.dtypes == table.dtypes and back.count() == rows
    assert back.select("country").distinct().collect() == [("044",)]


def test_partitioned_write_is_pruned_and_bounded(spark, sample, tmp_path):
    cfg = Settings(max_records_per_file=20)
    written = sinks.write_table(sample, str(tmp_path / "t"), ("year", "month"), cfg=cfg)
    assert written.rows == sample.count()
    back = spark.read.parquet(written.path)
    assert back.count() == written.rows
    sizes = back.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count")).first()[0]
    assert sizes <= 20
    year = back.filter("year = 2011")
    assert "PartitionFilters: [isnotnull(year" in year._jdf.queryExecution().toString()
    assert year.count() == sample.filter("year = 2011").count()


def test_small_write_is_one_file(spark, sample, tmp_path):
    sinks.write_table(sample, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_failed_overwrite_surfaces(spark, sample, tmp_path):
    broken = sample.select(F.raise_error(F.lit("broken")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_table(broken, str(tmp_path / "t"))


def test_quality_report(spark, sample, tmp_path):
    checks = run_all_checks(sample.limit(10))
    text = sinks.write_quality_report(checks, summarize_checks(checks), str(tmp_path / "r"), NOW)
    assert "Quality score" in text and "- row_count: 10 rows" in text
    stored = spark.read.text(f"{tmp_path}/r/text").collect()
    assert [r.value for r in stored] == text.splitlines()
    assert spark.read.json(f"{tmp_path}/r/json").count() == checks.count()


def test_staging_uses_the_shared_folder(spark, sample):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    copy = staged(sample, "lines")
    assert copy.dtypes == sample.dtypes and copy.count() == sample.count()
    assert all(shared_folder(spark) in f for f in copy.inputFiles())
    drop_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(copy.inputFiles()[0]).count()


def test_shuffle_sizing_and_storage():
    assert sizing.shuffle_partitions(1000) == 1
    assert sizing.shuffle_partitions(10**12) == 745_059
    assert sizing.storage_level("DISK_ONLY") == StorageLevel.DISK_ONLY
    assert sizing.storage_level("anything") == StorageLevel.MEMORY_AND_DISK


def test_cache_is_released(sample):
    frame = sample.select("invoice_no")
    with sizing.cached(frame) as kept:
        assert kept.is_cached and kept.count() == 1200
    assert not frame.is_cached


# --- run log and gates -------------------------------------------------------


def test_run_history(spark, tmp_path):
    """Twenty runs, one every eight hours, against the same figures in Python."""
    log, runs = str(tmp_path / "log"), []
    for n in range(20):
        done = n % 3 != 1
        record = {"status": "completed" if done else "failed", "total_duration_seconds": 3.0 + n * n % 17, "rows_read": 100 * n, "stage_seconds": {"report": 1.0, "transformation": float(n % 4)}}
        record |= {"rows_processed": 90 * n, "rows_written": {"daily_metrics": n}} if done else {"failed_stage": "report", "error": "lost"}
        run_log.append_run(spark, log, record, NOW - timedelta(hours=8 * n + 1))
        if 8 * n + 1 < 4 * 24:
            runs.append(record)
    row = run_log.run_history(run_log.read_runs(spark, log), 4, F.lit(NOW)).first()
    good = [r["total_duration_seconds"] for r in runs if r["status"] == "completed"]
    assert (row.total_runs, row.successful_runs, row.failed_runs) == (len(runs), len(good), len(runs) - len(good))
    assert (row.avg_duration, row.min_duration, row.max_duration) == (pytest.approx(sum(good) / len(good)), min(good), max(good))
    assert (row.rows_read, row.rows_processed) == (sum(r["rows_read"] for r in runs), sum(r.get("rows_processed", 0) for r in runs))
    assert (row.slowest_stage, row.failing_stage) == ("transformation", "report")
    assert row.last_execution_date == (NOW - timedelta(hours=1)).date()


def test_older_records_of_the_log_still_read(spark, tmp_path):
    (tmp_path / "old.json").write_text('{"run_time": "2013-01-07T10:00:00", "status": "completed", "total_duration_seconds": 4.0}\n')
    run_log.append_run(spark, str(tmp_path), {"status": "completed", "rows_written": {"a": 3}, "quality_passed": True}, NOW)
    old, new = run_log.read_runs(spark, str(tmp_path)).orderBy("run_time").collect()
    assert (old.status, old.rows_written, old.execution_date) == ("completed", None, None)
    assert new.rows_written == {"a": 3} and new.quality_passed and new.execution_date == NOW.date()
    assert run_log.run_history(run_log.read_runs(spark, str(tmp_path)), 7, F.lit(NOW)).first().total_runs == 2


def test_reasons_of_malformed_lines(spark, tmp_path):
    bad = {
        "2,B,MUG,many,6/2/2011 9:00,1.0,C1,France": ("Quantity is not a number", "Quantity"),
        '3,B,"MUG, ""BLUE""",2,6/2/2011 9:00,free,C1,France': ("UnitPrice is not a number", "UnitPrice"),
        "4,B,MUG,2,6/2/2011 9:00,1.0": ("6 fields instead of 8", None),
        "5,B,MUG,2,6/2/2011 9:00,1.0,C1,France,more": ("9 fields instead of 8", None),
        "6,B,MUG,few,6/2/2011 9:00,free,C1,France": ("Quantity is not a number", "Quantity"),
    }
    (tmp_path / "data.csv").write_text(HEADER + GOOD + "\n".join(bad) + "\n")
    good, quarantine = readers.split_corrupt(readers.read_csv(spark, str(tmp_path)))
    reasoned = readers.with_reason(quarantine)
    assert {r[readers.CORRUPT]: (r.reason, r.field) for r in reasoned.collect()} == bad
    counts = {r.reason: r.line_count for r in readers.quarantine_report(reasoned).collect()}
    assert counts["Quantity is not a number"] == 2 and sum(counts.values()) == len(bad) and good.count() == 1


def test_source_size_gate(spark):
    found = gates.source_size_gate(listing(spark, ("a.csv", 200_000), ("b.csv", 10)))
    assert {r.length: r.status for r in found.collect()} == {200_000: "passed", 10: "failed"}


def test_output_presence_and_freshness(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "daily_metrics"))
    found = gates.output_presence(spark, str(tmp_path), ["daily_metrics", "country_metrics"])
    assert {r.table: r.status for r in found.collect()} == {
        "daily_metrics": "passed",
        "country_metrics": "failed",
    }
    path = str(tmp_path / "daily_metrics")
    assert gates.file_freshness(spark, path).first().status == "passed"
    later = F.current_timestamp() + F.expr("INTERVAL 25 HOURS")
    assert gates.file_freshness(spark, path, later).first().status == "failed"


def test_volume_gate(spark):
    sizes = spark.createDataFrame([(100, 10), (99, 10), (100, 9)], "total_customers int, total_products int")
    assert [r.status for r in gates.volume_gate(sizes).collect()] == ["passed", "failed", "failed"]


# --- the whole batch ---------------------------------------------------------


def write_csv(path, count):
    with open(path / "data.csv", "w") as out:
        out.write(HEADER)
        for n in range(count):
            customer = "" if n % 4 == 0 else f"C{n % 120}"
            out.write(
                f"{n // 3},P{n % 20},ITEM {n % 20},{1 + n % 9},{1 + n % 12}/{1 + n // 12 % 28}/2011 "
                f"{8 + n % 12}:{n % 60:02d},{1 + n % 30}.5,{customer},{('UK', 'France')[n // 3 % 2]}\n"
            )


def test_batch_end_to_end(spark, tmp_path):
    write_csv(tmp_path, 1500)
    bad = "9,B,MUG,many,6/2/2011 9:00,1.0,C1,France"
    (tmp_path / "more.csv").write_text(HEADER + bad + "\n")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    record = run_batch(readers.load_csv_folder(spark, str(tmp_path)), out, run_log=log)
    assert record["rows_quarantined"] == 1
    assert [(r[readers.CORRUPT], r.field) for r in spark.read.parquet(f"{out}/quarantine").collect()] == [(bad, "Quantity")]
    assert [r.line_count for r in spark.read.json(f"{out}/quarantine_report").collect()] == [1]
    assert record["status"] == "completed" and record["rows_processed"] == 1500
    assert (record["rows_read"], record["retained_percent"]) == (1500, 100.0)
    assert record["quality_passed"] is True
    presence = gates.output_presence(spark, out, ["enriched_data", *METRIC_TABLES])
    assert {r.status for r in presence.collect()} == {"passed"}
    for name in METRIC_TABLES:
        assert spark.read.parquet(f"{out}/{name}").count() == record["rows_written"][name]
    summary = spark.read.json(f"{out}/summary_report").first()
    assert summary.total_customers == record["rows_written"]["customer_metrics"]
    assert summary.total_days == record["rows_written"]["daily_metrics"]
    assert summary.quality_score == record["quality_score"] and summary.failed_checks == []
    assert spark.read.json(f"{out}/run_result").first().status == "completed"
    (run,) = run_log.read_runs(spark, log).collect()
    assert (run.status, run.rows_processed, run.rows_quarantined) == ("completed", 1500, 1)
    assert run.rows_written == record["rows_written"] and run.stage_seconds == record["stage_seconds"]
    assert summary.execution_date == str(run.execution_date) and summary.pipeline_duration_seconds > 0
    json.dumps(record)


def test_batch_with_bad_data_reports_and_can_stop(spark, tmp_path):
    write_csv(tmp_path, 30)
    raw = readers.load_csv_folder(spark, str(tmp_path))
    record = run_batch(raw, str(tmp_path / "out"))
    assert record["status"] == "completed" and record["quality_passed"] is False
    with pytest.raises(QualityError):
        run_batch(raw, str(tmp_path / "stop"), run_log=str(tmp_path / "log"), stop_on_errors=True)
    (run,) = run_log.read_runs(spark, str(tmp_path / "log")).collect()
    assert (run.status, run.failed_stage) == ("failed", "quality_and_metrics")


def test_batch_without_valid_lines(spark, raw, tmp_path):
    record = run_batch(raw({"Quantity": -1}), str(tmp_path / "out"))
    assert record["status"] == "completed" and record["rows_processed"] == 0


def test_staged_tables_are_released_and_leave_the_session_as_it_was(spark):
    before = spark.conf.get(CLEANUP, None)
    first = staged(spark.range(20).groupBy((F.col("id") % 4).alias("k")).count(), "first")
    second = staged(first.join(first.withColumnRenamed("count", "again"), "k"), "second")
    folder = first.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("///", "/")
    assert Path(folder).exists()
    release(first, spark.range(1))  # a frame that was not staged is left alone
    assert not Path(folder).exists()
    assert sorted(map(tuple, second.collect())) == [(k, 5, 5) for k in range(4)]
    assert spark.conf.get(CLEANUP, None) == before
