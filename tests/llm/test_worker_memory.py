"""Tasks of the corpus operators give Arrow's memory back and hold few texts at once; leaks need no Python rows."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salespect.functions.staging import BATCH_ROWS, staged
from salespect.llm import batches, decontaminate, jaccard_join, packing, quality, toxicity


@pytest.mark.parametrize(
    "task",
    [quality._patterns, quality._featured, quality._scored, quality._kept, toxicity._words, toxicity._hits, toxicity._scored, toxicity._kept]
    + [jaccard_join._signatures, jaccard_join._prefixes, jaccard_join._keyed_sets, jaccard_join._measured, decontaminate._leaks, packing._pieces, packing._placed],
    ids=lambda task: f"{task.__module__}.{task.__name__}",
)
def test_tasks_over_batches_are_tidy(task):
    assert hasattr(task, "__wrapped__") and task.__code__ is batches.tidy(task).__code__


def test_tidy_gives_memory_back_after_each_result_and_at_the_end(monkeypatch):
    seen = []
    monkeypatch.setattr(batches.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: seen.append("released")))
    for out in batches.tidy(lambda rows, step: iter(range(0, rows, step)))(4, step=2):
        seen.append(out)
    assert seen == [0, "released", 2, "released", "released"]
    seen.clear()
    assert list(batches.tidy(iter)([])) == [] and seen == ["released"]


def test_words_of_labelled_texts_leave_a_task_in_runs():
    count = 2 * batches.ROWS + 7
    digests = [str(n).encode() for n in range(count)]
    rows = pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([f"one two{n} one" for n in range(count)]), pa.array([n % 2 for n in range(count)], pa.int32())], ["digest", "text", "label"])
    found = list(toxicity._words([rows, rows.slice(3, 2)]))
    assert [r.num_rows for r in found] == [batches.ROWS, batches.ROWS, 7, 2]
    table = pa.Table.from_batches(found).to_pylist()
    assert [(r["digest"], r["label"]) for r in table] == [(digests[n], n % 2) for n in [*range(count), 3, 4]]
    assert all(r["words"] == ["one", "two"] and r["times"] == [2, 1] for r in table)


def test_leaks_read_no_rows_made_in_python(spark):
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text"))
    items = spark.range(2).select(F.col("id").alias("item_id"), F.lit("a b c d e f").alias("text"))
    for benchmark, leaks in ((items, 6), (items.limit(0), 0), (items.withColumn("text", F.lit(None).cast("string")), 0)):
        found = decontaminate.benchmark_leaks(docs, benchmark)
        assert "ExistingRDD" not in found._jdf.queryExecution().toString()
        assert found.dtypes == [("doc_id", "bigint"), ("item_id", "bigint"), ("marked", "bigint"), ("item_words", "bigint"), ("row_key", "string")]
        assert found.count() == leaks


def test_staged_writes_take_small_batches_and_leave_the_session(spark):
    rows = spark.range(0, 5000, 1, 1)

    def sizes(found):
        for batch in found:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    def largest(batch_rows):
        return staged(rows.mapInArrow(sizes, "n long"), "sizes", batch_rows).agg(F.max("n"), F.sum("n")).first()

    assert spark.conf.get(BATCH_ROWS, None) is None
    assert tuple(largest(1000)) == (1000, 5000) and tuple(largest(None)) == (5000, 5000)
    assert spark.conf.get(BATCH_ROWS, None) is None
    spark.conf.set(BATCH_ROWS, "300")
    try:
        assert tuple(largest(1000)) == (300, 5000) and spark.conf.get(BATCH_ROWS) == "300"
    finally:
        spark.conf.unset(BATCH_ROWS)
