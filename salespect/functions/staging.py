"""Written intermediate tables in a folder that all executors can reach.

A plan that reads an expensive aggregate several times (quantiles, ranks and
the rows themselves) writes it once and reads the files. That cuts the lineage,
keeps column pruning, and survives the loss of executors.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from threading import Lock
from urllib.parse import urlsplit
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Shuffle files of a staged write go with the write: its table is read from then on, never its plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
# Per session and setting the number of writes at work and the value that the first of them found.
_WRITING: WeakKeyDictionary[SparkSession, dict[str, tuple[int, str | None]]] = WeakKeyDictionary()
_LOCK = Lock()


@contextmanager
def _held(spark: SparkSession, key: str, value: str | None):
    """The setting holds while any thread writes, and the last one restores what the first one found; None holds nothing."""
    if value is None:
        yield
        return
    with _LOCK:
        held = _WRITING.setdefault(spark, {})
        writes, before = held.get(key) or (0, spark.conf.get(key, None))
        spark.conf.set(key, value)
        held[key] = writes + 1, before
    try:
        yield
    finally:
        with _LOCK:
            writes, before = held.pop(key)
            if writes > 1:
                held[key] = writes - 1, before
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def _cleaned_up(spark: SparkSession):
    return _held(spark, CLEANUP, "true")


def _at_most(spark: SparkSession, rows: int | None) -> str | None:
    """Rows of an Arrow batch, unless the session asks for fewer."""
    mine = int(spark.conf.get(BATCH_ROWS, None) or 0)
    return None if rows is None or 0 < mine <= rows else str(rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, else one below the warehouse; the session is left as it is."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and urlsplit(folder).scheme in ("", "file"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return folder.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _staging_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, label: str) -> str:
    """A folder not used before; what lies below it goes with drop_staged or with the application."""
    root = _staging_root(spark)
    files, path = _hadoop(spark, root)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write the rows once and return a scan of what was written.

    With batch_rows, Python tasks of this write get Arrow batches of at most so
    many rows: of wide rows, Spark's 10,000 are buffers of up to 100 MB a task.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    with _cleaned_up(spark), _held(spark, BATCH_ROWS, _at_most(spark, batch_rows)):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete what was staged for these frames, once all that is made of them is itself written; others are left."""
    for frame in frames:
        if path := _FOLDERS.pop(frame, None):
            files, folder = _hadoop(frame.sparkSession, path)
            files.delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application has staged; frames that read it stop working."""
    files, path = _hadoop(spark, _staging_root(spark))
    files.delete(path, True)
