"""Readers for transaction tables: CSV, Parquet, JSON and JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespect.functions.staging import staged
from salespect.schema import INVOICE_TIME_FORMAT, RAW_SCHEMA, STANDARD_SCHEMA
from salespect.sources.files import CSV_GLOB, list_files, main_file, other_files

CORRUPT = "_corrupt_record"

# CSV dialect.
CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "multiLine": "false",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "nanValue": "NaN",
    "timestampFormat": INVOICE_TIME_FORMAT,
}
# JDBC defaults.
JDBC_DRIVER = "org.postgresql.Driver"
JDBC_FETCH_SIZE = "10000"
JDBC_SPLIT = ("lowerBound", "upperBound", "numPartitions")


def read_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw lines of the given files or folders, with the text of malformed lines kept aside.

    Use split_corrupt to separate those.
    """
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(list(paths))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed lines, and the quarantined rest with its original text.

    A CSV scan parses only the columns a query asks for and judges lines by
    those, so the lines are first stored as parsed in full.
    """
    parsed, bad = staged(df, "parsed_csv"), F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad)


def with_reason(malformed: DataFrame) -> DataFrame:
    """Quarantined lines with the cause, read from their text field by field, and the field it lies in.

    Too few or too many fields come first, then the first field that its type
    cannot hold; NULL fields are in order.
    """
    names = RAW_SCHEMA.names
    as_text = ", ".join(f"{n} string" for n in names)
    read = F.from_csv(F.col(CORRUPT), as_text, {k: CSV_OPTIONS[k] for k in ("quote", "escape") if k in CSV_OPTIONS})
    cells = malformed.withColumn("_cells", read)
    # Commas outside quotes, and one.
    separators = F.size(F.split(F.regexp_replace(F.col(CORRUPT), '"([^"]|"")*"', ""), ","))
    bad = [
        (F.col("_cells")[f.name].isNotNull() & F.col("_cells")[f.name].try_cast(f.dataType).isNull(), f.name)
        for f in RAW_SCHEMA
        if not isinstance(f.dataType, T.StringType)
    ]
    wrong_count = separators != len(names)
    field = F.coalesce(*[F.when(condition, name) for condition, name in bad])
    reason = (
        F.when(wrong_count, F.concat(separators.cast("string"), F.lit(f" fields instead of {len(names)}")))
        .when(field.isNotNull(), F.concat(field, F.lit(" is not a number")))
        .otherwise("unreadable line")
    )
    return cells.withColumns({"reason": reason, "field": F.when(~wrong_count, field)}).drop("_cells")


def quarantine_report(reasoned: DataFrame) -> DataFrame:
    """Lines per reason."""
    return reasoned.groupBy("reason", "field").agg(F.count(F.lit(1)).alias("line_count"))


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Redistribute rows read from files that cannot be split, such as gzip."""
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def _csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """The folder's CSV files; FileNotFoundError if it has none."""
    try:
        found = list_files(spark, folder, CSV_GLOB)
        if not found.isEmpty():
            return found
    except AnalysisException as error:
        raise FileNotFoundError(f"cannot list {folder}") from error
    raise FileNotFoundError(f"no CSV files in {folder}")


def load_csv_folder(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    """Raw lines of all CSV files of the folder, with the text of malformed lines kept aside."""
    found = _csv_files(spark, folder)
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.options(**CSV_OPTIONS, pathGlobFilter=CSV_GLOB).schema(schema).csv(folder)
    gzipped = not found.where(F.col("path").endswith(".gz")).isEmpty()
    return spread(lines, partitions) if gzipped else lines


def load_main_csv(spark: SparkSession, folder: str, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw lines of the folder's main CSV file alone, as load_csv_folder gives them, and the files left out."""
    found = _csv_files(spark, folder)
    chosen = main_file(found).select("path").first().path
    lines = read_csv(spark, chosen)
    return spread(lines, partitions) if chosen.endswith(".gz") else lines, other_files(found, chosen)


def read_parquet(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Merged-schema Parquet. `recursive` picks up nested folders but gives up partition columns."""
    reader = spark.read.option("mergeSchema", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(path)


def read_json(
    spark: SparkSession, path: str, multiline: bool = False, schema: T.StructType | None = None
) -> DataFrame:
    """JSON lines or documents. Passing a schema saves the inference pass."""
    reader = spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).json(path)


def jdbc_options(connection: Mapping[str, str], query: str) -> dict[str, str]:
    """Options of a query scan; naming a partitionColumn makes it a parallel scan.

    A parallel scan needs bounds and a number of parts from the caller: rows
    outside the bounds all fall into the first or last part.
    """
    options = {
        "url": connection["url"],
        "dbtable": f"({query}) as subquery",
        "user": connection["user"],
        "password": connection["password"],
        "driver": connection.get("driver", JDBC_DRIVER),
        "fetchsize": JDBC_FETCH_SIZE,
    }
    if connection.get("partitionColumn"):
        options["partitionColumn"] = connection["partitionColumn"]
        if missing := [k for k in JDBC_SPLIT if not connection.get(k)]:
            raise ValueError("a parallel scan needs " + ", ".join(missing))
        options |= {k: connection[k] for k in JDBC_SPLIT}
    return options


def read_jdbc(spark: SparkSession, connection: Mapping[str, str], query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(connection, query)).load()


def schema_report(df: DataFrame) -> DataFrame:
    """Missing, extra and differently typed columns against the standard schema, one row each."""
    expected = {f.name: f.dataType for f in STANDARD_SCHEMA}
    found = {f.name: f.dataType for f in df.schema}
    rows = [(c, "missing", "failed") for c in expected if c not in found]
    rows += [(c, "extra", "warning") for c in found if c not in expected]
    rows += [
        (c, f"{found[c].simpleString()} instead of {t.simpleString()}", "warning")
        for c, t in expected.items()
        if c in found and found[c] != t
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, finding string, status string")


def schema_is_valid(df: DataFrame) -> bool:
    return set(STANDARD_SCHEMA.names) <= set(df.columns)
