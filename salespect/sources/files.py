"""File metadata as a DataFrame, without reading file contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_GLOB = "*.{csv,csv.gz}"

# Name fragments of the main file, best first.
MAIN_FILE_NAMES = ("ecommerce_data", "data.csv", "transactions", "sales")


def list_files(
    spark: SparkSession, path: str, glob: str, recursive: bool = False
) -> DataFrame:
    """path, length and modificationTime of the matching files."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def main_file(files: DataFrame) -> DataFrame:
    """The row of the file to load: by name fragment, else the largest."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    places = [F.when(name.contains(n), i) for i, n in enumerate(MAIN_FILE_NAMES)]
    priority = F.coalesce(*places, F.lit(len(places)))
    return files.orderBy(priority, F.desc("length"), "path").limit(1)


def other_files(files: DataFrame, chosen: str) -> DataFrame:
    """The files that a choice leaves out."""
    return files.where(F.col("path") != chosen)
