"""File listing of an input folder as a DataFrame (no file contents are read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file, in file name order: path, file name, length, modification time. Only
    metadata columns are selected, so the binary reader never loads file contents."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path).select("path", "length", "modificationTime")
    return files.select("path", F.substring_index("path", "/", -1).alias("file_name"), "length",
                        F.col("modificationTime").alias("modified_at")).orderBy("file_name", "path")


def inventory_totals(files: DataFrame) -> DataFrame:
    """File count and total bytes in one row."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
