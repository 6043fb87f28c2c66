"""Whole-file reading for formats Spark has no reader for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, content) of the matching files below ``path``, to be decoded one file at a time.

    ``binaryFile`` takes files up to 2 GB. Small files share a task by size, as for any Spark scan.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "content")
    )


def first_file(spark: SparkSession, path: str, glob: str) -> str:
    """The first matching file by name, without reading any."""
    found = binary_files(spark, path, glob).agg(F.min("path").alias("path")).first()["path"]
    if found is None:
        raise FileNotFoundError(f"no files {glob} in {path}")
    return found
