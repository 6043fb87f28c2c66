"""Incremental loading: new files are appended once, however often the job runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
    **options: str,
) -> None:
    """Append the files of ``source`` that no earlier run has taken to the Parquet folder ``target``, then stop.

    The checkpoint holds which files are done and the sink log which writes are, so a rerun, also after a failure,
    loads nothing twice. ``max_files`` cuts a large backlog into several batches.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(source)
    if transform:
        rows = transform(rows)
    query = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
