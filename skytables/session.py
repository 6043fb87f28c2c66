"""Session settings the jobs expect, and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE sizes the reduce side and splits skewed join partitions; the rest are Spark's defaults.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "skytables", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A new folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="skytables-")
    return f"{base.rstrip('/')}/skytables-{uuid.uuid4().hex}"


def materialise(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back, for tables several later steps read.

    ``compression`` is Parquet's, Spark's default if not given: ``zstd`` for texts and other wide rows.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
