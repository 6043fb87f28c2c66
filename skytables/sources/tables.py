"""Catalogue tables: creation policy, layout and housekeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRETCH_BITS = 20
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str, missing_ok: bool = False) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if missing_ok else ''}{name}")


def clustered(df: DataFrame, sort_by: list[str], partition_by: list[str] | None = None) -> DataFrame:
    """Rows laid out on the sort keys, so that scans can skip files or row groups by their key ranges.

    Rows are rebalanced on the partition columns or, without them, on stretches of the first sort key: adaptive execution
    cuts what is heavy, equal keys too, into files of the advisory size and joins what is light. The input is computed once;
    ranging the rows instead would compute it a second time for a sample.
    """
    if partition_by:
        return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)
    first = F.col(sort_by[0])
    if isinstance(df.schema[sort_by[0]].dataType, (T.LongType, T.IntegerType)):
        first = F.shiftright(first, _STRETCH_BITS)
    stretched = df.withColumn("_stretch", first)
    return stretched.hint("rebalance", "_stretch").sortWithinPartitions("_stretch", *sort_by).drop("_stretch")


def write_table(
    df: DataFrame,
    name: str,
    on_exists: str = "fail",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    covers: list[dict] | None = None,
) -> DataFrame:
    """Create the Parquet table ``name`` from ``df`` and return it.

    An existing table makes the write fail, is kept and the write skipped, or is dropped first. With ``replace``, the
    partitions that ``df`` has rows of are replaced and all others stay, so a table can be loaded part by part and a part
    can be loaded again; this needs ``partition_by``. ``covers`` names partitions (column to value) the load stands for:
    they are emptied first, so a part whose new load has no rows does not keep its old ones.
    """
    modes = {"fail": "errorifexists", "keep": "ignore", "drop": "overwrite", "replace": "overwrite"}
    if on_exists not in modes:
        raise ValueError(f"on_exists must be one of {', '.join(modes)}, not {on_exists!r}")
    rows = clustered(df, sort_by, partition_by) if sort_by else df
    if on_exists == "replace":
        if not partition_by:
            raise ValueError("replace works on partitions: partition_by is missing")
        if table_exists(df.sparkSession, name):
            for spec in covers or []:
                values = ", ".join(f"{k} = {_literal(v)}" for k, v in spec.items())
                df.sparkSession.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({values})")
            return _replace_partitions(rows, name)
    writer = rows.write.format("parquet").mode(modes[on_exists])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _literal(value) -> str:
    return "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else str(int(value))


def _replace_partitions(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` as table ``name`` in ``buckets`` files by the hash of ``key``, each sorted on it, and return the
    table. Two tables bucketed alike on the join key join without moving either: each task reads one bucket of both."""
    df.write.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)
