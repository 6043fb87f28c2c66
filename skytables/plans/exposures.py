"""Exposure metadata to the exposure tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.functions.time import mid_exposure_helio, to_mjd
from skytables.operators.exposures import clean_exposures, exposures_by_quadrant, exposures_per_field
from skytables.operators.quality import check_nullability
from skytables.schemas import EXPOSURE_BANDS, EXPOSURES
from skytables.sources.tables import create_database, write_table


def exposures(raw: DataFrame, centres: DataFrame, schema: T.StructType = EXPOSURES) -> DataFrame:
    """One row per exposure and quadrant with its start and heliocentric mid time; an unknown band fails the job."""
    cleaned = clean_exposures(raw, schema, include=schema.names, exclude=["ra", "dec"])
    known = F.col("band").isNull() | F.col("band").isin(*EXPOSURE_BANDS)
    unknown = F.raise_error(F.concat(F.lit("unknown band "), F.col("band"))).cast("string")
    cleaned = cleaned.withColumn("band", F.when(known, F.col("band")).otherwise(unknown))
    placed = exposures_by_quadrant(cleaned, centres)
    start = to_mjd("obsdate")
    return placed.withColumn("expstart_mjd", start).withColumn(
        "expmid_hmjd", mid_exposure_helio("expstart_mjd", "exptime", "ra", "dec")
    ).drop("obsdate")


def exposure_tables(
    spark: SparkSession, raw: DataFrame, centres: DataFrame, database: str, on_exists: str = "fail"
) -> dict[str, str]:
    """Check the declared columns, then store exposures per quadrant and per exposure; returns the table names."""
    failed = check_nullability(raw, EXPOSURES).where(~F.col("ok")).collect()  # at most one row per declared column
    if failed:
        raise ValueError(f"nulls in columns declared NOT NULL: {failed}")
    create_database(spark, database)
    names = {"exposures": f"{database}.exposures", "exposures_field": f"{database}.exposures_field"}
    stored = write_table(exposures(raw, centres), names["exposures"], on_exists, sort_by=["expid"])
    write_table(exposures_per_field(stored), names["exposures_field"], on_exists, sort_by=["expid"])
    return names
