"""The sky grid and lookups in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytables.functions.extinction import extinction_columns
from skytables.functions.sky import COARSE, ZONE_STRIDE, bins_in_zone, sky_cell, zone_count


def cell_centre(cell, level: int = COARSE) -> tuple[Column, Column, Column]:
    """Right ascension and declination of a cell's centre, and whether the level has such a cell."""
    cell = F.col(cell) if isinstance(cell, str) else cell
    zone, place = F.floor(cell / F.lit(ZONE_STRIDE)), F.pmod(cell, F.lit(ZONE_STRIDE))
    bins = bins_in_zone(zone, level)
    exists = (zone >= 0) & (zone < zone_count(level)) & (place < bins)
    return (place + 0.5) * 360.0 / bins, (zone + 0.5) / level - 90.0, exists


def sky_grid(spark: SparkSession, level: int = COARSE) -> DataFrame:
    """Every cell of the sphere once, with its centre: (cell, ra, dec). Zones are spread over the cluster."""
    zones = spark.range(zone_count(level)).withColumnRenamed("id", "zone")
    bins = zones.withColumn("bins", bins_in_zone("zone", level))
    cells = bins.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    ra, dec, _ = cell_centre("cell", level)
    return cells.select((F.col("zone") * ZONE_STRIDE + F.col("bin")).alias("cell")).select("cell", ra.alias("ra"), dec.alias("dec"))


def deredden(
    catalogue: DataFrame, dust: DataFrame, level: int = COARSE, systems: list[str] | None = None
) -> DataFrame:
    """Catalogue rows with E(B-V) of their coarse cell and the extinction columns; unmapped cells give NULL.

    The dust side has one row per cell, so a crowded cell only makes the catalogue side skewed, which the adaptive
    join splits.
    """
    coarse = catalogue.withColumn("dust_cell", sky_cell("ra", "dec", level))
    values = dust.select(F.col("cell").alias("dust_cell"), "eb_v")
    joined = coarse.join(values, "dust_cell", "left")
    return extinction_columns(joined, systems=systems)
