"""The extinction table over the sky grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytables.functions.extinction import extinction_columns
from skytables.functions.sky import COARSE
from skytables.operators.grid import cell_centre
from skytables.sources.tables import create_database, write_table


def dust_grid(spark: SparkSession, values: DataFrame, level: int = COARSE) -> DataFrame:
    """(cell, ra, dec, eb_v) for each cell of the sphere that ``values`` (cell, eb_v; one row per cell) covers.

    A cell's centre follows from its id, so this is a projection; ids that are no cell of the level are left out.
    """
    ra, dec, exists = cell_centre("cell", level)
    return values.where(exists).select("cell", ra.alias("ra"), dec.alias("dec"), F.col("eb_v").cast("float").alias("eb_v"))


def sample_polar_map(points: DataFrame, pixels: DataFrame, size: int, key: str = "cell") -> DataFrame:
    """(key, eb_v): a map of two polar Lambert projections sampled at each point (key, ra, dec) by bilinear
    interpolation of ``pixels`` (hemisphere 1/-1, x, y, value; a missing pixel counts 0).

    Coordinates are held inside the map, so points on the rim and at the poles take the nearest pixels. The four
    neighbours of a point are four rows joined to the pixels on their integer coordinates: an equi-join that the planner
    broadcasts when the map is small and shuffles when it is large; nothing pairs points with pixels otherwise.
    """
    from skytables.functions.sky import galactic, polar_pixel

    l, b = galactic("ra", "dec")
    hemisphere, x, y = polar_pixel(l, b, size)
    top = float(size - 1)
    xc, yc = (F.least(F.greatest(c, F.lit(0.0)), F.lit(top)) for c in (x, y))
    placed = points.select(F.col(key).alias("_key"), hemisphere.alias("_h"), xc.alias("_x"), yc.alias("_y"))
    x0, y0 = F.least(F.floor("_x"), F.lit(size - 2)), F.least(F.floor("_y"), F.lit(size - 2))
    placed = placed.select("_key", "_h", x0.alias("_x0"), y0.alias("_y0"), (F.col("_x") - x0).alias("_fx"), (F.col("_y") - y0).alias("_fy"))
    corners = F.array(
        *[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), ((F.col("_fx") if dx else 1 - F.col("_fx")) * (F.col("_fy") if dy else 1 - F.col("_fy"))).alias("w"))
          for dx in (0, 1) for dy in (0, 1)]
    )
    four = placed.select("_key", "_h", "_x0", "_y0", F.explode(corners).alias("_c")).select(
        "_key", "_h", (F.col("_x0") + F.col("_c.dx")).cast("int").alias("_px"), (F.col("_y0") + F.col("_c.dy")).cast("int").alias("_py"), F.col("_c.w").alias("_w")
    )
    values = pixels.select(F.col("hemisphere").alias("_h"), F.col("x").cast("int").alias("_px"), F.col("y").cast("int").alias("_py"), F.col("value").cast("double").alias("_v"))
    joined = four.join(values, ["_h", "_px", "_py"], "left")
    return joined.groupBy(F.col("_key").alias(key)).agg(F.sum(F.col("_w") * F.coalesce("_v", F.lit(0.0))).alias("eb_v"))


def dust_table(
    spark: SparkSession, values: DataFrame, database: str, name: str = "sfd", level: int = COARSE, on_exists: str = "fail"
) -> DataFrame:
    """Store the grid values only; the extinction columns are computed when the result is read."""
    create_database(spark, database)
    stored = write_table(dust_grid(spark, values, level), f"{database}.{name}", on_exists, sort_by=["cell"])
    return extinction_columns(stored)
