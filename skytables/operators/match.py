"""Matching on the sky: cell equi-join, then the exact distance.

A hot cell is split by the adaptive skew join, which can cut either side since no aggregate sits on the join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytables.functions.sky import FINE, angular_distance, match_level, sky_cell, with_neighbour_cells
from skytables.operators.lightcurve import good_objects

_ARCSEC = 3600.0


def _usable(objects: DataFrame) -> DataFrame:
    return good_objects(objects) if "ngoodobs" in objects.columns else objects


def _match_cell(objects: DataFrame, level: int) -> Column:
    stored = level == FINE and "cell" in objects.columns
    return F.col("cell") if stored else sky_cell("ra", "dec", level)


def _pairs(left: DataFrame, right: DataFrame, radius_deg: float, level: int) -> DataFrame:
    """Join ``left`` (ra1, dec1, match_cell, ...) with ``right`` (ra, dec, ...) closer than the radius."""
    ring = with_neighbour_cells(right, radius_deg, level, out="match_cell")
    near = F.abs(F.col("dec") - F.col("dec1")) <= radius_deg + 1e-9  # cheap test before the trigonometry
    return (
        left.join(ring, "match_cell")
        .where(near)
        .withColumn("distance_deg", angular_distance("ra1", "dec1", "ra", "dec"))
        .where(F.col("distance_deg") < radius_deg)
        .drop("match_cell")
    )


def _left_side(objects: DataFrame, level: int, *keep: Column) -> DataFrame:
    return _usable(objects).select(
        F.col("oid").alias("oid1"),
        F.col("ra").alias("ra1"),
        F.col("dec").alias("dec1"),
        _match_cell(objects, level).alias("match_cell"),
        *keep,
    )


def circle_match(
    left: DataFrame, right: DataFrame | None = None, radius_arcsec: float = 0.2, level: int | None = None
) -> DataFrame:
    """Every pair of objects closer than the radius; of one table with itself when ``right`` is left out.

    An object's pair with itself is kept. ``ra`` and ``dec`` are those of ``oid2``, ``cell`` that of ``oid1``. The pair
    list is the result, so its size is the number of true neighbours; to go on to the cross match without building
    it, use :func:`nearest_matches`.
    """
    radius = radius_arcsec / _ARCSEC
    level = level or match_level(radius)
    cell = F.col("cell") if "cell" in left.columns else sky_cell("ra", "dec")
    ring = _usable(left if right is None else right).select(
        F.col("oid").alias("oid2"), F.col("band").alias("band2"), F.col("fieldid").alias("fieldid2"), "ra", "dec"
    )
    pairs = _pairs(_left_side(left, level, cell.alias("cell")), ring, radius, level)
    return pairs.select("cell", "oid1", "oid2", "band2", "fieldid2", "ra", "dec", "distance_deg")


def nearest_per_group(circle: DataFrame) -> DataFrame:
    """The closest neighbour of each object in each (band, field); the smaller id wins a tie."""
    return (
        circle.groupBy("oid1", "band2", "fieldid2")
        .agg(F.min(F.struct("distance_deg", "oid2", "ra", "dec")).alias("best"))
        .select("oid1", F.col("best.oid2").alias("oid2"), F.col("best.ra").alias("ra2"), F.col("best.dec").alias("dec2"))
    )


def nearest_matches(
    left: DataFrame, right: DataFrame | None = None, radius_arcsec: float = 0.2, level: int | None = None
) -> DataFrame:
    """``nearest_per_group(circle_match(...))`` without building the pairs.

    Objects of one band and field at one position tie at every distance, so only the smallest id among them can be
    chosen: they are folded to it, map-side first, before the join. A pile of copies thus joins as one row.
    """
    radius = radius_arcsec / _ARCSEC
    level = level or match_level(radius)
    ring = (
        _usable(left if right is None else right)
        .groupBy("ra", "dec", F.col("band").alias("band2"), F.col("fieldid").alias("fieldid2"))
        .agg(F.min("oid").alias("oid2"))
    )
    return nearest_per_group(_pairs(_left_side(left, level), ring, radius, level))


def cross_match(
    a: DataFrame, b: DataFrame, radius_arcsec: float = 0.2, nearest: bool = True, level: int | None = None
) -> DataFrame:
    """Match two catalogues with columns oid, ra, dec: (oid1, oid2, ra2, dec2, distance_deg).

    With ``nearest`` each object of ``a`` gets its closest object of ``b``; the smaller id wins a tie.
    """
    radius = radius_arcsec / _ARCSEC
    level = level or match_level(radius)
    ring = _usable(b).select("oid", "ra", "dec")
    if nearest:
        ring = ring.groupBy("ra", "dec").agg(F.min("oid").alias("oid2"))
    else:
        ring = ring.withColumnRenamed("oid", "oid2")
    pairs = _pairs(_left_side(a, level), ring, radius, level).select(
        "oid1", "oid2", F.col("ra").alias("ra2"), F.col("dec").alias("dec2"), "distance_deg"
    )
    if not nearest:
        return pairs
    return (
        pairs.groupBy("oid1")
        .agg(F.min(F.struct("distance_deg", "oid2", "ra2", "dec2")).alias("best"))
        .select("oid1", "best.oid2", "best.ra2", "best.dec2", "best.distance_deg")
    )
