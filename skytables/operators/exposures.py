"""Exposure tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DROPPED = {"ra", "dec", "expmid_hmjd"}


def clean_exposures(
    df: DataFrame, schema: T.StructType, include: list[str] | None = None, exclude: list[str] | None = None
) -> DataFrame:
    """Chosen columns in their declared types; an empty text becomes NULL in nullable columns that are not text."""
    names = [c for c in (include or df.columns) if c not in set(exclude or ())]
    unknown = [c for c in names if c not in df.columns or c not in schema.names]
    if unknown:
        raise ValueError(f"columns not found: {unknown}")
    out = []
    for name in names:
        field = schema[name]
        value = F.col(name)
        if not isinstance(field.dataType, T.StringType):
            if field.nullable and isinstance(df.schema[name].dataType, T.StringType):
                value = F.nullif(value, F.lit(""))
            value = value.cast(field.dataType)
        out.append(value.alias(name))
    return df.select(*out)


def exposures_by_quadrant(exposures: DataFrame, centres: DataFrame) -> DataFrame:
    """One row per exposure and quadrant of its field, placed at the quadrant centre.

    No broadcast hint: the planner broadcasts the centres by their measured size, and otherwise shuffles and splits
    fields that hold many exposures.
    """
    placed = exposures.drop("ra", "dec", "rcid")
    quadrants = centres.select(F.col("fieldid").alias("field"), "rcid", "ra", "dec")
    return placed.join(quadrants, "field")


def quadrant_centres(fields: DataFrame, offsets: list[tuple[int, float, float]]) -> DataFrame:
    """(fieldid, rcid, ra, dec): the centre of every quadrant of every field, from the field centres (fieldid, ra, dec)
    and the focal-plane layout, ``offsets`` of (rcid, xi, eta) in degrees on the tangent plane. The layout is a short
    list of the camera, given as literals: each field row is unrolled into its quadrants, with no join."""
    from skytables.functions.sky import tangent_to_sky

    layout = F.array(*[F.struct(F.lit(r).cast("smallint").alias("rcid"), F.lit(float(x)).alias("xi"), F.lit(float(y)).alias("eta")) for r, x, y in offsets])
    unrolled = fields.select("fieldid", F.col("ra").alias("_ra0"), F.col("dec").alias("_dec0"), F.explode(layout).alias("_q"))
    ra, dec = tangent_to_sky("_ra0", "_dec0", "_q.xi", "_q.eta")
    return unrolled.select("fieldid", F.col("_q.rcid").alias("rcid"), ra.alias("ra"), dec.alias("dec"))


def exposures_per_field(exposures: DataFrame) -> DataFrame:
    """One row per exposure: what is common to its quadrants."""
    common = [c for c in exposures.columns if c != "expid" and c not in _DROPPED]
    return exposures.groupBy("expid").agg(*[F.min(c).alias(c) for c in common])
