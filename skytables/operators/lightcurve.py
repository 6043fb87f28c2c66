"""From raw epoch arrays to cleaned light curves, observations and per-object metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytables.functions.arrays import (
    array_join,
    array_mean,
    equal_sizes,
    good_elements,
    has_any,
    has_good_epoch,
    is_good,
)
from skytables.functions.sky import sky_cell

META_COLUMNS = (
    "oid", "nobs", "ngoodobs", "band", "fieldid", "rcid", "ra", "dec", "cell",
    "durgood", "mingoodmag", "maxgoodmag", "meangoodmag",
)


def _object_columns() -> list[Column]:
    return [
        F.col("objectid").cast("bigint").alias("oid"),
        F.col("filterid").alias("band"),
        F.col("fieldid"),
        F.col("rcid"),
        F.col("objra").cast("double").alias("ra"),
        F.col("objdec").cast("double").alias("dec"),
    ]


def to_observations(raw: DataFrame) -> DataFrame:
    """One row per epoch of the raw table, bad epochs and flags included."""
    arrays = ["mjd", "mag", "magerr", "clrcoeff", "catflags"]
    renamed = raw.select(
        *_object_columns(),
        F.col("nepochs").cast("int").alias("nobs"),
        sky_cell(F.col("objra").cast("double"), F.col("objdec").cast("double")).alias("cell"),
        F.col("hmjd").alias("mjd"),
        *arrays[1:],
    )
    return array_join(renamed, arrays).select(
        "oid", "nobs", "band", "fieldid", "rcid", "ra", "dec", "cell", *arrays
    )


def lc_summary(olc: DataFrame) -> DataFrame:
    """Add the stored scalars of a light curve: count, duration and magnitude range and mean."""
    return olc.withColumns(
        {
            "ngoodobs": F.size("mjd"),
            "durgood": F.array_max("mjd") - F.array_min("mjd"),
            "mingoodmag": F.array_min("mag"),
            "maxgoodmag": F.array_max("mag"),
            "meangoodmag": array_mean("mag").cast("float"),
        }
    )


def build_olc(raw: DataFrame) -> DataFrame:
    """Object light curves: good epochs only, objects without one dropped. A projection: nothing is shuffled.

    The row filter stops at the first good epoch; each array is then filtered once per kept object.
    """
    arrays = {"mjd": "hmjd", "mag": "mag", "magerr": "magerr", "clrcoeff": "clrcoeff"}
    kept = F.when(equal_sizes([*arrays.values(), "catflags"]), has_good_epoch()).otherwise(
        F.raise_error(F.lit("epoch arrays have different lengths")).cast("boolean")
    )
    # Renamed in a step of its own: inside a lambda, an alias of the same select would win over the raw column.
    filtered = raw.where(kept).select(
        *_object_columns(),
        F.size("hmjd").alias("nobs_w_bad"),
        sky_cell(F.col("objra").cast("double"), F.col("objdec").cast("double")).alias("cell"),
        *[good_elements(source).alias(f"good_{name}") for name, source in arrays.items()],
    )
    return lc_summary(filtered.withColumnsRenamed({f"good_{name}": name for name in arrays}))


def observations_view(olc: DataFrame) -> DataFrame:
    """Per-epoch view of the light curves; flags are 0 as bad epochs are gone. Unordered: sort where it is needed."""
    arrays = ["mjd", "mag", "magerr", "clrcoeff"]
    renamed = olc.select(
        "oid", F.col("nobs_w_bad").alias("nobs"), "band", "fieldid", "rcid", "ra", "dec", "cell", *arrays
    )
    return array_join(renamed, arrays).withColumn("catflags", F.lit(0))


def create_observations_view(spark, olc_table: str, view: str, replace: bool = False) -> None:
    """Persistent view of :func:`observations_view` over a stored light-curve table; an existing view is kept unless
    ``replace`` is set."""
    create = "CREATE OR REPLACE VIEW" if replace else "CREATE VIEW IF NOT EXISTS"
    spark.sql(
        f"""{create} {view} AS
        SELECT oid, nobs_w_bad AS nobs, band, fieldid, rcid, ra, dec, cell,
               epoch.mjd, epoch.mag, epoch.magerr, epoch.clrcoeff, 0 AS catflags
        FROM {olc_table} LATERAL VIEW explode(arrays_zip(mjd, mag, magerr, clrcoeff)) AS epoch"""
    )


def object_meta(obs: DataFrame) -> DataFrame:
    """Per-object metadata from observations. Objects without a good epoch stay, with 0 duration and NULL magnitudes."""
    good = is_good()
    mag, mjd = F.when(good, F.col("mag")), F.when(good, F.col("mjd"))
    same = [F.min(c).alias(c) for c in ("nobs", "band", "fieldid", "rcid", "ra", "dec", "cell")]
    return (
        obs.groupBy("oid")
        .agg(
            *same,
            F.count_if(good).cast("int").alias("ngoodobs"),
            F.coalesce(F.max(mjd) - F.min(mjd), F.lit(0.0)).alias("durgood"),
            F.min(mag).alias("mingoodmag"),
            F.max(mag).alias("maxgoodmag"),
            F.avg(mag).cast("float").alias("meangoodmag"),
        )
        .select(*META_COLUMNS)
    )


def object_meta_from_olc(olc: DataFrame) -> DataFrame:
    """The same metadata by projection of the stored light-curve scalars."""
    return olc.withColumnRenamed("nobs_w_bad", "nobs").select(*META_COLUMNS)


def object_meta_from_raw(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The same metadata from raw arrays.

    ``strict`` keeps objects with a good epoch. Otherwise an object passes when some epoch has a positive error and
    some epoch, perhaps another one, has no flag.
    """
    loose = has_any("magerr", lambda e: e > 0) & has_any("catflags", lambda f: f == 0)
    curves = raw.where(has_good_epoch() if strict else loose).select(
        *_object_columns(),
        F.col("nepochs").cast("int").alias("nobs"),
        sky_cell(F.col("objra").cast("double"), F.col("objdec").cast("double")).alias("cell"),
        good_elements("hmjd").alias("good_mjd"),
        good_elements("mag").alias("good_mag"),
    )
    meta = lc_summary(curves.withColumnsRenamed({"good_mjd": "mjd", "good_mag": "mag"}))
    return meta.withColumn("durgood", F.coalesce("durgood", F.lit(0.0))).select(*META_COLUMNS)


def good_objects(meta: DataFrame) -> DataFrame:
    return meta.where(F.col("ngoodobs") > 0)
