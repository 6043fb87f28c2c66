"""Per-source metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytables.functions.arrays import array_extrema, is_good, sorted_unique
from skytables.functions.sky import sky_cell
from skytables.operators.filters import mjd_window
from skytables.schemas import BAND_NUMBERS, PRIVATE_INTERVALS

_G, _R, _I = (BAND_NUMBERS[b] for b in "gri")


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _fold(epochs: DataFrame, *keys: str) -> DataFrame:
    """Epochs to one row of statistics per object, with plain hash aggregates that combine map-side."""
    place = [F.min(c).alias(c) for c in ("ra", "dec", "cell") if "sid" in keys]
    return epochs.groupBy(*keys, "oid", "band", "fieldid").agg(
        *place,
        F.count("*").alias("n"),
        F.sum(F.col("mag").cast("double")).alias("mag_sum"),
        F.min("mag").alias("mag_lo"),
        F.max("mag").alias("mag_hi"),
        F.min("mjd").alias("mjd_lo"),
        F.max("mjd").alias("mjd_hi"),
    )


def source_meta(source_obs: DataFrame, where: Column | None = None) -> DataFrame:
    """Position, member lists, counts, magnitudes and durations of each source, from source observations."""
    return _summarise(_fold(source_obs if where is None else source_obs.where(where), "sid"))


def source_meta_of_members(obs: DataFrame, members: DataFrame, where: Column | None = None) -> DataFrame:
    """The same straight from observations and source members.

    Epochs are folded per object before the join, so the join moves one row per object, and an object with very many
    epochs meets its source as one row like any other.
    """
    good = obs.where(is_good()) if where is None else obs.where(is_good() & where)
    placed = members.withColumn("cell", sky_cell("ra", "dec"))
    return _summarise(_fold(good).join(placed, "oid"))


def _summarise(per_object: DataFrame) -> DataFrame:
    """Fold object statistics per source. What is collected is bounded by the members: one per band and field."""

    def of(bands: tuple[int, ...], name: str) -> Column:
        return F.when(F.col("band").isin(*bands), F.col(name))

    aggregates = {
        "ra": F.min("ra"),
        "dec": F.min("dec"),
        "cell": F.min("cell"),
        "oids": sorted_unique("oid"),
        "bands": sorted_unique("band"),
        "fieldids": sorted_unique("fieldid"),
        "nobs": F.sum("n").cast("int"),
        "mjd_lo": F.min("mjd_lo"),
        "mjd_hi": F.max("mjd_hi"),
        "lo_gr": F.min(of((_G, _R), "mjd_lo")),
        "hi_gr": F.max(of((_G, _R), "mjd_hi")),
    }
    for name, number in BAND_NUMBERS.items():
        aggregates |= {
            f"nobs_{name}": F.coalesce(F.sum(of((number,), "n")), F.lit(0)).cast("int"),
            f"max_mag_{name}": F.max(of((number,), "mag_hi")),
            f"min_mag_{name}": F.min(of((number,), "mag_lo")),
            f"mean_mag_{name}": (F.sum(of((number,), "mag_sum")) / F.sum(of((number,), "n"))).cast("float"),
            f"lo_{name}": F.min(of((number,), "mjd_lo")),
            f"hi_{name}": F.max(of((number,), "mjd_hi")),
        }
    s = per_object.groupBy("sid").agg(*[c.alias(name) for name, c in aggregates.items()])

    lo = {b: F.col(f"lo_{b}") for b in BAND_NUMBERS}
    hi = {b: F.col(f"hi_{b}") for b in BAND_NUMBERS}
    both_gr = (F.col("nobs_g") > 0) & (F.col("nobs_r") > 0)
    gr_overlap = F.least(hi["g"], hi["r"]) - F.greatest(lo["g"], lo["r"])
    # A missing band counts as time 0 here, which makes the overlap negative and so 0.
    gri_overlap = array_extrema(list(hi.values()), "min") - array_extrema(list(lo.values()), "max")
    durations = {f"duration_{b}": _zero(hi[b] - lo[b]) for b in BAND_NUMBERS} | {
        "duration_gr_wide": _zero(F.col("hi_gr") - F.col("lo_gr")),
        "duration_gr_narrow": F.when(both_gr, F.greatest(gr_overlap, F.lit(0.0))).otherwise(0.0),
        "duration_gri_wide": F.col("mjd_hi") - F.col("mjd_lo"),
        "duration_gri_narrow": F.greatest(gri_overlap, F.lit(0.0)),
    }
    statistics = [f"{how}_mag_{b}" for how in ("max", "min", "mean") for b in BAND_NUMBERS]
    return s.select(
        "sid", "ra", "dec", "cell", "oids", "bands", "fieldids", "nobs",
        *[f"nobs_{b}" for b in BAND_NUMBERS],
        *statistics,
        *[c.cast("float").alias(name) for name, c in durations.items()],
    )


def source_meta_short(source_obs: DataFrame, release: int) -> DataFrame:
    """Source metadata over the survey-internal period of an early data release."""
    if release not in PRIVATE_INTERVALS:
        raise ValueError(f"release {release} has no private interval; known: {sorted(PRIVATE_INTERVALS)}")
    return source_meta(mjd_window(source_obs, *PRIVATE_INTERVALS[release]))
