"""Sky geometry as Column expressions.

Cells follow the zones idea (Gray, Nieto-Santisteban, Szalay, 2006): declination is cut in zones of equal height and
each zone in right-ascension bins at least as wide as the zone is high. ``level`` is the number of zones per degree.
Cells only choose which rows meet; every match is decided by the exact distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINE = 1024  # 3.5 arcsec zones, the stored match cell
COARSE = 64  # 56 arcsec zones, the dust lookup cell
ZONE_STRIDE = 1 << 32
_PAD = 1e-9  # degrees; covers rounding in cell edges, far below any radius in use


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def angular_distance(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance in degrees (haversine, which stays accurate below an arcsecond)."""
    ra1, dec1, ra2, dec2 = map(_col, (ra1, dec1, ra2, dec2))
    half_dec = F.sin(F.radians(dec2 - dec1) / 2)
    half_ra = F.sin(F.radians(ra2 - ra1) / 2)
    h = half_dec * half_dec + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * half_ra * half_ra
    return F.degrees(2 * F.asin(F.sqrt(F.when(h > 1.0, 1.0).otherwise(h))))


def normalize_ra(ra) -> Column:
    """Right ascension in [0, 360)."""
    return F.pmod(_col(ra), F.lit(360.0))


def zone_count(level: int) -> int:
    return 180 * level


def zone_of(dec, level: int) -> Column:
    return F.least(F.floor((_col(dec) + 90.0) * level), F.lit(zone_count(level) - 1))


def bins_in_zone(zone, level: int) -> Column:
    zone = _col(zone)
    nearest_to_equator = F.when(zone >= 90 * level, zone / level - 90.0).otherwise(90.0 - (zone + 1) / level)
    return F.greatest(F.lit(1), F.floor(360.0 * level * F.cos(F.radians(nearest_to_equator))))


def has_position(ra, dec) -> Column:
    """Both coordinates are there, neither is NaN or infinite, and the declination exists on the sphere."""
    ra, dec = _col(ra), _col(dec)
    whole = F.coalesce(F.abs(ra) < float("inf"), F.lit(False)) & F.coalesce(F.abs(dec) <= 90.0, F.lit(False))
    return whole & ~F.isnan(ra.cast("double")) & ~F.isnan(dec.cast("double"))


def sky_cell(ra, dec, level: int = FINE) -> Column:
    """Integer sky cell of a position in degrees; NULL without a usable position."""
    zone = zone_of(dec, level)
    bins = bins_in_zone(zone, level)
    cell = zone * ZONE_STRIDE + F.least(F.floor(normalize_ra(ra) / 360.0 * bins), bins - 1)
    return F.when(has_position(ra, dec), cell)


def with_neighbour_cells(
    df: DataFrame, radius_deg: float, level: int, ra: str = "ra", dec: str = "dec", out: str = "cell"
) -> DataFrame:
    """One row per cell that can hold a point within ``radius_deg`` of the row's position, each cell once.

    Rows without a usable position have no cells.
    """
    r = radius_deg + _PAD
    low, high = F.col(dec) - r, F.col(dec) + r
    polar = F.abs(F.col(dec)) + r >= 90.0
    half_width = F.degrees(
        F.atan2(
            F.sin(F.radians(F.lit(r))),
            F.sqrt(F.greatest(F.cos(F.radians(low)) * F.cos(F.radians(high)), F.lit(0.0))),
        )
    )
    zones = F.sequence(F.greatest(F.floor((low + 90.0) * level), F.lit(0)), zone_of(high, level))
    ra_n = normalize_ra(ra)
    first = F.floor((ra_n - F.col("_half")) / 360.0 * F.col("_bins"))
    last = F.floor((ra_n + F.col("_half")) / 360.0 * F.col("_bins"))
    whole = F.col("_polar") | (last - first + 1 >= F.col("_bins"))
    return (
        df.where(has_position(ra, dec))
        .withColumns({"_polar": polar, "_half": half_width, "_zone": F.explode(zones)})
        .withColumn("_bins", bins_in_zone("_zone", level))
        .withColumn(
            "_bin",
            F.explode(
                F.sequence(F.when(whole, F.lit(0)).otherwise(first), F.when(whole, F.col("_bins") - 1).otherwise(last))
            ),
        )
        .withColumn(out, F.col("_zone") * ZONE_STRIDE + F.pmod("_bin", "_bins"))
        .drop("_polar", "_half", "_zone", "_bins", "_bin")
    )


def match_level(radius_deg: float) -> int:
    """Stored fine level while a zone is at least one radius high, else the finest power of two that is."""
    level = FINE
    while level > 1 and radius_deg * level > 1:
        level //= 2
    return level


def circular_mean(angle, where: Column | None = None, window=None) -> Column:
    """Mean of angles in degrees by summed sines and cosines; the result lies in (-180, 180]."""
    angle = F.radians(_col(angle))
    parts = [F.sin(angle), F.cos(angle)]
    if where is not None:
        parts = [F.when(where, p) for p in parts]
    sums = [F.sum(p) for p in parts]
    if window is not None:
        sums = [s.over(window) for s in sums]
    return F.degrees(F.atan2(*sums))


def radians_to_degrees(df: DataFrame, ra: str = "ra_rad", dec: str = "dec_rad") -> DataFrame:
    """Add ``ra`` and ``dec`` in degrees from radian columns."""
    scale = 180.0 / F.pi()
    return df.withColumns({"ra": scale * F.col(ra), "dec": scale * F.col(dec)})


def position_hash(ra="ra", dec="dec") -> Column:
    """64-bit key of a position."""
    return F.xxhash64(_col(ra), _col(dec))


def tangent_to_sky(ra0, dec0, xi, eta) -> tuple[Column, Column]:
    """Sky position (degrees, RA in [0, 360)) of the tangent-plane offsets ``xi`` (east), ``eta`` (north), in degrees
    of the gnomonic projection about the centre (``ra0``, ``dec0``). Exact for any centre, the poles and RA 0 included."""
    ra0, dec0, xi, eta = (F.radians(_col(c)) for c in (ra0, dec0, xi, eta))
    denominator = F.cos(dec0) - eta * F.sin(dec0)
    ra = ra0 + F.atan2(xi, denominator)
    dec = F.atan2(F.sin(dec0) + eta * F.cos(dec0), F.sqrt(xi * xi + denominator * denominator))
    return F.pmod(F.degrees(ra), F.lit(360.0)), F.degrees(dec)


def sky_to_tangent(ra0, dec0, ra, dec) -> tuple[Column, Column]:
    """Inverse of :func:`tangent_to_sky`: offsets (degrees) of a position on the tangent plane about the centre;
    NULL for positions 90 degrees or more from the centre, which the projection does not reach."""
    ra0, dec0, ra, dec = (F.radians(_col(c)) for c in (ra0, dec0, ra, dec))
    cos_c = F.sin(dec0) * F.sin(dec) + F.cos(dec0) * F.cos(dec) * F.cos(ra - ra0)
    xi = F.cos(dec) * F.sin(ra - ra0) / cos_c
    eta = (F.cos(dec0) * F.sin(dec) - F.sin(dec0) * F.cos(dec) * F.cos(ra - ra0)) / cos_c
    seen = cos_c > 0
    return F.when(seen, F.degrees(xi)), F.when(seen, F.degrees(eta))


# The rotation from equatorial (J2000) to galactic coordinates, rows x, y, z.
GALACTIC = (
    (-0.0548755604162154, -0.8734370902348850, -0.4838350155487132),
    (0.4941094278755837, -0.4448296299600112, 0.7469822444972189),
    (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669),
)


def galactic(ra, dec) -> tuple[Column, Column]:
    """Galactic longitude in [0, 360) and latitude, in degrees, of an equatorial position."""
    a, d = F.radians(_col(ra)), F.radians(_col(dec))
    v = (F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d))
    gx, gy, gz = (row[0] * v[0] + row[1] * v[1] + row[2] * v[2] for row in GALACTIC)
    return F.pmod(F.degrees(F.atan2(gy, gx)), F.lit(360.0)), F.degrees(F.asin(F.least(F.greatest(gz, F.lit(-1.0)), F.lit(1.0))))


def polar_pixel(l, b, size: int) -> tuple[Column, Column, Column]:
    """Hemisphere (1 north, -1 south) and pixel coordinates of a galactic position on a ``size`` x ``size`` Lambert
    equal-area map of each galactic hemisphere centred on its pole, the rim being the plane (b = 0)."""
    l, b = F.radians(_col(l)), _col(b)
    n = F.when(b >= 0, F.lit(1)).otherwise(F.lit(-1))
    r = F.sqrt(F.greatest(F.lit(1.0) - n * F.sin(F.radians(b)), F.lit(0.0)))
    half = size / 2
    return n, r * F.cos(l) * half + (half - 0.5), -n * r * F.sin(l) * half + (half - 0.5)
