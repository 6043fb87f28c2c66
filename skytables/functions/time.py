"""Modified Julian dates and the heliocentric mid-exposure time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0
_MJD_EPOCH = "1858-11-17"
_LIGHT_SECONDS_PER_AU = 499.0048


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_mjd(ts) -> Column:
    """MJD of an ISO text or zone-less timestamp in UTC; does not depend on the session time zone."""
    ts = _col(ts).cast("timestamp_ntz")
    days = F.date_diff(ts.cast("date"), F.lit(_MJD_EPOCH).cast("date"))
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    return days + seconds / SECONDS_PER_DAY


def heliocentric_correction(mjd, ra, dec) -> Column:
    """Light-travel time in seconds from the Sun to the Earth along (ra, dec).

    Low-precision solar position of the Astronomical Almanac, precessed to J2000; good to about 0.1 s, with the
    observatory taken at the Earth's centre (at most 0.03 s).
    """
    n = _col(mjd) - 51544.5
    mean_longitude = 280.460 + 0.9856474 * n
    anomaly = F.radians(357.528 + 0.9856003 * n)
    longitude = F.radians(mean_longitude + 1.915 * F.sin(anomaly) + 0.020 * F.sin(2 * anomaly) - 3.825e-5 * n)
    distance = 1.00014 - 0.01671 * F.cos(anomaly) - 0.00014 * F.cos(2 * anomaly)
    obliquity = F.radians(23.439 - 4e-7 * n)
    ra, dec = F.radians(_col(ra)), F.radians(_col(dec))
    projection = distance * (
        F.cos(longitude) * F.cos(dec) * F.cos(ra)
        + F.cos(obliquity) * F.sin(longitude) * F.cos(dec) * F.sin(ra)
        + F.sin(obliquity) * F.sin(longitude) * F.sin(dec)
    )
    return -_LIGHT_SECONDS_PER_AU * projection


def mid_exposure_helio(start_mjd, exptime, ra, dec) -> Column:
    """Middle of an exposure of ``exptime`` seconds, as heliocentric MJD."""
    middle = _col(start_mjd) + _col(exptime).cast("double") / 2 / SECONDS_PER_DAY
    return middle + heliocentric_correction(middle, ra, dec) / SECONDS_PER_DAY
