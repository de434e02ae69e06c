"""Sun position from low-precision formulas (Astronomical Almanac), as Columns of UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geogrid.functions.projections import wrap_pi

#: Days from the epoch 1970-01-01 to J2000.0 (2000-01-01 12:00).
J2000_DAYS = 10957.5


def days_j2000(t: Column) -> Column:
    """Days since J2000.0 of a timestamp_ntz."""
    seconds = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t) / 1e6
    return seconds / 86400.0 - J2000_DAYS


def sun_ra_dec(t: Column) -> tuple[Column, Column]:
    """Right ascension and declination of the sun in radians."""
    d = days_j2000(t)
    g = F.radians(F.pmod(d * 0.98560028 + 357.528, F.lit(360.0)))
    lon = F.radians(F.pmod(d * 0.9856474 + 280.460, F.lit(360.0)) + F.sin(g) * 1.915 + F.sin(g * 2) * 0.020)
    tilt = F.radians(F.lit(23.439) - d * 0.0000004)
    return F.atan2(F.cos(tilt) * F.sin(lon), F.cos(lon)), F.asin(F.sin(tilt) * F.sin(lon))


def gmst(t: Column) -> Column:
    """Greenwich mean sidereal time in radians."""
    return F.radians(F.pmod(days_j2000(t) * 360.98564736629 + 280.46061837, F.lit(360.0)))


def sun_zenith(t: Column, lon: Column, lat: Column) -> Column:
    """Solar zenith angle in degrees."""
    ra, dec = sun_ra_dec(t)
    hour = wrap_pi(F.degrees(gmst(t) - ra) + lon, 180.0)
    phi = F.radians(lat)
    cos = F.sin(phi) * F.sin(dec) + F.cos(phi) * F.cos(dec) * F.cos(F.radians(hour))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos))))
