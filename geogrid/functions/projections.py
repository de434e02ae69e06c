"""Map projections as Column expressions (Snyder, USGS PP 1395; CGMS LRIT/HRIT for geos).

A projection is a dictionary of PROJ-style parameters: ``proj`` (longlat, lcc, stere, merc, eqc, geos),
``lon_0``, ``lat_0``, ``lat_1``, ``lat_2``, ``lat_ts``, ``h``, ``sweep`` and the figure of the earth (``R``, or
``a`` and ``b``, or ``ellps``/``datum``). Angles are degrees, lengths metres. Null in, null out. ``lon_0`` may be a Column:
each row then has a central meridian of its own, for geos that of the satellite that took it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Semi-major axis and inverse flattening.
ELLIPSOIDS = {"WGS84": (6378137.0, 298.257223563), "GRS80": (6378137.0, 298.257222101)}
EARTH_RADIUS = 6370997.0
#: Longitudes of weather satellites around the equator, at most 83 degrees apart; one of them sees each place within 60 degrees of it.
SATELLITES = (-137.0, -75.0, 0.0, 45.5, 104.7, 140.7)


def figure(p: Mapping) -> tuple[float, float]:
    """(semi-major axis, eccentricity)."""
    if p.get("R") is not None:
        return float(p["R"]), 0.0
    if p.get("a") is not None:
        a, b = float(p["a"]), float(p.get("b", p["a"]))
        return a, math.sqrt(1 - b * b / (a * a))
    a, rf = ELLIPSOIDS[p.get("ellps") or p.get("datum") or "WGS84"]
    return a, math.sqrt(2 / rf - 1 / rf**2)


def wrap_pi(v: Column, half: float) -> Column:
    """(v + half) mod 2 half - half: into [-half, half)."""
    return F.pmod(v + half, F.lit(2.0 * half)) - half


def wrap_lon(lon: Column) -> Column:
    return wrap_pi(lon, 180.0)


def nearest_satellite(lon: Column) -> Column:
    """The one of ``SATELLITES`` that stands highest over a place: a ``lon_0`` for geos."""
    away = [F.struct(F.abs(wrap_lon(lon - at)).alias("away"), F.lit(at).alias("lon_0")) for at in SATELLITES]
    return F.least(*away)["lon_0"]


def _lon_0(p: Mapping) -> Column | float:
    own = p.get("lon_0", 0)
    return own if isinstance(own, Column) else float(own)


def lon_360(lon: Column) -> Column:
    return F.pmod(lon, F.lit(360.0))


def _t(phi: float, e: float) -> float:
    s = e * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)


def _m(phi: float, e: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)


def _t_column(phi: Column, e: float) -> Column:
    t = F.tan(F.lit(math.pi / 4) - phi / 2)
    if e == 0:
        return t
    s = F.sin(phi) * e
    return t / F.pow((1 - s) / (1 + s), F.lit(e / 2))


def _latitude(t: Column, e: float) -> Column:
    """Degrees of the latitude whose isometric value is t (Snyder 3-5)."""
    chi = F.lit(math.pi / 2) - F.atan(t) * 2
    e2, e4, e6, e8 = e**2, e**4, e**6, e**8
    phi = chi
    for k, c in ((2, e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360), (4, 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520), (6, 7 * e6 / 120 + 81 * e8 / 1120), (8, 4279 * e8 / 161280)):
        if c:
            phi = phi + F.sin(chi * k) * c
    return F.degrees(phi)


def _lcc(p: Mapping) -> tuple[float, float, float, float, float]:
    a, e = figure(p)
    phi0, phi1 = (math.radians(float(p.get(k, p.get("lat_0", 0)))) for k in ("lat_0", "lat_1"))
    phi2 = math.radians(float(p["lat_2"])) if p.get("lat_2") is not None else phi1
    n = math.sin(phi1) if abs(phi1 - phi2) < 1e-10 else (math.log(_m(phi1, e)) - math.log(_m(phi2, e))) / (math.log(_t(phi1, e)) - math.log(_t(phi2, e)))
    scale = a * _m(phi1, e) / (n * _t(phi1, e) ** n)
    return a, e, n, scale, scale * _t(phi0, e) ** n


def _stere(p: Mapping) -> tuple[float, float, float, float]:
    """(a, e, sign of the pole, rho over t)."""
    a, e = figure(p)
    pole = 1.0 if float(p.get("lat_0", 90)) > 0 else -1.0
    ts = math.radians(abs(float(p.get("lat_ts", 90))))
    if abs(ts - math.pi / 2) < 1e-10:
        return a, e, pole, 2 * a / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
    return a, e, pole, a * _m(ts, e) / _t(ts, e)


def forward(p: Mapping, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Projected x and y; null off the disk for geos and at an unreachable pole."""
    kind = p.get("proj", "longlat")
    if kind in ("longlat", "latlong"):
        return lon, lat
    lam = F.radians(wrap_lon(lon - _lon_0(p)))
    phi = F.radians(lat)
    if kind == "lcc":
        _, e, n, scale, rho0 = _lcc(p)
        rho = F.pow(_t_column(phi, e), F.lit(n)) * scale
        return rho * F.sin(lam * n), F.lit(rho0) - rho * F.cos(lam * n)
    if kind == "stere":
        _, e, pole, k = _stere(p)
        rho = _t_column(phi * pole, e) * k
        return rho * F.sin(lam), rho * F.cos(lam) * -pole
    a, e = figure(p)
    if kind == "merc":
        k = _m(math.radians(float(p.get("lat_ts", 0))), e)
        y = F.when(F.abs(lat) < 90, -F.log(_t_column(phi, e)) * (a * k))
        return lam * (a * k), y
    if kind == "eqc":
        return lam * (a * math.cos(math.radians(float(p.get("lat_ts", 0))))), (phi - math.radians(float(p.get("lat_0", 0)))) * a
    if kind == "geos":
        h = float(p["h"])
        ratio = 1 - e * e  # b**2 / a**2
        centric = F.atan(F.tan(phi) * ratio)
        r = F.lit(a * math.sqrt(ratio)) / F.sqrt(1 - F.pow(F.cos(centric), F.lit(2.0)) * (e * e))
        vx, vy, vz = F.lit(h + a) - r * F.cos(centric) * F.cos(lam), r * F.cos(centric) * F.sin(lam), r * F.sin(centric)
        seen = (F.lit(h + a) - vx) * vx - vy * vy - vz * vz / ratio >= 0
        if p.get("sweep", "y") == "x":
            x, y = F.atan(vy / F.hypot(vz, vx)), F.atan(vz / vx)
        else:
            x, y = F.atan(vy / vx), F.atan(vz / F.hypot(vy, vx))
        return F.when(seen, x * h), F.when(seen, y * h)
    raise ValueError(f"projection {kind!r} is not known")


def inverse(p: Mapping, x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude (-180 to 180) and latitude; null off the disk for geos."""
    kind = p.get("proj", "longlat")
    if kind in ("longlat", "latlong"):
        return x, y
    lon_0 = _lon_0(p)
    a, e = figure(p)
    if kind == "lcc":
        _, e, n, scale, rho0 = _lcc(p)
        sign = math.copysign(1.0, n)
        rho = F.hypot(x, F.lit(rho0) - y) * sign
        theta = F.atan2(x * sign, (F.lit(rho0) - y) * sign)
        return wrap_lon(F.degrees(theta / n) + lon_0), _latitude(F.pow(rho / scale, F.lit(1 / n)), e)
    if kind == "stere":
        _, e, pole, k = _stere(p)
        return wrap_lon(F.degrees(F.atan2(x, y * -pole)) + lon_0), _latitude(F.hypot(x, y) / k, e) * pole
    if kind == "merc":
        k = a * _m(math.radians(float(p.get("lat_ts", 0))), e)
        return wrap_lon(F.degrees(x / k) + lon_0), _latitude(F.exp(-y / k), e)
    if kind == "eqc":
        return wrap_lon(F.degrees(x / (a * math.cos(math.radians(float(p.get("lat_ts", 0)))))) + lon_0), F.degrees(y / a) + float(p.get("lat_0", 0))
    if kind == "geos":
        h = float(p["h"])
        ratio = 1 - e * e
        if p.get("sweep", "y") == "x":
            vz = F.tan(y / h)
            vy = F.tan(x / h) * F.hypot(F.lit(1.0), vz)
        else:
            vy = F.tan(x / h)
            vz = F.tan(y / h) * F.hypot(F.lit(1.0), vy)
        qa = vy * vy + vz * vz / ratio + 1
        det = (h + a) ** 2 - qa * ((h + a) ** 2 - a * a)
        k = (F.lit(h + a) - F.sqrt(F.when(det >= 0, det))) / qa
        px, py, pz = F.lit(h + a) - k, k * vy, k * vz
        return wrap_lon(F.degrees(F.atan2(py, px)) + lon_0), F.degrees(F.atan(F.tan(F.atan2(pz, F.hypot(px, py))) / ratio))
    raise ValueError(f"projection {kind!r} is not known")


def unit_sphere(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    lam, phi = F.radians(lon), F.radians(lat)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def chord_distance(a: tuple[Column, Column], b: tuple[Column, Column], radius: float = EARTH_RADIUS) -> Column:
    """Straight distance in metres between two (lon, lat) points of a sphere."""
    pairs = zip(unit_sphere(*a), unit_sphere(*b), strict=True)
    return F.sqrt(sum(((u - v) * (u - v) for u, v in pairs), F.lit(0.0))) * radius


def great_circle(a: tuple[Column, Column], b: tuple[Column, Column], radius: float = EARTH_RADIUS) -> Column:
    return F.asin(F.least(chord_distance(a, b, 1.0) / 2, F.lit(1.0))) * (2 * radius)
