"""Polygons of great circles on the unit sphere, as arrays of their corners: areas, clipping, overlap.

A ring is an (n, 3) array of unit vectors. Of the two regions that it bounds the one without the point opposite to
its middle is meant. Rings may be concave; a clipped one may run back and forth along the clipping circle, which adds
nothing to its signed area.
"""

from __future__ import annotations

import numpy as np


def vectors(lon, lat, keep_all: bool = False) -> np.ndarray:
    """Unit vectors of points in degrees, without points that are missing or (unless ``keep_all``) equal the one before."""
    lon, lat = np.radians(np.asarray(lon, float)), np.radians(np.asarray(lat, float))
    known = np.isfinite(lon) & np.isfinite(lat)
    lon, lat = lon[known], lat[known]
    out = np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)
    return out if keep_all or not len(out) else out[np.abs(out - np.roll(out, 1, axis=0)).max(axis=1) > 1e-12]


def middle(ring: np.ndarray) -> np.ndarray:
    """Direction of the mean corner; where corners cancel out, that around which the ring runs."""
    for out in (ring.mean(axis=0), np.cross(ring, np.roll(ring, -1, axis=0)).sum(axis=0), ring[0]):
        size = np.linalg.norm(out)
        if size > 1e-9:
            break
    return out / size


def signed_area(ring: np.ndarray, around: np.ndarray | None = None) -> float:
    """Steradians, positive for rings that run counter-clockwise seen from outside: triangles around a point."""
    if len(ring) < 3:
        return 0.0
    o = middle(ring) if around is None else around
    to = np.roll(ring, -1, axis=0)
    volume = np.cross(ring, to) @ o
    return float((2 * np.arctan2(volume, 1 + ring @ o + to @ o + (ring * to).sum(axis=1))).sum())


def area(ring: np.ndarray) -> float:
    return abs(signed_area(ring))


def clip(ring: np.ndarray, pole: np.ndarray) -> np.ndarray:
    """The part of a ring in the hemisphere around ``pole``."""
    if not len(ring):
        return ring
    to = np.roll(ring, -1, axis=0)
    above = ring @ pole
    next_above = np.roll(above, -1)
    inside = above >= 0
    crossing = ring * np.abs(next_above)[:, None] + to * np.abs(above)[:, None]
    size = np.linalg.norm(crossing, axis=1)
    crossing /= np.where(size > 0, size, 1)[:, None]
    both = np.stack([ring, crossing], axis=1)
    return both[np.stack([inside, inside != (next_above >= 0)], axis=1)]


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Steradians that both rings hold: ``a`` is clipped by the triangles of ``b`` around its middle, those of concave
    stretches counting negative."""
    if len(a) < 3 or len(b) < 3:
        return 0.0
    a = a if signed_area(a) >= 0 else a[::-1]
    b = b if signed_area(b) >= 0 else b[::-1]
    o, total = middle(b), 0.0
    for one, two in zip(b, np.roll(b, -1, axis=0), strict=True):
        sign = np.sign(np.dot(np.cross(one, two), o))
        if not sign:
            continue
        part = a
        for pole in (np.cross(o, one), np.cross(one, two), np.cross(two, o)):
            part = clip(part, sign * pole)
        total += sign * signed_area(part, middle(np.stack([o, one, two])))
    return max(total, 0.0)
