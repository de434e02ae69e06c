"""Printed expectations of scalings, colours and types."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from geogrid.functions import enhance as E
from geogrid.operators import composites, grids, products
from geogrid.sources import granules


def one(spark, *columns):
    r = spark.range(1).select(*columns).first()
    return r[0] if len(columns) == 1 else tuple(r)


def test_temperature_difference_levels(spark):
    got = [one(spark, F.bround(E.temperature_difference(F.lit(v)) * 255)) for v in (-10.0, 0.0, 10.0, -50.0, 50.0)]
    assert got == [5, 105, 205, 4, 206]


def test_inverted_stretch(spark):
    assert one(spark, E.crude_stretch(F.lit(180.0), 280.0, 180.0)) == 1.0
    assert one(spark, E.crude_stretch(F.lit(280.0), 280.0, 180.0)) == 0.0


def test_btemp_threshold_meets_at_the_break(spark):
    lo, at, hi = (one(spark, E.btemp_threshold(F.lit(v), 163.0, 330.0, 242.0)) for v in (163.0, 242.0, 330.0))
    assert (lo, hi) == (1.0, 0.0) and abs(at - 176 / 255) < 1e-12


@pytest.mark.parametrize("src", ["uint8", "float32", "float64"])
@pytest.mark.parametrize("dst", ["uint8", "int16", "float32", "uint64"])
@pytest.mark.parametrize("enhanced", [True, False])
def test_quantize(spark, src, dst, enhanced):
    v = 0.37
    got = one(spark, E.quantize(F.lit(v).cast("double"), src, dst, enhanced, fill=9))
    lo, hi, _ = E.DTYPES[dst]
    if lo is None:
        assert abs(got - v) < 1e-6
    else:
        want = v * (hi - lo) + lo if src.startswith("float") and enhanced else v
        assert abs(int(got) - math.trunc(min(max(want, lo), hi))) <= abs(want) * 1e-15
    gone = one(spark, E.quantize(F.lit(None).cast("double"), src, dst, enhanced, fill=9))
    assert gone is None if dst == "float32" and src.startswith("float") else int(gone) == 9


def test_quantize_takes_the_fill_before_the_cast(spark):
    assert one(spark, E.quantize(F.lit(float("nan")), "float32", "uint8", True, fill=0)) == 0


@pytest.mark.parametrize("mask,want", [(0, 0), (1, 1), (2, 1), (3, 1), (4, 2), (12, 2), (16, 4), (31, 7)])
def test_cloud_layers(spark, mask, want):
    assert one(spark, E.cloud_layers_lmh(F.lit(mask))) == want


def test_colormap_ends_and_middle(spark):
    black_to_red = ([0.0, 1.0], [(0, 0, 0, 255), (255, 0, 0, 255)])
    got = [tuple(one(spark, E.colorize(F.lit(v), *black_to_red))) for v in (-1.0, 0.0, 1.0, 2.0)]
    assert got == [(0, 0, 0, 255), (0, 0, 0, 255), (255, 0, 0, 255), (255, 0, 0, 255)]
    reverse = one(spark, E.colorize(F.lit(300.0), *black_to_red, 300.0, 200.0))
    assert tuple(reverse) == (0, 0, 0, 255)
    assert one(spark, E.colorize(F.lit(None).cast("double"), *black_to_red)) is None


def test_limits(spark):
    lo, hi = E.color_limits(F.lit(0.1), F.lit(9.9995), "uint8")
    assert one(spark, lo, hi) == (10.0, 35.4995)
    lo, hi = E.color_limits(F.lit(None).cast("double"), F.lit(None).cast("double"), "uint8")
    assert one(spark, lo, hi) == (0.0, 255.0)
    lo, _ = E.color_limits(F.lit(float("nan")), F.lit(1.0), "uint8")
    with pytest.raises(Exception, match="NaN"):
        one(spark, lo)


def test_erf(spark):
    for x in (-2.0, -0.3, 0.0, 0.5, 1.7):
        assert abs(one(spark, E.erf(F.lit(x))) - math.erf(x)) < 2e-7


def test_isclose_counts_missing_as_equal(spark):
    gone = F.lit(None).cast("double")
    assert one(spark, E.isclose(gone, F.lit(float("nan")))) is True
    assert one(spark, E.isclose(gone, F.lit(1.0))) is False
    assert one(spark, E.isclose(F.lit(1.0), F.lit(1.1), atol=0.2)) is True


@pytest.mark.parametrize("lat,kind,part", [(10, "eqc", "lat_ts=10.00000"), (35, "lcc", "lat_1=35.00000"), (80, "stere", "lat_ts=80.00000"), (-80, "stere", "lat_0=90")])
def test_projection_choice(spark, lat, kind, part):
    text = one(spark, grids.choose_projection(F.lit(-95.0), F.lit(float(lat))))
    assert f"proj={kind} " in text and part in text and "lon_0=-95.00000" in text


@pytest.mark.parametrize("name,want", [("Suomi-NPP", "npp"), ("JPSS-1", "noaa20"), ("EOS-Terra", "terra"), ("GOES-16", "GOES-16"), ("GCOM-W1", "gcom-w1")])
def test_platforms(spark, name, want):
    assert one(spark, products.platform_alias(F.lit(name))) == want


@pytest.mark.parametrize("band,want", [("I01", "VIIRS-I1-SDR"), ("M16", "VIIRS-M16-SDR"), ("DNB", "VIIRS-DNB-SDR"), ("GITCO", "VIIRS-IMG-GEO-TC"), ("GMTCO", "VIIRS-MOD-GEO-TC"), ("GDNBO", "VIIRS-DNB-GEO")])
def test_band_prefixes(spark, band, want):
    assert one(spark, granules.band_prefix(F.lit(band))) == want


def test_granule_names(spark):
    rows = [("a/SVI01_npp_d20210101_t2359305_e0000559_b.h5",), ("a/readme.txt",), ("SVI01_npp_d20219901_t2359305_e0000559_b.h5",)]
    got = granules.granule_times(spark.createDataFrame(rows, "path string")).collect()
    assert [(str(r["start_time"]), str(r["end_time"])) for r in got] == [("2021-01-01 23:59:30.500000", "2021-01-02 00:00:55.900000")]


def test_pressure_names(spark):
    assert one(spark, products.pressure_name(F.lit("T"), F.lit(0.016))) == "T_0.016mb"
    assert one(spark, products.pressure_name(F.lit("T"), F.lit(986.067))) == "T_986mb"


def test_sub_band_needs_a_band():
    with pytest.raises(ValueError):
        composites.sub_band(F.lit(None), "Q")


def test_sharpening_without_high_resolution(spark):
    r, g, b = F.lit(1.0), F.lit(2.0), F.lit(3.0)
    assert tuple(one(spark, composites.ratio_sharpened(r, g, b, None, "r"))) == (1.0, 2.0, 3.0)
    assert tuple(one(spark, composites.ratio_sharpened(r, g, b, F.lit(2.0), "r"))) == (2.0, 4.0, 6.0)
    assert tuple(one(spark, composites.ratio_sharpened(F.lit(0.0), g, b, F.lit(2.0), "r"))) == (2.0, 2.0, 3.0)
