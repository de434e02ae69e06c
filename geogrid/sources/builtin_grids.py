"""The builtin target grids as rows."""

from __future__ import annotations

#: Fixed values. name | projection | dx dy | width height | upper-left corner (degrees), or extent.
GRIDS = """
wgs84_fit | proj=longlat datum=WGS84 | 0.0057 0.0057
latlon | proj=longlat datum=WGS84 | 0.0057 0.0057
wgs84_fit_250 | proj=longlat datum=WGS84 | 0.00225 0.00225
latlon_250 | proj=longlat datum=WGS84 | 0.00225 0.00225
wgs84_fit_1km | proj=longlat datum=WGS84 | 0.009 0.009
latlon_1km | proj=longlat datum=WGS84 | 0.009 0.009
lcc_fit | proj=lcc lat_1=25 lat_0=25 lon_0=-95 datum=WGS84 | 1000 1000
lcc_na | proj=lcc lat_1=25 lat_0=25 lon_0=-95 datum=WGS84 | 1000 1000
lcc_sa | proj=lcc lat_1=-25 lat_0=-25 lon_0=-55 datum=WGS84 | 1000 1000
lcc_eu | proj=lcc lat_1=25 lat_0=25 lon_0=15 datum=WGS84 | 1000 1000
lcc_south_africa | proj=lcc lat_1=-25 lat_0=-25 lon_0=25 datum=WGS84 | 1000 1000
lcc_aus | proj=lcc lat_1=-25 lat_0=-25 lon_0=135 datum=WGS84 | 1000 1000
lcc_asia | proj=lcc lat_1=25 lat_0=25 lon_0=105 datum=WGS84 | 1000 1000
lcc_fit_hr | proj=lcc lat_1=25 lat_0=25 lon_0=-95 datum=WGS84 | 400 400
lcc_conus_300 | proj=lcc lat_1=25 lat_0=25 lon_0=-95 datum=WGS84 | 300 300
lcc_conus_750 | proj=lcc lat_1=25 lat_0=25 lon_0=-95 datum=WGS84 | 750 750
lcc_conus_1km | proj=lcc lat_1=25 lat_0=25 lon_0=-95 datum=WGS84 | 1000 1000
eqc_fit | proj=eqc lat_ts=0 lat_0=0 lon_0=0 datum=WGS84 | 250 250
polar_canada | proj=stere lat_0=90 lat_ts=45 lon_0=-150 datum=WGS84 | 1000 1000
polar_north_pacific | proj=stere lat_0=90 lat_ts=45 lon_0=-170 datum=WGS84 | 400 400
polar_south_pacific | proj=stere lat_0=-90 lat_ts=-45 lon_0=-170 datum=WGS84 | 400 400
polar_russia | proj=stere lat_0=90 lat_ts=45 lon_0=50 datum=WGS84 | 400 400
polar_alaska | proj=stere lat_0=90 lat_ts=60 lon_0=-150 datum=WGS84 | 400 400
polar_alaska_300 | proj=stere lat_0=90 lat_ts=60 lon_0=-150 datum=WGS84 | 300 300
polar_alaska_750 | proj=stere lat_0=90 lat_ts=60 lon_0=-150 datum=WGS84 | 750 750
polar_alaska_1km | proj=stere lat_0=90 lat_ts=60 lon_0=-150 datum=WGS84 | 1000 1000
merc_conus_300 | proj=merc datum=WGS84 lon_0=-95 lat_0=0 | 300 300
merc_conus_750 | proj=merc datum=WGS84 lon_0=-95 lat_0=0 | 750 750
merc_conus_1km | proj=merc datum=WGS84 lon_0=-95 lat_0=0 | 1000 1000
merc_pacific_300 | proj=merc datum=WGS84 lon_0=170 lat_0=0 | 300 300
merc_pacific_750 | proj=merc datum=WGS84 lon_0=170 lat_0=0 | 750 750
merc_pacific_1km | proj=merc datum=WGS84 lon_0=170 lat_0=0 | 1000 1000
goesr_test_300 | proj=geos sweep=x lon_0=-89.5 h=35786023 ellps=GRS80 | 300 300
goes_east_1km | proj=geos sweep=x lon_0=-75 h=35786023 ellps=GRS80 | | 10848 10848 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
goes_east_4km | proj=geos sweep=x lon_0=-75 h=35786023 ellps=GRS80 | | 2712 2712 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
goes_east_8km | proj=geos sweep=x lon_0=-75 h=35786023 ellps=GRS80 | | 1356 1356 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
goes_east_10km | proj=geos sweep=x lon_0=-75 h=35786023 ellps=GRS80 | | 1085 1085 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
goes_west_1km | proj=geos sweep=x lon_0=-137 h=35786023 ellps=GRS80 | | 10848 10848 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
goes_west_4km | proj=geos sweep=x lon_0=-137 h=35786023 ellps=GRS80 | | 2712 2712 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
goes_west_8km | proj=geos sweep=x lon_0=-137 h=35786023 ellps=GRS80 | | 1356 1356 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
goes_west_10km | proj=geos sweep=x lon_0=-137 h=35786023 ellps=GRS80 | | 1085 1085 | -5434894.885056 -5434894.885056 5434894.885056 5434894.885056
dwd_germany | proj=stere lat_0=90 lat_ts=60 lon_0=10 R=6370000 | 400 400 | 3000 4000 | -2.003740084625484 56.00135806882267
australia | proj=merc a=6378137 b=6378137 lat_0=-30 lon_0=140 | 1015.9 1015.9 | 7700 7700 | 104.99543700751434 5.004545613141294
australia2 | proj=merc a=6378137 b=6378137 lat_0=-30 lon_0=140 | 7111.3 7111.3 | 1100 1100 | 104.96805905260021 5.031818627822129
211e | proj=lcc lat_1=25 lat_0=25 lon_0=-95 R=6371200 | 1015.9 1015.9 | 5120 5120 | -123.05258626573237 59.846816693862834
211e_10km | proj=lcc lat_1=25 lat_0=25 lon_0=-95 R=6371200 | 10159 10159 | 512 512 | -123.12989462094596 59.87214916199132
211e_hi | proj=lcc lat_1=25 lat_0=25 lon_0=-95 R=6371200 | 500 500 | 10000 10000 | -123.0482258516551 59.845386354052366
211w | proj=lcc lat_1=25 lat_0=25 lon_0=-95 R=6371200 | 1015.9 1015.9 | 4400 5120 | -152.86393178548968 54.537942379826546
211w_10km | proj=lcc lat_1=25 lat_0=25 lon_0=-95 R=6371200 | 10159 10159 | 440 512 | -152.94433769937515 54.55540643325579
203 | proj=stere lat_0=90 lat_ts=60 lon_0=-150 R=6371200 | 1000 1000 | 8384 7239 | 115.59569294357532 44.64159430957093
203_10km | proj=stere lat_0=90 lat_ts=60 lon_0=-150 R=6371200 | 10000 10000 | 838 724 | 115.54798101590025 44.601933749094634
204 | proj=merc lat_ts=20 lon_0=-180 R=6371200 | 1038.964 1038.964 | 14168 10318 | 109.99502851559393 60.64643710133693
204_10km | proj=merc lat_ts=20 lon_0=-180 R=6371200 | 10389.64 10389.64 | 1417 1032 | 109.9502851559393 60.668362720666025
205 | proj=stere lat_0=90 lat_ts=60 lon_0=-60 R=6371200 | 999.76145 999.76145 | 8384 7240 | -115.31061516849354 36.25602988653891
210 | proj=merc lat_ts=20 lon_0=-77 R=6371200 | 1041.66 1041.66 | 1920 1920 | -77.00498438487419 26.426463634448158
"""


def parse_projection(text: str) -> dict:
    out: dict = {}
    for part in text.split():
        key, _, value = part.lstrip("+").partition("=")
        try:
            out[key] = float(value) if key not in ("proj", "sweep", "ellps", "datum", "units") else value
        except ValueError:
            out[key] = value
    return out


def grid_rows() -> list[dict]:
    """One dictionary a grid; dynamic grids have no size and no extent."""
    rows = []
    for k, line in enumerate(GRIDS.strip().splitlines()):
        name, proj, *more = (x.strip() for x in line.split("|"))
        parts = [[float(x) for x in m.split()] for m in more] + [[]] * (3 - len(more))
        res, size, corner = parts
        row = {"area_id": name, "proj": proj, "dx": res[0] if res else None, "dy": res[1] if res else None, "width": int(size[0]) if size else None, "height": int(size[1]) if size else None}
        row |= dict(zip(("ul_lon", "ul_lat"), corner if len(corner) == 2 else (None, None), strict=True))
        row |= dict(zip(("x_min", "y_min", "x_max", "y_max"), corner if len(corner) == 4 else (None,) * 4, strict=True))
        rows.append(row | {"load_order": k})
    return rows
