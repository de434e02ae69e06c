"""Operators against brute force: quantiles, staged search, coverage, tables, colours, streams, flat arrays."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from geogrid.functions import enhance
from geogrid.operators import compare, composites, decide, enhancement, filters, grids, mosaic, products, resample, sinks
from geogrid.sources import builtin_colors, builtin_grids, builtin_products, builtin_rules, flat_binary, granules, shared, tables
from geogrid.streaming import arrivals


@pytest.mark.parametrize("most", [1, 5, 100_000])
def test_exact_quantiles(spark, most):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1, 400), np.full(300, 0.25), [1e6, -1e6]])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "diff double")
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = compare.exact_quantiles(df, "diff", shares, bins=8, most=most)
    assert np.allclose(got, np.quantile(v, shares))
    assert compare.exact_quantiles(df.limit(0), "diff", shares) == [None] * 6


def test_staged_nearest_with_a_radius_of_fifty_spacings(spark):
    rng = np.random.default_rng(5)
    swath = [(y, x, -95 + 0.01 * x, 40 + 0.01 * y, float(y * 40 + x)) for y in range(30) for x in range(40) if not 10 <= y <= 20]
    cells = [(k, 0, float(-95 + rng.uniform(-0.2, 0.6)), float(40 + rng.uniform(-0.2, 0.5))) for k in range(60)]
    s = spark.createDataFrame(swath, "y int, x int, lon double, lat double, value double")
    c = spark.createDataFrame(cells, "row int, col int, lon double, lat double")
    one = {(r["row"], r["y"], r["x"], round(r["distance"], 3)) for r in resample.nearest_index(c, s, 55_000.0).collect()}
    two = {(r["row"], r["y"], r["x"], round(r["distance"], 3)) for r in resample.nearest_index(c, s, 55_000.0, spacing=1100.0).collect()}
    assert one == two and len(one) == 60


def test_coverage_counts_cells(spark):
    hits = spark.createDataFrame([("a", 0, 0), ("a", 0, 0), ("a", 699, 399), ("a", 700, 0), ("b", 5, 5)], "product string, row int, col int")
    got = {r["product"]: r["coverage"] for r in filters.coverage(hits, 400, 700).collect()}
    assert got == {"a": 2 / 280_000, "b": 1 / 280_000}
    assert {r["product"]: r["coverage"] for r in filters.coverage(hits, 400, 700, block=100).collect()} == {"a": 2 / 28, "b": 1 / 28}


def test_small_tables_only(spark):
    assert shared.small(spark.range(5), 5).count() == 5
    with pytest.raises(ValueError):
        shared.small(spark.range(6), 5)


def test_builtin_product_tables(spark):
    defaults = tables.builtin_default_products(spark)
    assert defaults.select("reader").distinct().count() == 28 and defaults.count() == defaults.select("reader", "product").distinct().count()
    assert {tuple(r) for r in tables.builtin_criteria(spark, "viirs_sdr", "night").collect()} == {("standard_name", "temperature_difference")}
    assert tables.builtin_criteria(spark, "aws1_mwr_l1b_nc", "day").count() == 0
    labels = tables.builtin_elements(spark)
    p = spark.createDataFrame([("1", "modis_l1b", "modis"), ("1", "virr_l1b", "virr"), ("RR", "mirs", "atms")], "product string, reader string, sensor string")
    got = {(r["product"], r["reader"]): r["element"] for r in sinks.element_label(p, labels).collect()}
    assert got[("RR", "mirs")] == "MIRS Rain Rate"
    assert len(builtin_products.composite_rows("viirs")) == 29 and len(builtin_products.composite_rows("modis")) == 26


def test_every_builtin_rule_can_be_applied(spark):
    longer = {"IFR_PROB", "LIFR_PROB", "MVFR_PROB", "gridded_data"}  # tables of over 200 rows, read from files
    df = spark.range(3).select(F.col("id").cast("double").alias("v"))
    columns = []
    for row in builtin_rules.enhancement_rows():
        ops = builtin_rules.operations(row["operations"])
        if any(k.get("table") in longer for _, k in ops):
            with pytest.raises(ValueError):
                enhance.apply_operations(F.col("v"), ops, (F.lit(0.0), F.lit(2.0)))
            continue
        columns.append(enhance.apply_operations(F.col("v"), ops, (F.lit(0.0), F.lit(2.0))).alias(row["rule_id"]))
    assert len(df.select(*columns).collect()) == 3 and len(columns) == 133
    for name in longer:
        enhance.register_palette(name, [0, 255], [(0, 0, 0), (255, 255, 255)])
        assert df.select(enhance.METHODS["colorize"](F.col("v"), name, 0.0, 2.0)["r"].alias("r")).collect()[1]["r"] == 127.5
        del enhance.PALETTES[name]


def test_colour_tables():
    for name, (values, colors) in builtin_colors.color_tables().items():
        assert len(values) == len(colors) and values == sorted(values), name
    values, colors = builtin_colors.color_tables()["veg_index_steps"]
    assert len(values) == 30 and values[2] == pytest.approx(0.06001) and colors[2:4] == [(202, 108, 32), (255, 222, 104)]


def test_rainbow_between_its_ends(spark):
    rules = [{"rule_id": "lst", "operations": ["colorize rainbow 0 8"]}, {"rule_id": "plain", "operations": []}]
    px = spark.createDataFrame([("a", 0.5), ("a", 4.0), ("a", 9.0), ("a", None), ("b", 3.0), ("c", 2.0), ("c", 6.0), ("c", 3.0)], "product string, value double")
    chosen = spark.createDataFrame([("a", "lst"), ("b", "plain")], "product string, rule_id string")
    got = [(r["product"], r["value"], r["enhanced"], tuple(r["color"]) if r["color"] else None) for r in enhancement.enhance_pixels(px, chosen, rules).collect()]
    assert set(got) == {("a", 0.5, None, (0, 0, 191.5, 255)), ("a", 4.0, None, (128, 255, 128, 255)), ("a", 9.0, None, (128, 0, 0, 255)), ("a", None, None, None), ("b", 3.0, 3.0, None), ("c", 2.0, 0.0, None), ("c", 6.0, 1.0, None), ("c", 3.0, 0.25, None)}


def test_rule_priorities(spark):
    rules = [("std", {"standard_name": "x"}), ("std_sensor", {"standard_name": "x", "sensor": "s2"}), ("later", {"standard_name": "x", "sensor": "s1"}), ("named", {"name": "p"}), ("other", {"reader": "zzz"})]
    table = spark.createDataFrame([(n, k, i) for i, (n, k) in enumerate(rules)], "rule_id string, keys map<string,string>, load_order int").withColumn("kind", F.lit("k"))
    rows = [("p", "p", ["s1", "s2"], "x"), ("q", "q", ["s1", "s2"], "x"), ("r", "r", ["s3"], "x"), ("t", "t", ["s2"], "y")]
    p = spark.createDataFrame(rows, "product string, name string, sensor array<string>, standard_name string")
    got = {r["product"]: r["rule_id"] for r in decide.decide(p, table).collect()}
    # A name wins over more keys; of as many keys the later rule; a multi-sensor product matches by any sensor.
    assert got == {"p": "named", "q": "later", "r": "std", "t": None}
    with pytest.raises(Exception, match="no rule for product t"):
        decide.require_rules(decide.decide(p, table)).collect()


def test_modifiers_and_optional_inputs(spark):
    df = spark.createDataFrame([(60.0, 10.0, 8.0, 6.0)], "solar_zenith_angle double, M05 double, M04 double, M03 double")
    recipes = composites.builtin_recipes("viirs")
    composites.MODIFIERS.pop("rayleigh_corrected", None)
    assert "true_color" not in composites.available_recipes(spark, df.columns, recipes) and "true_color_raw" in composites.available_recipes(spark, df.columns, recipes)
    composites.register_modifier("rayleigh_corrected", (), lambda v: v - 1)
    got = composites.apply_recipes(df, ["true_color", "true_color_raw", "false_color"], recipes).first()
    assert [round(x, 6) for x in got["true_color"]] == [19, 15, 11] and [round(x, 6) for x in got["true_color_raw"]] == [20, 16, 12]
    assert "false_color" not in got.asDict()


def test_day_night_color(spark):
    df = spark.createDataFrame([(10.0, 1.0, 2.0, 3.0, 9.0), (120.0, 1.0, 2.0, 3.0, 9.0)], "solar_zenith_angle double, r double, g double, b double, C14 double")
    df = df.select("*", composites.rgb(F.col("r"), F.col("g"), F.col("b")).alias("true_color"))
    got = composites.apply_recipes(df, ["true_color_night"], composites.builtin_recipes("abi")).collect()
    assert [tuple(r["true_color_night"]) for r in got] == [(1, 2, 3), (9, 9, 9)]


def test_corner_extents_from_degrees(spark):
    rows = [r for r in builtin_grids.grid_rows() if r["area_id"] in ("211e", "211e_10km", "211e_hi")]
    df = spark.createDataFrame([tuple(r[k] for k in ("area_id", "dx", "dy", "width", "height", "ul_lon", "ul_lat")) for r in rows], "area_id string, dx double, dy double, width int, height int, ul_lon double, ul_lat double")
    got = {r["area_id"]: r for r in grids.corner_extent(df, {"proj": "lcc", "lat_0": 25, "lat_1": 25, "lon_0": -95, "R": 6371200.0}).collect()}
    # Three grids of one area with cells of different size: the same area to half a cell of the coarsest.
    for r in got.values():
        assert r["x_max"] - r["x_min"] == pytest.approx(r["dx"] * r["width"]) and r["y_max"] - r["y_min"] == pytest.approx(r["dy"] * r["height"])
        assert abs(r["x_min"] - got["211e"]["x_min"]) < 10159 and abs(r["y_max"] - got["211e"]["y_max"]) < 10159


def test_stream_keeps_all_batches_of_a_pass(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "store")
    schema = "area_id string, product string, row int, col int, value double"
    for k in range(3):
        spark.createDataFrame([("g", "a", k, 0, float(k)), ("g", "a", 9, 9, None if k == 2 else float(10 + k))], schema).coalesce(1).write.parquet(f"{src}/{k}")
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(src))
    for _ in range(2):  # a second run finds nothing new
        arrivals.append_passes(files, store, str(tmp_path / "c")).awaitTermination(120)
    assert spark.read.parquet(store).count() == 6
    got = {(r["row"], r["value"]) for r in arrivals.latest_pixels(spark, store).collect()}
    assert {(0, 0.0), (1, 1.0), (2, 2.0)} <= got and len(got) == 4


def test_flat_binary_of_many_blocks_and_wrong_sizes(spark, tmp_path):
    a = np.arange(60 * 7, dtype=np.int16).reshape(60, 7)
    a.tofile(tmp_path / "a.bin")
    got = flat_binary.read_flat_binary(spark, str(tmp_path / "a.bin"), 60, 7, "int16").toPandas().sort_values(["y", "x"])
    assert (got["value"].to_numpy() == np.arange(420)).all() and (got["y"].to_numpy() == np.repeat(np.arange(60), 7)).all()
    with pytest.raises(Exception, match="longer than"):
        flat_binary.read_flat_binary(spark, str(tmp_path / "a.bin"), 59, 7, "int16").count()


def test_ewa_with_and_without_kept_weights(spark):
    px = spark.createDataFrame([(y, x, float(x) + 0.3, float(y) + 0.2, float(y * x)) for y in range(6) for x in range(6)], "y int, x int, u double, v double, value double")
    kept = resample.resample_ewa(px, resample.ewa_weights(px, 6, 6))
    direct = resample.resample_ewa(None, resample.ewa_weights(px, 6, 6, carry=("value",)))
    as_map = lambda df: {(r["row"], r["col"]): round(r["value"], 9) for r in df.collect()}
    assert as_map(kept) == as_map(direct) and len(as_map(kept)) == 36


def test_values_without_a_mark(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (-999.0,), (None,)], "value double")
    assert [r["value"] for r in tables.without_missing(df, fill=-999.0).collect()] == [1.0, None, None, None]
    assert [r["m"] for r in df.select(filters.mask_space(F.lit(2.0), F.when(F.col("value") == 1, 1.0)).alias("m")).collect()] == [2.0, None, None, None]
    p = products.select_products(None, spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "product string, pos int"), spark.createDataFrame([("a",)], "product string"))
    assert [tuple(r) for r in p.collect()] == [("a", 1)]


def test_overlay_by_alpha_groups_and_names(spark):
    schema = "row int, col int, r double, g double, b double, a double"
    back = spark.createDataFrame([(0, 0, 100.0, 0.0, 0.0, 255.0), (0, 1, 10.0, 20.0, 30.0, 255.0)], schema)
    front = spark.createDataFrame([(0, 0, 0.0, 200.0, 0.0, 127.5), (0, 2, 7.0, 8.0, 9.0, 255.0)], schema)
    got = {(r["row"], r["col"]): tuple(r)[2:] for r in mosaic.overlay_alpha(back, front).collect()}
    assert got == {(0, 0): (50, 100, 0, 255), (0, 1): (10, 20, 30, 255), (0, 2): (7, 8, 9, 255)}
    df = spark.createDataFrame([("x", "g1"), ("x", "g1"), ("y", "g2")], "group string, area_id string")
    assert sinks.one_grid(df).count() == 3
    with pytest.raises(Exception, match="mixes grids"):
        sinks.one_grid(df.unionByName(spark.createDataFrame([("x", "g3")], df.schema))).collect()
    t = spark.createDataFrame([("p", "npp", ["viirs", "atms"], "2024-01-02 03:04:05")], "product string, platform_name string, sensor array<string>, t string")
    t = t.withColumns({"start_time": F.col("t").cast("timestamp_ntz"), "end_time": F.col("t").cast("timestamp_ntz")})
    assert tuple(sinks.dataset_attributes(t).first()) == ("p", "npp", "atms-viirs", "2024-01-02T03:04:05", "2024-01-02T03:04:05")
    assert t.select(granules.hour_prefix(F.col("start_time"), F.lit("npp"), F.lit("SVM01")).alias("p")).first()["p"] == "npp/SVM01/2024/01/02"
