"""Queries over whole tables against brute force on small fixtures."""

from __future__ import annotations

import datetime

import numpy as np
from pyspark.sql import functions as F

from geogrid.operators import resample
from geogrid.plans.queries import QUERIES
from geogrid.sources import granules


def test_nearest_takes_every_cell(spark, tmp_path):
    kinds = ["view", "click", "purchase"]
    events = [(i, None if i % 11 == 0 else float(i % 97), kinds[i % 3]) for i in range(700)]
    df = spark.createDataFrame(events, "event_id long, value double, event_type string").selectExpr("*", "timestamp_ntz'2024-01-01' as ts")
    df.write.parquet(str(tmp_path / "events.parquet"))
    n = np.arange(700)
    lon, lat = -95 + n % 100 * 0.05 + n // 100 * 0.01, 25 + n // 100 * 0.05 + n % 100 * 0.005

    def points(lon, lat):
        a, b = np.radians(lon), np.radians(lat)
        return np.stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)], axis=1)

    d = 6370997.0 * np.linalg.norm(points(lon + 0.013, lat - 0.004)[:, None] - points(lon, lat)[None], axis=2)
    best = d.argmin(axis=1)
    got = {(r["row"], r["col"]): (r["y"], r["x"], r["distance"]) for r in QUERIES["r14_nearest_index"](spark, str(tmp_path)).collect()}
    want = {(i // 100, i % 100): (best[i] // 100, best[i] % 100, d[i, best[i]]) for i in range(700) if d[i, best[i]] <= 6000}
    assert got.keys() == want.keys() and len(got) == 700
    assert all(got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) < 0.01 for k in want)
    usable = np.array([v is not None and k != "view" for _, v, k in events])
    d[:, ~usable] = np.inf
    best = d.argmin(axis=1)
    got = {(r["row"], r["col"]): r["value"] for r in QUERIES["r3_j5_nearest"](spark, str(tmp_path)).collect()}
    assert got == {(i // 100, i % 100): events[best[i]][1] if d[i, best[i]] <= 6000 else None for i in range(700)}


def test_frames_are_numbered_in_ranges(spark, tmp_path):
    df = spark.range(3000).selectExpr("id * 7919 % 3000 div 2 as pos", "id").selectExpr("if(pos = 5, null, pos) as pos", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = resample.frame_numbers(df)
        tasks = out.groupBy(F.spark_partition_id()).count().count()
        got = sorted((int(r["frame"]), -1 if r["pos"] is None else r["pos"]) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks > 1 and out.columns == ["pos", "id", "frame"]
    assert [n for n, _ in got] == list(range(1, 3001)) and [p for _, p in got] == sorted(p for _, p in got)
    assert resample.frame_numbers(df.limit(0)).count() == 0
    lines = spark.createDataFrame([(i // 4, i % 4, 10.0 * i, 2.0) for i in range(400)], "l_orderkey long, l_linenumber int, l_extendedprice double, l_quantity double")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = QUERIES["r16_w10_frames"](spark, str(tmp_path)).collect()
    assert {(r["y"], r["x"]): r["frame"] for r in rows} == {(i // 4, i % 4): f"{i + 1:03d}" for i in range(400)}


def test_all_granules_and_requests(spark, tmp_path):
    day = datetime.datetime(2024, 3, 1)
    orders = [(i, day + datetime.timedelta(minutes=7 * (i * 37 % 90)), ["1-URGENT", "5-LOW"][i % 2], "PFO"[i % 3]) for i in range(120)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    minute = datetime.timedelta(minutes=1)
    got = sorted(tuple(r) for r in QUERIES["s4_j4_search"](spark, str(tmp_path)).select("rid", "gid", "sat").collect())
    want = [(q, g, g % 5) for q, t, *_ in orders for g, s, *_ in orders if q % 5 == g % 5 and s <= t + 25 * minute and s + 1.5 * minute >= t - 20 * minute]
    assert got == sorted(want)
    got = sorted((r["gid"], r["band"], r["prefix"], r["hour"]) for r in QUERIES["s5_s6_o3_prefixes"](spark, str(tmp_path)).collect())
    bands = [("I01", "VIIRS-I1-SDR"), ("M12", "VIIRS-M12-SDR"), ("GDNBO", "VIIRS-DNB-GEO"), ("DNB", "VIIRS-DNB-SDR")]
    hours = {(g, *bands[g % 4], f"{x:%Y/%m/%d %H}") for g, t, *_ in orders for x in (t - minute, t, t + 1.5 * minute)}
    assert got == sorted(hours)


def test_requests_of_a_crowded_hour_are_sliced(spark, monkeypatch):
    monkeypatch.setattr(granules, "PAIRS_A_TASK", 50, raising=False)
    def times(hour, length):
        at = "timestamp_ntz'2024-03-01 00:00:00' + make_interval(0, 0, 0, 0, cast({} as int), cast(id * 7 % 50 + {} as int)) {}"
        return at.format(hour, 0, "start_time"), at.format(hour, length, "end_time")

    held = spark.range(90).selectExpr("id as gid", "if(id % 10 = 9, null, id % 2) as sat", *times("id % 3 div 2", 20))
    asked = spark.range(200).selectExpr("id as rid", "id % 3 as sat", *times("id % 20 div 19", 15))
    out = granules.search_granules(held, asked, ("sat",))
    assert out.columns == ["gid", "sat", "start_time", "end_time", "r_rid", "r_sat", "r_start_time", "r_end_time"]
    want = asked.alias("q").join(held.alias("g"), F.expr("g.sat = q.sat and g.start_time <= q.end_time and g.end_time >= q.start_time"))
    pairs = sorted(map(tuple, want.select("rid", "gid").collect()))
    assert sorted(map(tuple, out.select("r_rid", "gid").collect())) == pairs
    tasks = [n for (n,) in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(tasks) > 20 and max(tasks) < len(pairs) / 8
    assert granules.search_granules(held.limit(0), asked, ("sat",)).count() == 0
    monkeypatch.setattr(granules, "PAIRS_A_TASK", 5000)
    whole = granules.search_granules(held, asked, ("sat",))
    plan = whole._jdf.queryExecution().executedPlan().toString()
    # Dealt by the number of pairs alone: no further exchange, whose tasks would be joined by their bytes.
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "ENSURE_REQUIREMENTS" not in plan
    assert sorted(map(tuple, whole.select("r_rid", "gid").collect())) == pairs


def test_times_are_counted_before_hours(spark):
    def times(*rows):
        return spark.createDataFrame(rows, "id long, sat int, s string, e string").selectExpr("id", "sat", "cast(s as timestamp_ntz) as start_time", "cast(e as timestamp_ntz) as end_time")

    held = times(*[(i, i % 2, "2024-03-01 00:00:00", "2024-03-01 00:01:30") for i in range(40)], (40, None, "2024-03-01 00:00:00", "2024-03-01 00:01:30"), (41, 0, "2024-02-29 22:50:00", "2024-03-01 00:10:00"))
    spans = [("2024-02-29 23:40:00", "2024-03-01 00:25:00")] * 6 + [("2024-03-01 00:00:00", "2024-03-01 00:59:59.999999"), ("2024-03-01 00:00:00", "2024-03-01 01:00:00"), ("2024-03-01 00:01:00.9", "2024-03-01 00:01:00"), ("2024-03-01 00:01:01", "2024-03-01 00:01:00")]
    asked = times(*[(i, 0, *span) for i, span in enumerate(spans)])
    got = sorted((r["r_id"], r["id"]) for r in granules.search_granules(held, asked, ("sat",)).collect())
    assert got == sorted((q, g) for q in (0, 1, 2, 3, 4, 5, 6, 8) for g in [*range(0, 40, 2), 41])
    met = granules.pairs_by_hour(held, asked.where("id < 6").selectExpr(*[f"{c} as r_{c}" for c in asked.columns]), ("sat",))
    assert sorted((f"{r['__hour']:%d %H}", r["sat"], r["__pairs"]) for r in met.collect()) == [("01 00", 0, 126), ("29 23", 0, 6)]
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    steps = [next((w for w in ("Aggregate", "Generate", "LogicalRDD") if w in line), "") for line in plan.splitlines()]
    # Only distinct times are spread: each side is counted below its rows an hour too.
    assert [w for w in steps if w] == ["Aggregate", "Generate", "Aggregate", "LogicalRDD"] * 2
