import math
import random

import pytest
from pyspark.sql import functions as F

from sixfold.operators import spatial as sp

POINT = "event_id int, driver_id int, session_time_sec double, x double, y double, speed double, throttle double, brake int"


def test_border_is_inside(spark):
    df = spark.createDataFrame([(0.0, 50.0), (30.0, 40.0), (30.0, 40.001), (-50.0, 0.0), (None, 1.0)], "x double, y double")
    assert sorted(tuple(r) for r in sp.within_distance(df, 0, 0, 50).collect()) == [(-50.0, 0.0), (0.0, 50.0), (30.0, 40.0)]


def test_box_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(0.0, 50.0)], "x double, y double").write.parquet(str(tmp_path / "p"))
    plan = sp.within_distance(spark.read.parquet(str(tmp_path / "p")), 0, 0, 50)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(x,-50.0)" in plan.split("PushedFilters")[1]


def test_regions(spark):
    df = spark.createDataFrame([(1, 900.0, 1100.0, 1.0), (1, 100.0, 600.0, 2.0), (1, 800.0, 1100.0, 3.0), (1, 0.0, 0.0, 5.0)], "driver_id int, x double, y double, speed double")
    got = {r.track_sector: (r.sample_count, r.avg_speed, r.max_speed) for r in sp.region_summary(df, ["driver_id"], sp.track_sector()).collect()}
    assert got == {"SECTOR_1": (1, 1.0, 1.0), "SECTOR_2": (1, 2.0, 2.0), "SECTOR_3": (2, 4.0, 5.0)}


@pytest.mark.parametrize("distance", [3.0, 10.0])
def test_proximity_equals_brute_force(spark, distance):
    rng = random.Random(2)
    rows = [(rng.randrange(2), i, float(rng.randrange(-20, 20)), rng.uniform(-20, 20)) for i in range(120)] + [(0, 500, 10.0, 0.0), (0, 501, 10.0 + distance, 0.0), (0, 502, None, 1.0)]
    df = spark.createDataFrame(rows, "moment int, car int, x double, y double")
    got = {(r.moment, r.car_1, r.car_2) for r in sp.proximity(df, ["moment"], "car", distance).collect()}
    wanted = {
        (a[0], a[1], b[1]) for a in rows for b in rows
        if a[0] == b[0] and a[1] < b[1] and a[2] is not None and b[2] is not None and math.hypot(a[2] - b[2], a[3] - b[3]) <= distance
    }
    assert got == wanted and (0, 500, 501) in got


def test_map_coordinates(spark):
    points = spark.createDataFrame([("Singapore", 100.0, 200.0), ("turned", 100.0, 200.0)], "circuit string, x double, y double")
    extra = spark.createDataFrame([("turned", 10.0, 20.0, 90.0, 0.001)], sp.circuits(spark).schema)
    got = {r.circuit: r for r in sp.to_latlon(points, sp.circuits(spark).unionByName(extra)).collect()}
    assert got["Singapore"].lat == pytest.approx(1.2910 + 200 * 0.000000899) and got["Singapore"].lon == pytest.approx(103.8634 + 100 * 0.000000899)
    assert got["turned"].lat == pytest.approx(10.1) and got["turned"].lon == pytest.approx(19.8)


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0, 100.0), (3.0, 4.0, 200.0), (2.0, 3.0, 150.0)], "lat double, lon double, speed double")
    got = sp.centre_and_ratio(df).orderBy("speed").collect()
    assert [r.ratio for r in got] == [0.0, 0.5, 1.0] and got[0].center_lat == 2.0 and got[0].center_lon == 3.0
    assert [r.ratio for r in sp.centre_and_ratio(df.withColumn("speed", F.lit(7.0))).collect()] == [None] * 3


@pytest.mark.parametrize("hot", [None, 3])
def test_feeds(spark, hot):
    rows = [(1, d, float(i), float(i), 1.0, None if i == 4 else 100.0 + i, None if i == 5 else 50.0, i % 2) for d in (1, 2, 3) for i in range(12)]
    df = spark.createDataFrame(rows, POINT)
    drivers = spark.createDataFrame([(1, "NOR"), (2, "PIA")], "driver_id int, driver_code string")
    track = sp.track_points(df, drivers, stride=5, hot_rows=hot)
    assert sorted((r.driver_code, r.session_time_sec) for r in track.collect()) == [(d, t) for d in ("NOR", "PIA") for t in (0.0, 6.0, 11.0)]
    assert {r.driver_code for r in sp.track_points(df, drivers, ["PIA"], hot_rows=hot).collect()} == {"PIA"}
    every = sp.track_points(df, drivers, stride=1, hot_rows=hot)
    assert sorted(r.session_time_sec for r in sp.braking_points(every.where("driver_code = 'NOR'"), 3, hot_rows=hot).collect()) == [1.0, 7.0]
    trace = sp.speed_trace(df, drivers, ["NOR"], stride=4, hot_rows=hot)
    # Sampled 0, 5 and 9 of the rows with a speed; 5 lacks the throttle.
    assert sorted(r.session_time_sec for r in trace.collect()) == [0.0, 9.0]
