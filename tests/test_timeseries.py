import random

import pytest
from pyspark.sql import functions as F

from sixfold.operators import timeseries as ts


@pytest.mark.parametrize("hot", [None, 5])
def test_as_of_equals_correlated_lookup(spark, hot):
    rng = random.Random(7)
    left = [(rng.choice([1, 1, 1, 2, None]), rng.choice([float(rng.randrange(40)), None]), i) for i in range(200)]
    right = [(rng.choice([1, 1, 2, 3]), float(rng.randrange(40)), rng.choice(["x", "y", None, "z"])) for _ in range(80)]
    l = spark.createDataFrame(left, "k int, t double, id int")
    r = spark.createDataFrame(right, "k int, t double, status string")
    got = {row.id: row.status for row in ts.as_of(l, r, ["k"], "t", "t", ["status"], hot_rows=hot).collect()}
    wanted = {}
    for k, t, i in left:
        before = [x for x in right if t is not None and x[0] == k and x[1] <= t]
        latest = max((x[1] for x in before), default=None)
        names = [x[2] for x in before if x[1] == latest and x[2] is not None]
        wanted[i] = max(names) if names else None
    assert got == wanted


def test_as_of_edges(spark):
    weather = spark.createDataFrame([(1, 5.0), (1, 10.0), (1, 12.0), (2, 99.0)], "event_id int, time_sec double")
    status = spark.createDataFrame([(1, 10.0, "Started"), (1, 10.0, "Aborted")], "event_id int, time_sec double, status string")
    got = ts.as_of(weather, status, ["event_id"], "time_sec", "time_sec", ["status"]).orderBy("event_id", "time_sec").collect()
    assert [r.status for r in got] == [None, "Started", "Started", None]


def minutes(spark, per_event):
    rows = [(e, 60.0 * m + 5, v, v + 10) for e, ms in per_event.items() for m, v in ms.items()]
    return spark.createDataFrame(rows, "event_id int, time_sec double, air double, track double")


def test_neighbour_fill(spark):
    df = minutes(spark, {1: {57: 20.0, 59: 21.0, 60: 22.0, 63: 30.0}, 2: {58: 1.0}})
    got = {(r.event_id, r.bucket): (r.air, r.track, r.is_interpolated) for r in ts.neighbour_fill(df, ["event_id"], "time_sec", ["air", "track"], 57, 62).collect()}
    assert len(got) == 12
    assert got[1, 57] == (20.0, 30.0, 0)
    assert got[1, 58] == (20.5, 30.5, 1)
    assert got[1, 61] == (None, None, 1) and got[1, 62] == (None, None, 1)
    assert got[2, 58] == (1.0, 11.0, 0) and got[2, 57] == (None, None, 1) and got[2, 59] == (None, None, 1)


def test_neighbour_fill_uses_original_values_only(spark):
    # 58 and 59 are both missing: neither may be filled from the other.
    df = minutes(spark, {1: {57: 20.0, 60: 26.0}})
    got = {r.bucket: r.air for r in ts.neighbour_fill(df, ["event_id"], "time_sec", ["air"], 57, 60).collect()}
    assert got == {57: 20.0, 58: None, 59: None, 60: 26.0}


@pytest.mark.parametrize("hot", [None, 2])
def test_forward_fill(spark, hot):
    rows = [(1, 95.0, 20.0), (1, 100.0, 21.0), (1, 290.0, None), (1, 360.0, 25.0), (2, 10.0, 5.0)]
    df = spark.createDataFrame(rows, "event_id int, time_sec double, air double")
    got = ts.forward_fill(df, ["event_id"], "time_sec", ["air"], hot_rows=hot).orderBy("event_id", "bucket").collect()
    assert [(r.event_id, r.bucket, r.air_filled, r.data_source) for r in got] == [
        (1, 1, 20.5, "ACTUAL"), (1, 2, 20.5, "FILLED"), (1, 3, 20.5, "FILLED"), (1, 4, 20.5, "ACTUAL"), (1, 5, 20.5, "FILLED"), (1, 6, 25.0, "ACTUAL"),
        (2, 0, 5.0, "ACTUAL"),
    ]
    few = ts.forward_fill(df, ["event_id"], "time_sec", ["air"], max_points=3, hot_rows=hot)
    assert sorted((r.event_id, r.bucket) for r in few.collect()) == [(1, 1), (1, 2), (1, 3), (2, 0)]


def test_long_range_grows_in_steps(spark):
    df = spark.createDataFrame([(1, -3, 5000), (2, 7, 7), (3, 5, 4)], "k int, a bigint, b bigint")
    got = ts.explode_range(df, F.col("a"), F.col("b"), "n").groupBy("k").agg(F.count("n"), F.min("n"), F.max("n"), F.count_distinct("n"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5004, -3, 5000, 5004), (2, 1, 7, 7, 1)]


def test_braking_and_wings(spark):
    rows = [(1, 1, 1, 151.0, 12), (1, 1, 1, 150.0, 0), (1, 1, 0, 300.0, 10), (1, 2, 1, 200.0, 8), (1, 2, 1, 210.0, 8)]
    df = spark.createDataFrame(rows, "event_id int, driver_id int, brake int, speed double, drs int")
    assert [(r.driver_id, r.braking_events, r.max_speed_at_brake) for r in ts.heavy_braking(df).collect()] == [(2, 2, 210.0), (1, 1, 151.0)]
    used = {r.driver_id: (r.open_samples, r.max_open_speed) for r in ts.drs_usage(df).collect()}
    assert used == {1: (2, 300.0), 2: (0, None)}


def test_minutes(spark):
    df = spark.createDataFrame([(1, 3500.0, 25.25, 40.0, 70.5, 0), (1, 3400.0, 1.0, 1.0, 1.0, 0)], "event_id int, time_sec double, air_temp double, track_temp double, humidity double, rainfall int")
    got = ts.weather_by_minute(df).collect()
    assert [(r.race_minute, r.air_temp_c, r.humidity_pct) for r in got] == [(58.0, 25.3, 71.0)]
    assert ts.status_by_minute(spark.createDataFrame([(1, 90.0, "Started")], "event_id int, time_sec double, status string")).first().session_minute == 1.5


def test_weather_correlation(spark):
    laps = spark.createDataFrame([(1, float(i), 100.0 + i) for i in range(1, 6)], "event_id int, lap_start_time_sec double, lap_time_sec double")
    air = spark.createDataFrame([(1, float(i), 20.0 - i) for i in range(0, 6)], "event_id int, time_sec double, air double")
    got = ts.weather_correlation(laps, air, ["air"]).first()
    assert got.laps == 5 and got.corr_air == pytest.approx(-1.0)
