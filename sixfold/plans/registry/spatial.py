"""Points on the plane and on the map."""

from __future__ import annotations

from pyspark.sql import functions as F

from sixfold.operators import spatial as sp
from sixfold.plans.inputs import POINTS, point_drivers, points


def proximity(spark, sf):
    # One moment is a run of sixteen vectors, so the points compared with each other stay few however many there are.
    moments = points(spark, sf).select(
        F.floor(F.col("session_time_sec") / 16).alias("moment"), (F.col("session_time_sec") % 16).cast("bigint").alias("car"), "x", "y"
    )
    return sp.proximity(moments, ["moment"], "car", 400.0).withColumn("distance", F.round("distance", 6))


def _latlon(spark, sf):
    named = points(spark, sf).withColumn("circuit", F.when(F.col("event_id") % 2 == 0, "Singapore").otherwise("Monaco"))
    return sp.to_latlon(named.select("event_id", "driver_id", "session_time_sec", "circuit", "speed", "x", "y"), sp.circuits(spark))


def latlon(spark, sf):
    return _latlon(spark, sf).withColumns({c: F.round(c, 9) for c in ("lat", "lon")})


def centre_ratio(spark, sf):
    found = sp.centre_and_ratio(_latlon(spark, sf))
    return found.select("session_time_sec", *[F.round(c, 6).alias(c) for c in ("center_lat", "center_lon", "ratio")])


def _track(spark, sf, **options):
    return sp.track_points(points(spark, sf), point_drivers(spark, sf), **options)


SECTOR = "CASE WHEN x > 800 AND y > 1000 THEN 'SECTOR_1' WHEN x < 200 AND y > 500 THEN 'SECTOR_2' ELSE 'SECTOR_3' END"

NUMBERED = """joined AS (SELECT p.*, 'DRIVER' || driver_id AS driver_code FROM points p),
track AS (SELECT event_id, driver_code, session_time_sec, x, y, speed::DOUBLE AS speed, brake::BIGINT AS brake FROM joined
          QUALIFY (row_number() OVER (PARTITION BY event_id, driver_code ORDER BY session_time_sec) - 1) % 2 = 0)"""

LATLON = """placed AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 1.2910 ELSE 43.7347 END + y * 0.000000899::DOUBLE AS lat,
  CASE WHEN event_id % 2 = 0 THEN 103.8634 ELSE 7.4206 END + x * 0.000000899::DOUBLE AS lon FROM points)"""

QUERIES = {
    "within_distance": (
        lambda spark, sf: sp.within_distance(points(spark, sf), 50, 120, 600),
        f"""WITH {POINTS} SELECT event_id, driver_id, session_time_sec, x, y, speed::DOUBLE AS speed, throttle::DOUBLE AS throttle, brake::BIGINT AS brake
            FROM points WHERE (x - 50) * (x - 50) + (y - 120) * (y - 120) <= 360000""",
    ),
    "regions": (
        lambda spark, sf: sp.region_summary(points(spark, sf), ["driver_id"], sp.track_sector()),
        f"""WITH {POINTS} SELECT driver_id, {SECTOR} AS track_sector, count(*) AS sample_count, round(avg(speed) + 1e-9, 1) AS avg_speed,
              round(max(speed)::DOUBLE + 1e-9, 1) AS max_speed FROM points GROUP BY ALL""",
    ),
    "proximity": (
        proximity,
        f"""WITH {POINTS}, m AS (SELECT vec_id // 16 AS moment, vec_id % 16 AS car, x, y FROM points)
            SELECT moment, a.car AS car_1, b.car AS car_2, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS distance
            FROM m a JOIN m b USING (moment) WHERE a.car < b.car AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 160000""",
    ),
    "latlon": (
        latlon,
        f"""WITH {POINTS}, {LATLON} SELECT event_id, driver_id, session_time_sec, CASE WHEN event_id % 2 = 0 THEN 'Singapore' ELSE 'Monaco' END AS circuit,
              speed::DOUBLE AS speed, x, y, round(lat, 9) AS lat, round(lon, 9) AS lon FROM placed""",
    ),
    "centre_ratio": (
        centre_ratio,
        f"""WITH {POINTS}, {LATLON}, s AS (SELECT avg(lat) AS a, avg(lon) AS o, min(speed)::DOUBLE AS low, max(speed)::DOUBLE AS high FROM placed)
            SELECT session_time_sec, round(a, 6) AS center_lat, round(o, 6) AS center_lon, round((speed::DOUBLE - low) / nullif(high - low, 0), 6) AS ratio
            FROM placed, s""",
    ),
    "track_points": (lambda spark, sf: _track(spark, sf, stride=2), f"WITH {POINTS}, {NUMBERED} SELECT * FROM track"),
    "braking_points": (
        lambda spark, sf: sp.braking_points(_track(spark, sf, stride=2), stride=3),
        f"""WITH {POINTS}, {NUMBERED} SELECT * FROM track WHERE brake = 1
            QUALIFY (row_number() OVER (PARTITION BY event_id, driver_code ORDER BY session_time_sec) - 1) % 3 = 0""",
    ),
    "speed_trace": (
        lambda spark, sf: sp.speed_trace(points(spark, sf), point_drivers(spark, sf), stride=2),
        f"""WITH {POINTS}, {NUMBERED} SELECT event_id, driver_code, session_time_sec, x, y, speed::DOUBLE AS speed, throttle::DOUBLE AS throttle,
              brake::BIGINT AS brake FROM joined
            QUALIFY (row_number() OVER (PARTITION BY event_id, driver_code ORDER BY session_time_sec) - 1) % 2 = 0""",
    ),
}

#: Earlier names of the same queries.
QUERIES |= {f"{name}_all": QUERIES[name] for name in ("track_points", "braking_points", "speed_trace")}
