"""Buckets, as-of joins, gap filling, threshold events, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from sixfold.operators import timeseries as ts
from sixfold.operators.ordered import stride_sample
from sixfold.plans import views
from sixfold.plans.inputs import LAPS, TELEMETRY, WEATHER, table, telemetry, weather

HOUR = 3600


def telemetry_buckets(spark, sf):
    return views.telemetry_buckets(telemetry(spark, sf), HOUR)


def asof_status(spark, sf):
    events = table(spark, sf, "events")
    seen = events.where("event_type IS DISTINCT FROM 'signup'").select("user_id", "event_id", "ts", "value")
    marks = events.where("event_type = 'signup'").select("user_id", "ts", F.col("value").alias("signup_value"))
    return ts.as_of(seen, marks, ["user_id"], "ts", "ts", ["signup_value"])


def weather_timeline(spark, sf):
    events = table(spark, sf, "events")
    tables = {
        "fact_weather": weather(spark, sf),
        "fact_session_status": weather(spark, sf)
        .where("rainfall = 1")
        .select("event_id", "time_sec", F.concat(F.lit("status "), F.col("track_temp").cast("int").cast("string")).alias("status")),
        "dim_event": events.select(F.col("event_type").alias("event_id"), F.upper("event_type").alias("gp_name")).distinct(),
    }
    return views.weather_timeline(tables)


def neighbour_fill(spark, sf):
    return ts.neighbour_fill(weather(spark, sf), ["event_id"], "time_sec", ["air_temp", "track_temp"], step=HOUR)


def forward_fill(spark, sf):
    return ts.forward_fill(weather(spark, sf), ["event_id"], "time_sec", ["air_temp", "track_temp"], step=600)


def weather_correlation(spark, sf):
    events = table(spark, sf, "events").select(
        (F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 7) + 1).alias("event_id"),
        (F.col("ts") - F.lit("2024-01-01").cast("timestamp_ntz")).cast("decimal(14,6)").alias("time_sec"),
        "event_type",
        "value",
    )
    lapped = events.select("event_id", F.col("time_sec").alias("lap_start_time_sec"), F.col("value").cast("decimal(12,6)").alias("lap_time_sec"))
    air = events.where("event_type = 'error'").select("event_id", "time_sec", F.col("value").alias("air_temp"))
    found = ts.weather_correlation(lapped, air, ["air_temp"])
    return found.withColumn("corr_air_temp", F.round("corr_air_temp", 6))


def stride(spark, sf):
    return stride_sample(table(spark, sf, "events").select("user_id", "event_id", "ts", "value"), 10, ["user_id"], ["ts", "event_id"])


def drs_usage(spark, sf):
    return ts.drs_usage(telemetry(spark, sf)).withColumn("open_share", F.round("open_share", 6))


MEANS = "round(avg(air_temp) + 1e-9, 1) AS air_temp, round(avg(track_temp) + 1e-9, 1) AS track_temp"

QUERIES = {
    "telemetry_buckets": (
        telemetry_buckets,
        f"""WITH {TELEMETRY} SELECT event_id, driver_id, (floor(session_time_sec / {HOUR}) * {HOUR})::BIGINT AS time_bucket_sec,
              round(avg(speed) + 1e-9, 1) AS avg_speed, round(max(speed)::DOUBLE + 1e-9, 1) AS max_speed, round(avg(rpm) + 1e-9, 0) AS avg_rpm,
              round(avg(throttle) + 1e-9, 1) AS avg_throttle, sum(brake)::BIGINT AS brake_samples, count(*) AS sample_count
            FROM telemetry GROUP BY ALL""",
    ),
    "asof_status": (
        asof_status,
        """SELECT v.user_id, v.event_id, v.ts, v.value, s.value AS signup_value FROM (SELECT * FROM events WHERE event_type IS DISTINCT FROM 'signup') v
           ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'signup' GROUP BY ALL) s
             ON v.user_id = s.user_id AND v.ts >= s.ts""",
    ),
    "weather_timeline": (
        weather_timeline,
        f"""WITH {WEATHER}, marks AS (SELECT event_id, micros, max('status ' || track_temp::INT) AS status FROM weather WHERE rainfall = 1 GROUP BY ALL)
            SELECT w.event_id, upper(w.event_id) AS gp_name, w.micros / 1000000 AS time_sec, air_temp::DOUBLE AS air_temp, track_temp::DOUBLE AS track_temp,
              humidity::DOUBLE AS humidity, wind_speed::DOUBLE AS wind_speed, rainfall::BIGINT AS rainfall, m.status AS session_status
            FROM weather w ASOF LEFT JOIN marks m ON w.event_id = m.event_id AND w.micros >= m.micros""",
    ),
    "heavy_braking": (
        lambda spark, sf: ts.heavy_braking(telemetry(spark, sf), k=10),
        f"""WITH {TELEMETRY} SELECT driver_id, count(*) AS braking_events, round(avg(speed) + 1e-9, 1) AS avg_speed_at_brake,
              round(max(speed)::DOUBLE + 1e-9, 1) AS max_speed_at_brake FROM telemetry WHERE brake = 1 AND speed > 150
            GROUP BY driver_id ORDER BY count(*) DESC, driver_id LIMIT 10""",
    ),
    "threshold_events": (
        lambda spark, sf: ts.threshold_events(
            table(spark, sf, "events").withColumn("value", F.col("value").cast("decimal(12,6)")),
            ["user_id"], F.col("event_type") == "error", "value", 100, {"count": "n", "avg": "mean", "max": "top"}, k=None,
        ),
        """SELECT user_id, count(*) AS n, round(avg(value::DECIMAL(12,6)) + 1e-9, 1) AS mean, round(max(value) + 1e-9, 1) AS top
           FROM events WHERE event_type = 'error' AND value > 100 GROUP BY user_id""",
    ),
    "weather_by_minute": (
        lambda spark, sf: ts.weather_by_minute(weather(spark, sf), k=None),
        f"""WITH {WEATHER} SELECT event_id, micros / 1000000 AS time_sec, round(micros / 60000000, 0) AS race_minute,
              round(air_temp::DOUBLE + 1e-9, 1) AS air_temp_c, round(track_temp::DOUBLE, 1) AS track_temp_c,
              round(humidity::DOUBLE, 0) AS humidity_pct, rainfall::BIGINT AS rainfall FROM weather WHERE micros > 3400000000""",
    ),
    "status_by_minute": (
        lambda spark, sf: ts.status_by_minute(weather(spark, sf).withColumn("status", F.upper("event_id"))),
        f"""WITH {WEATHER} SELECT event_id, micros / 1000000 AS time_sec, round(micros / 60000000, 1) AS session_minute, upper(event_id) AS status
            FROM weather""",
    ),
    "neighbour_fill": (
        neighbour_fill,
        f"""WITH {WEATHER}, b AS (SELECT event_id, micros // {HOUR}000000 AS bucket, {MEANS} FROM weather GROUP BY ALL),
            g AS (SELECT event_id, unnest(generate_series(min(bucket), max(bucket))) AS bucket FROM b GROUP BY event_id),
            n AS (SELECT g.event_id, g.bucket, air_temp, track_temp, lag(air_temp) OVER w AS a0, lead(air_temp) OVER w AS a1,
                         lag(track_temp) OVER w AS t0, lead(track_temp) OVER w AS t1
                  FROM g LEFT JOIN b USING (event_id, bucket) WINDOW w AS (PARTITION BY g.event_id ORDER BY g.bucket))
            SELECT event_id, bucket, coalesce(air_temp, round((a0 + a1) / 2 + 1e-9, 1)) AS air_temp,
              coalesce(track_temp, round((t0 + t1) / 2 + 1e-9, 1)) AS track_temp, (CASE WHEN air_temp IS NULL THEN 1 ELSE 0 END)::BIGINT AS is_interpolated
            FROM n""",
    ),
    "forward_fill": (
        forward_fill,
        f"""WITH {WEATHER}, b AS (SELECT event_id, micros // 600000000 AS bucket, {MEANS} FROM weather GROUP BY ALL),
            g AS (SELECT event_id, unnest(generate_series(min(bucket), max(bucket))) AS bucket FROM b GROUP BY event_id)
            SELECT g.event_id, g.bucket, last_value(air_temp IGNORE NULLS) OVER w AS air_temp_filled,
              last_value(track_temp IGNORE NULLS) OVER w AS track_temp_filled, CASE WHEN b.bucket IS NULL THEN 'FILLED' ELSE 'ACTUAL' END AS data_source
            FROM g LEFT JOIN b USING (event_id, bucket)
            WINDOW w AS (PARTITION BY g.event_id ORDER BY g.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
    "drs_usage": (
        drs_usage,
        f"""WITH {TELEMETRY} SELECT event_id, driver_id, count(*) AS samples, count(*) FILTER (drs >= 10) AS open_samples,
              round(count(*) FILTER (drs >= 10) / count(*), 6) AS open_share, round(avg(speed) FILTER (drs >= 10) + 1e-9, 1) AS avg_open_speed,
              round((max(speed) FILTER (drs >= 10))::DOUBLE + 1e-9, 1) AS max_open_speed FROM telemetry GROUP BY ALL""",
    ),
    "weather_correlation": (
        weather_correlation,
        f"""WITH {LAPS}, air AS (SELECT date_diff('day', DATE '2024-01-01', ts::DATE) // 7 + 1 AS event_id, ts, max(value) AS air_temp
              FROM events WHERE event_type = 'error' GROUP BY ALL)
            SELECT l.event_id, count(*) AS laps, round(corr(l.lap_time_sec::DOUBLE, a.air_temp), 6) AS corr_air_temp
            FROM laps l ASOF LEFT JOIN air a ON l.event_id = a.event_id AND l.ts >= a.ts GROUP BY l.event_id""",
    ),
    "stride_sample": (
        stride,
        """SELECT user_id, event_id, ts, value FROM events
           QUALIFY (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) % 10 = 0""",
    ),
}
