"""The demo reports, over tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from sixfold.plans import demo
from sixfold.plans.inputs import LAPS, POINTS, STAR, TELEMETRY, laps, points, star, table, telemetry
from sixfold.plans.registry.relational import VALID


def race(spark, sf):
    """Weeks as events, users as drivers, nations as teams, event types as compounds (``view`` has none), events as laps."""
    lap = laps(spark, sf).withColumns(
        {
            "compound_id": F.ascii("compound").cast("bigint"),
            "position": F.when(F.col("is_accurate") == 1, F.col("source_id") % 20 + 1),
        }
    )
    events, embeddings = table(spark, sf, "events"), table(spark, sf, "embeddings")
    drivers = events.select(F.col("user_id").alias("driver_id")).union(embeddings.select(F.col("vec_id") % 20)).distinct()
    entered = lap.groupBy("event_id", "driver_id").agg(F.nullif(F.count(F.lit(1)) % 20, F.lit(0)).alias("final_position"))
    types = events.select("event_type").distinct().where("event_type <> 'view'")
    return {
        "fact_lap": lap,
        "fact_result": entered,
        "bridge_driver_team": entered.select("event_id", "driver_id", (F.col("driver_id") % 25).alias("team_id")),
        "dim_driver": drivers.select(
            "driver_id",
            F.concat(F.lit("U"), F.col("driver_id").cast("string")).alias("driver_code"),
            F.concat(F.lit("User "), F.col("driver_id").cast("string")).alias("full_name"),
        ),
        "dim_team": star(spark, sf)["dim_team"],
        "dim_compound": types.select(F.ascii("event_type").cast("bigint").alias("compound_id"), F.col("event_type").alias("compound_name")),
        "fact_telemetry": telemetry(spark, sf),
        "telemetry_spatial": points(spark, sf),
        "fact_session_status": events.select(
            F.col("event_id"), (F.unix_micros(F.col("ts").cast("timestamp")) % 86_400_000_000 / 1_000_000).alias("time_sec"), F.col("event_type").alias("status")
        ),
        "f1_messages": embeddings.select(F.nullif(F.col("label").cast("string"), F.lit("0")).alias("category"), "embedding"),
    }


RACE = f"""{LAPS}, fact_lap AS (
  SELECT *, ascii(compound)::BIGINT AS compound_id, CASE WHEN is_accurate = 1 THEN source_id % 20 + 1 END AS position FROM laps),
fact_result AS (SELECT event_id, driver_id, nullif(count(*) % 20, 0) AS final_position FROM fact_lap GROUP BY ALL),
bridge AS (SELECT event_id, driver_id, driver_id % 25 AS team_id FROM fact_result),
dim_driver AS (
  SELECT driver_id, 'U' || driver_id AS driver_code, 'User ' || driver_id AS full_name
  FROM (SELECT user_id AS driver_id FROM events UNION SELECT vec_id % 20 FROM embeddings)),
dim_team AS (SELECT n_nationkey::BIGINT AS team_id, n_name AS team_name, nullif(n_regionkey::VARCHAR, '0') AS team_color FROM nation),
dim_compound AS (
  SELECT DISTINCT ascii(event_type)::BIGINT AS compound_id, event_type AS compound_name FROM events WHERE event_type <> 'view')"""

_NAMED = "JOIN dim_driver USING (driver_id) LEFT JOIN dim_compound USING (compound_id)"
_WORN = f"""{RACE}, worn AS (
  SELECT event_id, driver_id, stint_number, compound_id, lap_number, tyre_life, lap_time_sec,
         lap_time_sec - first_value(lap_time_sec) OVER (PARTITION BY event_id, driver_id, stint_number ORDER BY lap_number) AS lost
  FROM fact_lap WHERE is_accurate = 1 AND tyre_life > 0)"""


def _matrix(spark, sf):
    found = demo.life_matrix(race(spark, sf))
    return found.select("driver_code", *[F.round(F.col(c).cast("double"), 5).alias(c) for c in found.columns if c != "driver_code"])


def _distribution(spark, sf):
    found = demo.distribution(race(spark, sf), above=10, below=130)
    return found.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("mean", "std", "q1", "median", "q3")})


def _near(spark, sf):
    return demo.near_point(race(spark, sf), 0, 0, 500, k=10)


QUERIES = {
    "demo_pace_delta": (
        lambda spark, sf: demo.pace_delta(race(spark, sf)),
        f"""WITH {RACE} SELECT event_id, driver_code, stint_number, compound_name AS compound, lap_number, lap_time_sec::DOUBLE AS lap_time_sec,
              delta::DOUBLE AS delta_to_prev FROM (
              SELECT event_id, driver_id, stint_number, compound_id, lap_number, lap_time_sec,
                     lap_time_sec - lag(lap_time_sec) OVER (PARTITION BY event_id, driver_id, stint_number ORDER BY lap_number) AS delta
              FROM fact_lap WHERE {VALID}) {_NAMED} ORDER BY driver_code, stint_number, lap_number, event_id LIMIT 15""",
    ),
    "demo_consistency_rank": (
        lambda spark, sf: demo.consistency_rank(race(spark, sf)),
        f"""WITH {RACE}, spread AS (
              SELECT driver_id, count(*) AS valid_laps, round(avg(lap_time_sec) + 1e-9, 3) AS avg_lap_time,
                     CASE WHEN count(*) = 1 THEN 0 ELSE stddev_samp(lap_time_sec::DOUBLE) END AS s
              FROM fact_lap WHERE {VALID} AND lap_time_sec < 120 GROUP BY driver_id)
            SELECT driver_code, full_name AS driver_name, valid_laps, avg_lap_time, round(s, 4) AS lap_time_stddev,
                   rank() OVER (ORDER BY s) AS consistency_rank
            FROM spread JOIN dim_driver USING (driver_id) ORDER BY s, driver_id LIMIT 10""",
    ),
    "demo_heavy_braking": (
        lambda spark, sf: demo.heavy_braking(race(spark, sf)),
        f"""WITH {RACE}, {TELEMETRY} SELECT driver_code, count(*) AS braking_events, round(avg(speed) + 1e-9, 1) AS avg_speed_at_brake,
              round(max(speed), 1)::DOUBLE AS max_speed_at_brake
            FROM telemetry JOIN dim_driver USING (driver_id) WHERE brake = 1 AND speed > 150 GROUP BY driver_id, driver_code
            ORDER BY count(*) DESC, driver_id LIMIT 10""",
    ),
    "demo_session_status": (
        lambda spark, sf: demo.session_status(race(spark, sf)),
        """SELECT event_id, seconds AS time_sec, round(seconds / 60, 1) AS session_minute, event_type AS status
           FROM (SELECT *, epoch_us(ts) % 86400000000 / 1000000 AS seconds FROM events)""",
    ),
    "demo_near_point": (
        _near,
        f"""WITH {RACE}, {POINTS} SELECT event_id, driver_code, session_time_sec, speed::DOUBLE AS speed, brake::BIGINT AS brake,
              round(x, 1) AS x, round(y, 1) AS y
            FROM points JOIN dim_driver USING (driver_id) WHERE x * x + y * y <= 250000
            ORDER BY session_time_sec, event_id, driver_id LIMIT 10""",
    ),
    "demo_sectors": (
        lambda spark, sf: demo.sectors(race(spark, sf)),
        f"""WITH {RACE}, {POINTS} SELECT driver_code, CASE WHEN x > 800 AND y > 1000 THEN 'SECTOR_1' WHEN x < 200 AND y > 500 THEN 'SECTOR_2'
              ELSE 'SECTOR_3' END AS track_sector, count(*) AS sample_count, round(avg(speed) + 1e-9, 1) AS avg_speed,
              round(max(speed), 1)::DOUBLE AS max_speed
            FROM points JOIN dim_driver USING (driver_id) GROUP BY driver_id, driver_code, track_sector ORDER BY driver_code, track_sector LIMIT 15""",
    ),
    "demo_network": (
        lambda spark, sf: demo.driver_network(star(spark, sf), k=20),
        f"""WITH {STAR} SELECT driver_code, full_name AS driver_name, team_name, final_position, points FROM bridge_driver_team
            JOIN fact_result USING (event_id, driver_id) JOIN dim_driver USING (driver_id) JOIN dim_team USING (team_id)
            ORDER BY final_position NULLS LAST, driver_code, team_name, points LIMIT 20""",
    ),
    "demo_categories": (
        lambda spark, sf: demo.message_categories(race(spark, sf)),
        """SELECT coalesce(nullif(label::VARCHAR, '0'), 'Unknown') AS category, count(*) AS cnt, (SELECT count(*) FROM embeddings) AS total
           FROM embeddings GROUP BY 1""",
    ),
    "demo_degradation": (
        lambda spark, sf: demo.degradation(race(spark, sf)),
        f"""WITH {_WORN} SELECT event_id, driver_code, stint_number, compound_name AS compound, lap_number, tyre_life,
              lap_time_sec::DOUBLE AS lap_time, lost::DOUBLE AS degradation_from_fresh FROM worn {_NAMED}""",
    ),
    "demo_life_matrix": (
        _matrix,
        f"""WITH {_WORN} SELECT driver_code, round(avg(lost), 5) AS mean_degradation,
              {", ".join(f"round(avg(lost) FILTER (tyre_life = {n}), 5) AS life_{n}" for n in range(1, 11))}
            FROM worn JOIN dim_driver USING (driver_id) GROUP BY driver_id, driver_code""",
    ),
    "demo_distribution": (
        _distribution,
        f"""WITH {RACE} SELECT driver_code, full_name AS driver_name, team_name, team_color, round(avg(lap_time_sec), 6) AS mean,
              round(stddev_samp(lap_time_sec::DOUBLE), 6) AS std, min(lap_time_sec)::DOUBLE AS low, max(lap_time_sec)::DOUBLE AS high,
              count(*) AS "count", round(quantile_cont(lap_time_sec::DOUBLE, 0.25), 6) AS q1,
              round(quantile_cont(lap_time_sec::DOUBLE, 0.5), 6) AS median, round(quantile_cont(lap_time_sec::DOUBLE, 0.75), 6) AS q3
            FROM fact_lap JOIN bridge USING (event_id, driver_id) JOIN dim_driver USING (driver_id) JOIN dim_team USING (team_id)
            WHERE is_accurate = 1 AND lap_time_sec > 10 AND lap_time_sec < 130 GROUP BY driver_id, driver_code, full_name, team_name, team_color""",
    ),
    "demo_stint_strategy": (
        lambda spark, sf: demo.stint_strategy(race(spark, sf)),
        f"""WITH {RACE} SELECT event_id, driver_code, final_position, stint_number, coalesce(compound_name, 'MEDIUM') AS compound,
              min(lap_number) AS start_lap, max(lap_number) AS end_lap, count(*) AS laps, max(lap_number) - min(lap_number) + 1 AS length,
              (SELECT max(lap_number) FROM fact_lap) AS max_lap
            FROM fact_lap JOIN fact_result USING (event_id, driver_id) {_NAMED} GROUP BY ALL""",
    ),
    "demo_position_deltas": (
        lambda spark, sf: demo.position_deltas(race(spark, sf)),
        f"""WITH {RACE} SELECT event_id, driver_code, team_color, lap_number, position,
              position - lag(position) OVER (PARTITION BY event_id, driver_id ORDER BY lap_number) AS position_delta
            FROM fact_lap JOIN bridge USING (event_id, driver_id) JOIN dim_driver USING (driver_id) JOIN dim_team USING (team_id)
            WHERE position IS NOT NULL""",
    ),
}
