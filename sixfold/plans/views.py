"""The seven views over the warehouse tables. Each takes the tables by name and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sixfold.functions.columns import truncated
from sixfold.operators.documents import json_fields
from sixfold.operators.graph import unordered_pairs
from sixfold.operators.relational import stint_summary as summarise_stints
from sixfold.operators.timeseries import as_of

Tables = Mapping[str, DataFrame]

# Dimension joins carry no broadcast hint: Spark measures the dimension and broadcasts it only while it is small; beyond that
# it sorts and merges, and splits skewed keys at run time.


def with_team(rows: DataFrame, t: Tables) -> DataFrame:
    """Add event, driver and team columns to rows keyed by event_id and driver_id; rows without a team are dropped."""
    event = t["dim_event"].select("event_id", "session_id", "season", "gp_name", "session_code", "session_name", "circuit_name")
    driver = t["dim_driver"].select("driver_id", "driver_code", "driver_number", F.col("full_name").alias("driver_name"))
    team = t["dim_team"].select("team_id", "team_name", "team_color")
    joined = rows.join(t["bridge_driver_team"].select("event_id", "driver_id", "team_id"), ["event_id", "driver_id"])
    return joined.join(event, "event_id").join(driver, "driver_id").join(team, "team_id")


def driver_event_results(t: Tables) -> DataFrame:
    """Results with driver, team, event and status."""
    status = t["dim_result_status"].select("status_id", F.col("status_name").alias("status"))
    return (
        with_team(t["fact_result"], t)
        .join(status, "status_id", "left")
        .select(
            "event_id", "session_id", "season", "gp_name", "session_code", "session_name", "circuit_name", "driver_id",
            "driver_code", "driver_number", "driver_name", "team_id", "team_name", "team_color", "grid_position",
            "final_position", "points", "status", "laps_completed",
        )
    )


def lap_analysis(t: Tables) -> DataFrame:
    """Laps with driver, team, event and compound."""
    compound = t["dim_compound"].select("compound_id", F.col("compound_name").alias("compound"))
    return (
        with_team(t["fact_lap"], t)
        .join(compound, "compound_id", "left")
        .select(
            "event_id", "session_id", "gp_name", "driver_id", "driver_code", "driver_name", "team_name", "lap_number",
            "lap_time_sec", "sector1_sec", "sector2_sec", "sector3_sec", "stint_number", "compound", "tyre_life", "position",
            "is_personal_best", "is_accurate", "speed_i1", "speed_i2", "speed_fl",
        )
    )


def stint_summary(t: Tables) -> DataFrame:
    """Lap statistics per event, driver, stint and compound."""
    compound = t["dim_compound"].select("compound_id", F.col("compound_name").alias("compound"))
    return summarise_stints(t["fact_lap"].join(compound, "compound_id", "left"))


def telemetry_1sec(t: Tables) -> DataFrame:
    """Telemetry per event, driver and second."""
    return telemetry_buckets(t["fact_telemetry"], 1)


def telemetry_buckets(telemetry: DataFrame, seconds: int) -> DataFrame:
    """Telemetry per event, driver and bucket of the session time (cut towards zero)."""
    bucket = truncated(F.col("session_time_sec") / seconds) * seconds
    return telemetry.groupBy("event_id", "driver_id", bucket.alias("time_bucket_sec")).agg(
        F.round(F.avg("speed"), 1).alias("avg_speed"),
        F.round(F.max("speed"), 1).alias("max_speed"),
        F.round(F.avg("rpm"), 0).alias("avg_rpm"),
        F.round(F.avg("throttle"), 1).alias("avg_throttle"),
        F.sum("brake").alias("brake_samples"),
        F.count(F.lit(1)).alias("sample_count"),
    )


MESSAGE_FIELDS = {
    "msg_time": ("$.Time", "string"),
    "category": ("$.Category", "string"),
    "flag": ("$.Flag", "string"),
    "scope": ("$.Scope", "string"),
    "message_text": ("$.Message", "string"),
    "racing_number": ("$.RacingNumber", "string"),
    "lap": ("$.Lap", "double"),
}


def race_control_messages(t: Tables) -> DataFrame:
    """Fields of the race control documents."""
    documents = t["f1_raw_documents"].where(F.col("doc_type") == "race_control_message")
    fields = json_fields(documents, MESSAGE_FIELDS, keep=["doc_id", "event_id"])
    return fields.join(t["dim_event"].select("event_id", "gp_name"), "event_id").select("doc_id", "event_id", "gp_name", *MESSAGE_FIELDS)


def teammates(t: Tables) -> DataFrame:
    """Driver pairs of one team in one event."""
    pairs = unordered_pairs(t["bridge_driver_team"], ["event_id", "team_id"], "driver_id")
    driver = t["dim_driver"]
    one = driver.select(F.col("driver_id").alias("driver_id_1"), F.col("driver_code").alias("driver1_code"), F.col("full_name").alias("driver1_name"))
    two = driver.select(F.col("driver_id").alias("driver_id_2"), F.col("driver_code").alias("driver2_code"), F.col("full_name").alias("driver2_name"))
    return (
        pairs.join(t["dim_event"].select("event_id", "session_id", "gp_name"), "event_id")
        .join(t["dim_team"].select("team_id", "team_name"), "team_id")
        .join(one, "driver_id_1")
        .join(two, "driver_id_2")
        .select("event_id", "session_id", "gp_name", "team_name", "driver1_code", "driver1_name", "driver2_code", "driver2_name")
    )


def weather_timeline(t: Tables, **options) -> DataFrame:
    """Weather with the latest session status at or before it."""
    weather = t["fact_weather"].select("event_id", "time_sec", "air_temp", "track_temp", "humidity", "wind_speed", "rainfall")
    statuses = t["fact_session_status"].select("event_id", "time_sec", F.col("status").alias("session_status"))
    joined = as_of(weather, statuses, ["event_id"], "time_sec", "time_sec", ["session_status"], **options)
    return joined.join(t["dim_event"].select("event_id", "gp_name"), "event_id").select(
        "event_id", "gp_name", "time_sec", "air_temp", "track_temp", "humidity", "wind_speed", "rainfall", "session_status"
    )


VIEWS = {
    "v_driver_event_results": driver_event_results,
    "v_lap_analysis": lap_analysis,
    "v_stint_summary": stint_summary,
    "v_telemetry_1sec": telemetry_1sec,
    "v_race_control_messages": race_control_messages,
    "v_teammates": teammates,
    "v_weather_timeline": weather_timeline,
}


def register_views(spark: SparkSession, t: Tables) -> list[str]:
    """Make the tables and all seven views available to ``spark.sql``."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(t).createOrReplaceTempView(name)
    return list(VIEWS)
