"""Table schemas, keys and lookup rows of the racing warehouse (fixed values: names, types, seeds)."""

from __future__ import annotations

from pyspark.sql import types as T

VECTOR_LENGTH = 384

# The seven tabular files per session, each ``{dataset}_{session_id}.csv``.
DATASETS = ("laps", "results", "weather", "telemetry", "race_control_messages", "track_status", "session_status")

TABLES = {
    "dim_event": "event_id bigint, session_id string, season int, gp_name string, gp_slug string, session_code string, "
    "session_name string, circuit_name string, country_code string, country_name string, session_start_ts timestamp_ntz",
    "dim_driver": "driver_id bigint, driver_code string, driver_number int, full_name string, first_name string, "
    "last_name string, country_code string",
    "dim_team": "team_id bigint, team_name string, team_code string, team_color string",
    "bridge_driver_team": "event_id bigint, driver_id bigint, team_id bigint",
    "dim_compound": "compound_id bigint, compound_name string, compound_type string",
    "dim_result_status": "status_id bigint, status_name string, is_classified int",
    "fact_result": "event_id bigint, driver_id bigint, grid_position int, final_position int, classified_position int, "
    "points decimal(5,2), status_id bigint, laps_completed int, total_time_sec decimal(12,3), q1_time_sec decimal(12,6), "
    "q2_time_sec decimal(12,6), q3_time_sec decimal(12,6)",
    "fact_lap": "event_id bigint, driver_id bigint, lap_number int, lap_time_sec decimal(12,6), sector1_sec decimal(12,6), "
    "sector2_sec decimal(12,6), sector3_sec decimal(12,6), stint_number int, compound_id bigint, tyre_life int, fresh_tyre int, "
    "is_personal_best int, is_accurate int, position int, pit_in_time_sec decimal(12,6), pit_out_time_sec decimal(12,6), "
    "track_status_code int, speed_i1 decimal(6,1), speed_i2 decimal(6,1), speed_fl decimal(6,1), speed_st decimal(6,1), "
    "lap_start_time_sec decimal(14,6)",
    "fact_telemetry": "event_id bigint, driver_id bigint, sample_ts timestamp_ntz, session_time_sec decimal(14,6), "
    "speed decimal(6,2), rpm decimal(8,2), n_gear int, throttle decimal(5,2), brake int, drs int, x decimal(12,4), "
    "y decimal(12,4), z decimal(12,4), distance decimal(14,6)",
    "fact_weather": "event_id bigint, time_sec decimal(14,6), air_temp decimal(5,2), track_temp decimal(5,2), "
    "humidity decimal(5,2), pressure decimal(8,2), wind_speed decimal(5,2), wind_direction decimal(5,1), rainfall int",
    "fact_track_status": "event_id bigint, time_sec decimal(14,6), status_code int, status_message string",
    "fact_session_status": "event_id bigint, time_sec decimal(14,6), status string",
    "telemetry_spatial": "event_id bigint, driver_id bigint, session_time_sec decimal(14,6), x double, y double, "
    "speed decimal(6,2), throttle decimal(5,2), brake int",
    "f1_raw_documents": "doc_id bigint, doc_type string, event_id bigint, driver_id bigint, payload string",
    "f1_messages": "event_id bigint, msg_id bigint, msg_ts timestamp_ntz, msg_time_sec decimal(14,6), category string, "
    "flag string, scope string, message_text string, embedding array<float>",
}

# Lookup tables outlive a full refresh; everything else is rebuilt.
LOOKUPS = ("dim_compound", "dim_result_status")

# Facts are laid out per event.
PARTITIONED = tuple(t for t in TABLES if t.startswith(("fact_", "f1_", "telemetry_")))

PRIMARY_KEYS = {
    "dim_event": ("event_id",),
    "dim_driver": ("driver_id",),
    "dim_team": ("team_id",),
    "dim_compound": ("compound_id",),
    "dim_result_status": ("status_id",),
    "bridge_driver_team": ("event_id", "driver_id"),
    "fact_result": ("event_id", "driver_id"),
    "fact_lap": ("event_id", "driver_id", "lap_number"),
    "fact_telemetry": ("event_id", "driver_id", "session_time_sec"),
    "fact_weather": ("event_id", "time_sec"),
    "fact_track_status": ("event_id", "time_sec"),
    "fact_session_status": ("event_id", "time_sec"),
    "telemetry_spatial": ("event_id", "driver_id", "session_time_sec"),
    "f1_raw_documents": ("doc_id",),
    "f1_messages": ("msg_id",),
}

UNIQUE_KEYS = {
    "dim_event": ("session_id",),
    "dim_driver": ("driver_code",),
    "dim_team": ("team_code",),
    "dim_compound": ("compound_name",),
    "dim_result_status": ("status_name",),
}

REQUIRED = {
    "dim_event": ("session_id", "season", "gp_name", "gp_slug", "session_code"),
    "dim_driver": ("driver_code",),
    "dim_team": ("team_name",),
    "dim_compound": ("compound_name",),
    "dim_result_status": ("status_name",),
    "f1_raw_documents": ("doc_type",),
    "f1_messages": ("event_id",),
}

_EVENT = ("event_id", "dim_event", "event_id")
_DRIVER = ("driver_id", "dim_driver", "driver_id")

FOREIGN_KEYS = {
    "bridge_driver_team": (_EVENT, _DRIVER, ("team_id", "dim_team", "team_id")),
    "fact_result": (_EVENT, _DRIVER, ("status_id", "dim_result_status", "status_id")),
    "fact_lap": (_EVENT, _DRIVER, ("compound_id", "dim_compound", "compound_id")),
    "fact_telemetry": (_EVENT, _DRIVER),
    "fact_weather": (_EVENT,),
    "fact_track_status": (_EVENT,),
    "fact_session_status": (_EVENT,),
    "telemetry_spatial": (_EVENT, _DRIVER),
    "f1_raw_documents": (_EVENT, _DRIVER),
    "f1_messages": (_EVENT,),
}

COMPOUNDS = (
    ("SOFT", "DRY"),
    ("MEDIUM", "DRY"),
    ("HARD", "DRY"),
    ("INTERMEDIATE", "WET"),
    ("WET", "WET"),
    ("HYPERSOFT", "DRY"),
    ("ULTRASOFT", "DRY"),
    ("SUPERSOFT", "DRY"),
    ("UNKNOWN", "OTHER"),
)

STATUSES = (
    ("Finished", 1),
    ("+1 Lap", 1),
    ("+2 Laps", 1),
    ("Collision", 0),
    ("Accident", 0),
    ("Retired", 0),
    ("Engine", 0),
    ("Gearbox", 0),
    ("Hydraulics", 0),
    ("Brakes", 0),
    ("Suspension", 0),
    ("Electrical", 0),
    ("Spun off", 0),
    ("Collision damage", 0),
    ("Power Unit", 0),
    ("Disqualified", 0),
    ("Excluded", 0),
    ("Not classified", 0),
)

# Circuit map settings: anchor, rotation in degrees, degrees per coordinate unit.
CIRCUITS = (
    ("Singapore", 1.2910, 103.8634, 0.0, 0.000000899),
    ("Monaco", 43.7347, 7.4206, 0.0, 0.000000899),
)

# First matching prefix gives the kind of a table.
TABLE_KINDS = (
    ("dim_", "Dimension"),
    ("fact_", "Fact"),
    ("bridge_", "Bridge"),
    ("f1_raw", "JSON"),
    ("f1_messages", "Vector"),
    ("telemetry_spatial", "Spatial"),
)


def struct(table: str) -> T.StructType:
    """The schema of one table."""
    return T._parse_datatype_string(TABLES[table])
