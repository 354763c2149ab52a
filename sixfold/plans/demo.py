"""The demo reports over the warehouse tables: the operators' numbers with the names, the order and the number of rows of a report.

Each takes the tables by name, as ``views`` does. Names are joined to aggregates or to the rows that are left, so that they do not
travel with the facts. ``k`` is the length of the report; ``None`` gives all rows. Ties are ordered by the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sixfold.operators import graph, spatial, timeseries, vector
from sixfold.operators import relational as rel
from sixfold.plans.views import Tables


def _first(df: DataFrame, order: list[Column | str], k: int | None) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)


def _coded(rows: DataFrame, t: Tables, *more: Column) -> DataFrame:
    """Add the driver's code (and more of the driver's columns)."""
    return rows.join(t["dim_driver"].select("driver_id", "driver_code", *more), "driver_id")


def _with_compound(rows: DataFrame, t: Tables) -> DataFrame:
    return rows.join(t["dim_compound"].select("compound_id", F.col("compound_name").alias("compound")), "compound_id", "left")


def pace_delta(t: Tables, k: int | None = 15) -> DataFrame:
    """Lap time and its change against the valid lap before, by driver, stint and lap."""
    laps = t["fact_lap"].select("event_id", "driver_id", "stint_number", "compound_id", "lap_number", "lap_time_sec", "is_accurate")
    named = _with_compound(_coded(rel.pace_delta(laps), t), t)
    rows = named.select("event_id", "driver_code", "stint_number", "compound", "lap_number", "lap_time_sec", "delta_to_prev")
    return _first(rows, ["driver_code", "stint_number", "lap_number", "event_id"], k)


def consistency_rank(t: Tables, below: float = 120, k: int = 10) -> DataFrame:
    """Drivers by the spread of their valid laps."""
    best = _coded(rel.consistency_rank(t["fact_lap"], below=below, k=k), t, F.col("full_name").alias("driver_name"))
    columns = ["driver_code", "driver_name", "valid_laps", "avg_lap_time", "lap_time_stddev", "consistency_rank"]
    return best.orderBy("consistency_rank", "driver_id").select(*columns)


def heavy_braking(t: Tables, k: int | None = 10) -> DataFrame:
    """Drivers by how often they braked hard."""
    found = timeseries.heavy_braking(t["fact_telemetry"], k=k)
    return _coded(found, t).orderBy(F.col("braking_events").desc(), "driver_id").drop("driver_id")


def session_status(t: Tables) -> DataFrame:
    """Session statuses in the order in which they began."""
    return timeseries.status_by_minute(t["fact_session_status"]).orderBy("time_sec", "event_id")


def near_point(t: Tables, x: float = 850, y: float = 1200, distance: float = 50, k: int | None = 10) -> DataFrame:
    """The first points within a distance of a place."""
    time = ["session_time_sec", "event_id", "driver_id"]
    found = _first(spatial.within_distance(t["telemetry_spatial"], x, y, distance), time, k)
    rounded = {"x": F.round("x", 1), "y": F.round("y", 1)}
    return _coded(found, t).orderBy(*time).withColumns(rounded).select("event_id", "driver_code", "session_time_sec", "speed", "brake", "x", "y")


def sectors(t: Tables, k: int | None = 15) -> DataFrame:
    """Samples and speeds per driver and part of the track."""
    found = _coded(spatial.region_summary(t["telemetry_spatial"], ["driver_id"], spatial.track_sector()), t)
    return _first(found.select("driver_code", "track_sector", "sample_count", "avg_speed", "max_speed"), ["driver_code", "track_sector"], k)


def driver_network(t: Tables, k: int | None = None) -> DataFrame:
    """Drivers, teams and results from the graph, the best places first and drivers without a place last."""
    found = graph.driver_network(graph.racing_graph(t))
    return _first(found, [F.col("final_position").asc_nulls_last(), "driver_code", "team_name", "points"], k)


def message_categories(t: Tables) -> DataFrame:
    """Messages with a vector per category, the largest category first."""
    return vector.category_counts(t["f1_messages"]).orderBy(F.col("cnt").desc(), "category")


def degradation(t: Tables, k: int | None = None) -> DataFrame:
    """Lap time lost since the first lap of the stint, by driver, stint and tyre age."""
    laps = t["fact_lap"].select("event_id", "driver_id", "stint_number", "compound_id", "lap_number", "tyre_life", "lap_time_sec", "is_accurate")
    named = _with_compound(_coded(rel.degradation(laps), t), t)
    rows = named.select("event_id", "driver_code", "stint_number", "compound", "lap_number", "tyre_life", "lap_time", "degradation_from_fresh")
    return _first(rows, ["driver_code", "stint_number", "tyre_life", "event_id", "lap_number"], k)


def life_matrix(t: Tables, widest: int = 25) -> DataFrame:
    """Mean degradation per driver and tyre age up to the oldest tyre (``widest`` at most), the lowest mean first.

    The columns depend on the data: one job finds the oldest tyre, one number, while the plan is built.
    """
    laps = t["fact_lap"].select("event_id", "driver_id", "stint_number", "lap_number", "tyre_life", "lap_time_sec", "is_accurate")
    oldest = laps.where((F.col("is_accurate") == 1) & (F.col("tyre_life") > 0)).agg(F.max("tyre_life")).first()[0]
    matrix = rel.life_matrix(rel.degradation(laps), max_life=min(int(oldest or 0), widest))
    return _coded(matrix, t).orderBy(F.col("mean_degradation").asc_nulls_last(), "driver_id").drop("driver_id")


def distribution(t: Tables, above: float = 90, below: float = 130) -> DataFrame:
    """Lap times per driver and team with names and colour, the most even driver first."""
    teams = t["bridge_driver_team"].select("event_id", "driver_id", "team_id")
    laps = t["fact_lap"].select("event_id", "driver_id", "lap_time_sec", "is_accurate").join(teams, ["event_id", "driver_id"])
    stats = _coded(rel.distribution(laps, ["driver_id", "team_id"], above, below), t, F.col("full_name").alias("driver_name"))
    named = stats.join(t["dim_team"].select("team_id", "team_name", "team_color"), "team_id")
    return named.orderBy(F.col("std").asc_nulls_last(), "driver_id", "team_id").drop("driver_id", "team_id")


def stint_strategy(t: Tables) -> DataFrame:
    """Stints of the drivers with a result, by final position."""
    laps = t["fact_lap"].select("event_id", "driver_id", "stint_number", "compound_id", "lap_number")
    stints = rel.stint_strategy(_with_compound(laps, t))
    placed = _coded(stints.join(t["fact_result"].select("event_id", "driver_id", "final_position"), ["event_id", "driver_id"]), t)
    order = [F.col("final_position").asc_nulls_last(), "stint_number", "event_id", "driver_id", "compound"]
    columns = ["event_id", "driver_code", "final_position", "stint_number", "compound", "start_lap", "end_lap", "laps", "length", "max_lap"]
    return placed.orderBy(*order).select(*columns)


def position_deltas(t: Tables) -> DataFrame:
    """Change of position from lap to lap with the team's colour."""
    laps = t["fact_lap"].select("event_id", "driver_id", "lap_number", "position")
    teams = t["bridge_driver_team"].join(t["dim_team"].select("team_id", "team_color"), "team_id").select("event_id", "driver_id", "team_color")
    named = _coded(rel.position_deltas(laps).join(teams, ["event_id", "driver_id"]), t)
    order = ["driver_code", "event_id", "lap_number"]
    return named.orderBy(*order).select("event_id", "driver_code", "team_color", "lap_number", "position", "position_delta")
