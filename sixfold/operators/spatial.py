"""Planar points: search, regions, proximity, map coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sixfold import schema
from sixfold.operators.ordered import HOT_ROWS, stride_sample


def within_distance(points: DataFrame, x: float, y: float, distance: float) -> DataFrame:
    """Points within a distance (in coordinate units, border included). The bounding box is pushed down to the scan."""
    box = F.col("x").between(x - distance, x + distance) & F.col("y").between(y - distance, y + distance)
    dx, dy = F.col("x") - x, F.col("y") - y
    return points.where(box).where(dx * dx + dy * dy <= distance * distance)


def region(rules: Sequence[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds."""
    chosen = F.lit(otherwise)
    for name, rule in reversed(rules):
        chosen = F.when(rule, F.lit(name)).otherwise(chosen)
    return chosen


def track_sector() -> Column:
    """Three parts of the demo track by coordinates."""
    x, y = F.col("x"), F.col("y")
    return region([("SECTOR_1", (x > 800) & (y > 1000)), ("SECTOR_2", (x < 200) & (y > 500))], "SECTOR_3")


def region_summary(points: DataFrame, by: Sequence[str], rule: Column, out: str = "track_sector") -> DataFrame:
    """Samples, mean and top speed per key and region."""
    return points.groupBy(*by, rule.alias(out)).agg(
        F.count(F.lit(1)).alias("sample_count"), F.round(F.avg("speed"), 1).alias("avg_speed"), F.round(F.max("speed"), 1).alias("max_speed")
    )


def proximity(points: DataFrame, moment: Sequence[str], car: str, distance: float, time: str | None = None) -> DataFrame:
    """Pairs of cars within a distance of each other at one moment, each pair once, with their distance.

    Points are put into square cells as wide as the distance. One side looks into its own cell and four of its neighbours, those that
    lie ahead, so each pair of neighbouring points of a moment meets once.
    """
    cells = {"_cx": F.floor(F.col("x") / distance), "_cy": F.floor(F.col("y") / distance)}
    kept = [car, "x", "y", *([time] if time else [])]
    placed = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumns(cells)
    ahead = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    probes = placed.select(*moment, "_cx", "_cy", F.struct(*kept).alias("_a"), F.explode(ahead).alias("_step")).withColumns(
        {"_cx": F.col("_cx") + F.col("_step.dx"), "_cy": F.col("_cy") + F.col("_step.dy")}
    )
    found = probes.join(placed.select(*moment, "_cx", "_cy", F.struct(*kept).alias("_b")), [*moment, "_cx", "_cy"])
    dx, dy = F.col("_a.x") - F.col("_b.x"), F.col("_a.y") - F.col("_b.y")
    square = dx * dx + dy * dy
    own = (F.col("_step.dx") == 0) & (F.col("_step.dy") == 0)
    rising = F.col(f"_a.{car}") < F.col(f"_b.{car}")
    pairs = found.where(square <= distance * distance).where(rising | (~own & (F.col(f"_a.{car}") > F.col(f"_b.{car}"))))
    one, two = F.when(rising, F.col("_a")).otherwise(F.col("_b")), F.when(rising, F.col("_b")).otherwise(F.col("_a"))
    named = pairs.select(*moment, one.alias("_1"), two.alias("_2"), F.sqrt(square).alias("distance"))
    extra = [F.col(f"_{i}")[time].alias(f"{time}_{i}") for i in (1, 2)] if time else []
    return named.select(*moment, *[F.col(f"_{i}")[car].alias(f"{car}_{i}") for i in (1, 2)], *extra, "distance")


def circuits(spark: SparkSession) -> DataFrame:
    """The known circuit settings as a table."""
    return spark.createDataFrame(
        list(schema.CIRCUITS), "circuit string, anchor_lat double, anchor_lon double, rotation double, scale_factor double"
    )


def to_latlon(points: DataFrame, settings: DataFrame, on: str = "circuit") -> DataFrame:
    """Rotate, scale and shift planar points to latitude and longitude by the settings of their circuit."""
    turn = F.radians("rotation")
    north = F.col("x") * F.sin(turn) + F.col("y") * F.cos(turn)
    east = F.col("x") * F.cos(turn) - F.col("y") * F.sin(turn)
    placed = points.join(settings, on).withColumns(
        {"lat": F.col("anchor_lat") + north * F.col("scale_factor"), "lon": F.col("anchor_lon") + east * F.col("scale_factor")}
    )
    return placed.select(*points.columns, "lat", "lon")


def centre_and_ratio(points: DataFrame, value: str = "speed") -> DataFrame:
    """Mean position of all points, and each value between the smallest (0) and the largest (1); NULL if all are equal."""
    stats = points.agg(
        F.struct(
            F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.min(value).alias("low"), F.max(value).alias("high")
        ).alias("_stats")
    ).scalar()
    v = F.col(value).cast("double")
    low, high = F.col("_stats.low").cast("double"), F.col("_stats.high").cast("double")
    ratio = (v - low) / F.nullif(high - low, F.lit(0.0))
    scaled = points.withColumn("_stats", stats)
    return scaled.select(
        *points.columns, F.col("_stats.lat").alias("center_lat"), F.col("_stats.lon").alias("center_lon"), ratio.alias("ratio")
    )


def track_points(
    spatial: DataFrame, drivers: DataFrame, codes: Sequence[str] | None = None, stride: int = 5, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Every fifth point with a speed per event and driver; missing brake counts as 0."""
    chosen = drivers.select("driver_id", "driver_code")
    if codes:
        chosen = chosen.where(F.col("driver_code").isin(list(codes)))
    located = spatial.where(F.col("speed").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()).join(chosen, "driver_id")
    rows = located.select("event_id", "driver_code", "session_time_sec", "x", "y", "speed", F.coalesce("brake", F.lit(0)).alias("brake"))
    return stride_sample(rows, stride, ["event_id", "driver_code"], ["session_time_sec"], hot_rows)


def braking_points(points: DataFrame, stride: int = 10, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Every tenth braking point per event and driver."""
    return stride_sample(points.where("brake = 1"), stride, ["event_id", "driver_code"], ["session_time_sec"], hot_rows)


def speed_trace(
    spatial: DataFrame, drivers: DataFrame, codes: Sequence[str] | None = None, stride: int = 20, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Every twentieth point per event and driver; points with anything missing are then dropped."""
    chosen = drivers.select("driver_id", "driver_code")
    if codes:
        chosen = chosen.where(F.col("driver_code").isin(list(codes)))
    rows = spatial.where(F.col("speed").isNotNull()).join(chosen, "driver_id")
    rows = rows.select("event_id", "driver_code", "session_time_sec", "x", "y", "speed", "throttle", "brake")
    return stride_sample(rows, stride, ["event_id", "driver_code"], ["session_time_sec"], hot_rows).dropna()
