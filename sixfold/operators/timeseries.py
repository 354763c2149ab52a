"""As-of joins, time grids, gap filling, buckets and threshold events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sixfold.functions.columns import truncated
from sixfold.operators.ordered import HOT_ROWS, with_ordered

GRID_STEP = 1024


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each left row with the right values at the latest time at or before its own (NULL before the first).

    Several right rows at one time: the largest values win. Both sides are laid on one time line per key and the last right row
    is carried forward: one shuffle, no comparison of pairs, and a hot key is cut along time.
    """
    keys, values = list(keys), list(values)
    points = right.where(F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).alias("_time"))
    points = points.agg(*[F.max(v).alias(v) for v in values])
    marks = points.select(*keys, "_time", F.lit(0).alias("_side"), F.struct(*values).alias("_seen"))
    carried = left.select(*keys, F.col(left_time).alias("_time"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    line = marks.unionByName(carried, allowMissingColumns=True)
    # Left rows of one time are all after the right row of that time; their order among themselves is of no account.
    filled = with_ordered(line, keys, ["_time", "_side"], last_seen={"_last": "_seen"}, hot_rows=hot_rows)
    return filled.where("_side = 1").select("_left.*", *[F.col(f"_last.{v}").alias(v) for v in values])


def bucket_averages(df: DataFrame, keys: Sequence[str], time: str, measures: Sequence[str], step: int, digits: int | None = 1) -> DataFrame:
    """Mean of each measure per key and time bucket (``bucket`` counts steps, cut towards zero)."""
    bucket = truncated(F.col(time) / step).alias("bucket")
    return df.groupBy(*keys, bucket).agg(*[_mean(m, digits) for m in measures])


def _mean(measure: str, digits: int | None) -> Column:
    mean = F.avg(measure)
    return (mean if digits is None else F.round(mean, digits)).alias(measure)


def explode_range(df: DataFrame, low: Column, high: Column, out: str) -> DataFrame:
    """One row per whole number from ``low`` to ``high``; long ranges grow in two steps, so no task holds one big array."""
    blocks = df.withColumns({"_low": low.cast("bigint"), "_high": high.cast("bigint")}).where("_low <= _high")
    blocks = blocks.withColumn("_block", F.explode(F.sequence("_low", "_high", F.lit(GRID_STEP).cast("bigint"))))
    end = F.least(F.col("_high"), F.col("_block") + (GRID_STEP - 1))
    return blocks.withColumn(out, F.explode(F.sequence("_block", end))).drop("_low", "_high", "_block")


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    measures: Sequence[str],
    step: int = 60,
    digits: int | None = 1,
    max_points: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """A gapless time line per key from its first to its last bucket; missing measures take the last known value.

    ``data_source`` tells ACTUAL buckets from FILLED ones. ``max_points`` keeps only the first buckets of each key.
    """
    keys = list(keys)
    raw = df.where(F.col(time).isNotNull()).select(*keys, truncated(F.col(time) / step).alias("bucket"), *measures, F.lit(1).alias("_actual"))
    ends = raw.groupBy(*keys).agg(F.min("bucket").alias("_first"), F.max("bucket").alias("_last"))
    last = F.col("_last") if max_points is None else F.least(F.col("_last"), F.col("_first") + (max_points - 1))
    grid = explode_range(ends, F.col("_first"), last, "bucket").select(*keys, "bucket")
    # Grid and samples meet in one aggregate: a bucket of the grid without a sample keeps NULL measures.
    both = raw.unionByName(grid.withColumn("_grid", F.lit(1)), allowMissingColumns=True)
    per_bucket = both.groupBy(*keys, "bucket").agg(
        *[_mean(m, digits) for m in measures], F.max("_actual").alias("_actual"), F.max("_grid").alias("_grid")
    )
    line = per_bucket.where("_grid = 1")
    filled = with_ordered(line, keys, ["bucket"], last_seen={f"{m}_filled": m for m in measures}, hot_rows=hot_rows)
    source = F.when(F.col("_actual") == 1, F.lit("ACTUAL")).otherwise(F.lit("FILLED"))
    return filled.select(*keys, "bucket", *[f"{m}_filled" for m in measures], source.alias("data_source"))


def neighbour_fill(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    measures: Sequence[str],
    low: int | Column | None = None,
    high: int | Column | None = None,
    step: int = 60,
    digits: int = 1,
) -> DataFrame:
    """Buckets ``low .. high`` of every key, by default from its first to its last; a missing measure becomes the mean of the buckets right before and after.

    Only measured neighbours count, and both must be there. ``is_interpolated`` is 1 where the first measure was missing.
    Every bucket offers its means to itself and its two neighbours, so one aggregate does the lookup without any window.
    """
    keys = list(keys)
    means = bucket_averages(df.where(F.col(time).isNotNull()), keys, time, measures, step, digits)
    offers = means.select(*keys, F.posexplode(F.array(F.col("bucket") + 1, F.col("bucket"), F.col("bucket") - 1)).alias("_role", "bucket"), *measures)
    ends = means.groupBy(*keys).agg(F.min("bucket").alias("_low"), F.max("bucket").alias("_high"))
    low, high = (F.col(own) if end is None else F.lit(end) if isinstance(end, int) else end for end, own in ((low, "_low"), (high, "_high")))
    grid = explode_range(ends, low, high, "bucket").select(*keys, "bucket")
    both = offers.unionByName(grid.withColumn("_grid", F.lit(1)), allowMissingColumns=True)

    def offered(measure: str, role: int) -> Column:
        return F.max(F.when(F.col("_role") == role, F.col(measure)))

    per_bucket = both.groupBy(*keys, "bucket").agg(
        F.max("_grid").alias("_grid"),
        *[offered(m, role).alias(f"_{name}_{m}") for m in measures for role, name in enumerate(("before", "own", "after"))],
    )
    filled = {
        m: F.coalesce(F.col(f"_own_{m}"), F.round((F.col(f"_before_{m}") + F.col(f"_after_{m}")) / 2, digits)) for m in measures
    }
    missing = F.col(f"_own_{measures[0]}").isNull().cast("int")
    chosen = per_bucket.where("_grid = 1")
    return chosen.select(*keys, "bucket", *[c.alias(m) for m, c in filled.items()], missing.alias("is_interpolated"))


def threshold_events(
    df: DataFrame, by: Sequence[str], when: Column, value: str, over: float, names: Mapping[str, str] | None = None, k: int | None = 10
) -> DataFrame:
    """Count, mean and maximum of ``value`` above a threshold per key while a condition holds; most events first."""
    names = {"count": "braking_events", "avg": "avg_speed_at_brake", "max": "max_speed_at_brake", **(names or {})}
    found = (
        df.where(when & (F.col(value) > over))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias(names["count"]),
            F.round(F.avg(value), 1).alias(names["avg"]),
            F.round(F.max(value), 1).alias(names["max"]),
        )
    )
    return found if k is None else found.orderBy(F.col(names["count"]).desc(), *by).limit(k)


def heavy_braking(telemetry: DataFrame, by: Sequence[str] = ("driver_id",), k: int | None = 10) -> DataFrame:
    """Braking samples above 150 per driver."""
    return threshold_events(telemetry, by, F.col("brake") == 1, "speed", 150, k=k)


def weather_by_minute(weather: DataFrame, after: float = 3400, k: int | None = 10) -> DataFrame:
    """Rounded weather after a session time, earliest first."""
    later = weather.where(F.col("time_sec") > after)
    if k is not None:
        later = later.orderBy("time_sec", "event_id").limit(k)
    return later.select(
        "event_id",
        "time_sec",
        F.round(F.col("time_sec") / 60, 0).alias("race_minute"),
        F.round("air_temp", 1).alias("air_temp_c"),
        F.round("track_temp", 1).alias("track_temp_c"),
        F.round("humidity", 0).alias("humidity_pct"),
        "rainfall",
    )


def status_by_minute(statuses: DataFrame) -> DataFrame:
    """Session statuses with the minute they began."""
    return statuses.select("event_id", "time_sec", F.round(F.col("time_sec") / 60, 1).alias("session_minute"), "status")


# Fixed value: wing codes from this one on mean an open wing.
DRS_OPEN = 10


def drs_usage(telemetry: DataFrame, by: Sequence[str] = ("event_id", "driver_id")) -> DataFrame:
    """Samples with an open wing, their share and their mean and top speed per driver."""
    is_open = F.col("drs") >= DRS_OPEN
    return telemetry.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(is_open).alias("open_samples"),
        (F.count_if(is_open) / F.count(F.lit(1))).alias("open_share"),
        F.round(F.avg(F.when(is_open, F.col("speed"))), 1).alias("avg_open_speed"),
        F.round(F.max(F.when(is_open, F.col("speed"))), 1).alias("max_open_speed"),
    )


def weather_correlation(
    laps: DataFrame, weather: DataFrame, measures: Sequence[str], by: Sequence[str] = ("event_id",), hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Correlation of lap times with the weather at the lap's time, per event."""
    timed = laps.where(F.col("lap_time_sec").isNotNull() & F.col("lap_start_time_sec").isNotNull())
    timed = timed.select(*by, "lap_start_time_sec", F.col("lap_time_sec").cast("double").alias("lap_time_sec"))
    joined = as_of(timed, weather, list(by), "lap_start_time_sec", "time_sec", list(measures), hot_rows)
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("laps"), *[F.corr("lap_time_sec", F.col(m).cast("double")).alias(f"corr_{m}") for m in measures]
    )
