"""Laps, stints, positions and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sixfold.functions.columns import stddev_or_zero
from sixfold.operators.ordered import HOT_ROWS, same_key, with_ordered

DRIVER = ("event_id", "driver_id")
STINT = ("event_id", "driver_id", "stint_number")


def valid_laps(laps: DataFrame) -> DataFrame:
    """Accurate laps with a lap time."""
    return laps.where((F.col("is_accurate") == 1) & F.col("lap_time_sec").isNotNull())


def pace_delta(laps: DataFrame, keys: Sequence[str] = STINT, order: Sequence[str] = ("lap_number",), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Lap time and its change against the previous valid lap of the same stint."""
    timed = with_ordered(valid_laps(laps), keys, order, previous={"_previous": "lap_time_sec"}, hot_rows=hot_rows)
    return timed.withColumns(
        {
            "delta_to_prev": F.round(F.col("lap_time_sec") - F.col("_previous"), 3),
            "lap_time_sec": F.round("lap_time_sec", 3),
        }
    ).drop("_previous")


def consistency_rank(laps: DataFrame, by: Sequence[str] = ("driver_id",), below: float = 120, k: int = 10) -> DataFrame:
    """Drivers by spread of their lap times under ``below`` seconds, best ``k`` first; equal spreads share a rank.

    The k best are taken first and only they are ranked: the ranks of a sorted prefix equal the full ranking's.
    """
    spread = (
        valid_laps(laps)
        .where(F.col("lap_time_sec") < below)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("valid_laps"),
            F.round(F.avg("lap_time_sec"), 3).alias("avg_lap_time"),
            stddev_or_zero("lap_time_sec").alias("_spread"),
        )
    )
    ranked = top_ranked(spread, [F.col("_spread").asc_nulls_last()], by, k, "consistency_rank")
    return ranked.select(*by, "valid_laps", "avg_lap_time", F.round("_spread", 4).alias("lap_time_stddev"), "consistency_rank")


def top_ranked(df: DataFrame, order: Sequence[Column], ties: Sequence[str], k: int, out: str) -> DataFrame:
    """The first ``k`` rows with their RANK; ``ties`` decides which of equal rows are kept. Only the k rows meet in one task."""
    return df.orderBy(*order, *ties).limit(k).withColumn(out, F.rank().over(Window.orderBy(*order)).cast("bigint"))


def stint_summary(laps: DataFrame, by: Sequence[str] = (*STINT, "compound")) -> DataFrame:
    """Valid laps per stint: span, count, lap-time statistics, oldest tyre."""
    return (
        valid_laps(laps)
        .groupBy(*by)
        .agg(
            F.min("lap_number").alias("stint_start_lap"),
            F.max("lap_number").alias("stint_end_lap"),
            F.count(F.lit(1)).alias("lap_count"),
            F.round(F.avg("lap_time_sec"), 3).alias("avg_lap_time"),
            F.round(F.min("lap_time_sec"), 3).alias("best_lap_time"),
            F.round(F.max("lap_time_sec"), 3).alias("worst_lap_time"),
            F.round(stddev_or_zero("lap_time_sec"), 3).alias("lap_time_stddev"),
            F.max("tyre_life").alias("max_tyre_age"),
        )
    )


def driver_cards(t) -> DataFrame:
    """Driver, team colour and final position per event; ``#666666`` where a team has no colour."""
    result = t["fact_result"].select("event_id", "driver_id", "final_position")
    return (
        t["bridge_driver_team"]
        .join(t["dim_driver"].select("driver_id", "driver_code", "full_name"), "driver_id")
        .join(t["dim_team"].select("team_id", "team_color"), "team_id")
        .join(result, ["event_id", "driver_id"], "left")
        .select(
            "event_id",
            "driver_id",
            "driver_code",
            F.col("full_name").alias("driver_name"),
            F.coalesce(F.concat(F.lit("#"), F.col("team_color")), F.lit("#666666")).alias("color"),
            "final_position",
        )
    )


def position_changes(laps: DataFrame, keys: Sequence[str] = DRIVER) -> DataFrame:
    """Laps after which a driver's position differs on the very next lap.

    Joined on the lap's own key (driver and lap number), which is unique, so no driver gathers in one task.
    """
    placed = laps.where(F.col("position").isNotNull())
    now = placed.select(*keys, "lap_number", F.col("position").alias("pos_before"))
    then = placed.select(*keys, (F.col("lap_number") - 1).alias("lap_number"), F.col("position").alias("pos_after"))
    return now.join(then, [*keys, "lap_number"]).where("pos_before != pos_after")


def position_deltas(laps: DataFrame, keys: Sequence[str] = DRIVER, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Position and its change since the driver's previous placed lap."""
    placed = laps.where(F.col("position").isNotNull())
    lagged = with_ordered(placed, keys, ["lap_number"], previous={"_previous": "position"}, hot_rows=hot_rows)
    return lagged.withColumn("position_delta", F.col("position") - F.col("_previous")).drop("_previous")


def movers(deltas: DataFrame, by: Sequence[str] = DRIVER) -> DataFrame:
    """Per driver: laps with a gain, laps with a loss, places gained in all."""
    delta = F.col("position_delta")
    return deltas.groupBy(*by).agg(
        F.count_if(delta < 0).alias("overtakes"),
        F.count_if(delta > 0).alias("positions_lost"),
        F.coalesce(F.sum(F.when(delta < 0, -delta)), F.lit(0)).alias("gained"),
    )


def top_mover(moved: DataFrame, by: Sequence[str] = DRIVER) -> DataFrame:
    """The driver with most places gained (smallest key on ties)."""
    return moved.orderBy(F.col("gained").desc(), *by).limit(1)


def degradation(laps: DataFrame, keys: Sequence[str] = STINT, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Lap time lost against the first lap of the stint (accurate laps with a tyre age)."""
    worn = laps.where((F.col("is_accurate") == 1) & (F.col("tyre_life") > 0))
    fresh = with_ordered(worn, keys, ["lap_number"], first={"_fresh": "lap_time_sec"}, hot_rows=hot_rows)
    return fresh.withColumns(
        {
            "degradation_from_fresh": F.round(F.col("lap_time_sec") - F.col("_fresh"), 3),
            "lap_time": F.round("lap_time_sec", 3),
        }
    ).drop("_fresh", "lap_time_sec")


def life_matrix(worn: DataFrame, by: Sequence[str] = ("driver_id",), max_life: int = 25) -> DataFrame:
    """Mean degradation per driver (``mean_degradation``) and per tyre age (``life_1`` ... ``life_25``)."""
    value, life = F.col("degradation_from_fresh"), F.col("tyre_life")
    per_life = [F.avg(F.when(life == n, value)).alias(f"life_{n}") for n in range(1, max_life + 1)]
    return worn.groupBy(*by).agg(F.avg(value).alias("mean_degradation"), *per_life)


def matrix_range(matrix: DataFrame, by: Sequence[str] = ("driver_id",)) -> DataFrame:
    """Smallest and largest cell of a life matrix and the driver with the lowest mean."""
    cells = [F.col(c) for c in matrix.columns if c.startswith("life_")]
    best = F.min_by(F.struct(*by), F.struct(F.col("mean_degradation").isNull(), "mean_degradation", *by))
    return matrix.agg(
        F.min(F.least(*cells)).alias("min_cell"), F.max(F.greatest(*cells)).alias("max_cell"), best.alias("best")
    ).select("min_cell", "max_cell", *[F.col(f"best.{c}").alias(c) for c in by])


def quantiles(df: DataFrame, by: Sequence[str], value: str, points: dict[str, float], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Exact interpolated quantiles per key.

    Equal values are counted before the shuffle and the counts are summed along the order, so no key has to fit into one
    task's memory as it must for the built-in exact percentile.
    """
    return _from_counts(df, by, value, points, hot_rows).select(*by, *points)


def _from_counts(df: DataFrame, by: Sequence[str], value: str, points: dict[str, float], hot_rows: int | None) -> DataFrame:
    """Mean, spread, extremes, count and quantiles per key, all from how often each value occurs; the input is aggregated once."""
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    x = F.col(value).cast("double")
    weighted = counted.withColumn("_weighted", F.col(value) * F.col("_n"))  # decimals are summed exactly
    sums = {"_total": "_n", "_sum": "_weighted"}
    placed = with_ordered(weighted, by, [value], running_sum={"_upto": "_n"}, key_sum=sums, hot_rows=hot_rows)
    picks = []
    for name, share in points.items():
        at = (F.col("_total") - 1) * F.lit(float(share))
        for end, rank in (("low", F.floor(at)), ("high", F.ceil(at))):
            inside = (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(inside, x)).alias(f"_{end}_{name}"))
    mean = F.col("_sum").cast("double") / F.col("_total")
    off = x - mean
    measures = [F.min(value).alias("low"), F.max(value).alias("high"), F.sum(off * off * F.col("_n")).alias("_squares"), F.max("_sum").alias("_sum")]
    found = placed.groupBy(*by, "_total").agg(*picks, *measures)
    results = []
    for name, share in points.items():
        at = (F.col("_total") - 1) * F.lit(float(share))
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        results.append((low + (high - low) * (at - F.floor(at))).alias(name))
    spread = F.sqrt(F.try_divide(F.col("_squares"), F.col("_total") - 1))
    return found.select(*by, mean.alias("mean"), spread.alias("std"), "low", "high", F.col("_total").alias("count"), *results)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def distribution(
    laps: DataFrame, by: Sequence[str], above: float = 90, below: float = 130, exact: bool = True, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Mean, spread, quartiles, extremes and count of the accurate lap times between two bounds (both excluded).

    A single lap has no spread (NULL). ``exact=False`` takes approximate quartiles in one pass.
    """
    by = list(by)
    kept = laps.where((F.col("is_accurate") == 1) & (F.col("lap_time_sec") > above) & (F.col("lap_time_sec") < below))
    if not exact:
        value = F.col("lap_time_sec")
        measures = [
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.count(value).alias("count"),
        ]
        cuts = F.percentile_approx(value, list(QUARTILES.values()), 10_000).alias("_cuts")
        rough = kept.groupBy(*by).agg(*measures, cuts)
        return rough.withColumns({n: F.col("_cuts")[i].cast("double") for i, n in enumerate(QUARTILES)}).drop("_cuts")
    return _from_counts(kept, by, "lap_time_sec", QUARTILES, hot_rows)


def most_consistent(stats: DataFrame, ties: Sequence[str], k: int = 3) -> DataFrame:
    """The ``k`` drivers with the smallest spread."""
    return stats.orderBy(F.col("std").asc_nulls_last(), *ties).limit(k)


def stint_strategy(laps: DataFrame, by: Sequence[str] = (*STINT, "compound")) -> DataFrame:
    """Start, end, length and lap count per stint; a missing compound counts as MEDIUM; ``max_lap`` is the last lap of all."""
    stints = (
        laps.where(F.col("stint_number").isNotNull())
        .groupBy(*by)
        .agg(F.min("lap_number").alias("start_lap"), F.max("lap_number").alias("end_lap"), F.count(F.lit(1)).alias("laps"))
    )
    last = laps.where(F.col("stint_number").isNotNull()).agg(F.max("lap_number").alias("max_lap"))
    return stints.withColumns(
        {
            "compound": F.coalesce("compound", F.lit("MEDIUM")),
            "length": F.col("end_lap") - F.col("start_lap") + 1,
            "max_lap": last.scalar(),
        }
    )


def pit_stops(stints: DataFrame, keys: Sequence[str] = DRIVER, hot_rows: int | None = None) -> DataFrame:
    """The lap before each stint but the driver's first. Only the first is looked up, by an aggregate; no window numbers the stints.

    ``hot_rows`` has no effect any more: an aggregate needs no cut of hot keys.
    """
    keys, order = list(keys), F.struct("stint_number", "start_lap", "compound")
    firsts = stints.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.min(order).alias("_first"))
    both = stints.join(firsts, same_key([F.col(k) for k in keys], [F.col(f"_of_{k}") for k in keys]))
    return both.where(order != F.col("_first")).select(*keys, "stint_number", (F.col("start_lap") - 1).alias("pit_lap"))


def grid_gain(results: DataFrame) -> DataFrame:
    """Places won between the grid and the flag (negative: lost)."""
    return results.withColumn("places_gained", F.col("grid_position") - F.col("final_position"))


def team_ranking(results: DataFrame, by: Sequence[str] = ("team_name",), k: int = 10) -> DataFrame:
    """Teams by points, with the mean finishing position; the best ``k``."""
    totals = results.groupBy(*by).agg(
        F.sum("points").alias("points"),
        F.round(F.avg("final_position"), 3).alias("avg_position"),
        F.count(F.lit(1)).alias("entries"),
    )
    return top_ranked(totals, [F.col("points").desc_nulls_last()], by, k, "team_rank")
