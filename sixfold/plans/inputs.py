"""The given tables in the shapes the operators read, each with the same shape as SQL.

All inputs are whole tables, or derived from whole tables by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sixfold.operators.ordered import with_ordered
from sixfold.sources.tables import stored


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- laps: one session per week, one driver per user, one lap per event ---------------------------------------------------


def laps(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        (F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 7) + 1).alias("event_id"),
        F.col("user_id").alias("driver_id"),
        "ts",
        F.col("event_id").alias("source_id"),
        F.col("value").cast("decimal(12,6)").alias("lap_time_sec"),
        F.col("event_type").alias("compound"),
        (F.col("event_type") != "error").cast("int").alias("is_accurate"),
    )
    numbered = with_ordered(events, ["event_id", "driver_id"], ["ts", "source_id"], row_number="lap_number")
    return numbered.withColumns(
        {
            "stint_number": F.floor((F.col("lap_number") - 1) / 10) + 1,
            "tyre_life": (F.col("lap_number") - 1) % 10 + 1,
        }
    )


LAPS = """laps AS (
  SELECT *, (lap_number - 1) // 10 + 1 AS stint_number, (lap_number - 1) % 10 + 1 AS tyre_life FROM (
    SELECT week AS event_id, user_id AS driver_id, ts, source_id, lap_time_sec, compound, is_accurate,
           row_number() OVER (PARTITION BY week, user_id ORDER BY ts, source_id) AS lap_number
    FROM (SELECT date_diff('day', DATE '2024-01-01', ts::DATE) // 7 + 1 AS week, user_id, ts, event_id AS source_id,
                 value::DECIMAL(12,6) AS lap_time_sec, event_type AS compound,
                 CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS is_accurate
          FROM events)))"""


# --- positions: one race per user, one driver per event type, one lap per day ---------------------------------------------


def positions(spark: SparkSession, sf: str) -> DataFrame:
    totals = (
        table(spark, sf, "events")
        .groupBy(
            F.col("user_id").alias("event_id"),
            F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("bigint").alias("lap_number"),
            F.col("event_type").alias("driver_id"),
        )
        .agg((-F.sum(F.col("value").cast("decimal(18,2)"))).alias("_behind"))
    )
    # A group holds one row per event type.
    placed = with_ordered(totals, ["event_id", "lap_number"], ["_behind", "driver_id"], row_number="position", hot_rows=None)
    return placed.drop("_behind")


POSITIONS = """positions AS (
  SELECT event_id, lap_number, driver_id,
         row_number() OVER (PARTITION BY event_id, lap_number ORDER BY total DESC, driver_id) AS position
  FROM (SELECT user_id AS event_id, date_diff('day', DATE '2024-01-01', ts::DATE) AS lap_number, event_type AS driver_id,
               sum(value::DECIMAL(18,2)) AS total
        FROM events GROUP BY ALL))"""


# --- the star: orders are events, suppliers drivers, nations teams, order lines laps --------------------------------------


#: All columns of ``fact_result`` but its key.
RESULT = ("grid_position", "final_position", "points", "status_id", "laps_completed")


def star(spark: SparkSession, sf: str, results: Sequence[str] = ()) -> dict[str, DataFrame]:
    """``results``: columns of ``fact_result``, for queries that join it to the bridge.

    Both are made from one table then, aggregated once and written first, so that the join's tasks only sort and do not also aggregate
    twice what they join.
    """
    orders, supplier, nation, lines = (table(spark, sf, n) for n in ("orders", "supplier", "nation", "lineitem"))
    entered = lines.groupBy(F.col("l_orderkey").alias("event_id"), F.col("l_suppkey").alias("driver_id")).agg(
        F.min("l_linenumber").alias("grid_position"),
        F.max("l_linenumber").alias("final_position"),
        F.sum(F.col("l_quantity").cast("decimal(5,2)")).alias("points"),
        F.min(F.ascii("l_returnflag")).cast("bigint").alias("status_id"),
        F.count(F.lit(1)).alias("laps_completed"),
    )
    if results:
        entered = stored(entered.select("event_id", "driver_id", *results))
    return {
        "dim_event": orders.select(
            F.col("o_orderkey").alias("event_id"),
            F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("session_id"),
            F.year("o_orderdate").alias("season"),
            F.col("o_orderpriority").alias("gp_name"),
            F.col("o_orderstatus").alias("session_code"),
            F.concat(F.lit("Session "), F.col("o_orderstatus")).alias("session_name"),
            F.lit(None).cast("string").alias("circuit_name"),
        ),
        "dim_driver": supplier.select(
            F.col("s_suppkey").alias("driver_id"),
            F.col("s_name").alias("driver_code"),
            (F.col("s_suppkey") % 100).alias("driver_number"),
            F.concat(F.lit("Driver "), F.col("s_name")).alias("full_name"),
        ),
        "dim_team": nation.select(
            F.col("n_nationkey").cast("bigint").alias("team_id"),
            F.col("n_name").alias("team_name"),
            F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("team_code"),
            F.nullif(F.col("n_regionkey").cast("string"), F.lit("0")).alias("team_color"),
        ),
        "bridge_driver_team": entered.select("event_id", "driver_id").join(
            supplier.select(F.col("s_suppkey").alias("driver_id"), F.col("s_nationkey").cast("bigint").alias("team_id")), "driver_id"
        ),
        "fact_result": entered,
        "dim_result_status": lines.select(F.ascii("l_returnflag").cast("bigint").alias("status_id"), F.col("l_returnflag").alias("status_name"))
        .where("status_name != 'N'")
        .distinct(),
        "dim_compound": lines.select(F.ascii("l_linestatus").cast("bigint").alias("compound_id"), F.col("l_linestatus").alias("compound_name"))
        .where("compound_name = 'O'")
        .distinct(),
        "fact_lap": lines.select(
            F.col("l_orderkey").alias("event_id"),
            F.col("l_suppkey").alias("driver_id"),
            F.col("l_linenumber").alias("lap_number"),
            F.col("l_extendedprice").alias("lap_time_sec"),
            F.col("l_quantity").alias("sector1_sec"),
            F.col("l_discount").alias("sector2_sec"),
            F.col("l_tax").alias("sector3_sec"),
            F.lit(1).alias("stint_number"),
            F.ascii("l_linestatus").cast("bigint").alias("compound_id"),
            F.lit(1).alias("tyre_life"),
            F.lit(None).cast("int").alias("position"),
            F.lit(0).alias("is_personal_best"),
            F.lit(1).alias("is_accurate"),
            F.col("l_partkey").cast("double").alias("speed_i1"),
            F.lit(None).cast("double").alias("speed_i2"),
            F.lit(None).cast("double").alias("speed_fl"),
        ),
    }


STAR = """dim_event AS (
  SELECT o_orderkey AS event_id, 'S' || o_orderkey AS session_id, year(o_orderdate)::BIGINT AS season, o_orderpriority AS gp_name,
         o_orderstatus AS session_code, 'Session ' || o_orderstatus AS session_name, NULL::VARCHAR AS circuit_name FROM orders),
dim_driver AS (
  SELECT s_suppkey AS driver_id, s_name AS driver_code, s_suppkey % 100 AS driver_number, 'Driver ' || s_name AS full_name FROM supplier),
dim_team AS (
  SELECT n_nationkey::BIGINT AS team_id, n_name AS team_name, 'T' || n_nationkey AS team_code,
         nullif(n_regionkey::VARCHAR, '0') AS team_color FROM nation),
fact_result AS (
  SELECT l_orderkey AS event_id, l_suppkey AS driver_id, min(l_linenumber)::BIGINT AS grid_position,
         max(l_linenumber)::BIGINT AS final_position, sum(l_quantity::DECIMAL(5,2))::DOUBLE AS points,
         min(ascii(l_returnflag))::BIGINT AS status_id, count(*) AS laps_completed
  FROM lineitem GROUP BY ALL),
bridge_driver_team AS (
  SELECT event_id, driver_id, s_nationkey::BIGINT AS team_id FROM fact_result JOIN supplier ON driver_id = s_suppkey),
dim_result_status AS (
  SELECT DISTINCT ascii(l_returnflag)::BIGINT AS status_id, l_returnflag AS status_name FROM lineitem WHERE l_returnflag <> 'N'),
dim_compound AS (
  SELECT DISTINCT ascii(l_linestatus)::BIGINT AS compound_id, l_linestatus AS compound_name FROM lineitem WHERE l_linestatus = 'O')"""


# --- time series ------------------------------------------------------------------------------------------------------------

EPOCH = "2024-01-01 00:00:00"


def _seconds(column: str = "ts"):
    return (F.col(column) - F.lit(EPOCH).cast("timestamp_ntz")).cast("decimal(14,6)")


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """One session per event type, one driver per user; the counter in ``props`` is the wing code and engine speed."""
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_type").alias("event_id"),
        F.col("user_id").alias("driver_id"),
        _seconds().alias("session_time_sec"),
        F.col("value").cast("decimal(6,2)").alias("speed"),
        (k * 100).cast("decimal(8,2)").alias("rpm"),
        k.cast("decimal(5,2)").alias("throttle"),
        (k % 2).alias("brake"),
        (k % 15).alias("drs"),
    )


TELEMETRY = f"""telemetry AS (
  SELECT event_type AS event_id, user_id AS driver_id, date_diff('microsecond', TIMESTAMP '{EPOCH}', ts)::DECIMAL(18,0) / 1000000 AS session_time_sec,
         value::DECIMAL(6,2) AS speed, (k * 100)::DECIMAL(8,2) AS rpm, k::DECIMAL(5,2) AS throttle, k % 2 AS brake, k % 15 AS drs
  FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events))"""


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """One session per event type: the values as air, the counters as track temperature."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("event_id"),
        F.col("event_id").alias("source_id"),
        _seconds().alias("time_sec"),
        F.col("value").cast("decimal(5,2)").alias("air_temp"),
        k.cast("decimal(5,2)").alias("track_temp"),
        (F.col("user_id") % 100).cast("decimal(5,2)").alias("humidity"),
        (k % 3).cast("decimal(5,2)").alias("wind_speed"),
        (k % 2).alias("rainfall"),
    )


WEATHER = f"""weather AS (
  SELECT event_type AS event_id, event_id AS source_id,
         date_diff('microsecond', TIMESTAMP '{EPOCH}', ts) AS micros, value::DECIMAL(5,2) AS air_temp, k::DECIMAL(5,2) AS track_temp,
         (user_id % 100)::DECIMAL(5,2) AS humidity, (k % 3)::DECIMAL(5,2) AS wind_speed, k % 2 AS rainfall
  FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events))"""


# --- messages: one session per conversation, one message per turn ---------------------------------------------------------


def message_documents(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    at = F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("conv_id").cast("int"), F.col("turn").cast("decimal(18,6)"))
    flag = F.when(F.col("turn") % 3 == 1, "GREEN").when(F.col("turn") % 3 == 2, "YELLOW")
    payload = F.struct(
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("Time"),
        F.col("role").alias("Category"),
        flag.alias("Flag"),
        F.lit("Track").alias("Scope"),
        F.col("text").alias("Message"),
        F.col("conv_id").cast("string").alias("RacingNumber"),
        F.when(F.col("turn") > 0, F.col("turn")).alias("Lap"),
    )
    return turns.select(
        (F.col("conv_id") * 1_000_000_000 + F.col("turn")).alias("doc_id"),
        F.lit("race_control_message").alias("doc_type"),
        F.col("conv_id").alias("event_id"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"),
    )


MESSAGES = f"""messages AS (
  SELECT conv_id * 1000000000 + turn AS doc_id, conv_id AS event_id,
         strftime(TIMESTAMP '{EPOCH}' + to_minutes(conv_id) + to_seconds(turn), '%Y-%m-%d %H:%M:%S') AS msg_time,
         conv_id * 60.0 + turn AS seconds, role AS category,
         CASE turn % 3 WHEN 1 THEN 'GREEN' WHEN 2 THEN 'YELLOW' END AS flag, text AS message,
         conv_id::VARCHAR AS racing_number, CASE WHEN turn > 0 THEN turn::DOUBLE END AS lap
  FROM conversations)"""


# --- points: two leading vector elements as coordinates ---------------------------------------------------------------------


def points(spark: SparkSession, sf: str) -> DataFrame:
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(4)]
    return table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("event_id"),
        (F.col("vec_id") % 20).alias("driver_id"),
        F.col("vec_id").cast("double").alias("session_time_sec"),
        (e[0] * 5000).alias("x"),
        (e[1] * 5000).alias("y"),
        (e[2] * 100 + 200).cast("decimal(6,2)").alias("speed"),
        (F.abs(e[3]) * 100).cast("decimal(5,2)").alias("throttle"),
        (e[3] > 0).cast("int").alias("brake"),
    )


POINTS = """points AS (
  SELECT label::BIGINT AS event_id, vec_id % 20 AS driver_id, vec_id::DOUBLE AS session_time_sec, vec_id,
         embedding[1]::DOUBLE * 5000 AS x, embedding[2]::DOUBLE * 5000 AS y,
         (embedding[3]::DOUBLE * 100 + 200)::DECIMAL(6,2) AS speed, (abs(embedding[4]::DOUBLE) * 100)::DECIMAL(5,2) AS throttle,
         CASE WHEN embedding[4] > 0 THEN 1 ELSE 0 END AS brake
  FROM embeddings)"""


def point_drivers(spark: SparkSession, sf: str) -> DataFrame:
    """A driver for every point."""
    return points(spark, sf).select("driver_id", F.concat(F.lit("DRIVER"), F.col("driver_id").cast("string")).alias("driver_code")).distinct()
