"""Laps, stints, positions, results, teammates and the driver graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from sixfold.operators.ordered import with_ordered
from sixfold.operators import graph
from sixfold.operators import relational as rel
from sixfold.plans import views
from sixfold.plans.inputs import LAPS, POSITIONS, RESULT, STAR, laps, positions, star

# A stint of the derived laps holds ten rows and a race as many as there are days: plain windows.
BOUNDED = None

VALID = "is_accurate = 1 AND lap_time_sec IS NOT NULL"


def pace_delta(spark, sf):
    found = rel.pace_delta(laps(spark, sf), hot_rows=BOUNDED)
    return found.select("event_id", "driver_id", "stint_number", "compound", "lap_number", "lap_time_sec", "delta_to_prev")


def distribution(spark, sf):
    found = rel.distribution(laps(spark, sf), ["event_id", "driver_id"], above=10, below=130)
    rounded = {c: F.round(F.col(c).cast("double"), 6) for c in ("mean", "std", "q1", "median", "q3")}
    return found.withColumns(rounded).withColumn("count", F.col("count").cast("bigint"))


def most_consistent(spark, sf):
    found = rel.distribution(laps(spark, sf), ["driver_id"], above=10, below=130, exact=False)
    best = rel.most_consistent(found, ["driver_id"], 3)
    return best.select("driver_id", "count", F.round("std", 6).alias("std"))


def degradation(spark, sf):
    found = rel.degradation(laps(spark, sf), hot_rows=BOUNDED)
    return found.select("event_id", "driver_id", "stint_number", "compound", "tyre_life", "lap_number", "lap_time", "degradation_from_fresh")


def _matrix(spark, sf):
    return rel.life_matrix(rel.degradation(laps(spark, sf), hot_rows=BOUNDED), max_life=10)


def life_matrix(spark, sf):
    matrix = _matrix(spark, sf)
    return matrix.select("driver_id", *[F.round(F.col(c).cast("double"), 5).alias(c) for c in matrix.columns[1:]])


def matrix_range(spark, sf):
    found = rel.matrix_range(_matrix(spark, sf))
    return found.select("driver_id", *[F.round(F.col(c).cast("double"), 5).alias(c) for c in ("min_cell", "max_cell")])


def pit_stops(spark, sf):
    stints = rel.stint_strategy(laps(spark, sf), by=("event_id", "driver_id", "stint_number", "compound"))
    return rel.pit_stops(stints)


def _changes(spark, sf):
    return rel.position_changes(positions(spark, sf))


def _edges(spark, sf):
    placed = positions(spark, sf)
    return graph.overtakes(placed, rel.position_changes(placed))


def edge_weights(spark, sf):
    return graph.edge_weights(_edges(spark, sf)).withColumn("normalized", F.round("normalized", 6))


def _deltas(spark, sf):
    return rel.position_deltas(positions(spark, sf))


def movers(spark, sf):
    return rel.movers(_deltas(spark, sf))


def top_mover(spark, sf):
    return rel.top_mover(movers(spark, sf))


def teammates_view(spark, sf):
    return views.teammates(star(spark, sf))


def graph_teammates(spark, sf):
    return graph.teammates(graph.racing_graph(star(spark, sf)))


def graph_network(spark, sf):
    return graph.driver_network(graph.racing_graph(star(spark, sf, RESULT)))


CHANGES = f"""{POSITIONS}, changes AS (
  SELECT a.event_id, a.driver_id, a.lap_number, a.position AS pos_before, b.position AS pos_after
  FROM positions a JOIN positions b ON a.event_id = b.event_id AND a.driver_id = b.driver_id AND b.lap_number = a.lap_number + 1
  WHERE a.position <> b.position)"""

EDGES = f"""{CHANGES}, edges AS (
  SELECT c.event_id, c.driver_id AS overtaker_id, p.driver_id AS overtaken_id, count(*) AS weight
  FROM changes c JOIN positions p ON p.event_id = c.event_id AND p.lap_number = c.lap_number
   AND p.position >= c.pos_after AND p.position < c.pos_before
  WHERE p.driver_id <> c.driver_id GROUP BY ALL)"""

DELTAS = f"""{POSITIONS}, deltas AS (
  SELECT event_id, driver_id, lap_number, position,
         position - lag(position) OVER (PARTITION BY event_id, driver_id ORDER BY lap_number) AS position_delta FROM positions)"""

MOVERS = f"""{DELTAS}, movers AS (
  SELECT event_id, driver_id, count(*) FILTER (position_delta < 0) AS overtakes, count(*) FILTER (position_delta > 0) AS positions_lost,
         coalesce(sum(-position_delta) FILTER (position_delta < 0), 0)::BIGINT AS gained FROM deltas GROUP BY ALL)"""

WORN = f"""{LAPS}, worn AS (
  SELECT *, (round(lap_time_sec - first_value(lap_time_sec) OVER (PARTITION BY event_id, driver_id, stint_number ORDER BY lap_number), 3))
         AS degradation_from_fresh FROM laps WHERE is_accurate = 1 AND tyre_life > 0)"""

_LIVES = ", ".join(f"avg(degradation_from_fresh) FILTER (tyre_life = {n}) AS life_{n}" for n in range(1, 11))
MATRIX = f"{WORN}, matrix AS (SELECT driver_id, avg(degradation_from_fresh) AS mean_degradation, {_LIVES} FROM worn GROUP BY driver_id)"
_CELLS = ", ".join(f"life_{n}" for n in range(1, 11))

TEAMMATES = f"""{STAR}, pairs AS (
  SELECT a.event_id, a.team_id, a.driver_id AS d1, b.driver_id AS d2 FROM bridge_driver_team a JOIN bridge_driver_team b
    ON a.event_id = b.event_id AND a.team_id = b.team_id AND a.driver_id < b.driver_id)"""

_PAIR_NAMES = "x.driver_code AS driver1_code, x.full_name AS driver1_name, y.driver_code AS driver2_code, y.full_name AS driver2_name"
_PAIR_JOINS = "JOIN dim_team t USING (team_id) JOIN dim_driver x ON x.driver_id = d1 JOIN dim_driver y ON y.driver_id = d2"


def next_lap(spark, sf):
    return with_ordered(laps(spark, sf).select("event_id", "driver_id", "lap_number", "lap_time_sec"), rel.DRIVER, ["lap_number"], following={"next_time": "lap_time_sec"})


QUERIES = {
    "next_lap": (
        next_lap,
        f"""WITH {LAPS} SELECT event_id, driver_id, lap_number, lap_time_sec::DOUBLE AS lap_time_sec,
              (lead(lap_time_sec) OVER (PARTITION BY event_id, driver_id ORDER BY lap_number))::DOUBLE AS next_time FROM laps""",
    ),
    "pace_delta": (
        pace_delta,
        f"""WITH {LAPS} SELECT event_id, driver_id, stint_number, compound, lap_number, lap_time_sec::DOUBLE AS lap_time_sec,
              (lap_time_sec - lag(lap_time_sec) OVER (PARTITION BY event_id, driver_id, stint_number ORDER BY lap_number))::DOUBLE AS delta_to_prev
            FROM laps WHERE {VALID}""",
    ),
    "consistency_rank": (
        lambda spark, sf: rel.consistency_rank(laps(spark, sf), below=120, k=10),
        f"""WITH {LAPS}, spread AS (
              SELECT driver_id, count(*) AS valid_laps, round(avg(lap_time_sec) + 1e-9, 3) AS avg_lap_time,
                     CASE WHEN count(*) = 1 THEN 0 ELSE stddev_samp(lap_time_sec::DOUBLE) END AS s
              FROM laps WHERE {VALID} AND lap_time_sec < 120 GROUP BY driver_id)
            SELECT driver_id, valid_laps, avg_lap_time, round(s, 4) AS lap_time_stddev, rank() OVER (ORDER BY s) AS consistency_rank
            FROM spread ORDER BY s, driver_id LIMIT 10""",
    ),
    "stint_summary": (
        lambda spark, sf: rel.stint_summary(laps(spark, sf)),
        f"""WITH {LAPS} SELECT event_id, driver_id, stint_number, compound, min(lap_number) AS stint_start_lap, max(lap_number) AS stint_end_lap,
              count(*) AS lap_count, round(avg(lap_time_sec) + 1e-9, 3) AS avg_lap_time, min(lap_time_sec)::DOUBLE AS best_lap_time,
              max(lap_time_sec)::DOUBLE AS worst_lap_time,
              round(CASE WHEN count(*) = 1 THEN 0 ELSE stddev_samp(lap_time_sec::DOUBLE) END, 3) AS lap_time_stddev, max(tyre_life) AS max_tyre_age
            FROM laps WHERE {VALID} GROUP BY ALL""",
    ),
    "stint_strategy": (
        lambda spark, sf: rel.stint_strategy(laps(spark, sf)),
        f"""WITH {LAPS} SELECT event_id, driver_id, stint_number, compound, min(lap_number) AS start_lap, max(lap_number) AS end_lap, count(*) AS laps,
              max(lap_number) - min(lap_number) + 1 AS length, (SELECT max(lap_number) FROM laps) AS max_lap FROM laps
            GROUP BY event_id, driver_id, stint_number, compound""",
    ),
    "pit_stops": (
        pit_stops,
        f"""WITH {LAPS}, stints AS (SELECT event_id, driver_id, stint_number, compound, min(lap_number) AS start_lap FROM laps GROUP BY ALL)
            SELECT event_id, driver_id, stint_number, start_lap - 1 AS pit_lap FROM stints
            QUALIFY row_number() OVER (PARTITION BY event_id, driver_id ORDER BY stint_number, start_lap, compound) > 1""",
    ),
    "degradation": (
        degradation,
        f"""WITH {WORN} SELECT event_id, driver_id, stint_number, compound, tyre_life, lap_number, lap_time_sec::DOUBLE AS lap_time,
              degradation_from_fresh::DOUBLE AS degradation_from_fresh FROM worn""",
    ),
    "life_matrix": (
        life_matrix,
        f"""WITH {MATRIX} SELECT driver_id, round(mean_degradation, 5) AS mean_degradation,
              {", ".join(f"round(life_{n}, 5) AS life_{n}" for n in range(1, 11))} FROM matrix""",
    ),
    "matrix_range": (
        matrix_range,
        f"""WITH {MATRIX} SELECT (SELECT driver_id FROM matrix ORDER BY mean_degradation NULLS LAST, driver_id LIMIT 1) AS driver_id,
              round(min(least({_CELLS})), 5) AS min_cell, round(max(greatest({_CELLS})), 5) AS max_cell FROM matrix""",
    ),
    "distribution": (
        distribution,
        f"""WITH {LAPS} SELECT event_id, driver_id, round(avg(lap_time_sec), 6) AS mean, round(stddev_samp(lap_time_sec::DOUBLE), 6) AS std,
              min(lap_time_sec)::DOUBLE AS low, max(lap_time_sec)::DOUBLE AS high, count(*) AS "count",
              round(quantile_cont(lap_time_sec::DOUBLE, 0.25), 6) AS q1, round(quantile_cont(lap_time_sec::DOUBLE, 0.5), 6) AS median,
              round(quantile_cont(lap_time_sec::DOUBLE, 0.75), 6) AS q3
            FROM laps WHERE is_accurate = 1 AND lap_time_sec > 10 AND lap_time_sec < 130 GROUP BY event_id, driver_id""",
    ),
    "most_consistent": (
        most_consistent,
        f"""WITH {LAPS} SELECT driver_id, count(*) AS "count", round(stddev_samp(lap_time_sec::DOUBLE), 6) AS std FROM laps
            WHERE is_accurate = 1 AND lap_time_sec > 10 AND lap_time_sec < 130 GROUP BY driver_id
            ORDER BY stddev_samp(lap_time_sec::DOUBLE) NULLS LAST, driver_id LIMIT 3""",
    ),
    "position_changes": (_changes, f"WITH {CHANGES} SELECT * FROM changes"),
    "position_deltas": (_deltas, f"WITH {DELTAS} SELECT * FROM deltas"),
    "movers": (movers, f"WITH {MOVERS} SELECT * FROM movers"),
    "top_mover": (top_mover, f"WITH {MOVERS} SELECT * FROM movers ORDER BY gained DESC, event_id, driver_id LIMIT 1"),
    "overtakes": (_edges, f"WITH {EDGES} SELECT * FROM edges"),
    "edge_weights": (
        edge_weights,
        f"WITH {EDGES} SELECT *, round(weight / (SELECT max(weight) FROM edges), 6) AS normalized FROM edges",
    ),
    "net_gains": (
        lambda spark, sf: graph.net_gains(_edges(spark, sf)),
        f"""WITH {EDGES} SELECT event_id, driver_id, sum(c)::BIGINT AS net_gain FROM (
              SELECT event_id, overtaker_id AS driver_id, weight AS c FROM edges UNION ALL SELECT event_id, overtaken_id, -weight FROM edges)
            GROUP BY ALL""",
    ),
    "driver_event_results": (
        lambda spark, sf: views.driver_event_results(star(spark, sf, RESULT)),
        f"""WITH {STAR} SELECT event_id, session_id, season, gp_name, session_code, session_name, circuit_name, driver_id, driver_code,
              driver_number, full_name AS driver_name, team_id, team_name, team_color, grid_position, final_position, points,
              status_name AS status, laps_completed
            FROM fact_result JOIN dim_event USING (event_id) JOIN dim_driver USING (driver_id)
            JOIN bridge_driver_team USING (event_id, driver_id) JOIN dim_team USING (team_id) LEFT JOIN dim_result_status USING (status_id)""",
    ),
    "lap_analysis": (
        lambda spark, sf: views.lap_analysis(star(spark, sf)),
        f"""WITH {STAR} SELECT event_id, session_id, gp_name, driver_id, driver_code, full_name AS driver_name, team_name,
              l_linenumber::BIGINT AS lap_number, l_extendedprice AS lap_time_sec, l_quantity AS sector1_sec, l_discount AS sector2_sec,
              l_tax AS sector3_sec, 1::BIGINT AS stint_number, compound_name AS compound, 1::BIGINT AS tyre_life, NULL::BIGINT AS position,
              0::BIGINT AS is_personal_best, 1::BIGINT AS is_accurate, l_partkey::DOUBLE AS speed_i1, NULL::DOUBLE AS speed_i2, NULL::DOUBLE AS speed_fl
            FROM lineitem JOIN dim_event ON event_id = l_orderkey JOIN dim_driver ON driver_id = l_suppkey
            JOIN bridge_driver_team USING (event_id, driver_id) JOIN dim_team USING (team_id)
            LEFT JOIN dim_compound ON compound_id = ascii(l_linestatus)""",
    ),
    "teammates": (
        teammates_view,
        f"""WITH {TEAMMATES} SELECT event_id, session_id, gp_name, team_name, {_PAIR_NAMES}
            FROM pairs JOIN dim_event USING (event_id) {_PAIR_JOINS}""",
    ),
    "graph_teammates": (graph_teammates, f"WITH {TEAMMATES} SELECT {_PAIR_NAMES}, team_name FROM pairs {_PAIR_JOINS}"),
    "graph_network": (
        graph_network,
        f"""WITH {STAR} SELECT driver_code, full_name AS driver_name, team_name, final_position, points FROM bridge_driver_team
            JOIN fact_result USING (event_id, driver_id) JOIN dim_driver USING (driver_id) JOIN dim_team USING (team_id)
            JOIN dim_event USING (event_id)""",
    ),
    "driver_cards": (
        lambda spark, sf: rel.driver_cards(star(spark, sf, ["final_position"])),
        f"""WITH {STAR} SELECT event_id, driver_id, driver_code, full_name AS driver_name, coalesce('#' || team_color, '#666666') AS color,
              final_position FROM bridge_driver_team JOIN dim_driver USING (driver_id) JOIN dim_team USING (team_id)
            LEFT JOIN fact_result USING (event_id, driver_id)""",
    ),
    "grid_gain": (
        lambda spark, sf: rel.grid_gain(star(spark, sf)["fact_result"]),
        f"WITH {STAR} SELECT *, grid_position - final_position AS places_gained FROM fact_result",
    ),
    "team_ranking": (
        lambda spark, sf: rel.team_ranking(views.driver_event_results(star(spark, sf, RESULT)), k=10),
        f"""WITH {STAR}, totals AS (
              SELECT team_name, sum(points) AS points, round(avg(final_position) + 1e-9, 3) AS avg_position, count(*) AS entries
              FROM fact_result JOIN bridge_driver_team USING (event_id, driver_id) JOIN dim_team USING (team_id) GROUP BY team_name)
            SELECT *, rank() OVER (ORDER BY points DESC) AS team_rank FROM totals ORDER BY points DESC, team_name LIMIT 10""",
    ),
}
