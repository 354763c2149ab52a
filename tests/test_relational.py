import random
import statistics

import pytest
from pyspark.sql import functions as F

from sixfold.operators import graph
from sixfold.operators import relational as rel

HOT = [None, 3]


def frame(spark, rows, schema="event_id int, driver_id int, stint_number int, lap_number int, lap_time_sec decimal(12,6), is_accurate int, compound string, tyre_life int"):
    from decimal import Decimal

    fixed = [tuple(Decimal(str(v)) if i == 4 and v is not None else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(fixed, schema)


def stints(spark):
    rows = []
    for event in (1, 2):
        for driver in (1, 2):
            rows += [(event, driver, 1 + (lap > 3), lap, 90 + driver + lap * 0.5, int(lap != 2), "SOFT", lap) for lap in range(1, 7)]
    return frame(spark, rows)


@pytest.mark.parametrize("hot", HOT)
def test_pace_delta_skips_inaccurate_laps(spark, hot):
    got = rel.pace_delta(stints(spark), hot_rows=hot).where("event_id = 1 and driver_id = 1").orderBy("lap_number").collect()
    assert [(r.lap_number, None if r.delta_to_prev is None else float(r.delta_to_prev)) for r in got] == [(1, None), (3, 1.0), (4, None), (5, 0.5), (6, 0.5)]


def test_stint_of_one_lap(spark):
    one = frame(spark, [(1, 1, 1, 1, 95.0, 1, None, 1)])
    assert rel.stint_summary(one).first().lap_time_stddev == 0.0
    assert rel.consistency_rank(one).first().lap_time_stddev == 0.0
    assert rel.distribution(one, ["event_id", "driver_id"]).first().std is None


def test_rank_ties_share_a_rank(spark):
    rows = [(1, d, 1, lap, 90.0 + lap * (d > 2), 1, "SOFT", lap) for d in (1, 2, 3) for lap in (1, 2)]
    got = [(r.driver_id, r.consistency_rank) for r in rel.consistency_rank(frame(spark, rows), k=3).orderBy("driver_id").collect()]
    assert got == [(1, 1), (2, 1), (3, 3)]


@pytest.mark.parametrize("hot", HOT)
def test_degradation_and_matrix(spark, hot):
    worn = rel.degradation(stints(spark), hot_rows=hot)
    first = worn.where("event_id = 1 and driver_id = 2 and stint_number = 1").orderBy("lap_number").collect()
    assert [float(r.degradation_from_fresh) for r in first] == [0.0, 1.0]
    matrix = rel.life_matrix(worn, max_life=6)
    row = matrix.where("driver_id = 1").first()
    assert row.life_2 is None and float(row.life_3) == 1.0 and float(row.life_6) == 1.0
    limits = rel.matrix_range(matrix).first()
    assert (float(limits.min_cell), float(limits.max_cell), limits.driver_id) == (0.0, 1.0, 1)


@pytest.mark.parametrize("hot", [None, 10])
def test_quartiles_equal_plain_computation(spark, hot):
    rng = random.Random(1)
    values = {key: [rng.choice([91, 92.5, 95, 99, 120]) + rng.randrange(3) for _ in range(n)] for key, n in ((1, 60), (2, 1), (3, 8))}
    rows = [(1, key, 1, i, v, 1, "SOFT", 1) for key, vs in values.items() for i, v in enumerate(vs)]
    got = {r.driver_id: r for r in rel.distribution(frame(spark, rows), ["driver_id"], hot_rows=hot).collect()}
    for key, vs in values.items():
        q = statistics.quantiles(vs, n=4, method="inclusive") if len(vs) > 1 else vs * 3
        assert [got[key].q1, got[key].median, got[key].q3] == pytest.approx(q)
        assert got[key]["count"] == len(vs)
    rough = rel.distribution(frame(spark, rows), ["driver_id"], exact=False)
    assert rough.columns[:2] == ["driver_id", "mean"] and rough.count() == 3
    assert [r.driver_id for r in rel.most_consistent(rough, ["driver_id"], 2).collect()][-1] in (1, 3)


def test_strategy_and_pit_stops(spark):
    rows = [(1, 1, s, lap, 95.0, 1, None if s == 2 else "HARD", 1) for s, lap in ((1, 1), (1, 2), (2, 3), (3, 4), (3, 5))]
    plan = rel.stint_strategy(frame(spark, rows))
    got = [(r.stint_number, r.compound, r.start_lap, r.end_lap, r.length, r.laps, r.max_lap) for r in plan.orderBy("stint_number").collect()]
    assert got == [(1, "HARD", 1, 2, 2, 2, 5), (2, "MEDIUM", 3, 3, 1, 1, 5), (3, "HARD", 4, 5, 2, 2, 5)]
    assert sorted(r.pit_lap for r in rel.pit_stops(plan, hot_rows=2).collect()) == [2, 3]


def test_overtakes_by_hand(spark):
    before, after = {"A": 1, "B": 2, "C": 3}, {"C": 1, "A": 2, "B": 3}
    rows = [(1, d, 1, p) for d, p in before.items()] + [(1, d, 2, p) for d, p in after.items()]
    laps = spark.createDataFrame(rows, "event_id int, driver_id string, lap_number int, position int")
    edges = graph.overtakes(laps, rel.position_changes(laps))
    assert sorted((r.overtaker_id, r.overtaken_id, r.weight) for r in edges.collect()) == [("C", "A", 1), ("C", "B", 1)]
    assert {r.driver_id: r.net_gain for r in graph.net_gains(edges).collect()} == {"C": 2, "A": -1, "B": -1}
    assert {r.normalized for r in graph.edge_weights(edges).collect()} == {1.0}


def test_lap_gap_is_no_change(spark):
    laps = spark.createDataFrame([(1, 1, 5, 3), (1, 1, 7, 2), (1, 1, 8, None)], "event_id int, driver_id int, lap_number int, position int")
    assert rel.position_changes(laps).count() == 0
    assert [r.position_delta for r in rel.position_deltas(laps).orderBy("lap_number").collect()] == [None, -1]


@pytest.mark.parametrize("seed", range(3))
def test_overtakes_equal_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    rows, order = [], {}
    for event in (1, 2):
        for lap in range(1, 9):
            field = list(range(1, 9))
            rng.shuffle(field)
            for place, d in enumerate(field, 1):
                if rng.random() < 0.9:
                    rows.append((event, d, lap, place))
                    order[event, lap, place] = d
    # One place held twice: the smaller driver counts.
    rows.append((1, 99, 1, 1))
    order.setdefault((1, 1, 1), 99)
    at = {(e, d, lap): p for e, d, lap, p in rows}
    counts = {}
    for (e, d, lap), p in at.items():
        nxt = at.get((e, d, lap + 1))
        if nxt is not None and nxt < p:
            for place in range(nxt, p):
                other = order.get((e, lap, place))
                if other is not None and other != d:
                    counts[e, d, other] = counts.get((e, d, other), 0) + 1
    laps = spark.createDataFrame(rows, "event_id int, driver_id int, lap_number int, position int")
    edges = graph.overtakes(laps, rel.position_changes(laps))
    assert {(r.event_id, r.overtaker_id, r.overtaken_id): r.weight for r in edges.collect()} == counts
    gains = {}
    for (e, a, b), n in counts.items():
        gains[e, a] = gains.get((e, a), 0) + n
        gains[e, b] = gains.get((e, b), 0) - n
    assert {(r.event_id, r.driver_id): r.net_gain for r in graph.net_gains(edges).collect()} == gains


@pytest.mark.parametrize("hot", HOT)
def test_movers(spark, hot):
    rows = [(1, 1, lap, p) for lap, p in enumerate([5, 3, 4, 1], 1)] + [(1, 2, lap, p) for lap, p in enumerate([1, 1, 2], 1)]
    laps = spark.createDataFrame(rows, "event_id int, driver_id int, lap_number int, position int")
    moved = rel.movers(rel.position_deltas(laps, hot_rows=hot))
    assert sorted(tuple(r) for r in moved.collect()) == [(1, 1, 2, 1, 5), (1, 2, 0, 1, 0)]
    assert rel.top_mover(moved).first().driver_id == 1


def test_grid_and_teams(spark):
    results = spark.createDataFrame([("x", 5, 1, 25), ("x", 1, 4, 12), ("y", 2, 2, 18), ("z", None, None, 37)], "team_name string, grid_position int, final_position int, points int")
    assert [r.places_gained for r in rel.grid_gain(results).orderBy("points").collect()] == [-3, 0, 4, None]
    ranks = {r.team_name: (r.points, r.team_rank) for r in rel.team_ranking(results).collect()}
    assert ranks == {"x": (37, 1), "z": (37, 1), "y": (18, 3)}


def test_pattern_over_two_events(spark):
    bridge = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (2, 1, 20), (2, 3, 10)], "event_id int, driver_id int, team_id int")
    t = {
        "dim_driver": spark.createDataFrame([(i, f"D{i}", f"Driver {i}", i) for i in (1, 2, 3)], "driver_id int, driver_code string, full_name string, driver_number int"),
        "dim_team": spark.createDataFrame([(10, "Ten", "t"), (20, "Twenty", "w")], "team_id int, team_name string, team_code string"),
        "dim_event": spark.createDataFrame([(1, "s1", 2024, "g", "r"), (2, "s2", 2024, "g", "r")], "event_id int, session_id string, season int, gp_name string, session_name string"),
        "bridge_driver_team": bridge,
        "fact_result": spark.createDataFrame([(1, 1, 1, 25, 1), (2, 1, None, 0, 1)], "event_id int, driver_id int, final_position int, points int, status_id int"),
    }
    g = graph.racing_graph(t)
    assert [(r.driver1_code, r.driver2_code) for r in graph.teammates(g).collect()] == [("D1", "D2")]
    loose = sorted((r.driver1_code, r.driver2_code) for r in graph.teammates(g, same_event=False).collect())
    assert loose == [("D1", "D2"), ("D1", "D3"), ("D2", "D3")]
    network = graph.driver_network(g).orderBy(F.col("final_position").asc_nulls_last()).collect()
    assert [(r.driver_code, r.team_name, r.final_position) for r in network] == [("D1", "Ten", 1), ("D1", "Twenty", None)]
    with pytest.raises(ValueError):
        g.match("d", "drives_for", "e", "t").columns(x="d.shoe_size")
