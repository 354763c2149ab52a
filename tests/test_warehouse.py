"""The whole load from raw files, the views over it, and loading again."""

import math

import pytest
from pyspark.sql import functions as F

from sixfold import schema
from sixfold.operators import documents, graph, quality, relational, spatial, timeseries, vector
from sixfold.plans import demo, views, warehouse
from sixfold.plans.warehouse import build_warehouse
from sixfold.sources import tables
from sixfold.sources.tables import read_warehouse
from tests.bronze_files import telemetry, write_all, write_session


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    bronze, out = str(tmp_path_factory.mktemp("bronze")), str(tmp_path_factory.mktemp("out"))
    write_all(bronze)
    return bronze, out, build_warehouse(spark, bronze, out)


@pytest.fixture(scope="module")
def t(loaded):
    return loaded[2]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dimensions(t):
    events = {r.session_id: r for r in t["dim_event"].collect()}
    assert set(events) == {"2024_Singapore_R", "2024_Monaco_R"}
    singapore = events["2024_Singapore_R"]
    assert (singapore.season, singapore.circuit_name, singapore.country_code, singapore.country_name) == (2024, "Singapore Town", "SGP", "Singapore")
    assert str(singapore.session_start_ts) == "2024-09-22 20:00:00"
    assert sorted(r.driver_code for r in t["dim_driver"].collect()) == ["NOR", "PIA", "VER"]
    assert sorted(r.driver_id for r in t["dim_driver"].collect()) == [1, 2, 3]
    assert t["bridge_driver_team"].count() == 5
    assert t["bridge_driver_team"].join(t["dim_driver"], "driver_id").where("driver_code = 'NOR'").count() == 2


def test_lookups(t):
    status = {r.status_name: (r.status_id, r.is_classified) for r in t["dim_result_status"].collect()}
    assert status["Finished"] == (1, 1) and len(status) == len(schema.STATUSES) + 2
    assert status["+3 Laps"][1] == 1 and status["Fire"][1] == 0
    assert {status["+3 Laps"][0], status["Fire"][0]} == {19, 20}
    compound = {r.compound_name: r.compound_type for r in t["dim_compound"].collect()}
    assert compound["SOFT"] == "DRY" and compound["C6"] == "OTHER" and len(compound) == len(schema.COMPOUNDS) + 1


def test_facts(t):
    laps = t["fact_lap"].join(t["dim_driver"], "driver_id").join(t["dim_event"], "event_id").where("season = 2024 and gp_name = 'Singapore'")
    assert laps.count() == 9  # ZZZ has no result and is dropped
    nor = laps.where("driver_code = 'NOR' and lap_number = 2").first()
    assert float(nor.lap_time_sec) == 100.0 and nor.is_personal_best == 1 and nor.is_accurate == 1 and float(nor.lap_start_time_sec) == 260.0
    assert laps.where("driver_code = 'PIA' and lap_number = 2").first().lap_time_sec is None
    assert laps.where("driver_code = 'NOR' and lap_number = 1").first().is_personal_best == 0
    assert t["fact_telemetry"].count() == 10 + 6 + 3
    assert t["telemetry_spatial"].count() == 2 + 2 + 1
    assert t["fact_track_status"].count() == 4  # one duplicate key per session
    assert t["fact_session_status"].count() == 4
    assert [float(r.air_temp) for r in t["fact_weather"].orderBy("time_sec").collect()] == [25.15, 26.0]
    result = t["fact_result"].where("final_position = 1").orderBy("event_id").first()
    assert float(result.total_time_sec) == 5400.123 and result.q1_time_sec is None


def test_documents_and_messages(t):
    docs = t["f1_raw_documents"]
    assert docs.count() == 8 and docs.select("doc_id").distinct().count() == 8
    texts = {r.message_text: r for r in views.race_control_messages(t).collect() if r.gp_name == "Singapore"}
    green = texts['GREEN LIGHT - "PIT" EXIT, OPEN']
    assert green.lap == 1.0 and green.flag == "GREEN" and green.msg_time == "2024-09-22 12:00:00"
    assert texts["INCIDENT NOTED"].category is None and texts["INCIDENT NOTED"].racing_number == "4"
    assert any("\n" in text for text in texts)
    messages = t["f1_messages"]
    assert messages.count() == 6 and messages.where(F.size("embedding") == 384).count() == 6
    for r in messages.collect():
        assert math.isclose(sum(x * x for x in r.embedding), 1.0, rel_tol=1e-4)
    info = documents.session_extract(docs).orderBy("gp_name").collect()
    assert [(r.session_id, r.location) for r in info] == [("2024_Monaco_R", "Monaco Town"), ("2024_Singapore_R", "Singapore Town")]
    top = documents.message_extract(docs, k=None).where("lap = 2").first()
    assert len(top.message_text) == 50


def test_all_constraints_hold(t):
    report = quality.constraint_report(t).collect()
    assert len(report) > 60
    assert [r for r in report if r.violations] == []


def test_views_run_and_match_by_hand(t):
    assert views.driver_event_results(t).count() == 5
    assert views.lap_analysis(t).count() == 11
    stints = {(r.driver_id, r.stint_number, r.compound): r for r in views.stint_summary(t).where("lap_count > 1").collect()}
    assert sorted(float(s.lap_time_stddev) for s in stints.values()) == sorted([1.061, 0.707, 0.25])
    one = views.stint_summary(t).where("lap_count = 1").collect()
    assert all(r.lap_time_stddev == 0.0 for r in one) and one
    per_second = views.telemetry_1sec(t)
    assert per_second.agg(F.sum("sample_count")).first()[0] == t["fact_telemetry"].count()
    mates = rows(views.teammates(t).select("gp_name", "team_name"), "gp_name")
    assert mates == [("Monaco", "RedBull"), ("Singapore", "McLaren")]
    weather = {float(r.time_sec): r.session_status for r in views.weather_timeline(t).collect()}
    assert weather == {30.0: "Inactive", 95.0: "Started"}


def test_view_names_are_registered(spark, t):
    names = views.register_views(spark, t)
    assert len(names) == 7
    assert spark.sql("select count(*) from v_lap_analysis where compound is null").first()[0] == 3


def test_demo_queries(t):
    pace = relational.pace_delta(t["fact_lap"]).join(t["dim_driver"], "driver_id").where("driver_code = 'PIA'").orderBy("lap_number").collect()
    assert [None if r.delta_to_prev is None else float(r.delta_to_prev) for r in pace] == [None, 1.0]
    rank = relational.consistency_rank(t["fact_lap"]).collect()
    assert [r.consistency_rank for r in rank] == sorted(r.consistency_rank for r in rank) and len(rank) == 3
    brakes = timeseries.heavy_braking(t["fact_telemetry"]).collect()
    assert brakes and all(float(r.max_speed_at_brake) > 150 for r in brakes)
    near = spatial.within_distance(t["telemetry_spatial"], 850, 1200, 50).collect()
    assert {(r.x, r.y) for r in near} == {(850.0, 1200.0)}
    g = graph.racing_graph(t)
    assert rows(graph.teammates(g).select("team_name"), "team_name") == [("McLaren",), ("RedBull",)]
    literal = graph.teammates(g, same_event=False).count()
    # Without the event: McLaren's pair; RedBull has VER twice and NOR once, so two pairs.
    assert literal == 3
    assert graph.driver_network(g).count() == 5
    assert graph.driver_network(g, same_event=False).count() == 2 * 2 + 1 + 2 * 2
    assert relational.driver_cards(t).count() == 5


def test_message_search(t):
    messages = t["f1_messages"]
    seed = messages.where("category = 'SafetyCar'").orderBy("msg_id").first()
    twin = vector.nearest_to_example(messages, F.col("category") == "SafetyCar", k=8).collect()
    assert len(twin) == 5 and twin[0].distance == 0.0 and twin[0].message_text == seed.message_text and twin[0].msg_id != seed.msg_id
    assert vector.nearest(messages, list(seed.embedding), k=2, where=F.col("category") == "Flag").count() == 2
    counts = {r.category: (r.cnt, r.total) for r in vector.category_counts(messages).collect()}
    assert counts == {"Flag": (2, 6), "SafetyCar": (2, 6), "Unknown": (2, 6)}
    flagged = vector.similar_with_keyword(messages, list(seed.embedding), k=6).collect()
    assert sum(r.has_keyword for r in flagged) == 2
    feed = documents.message_feed(t["f1_raw_documents"]).collect()
    assert len(feed) == 6 and {r.time_sec for r in feed} == {0.0, 90.0} and {r.category for r in feed} == {"Flag", "SafetyCar", "Unknown"}
    lines = documents.timeline(documents.message_feed(t["f1_raw_documents"])).select("category", "y_pos").distinct().collect()
    assert sorted(r.y_pos for r in lines) == [0, 1, 2]


def test_demo_reports(t):
    pace = demo.pace_delta(t).collect()
    order = [(r.driver_code, r.stint_number, r.lap_number, r.event_id) for r in pace]
    assert order == sorted(order) and {r.driver_code for r in pace} == {"NOR", "PIA", "VER"} and len(pace) <= 15
    assert len(demo.pace_delta(t, k=2).collect()) == 2
    ranks = [r.consistency_rank for r in demo.consistency_rank(t).collect()]
    assert ranks == sorted(ranks) and len(ranks) == 3
    braking = [r.braking_events for r in demo.heavy_braking(t).collect()]
    assert braking and braking == sorted(braking, reverse=True)
    minutes = [r.session_minute for r in demo.session_status(t).collect()]
    assert minutes == sorted(minutes) and len(minutes) == 4
    assert {(r.x, r.y) for r in demo.near_point(t).collect()} == {(850.0, 1200.0)}
    parts = [(r.driver_code, r.track_sector) for r in demo.sectors(t).collect()]
    assert parts and parts == sorted(parts)
    places = [r.final_position for r in demo.driver_network(t).collect()]
    assert len(places) == 5 and places == sorted(places, key=lambda p: (p is None, p))
    assert [r.cnt for r in demo.message_categories(t).collect()] == [2, 2, 2]
    worn = demo.degradation(t).collect()
    assert worn and all(r.degradation_from_fresh is not None for r in worn if r.lap_time is not None)
    matrix = demo.life_matrix(t)
    oldest = t["fact_lap"].where("is_accurate = 1").agg(F.max("tyre_life")).first()[0]
    assert [c for c in matrix.columns if c.startswith("life_")] == [f"life_{n}" for n in range(1, oldest + 1)]
    spread = [r.std for r in demo.distribution(t).collect()]
    known = [s for s in spread if s is not None]
    assert known == sorted(known) and spread[: len(known)] == known
    assert {r.compound for r in demo.stint_strategy(t).collect()} >= {"MEDIUM"}
    assert "team_color" in demo.position_deltas(t).columns and demo.position_deltas(t).count() == relational.position_deltas(t["fact_lap"]).count()


def test_second_load_keeps_keys(spark, loaded, monkeypatch):
    bronze, out, before = loaded
    messages = {(r.event_id, r.message_text, r.msg_id) for r in before["f1_messages"].collect()}
    read = []
    real = warehouse.bronze.read_dataset
    monkeypatch.setattr(warehouse.bronze, "read_dataset", lambda s, root, dataset, sessions=None: read.append((dataset, sessions)) or real(s, root, dataset, sessions))
    same = build_warehouse(spark, bronze, out, refresh=False)
    assert read == []  # nothing new: no file is read
    assert {(r.event_id, r.message_text, r.msg_id) for r in same["f1_messages"].collect()} == messages
    drivers = {r.driver_code: r.driver_id for r in before["dim_driver"].collect()}
    counts = {name: df.count() for name, df in before.items()}
    write_session(bronze, 2025, "Monza", [(4, "NOR", "McLaren", 1, "Finished"), (12, "ANT", "Mercedes", 2, "Finished")], [("ANT", 1, 90.0, 1, "SOFT", 1, 2)], telemetry(12, 20))
    after = build_warehouse(spark, bronze, out, refresh=False)
    assert {s for _, chosen in read for s in chosen} == {"2025_Monza_R"}
    kept = {(r.event_id, r.message_text, r.msg_id) for r in after["f1_messages"].collect()}
    assert messages < kept and len({m for _, _, m in kept}) == 9
    now = {r.driver_code: r.driver_id for r in after["dim_driver"].collect()}
    assert now == {**drivers, "ANT": 4}
    assert after["fact_lap"].count() == counts["fact_lap"] + 1
    assert after["f1_raw_documents"].count() == counts["f1_raw_documents"] + 4
    assert after["f1_messages"].count() == 9
    assert after["fact_telemetry"].count() == counts["fact_telemetry"] + 2
    assert [r for r in quality.constraint_report(after).collect() if r.violations] == []
    counts = {n: df.count() for n, df in after.items()}
    once_more = build_warehouse(spark, bronze, out, refresh=False, only=["2025_Monza_R"])  # its messages are written anew
    assert {n: df.count() for n, df in once_more.items()} == counts
    again = read_warehouse(spark, out)
    assert {n: df.count() for n, df in again.items()} == counts


def contents(spark, out):
    return {name: sorted(map(str, df.collect())) for name, df in read_warehouse(spark, out).items()}


def small(tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    (tmp_path / "bronze").mkdir()
    write_session(bronze, 2024, "Monaco", [(4, "NOR", "RedBull", 2, "Finished")], [("NOR", 1, 80.0, 1, "SOFT", 1, 2)], telemetry(4, 25))
    return bronze, out


def test_a_load_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    bronze, out = small(tmp_path)
    old = build_warehouse(spark, bronze, out)
    write_session(bronze, 2025, "Monza", [(4, "NOR", "McLaren", 1, "Finished"), (12, "ANT", "Mercedes", 2, "Fire")], [("ANT", 1, 90.0, 1, "C6", 1, 2)], telemetry(12, 20))
    before, real = contents(spark, out), tables.Load.append
    for refresh, after in ((True, 3), (False, 11)):
        writes = []

        def append(self, df, table):
            if len(writes) == after:
                raise RuntimeError("stopped")
            writes.append(table)
            return real(self, df, table)

        with monkeypatch.context() as m, pytest.raises(RuntimeError, match="stopped"):
            m.setattr(tables.Load, "append", append)
            build_warehouse(spark, bronze, out, refresh=refresh)
        assert contents(spark, out) == before
    begun, commit = [], tables.Load.commit

    def late(self):  # another load ends first: this one is refused and begins anew
        begun.append(self.base.version)
        if len(begun) == 1:
            other = tables.Load(spark, out)
            other.append(spark.createDataFrame([(7, "MON", 99, "X", "X", "X", "X")], schema.struct("dim_driver")), "dim_driver")
            commit(other)
            assert [r.driver_code for r in read_warehouse(spark, out)["dim_driver"].orderBy("driver_id").collect()] == ["NOR", "MON"]
        return commit(self)

    monkeypatch.setattr(tables.Load, "commit", late)
    whole = build_warehouse(spark, bronze, out, refresh=False)
    assert begun == [1, 2] and tables.latest(spark, out).version == 3
    assert sorted((r.driver_code, r.driver_id) for r in whole["dim_driver"].collect()) == [("ANT", 8), ("MON", 7), ("NOR", 1)]
    assert [r for r in quality.constraint_report(whole).collect() if r.violations] == []
    docs = {(r.doc_id, r.payload) for r in whole["f1_raw_documents"].collect()}
    assert {(r.doc_id, r.payload) for r in old["f1_raw_documents"].collect()} < docs and len({d for d, _ in docs}) == len(docs) == 8
    assert old["dim_event"].count() == 1 and whole["dim_event"].count() == 2  # each as of its commit
    kept = contents(spark, out)
    assert tables.remove_unused(spark, out, hours=-1) and contents(spark, out) == kept and tables.remove_unused(spark, out, hours=-1) == []


def test_only_folders_of_the_loading_events_are_read(spark, tmp_path):
    """The plan does not grow with the events, and prunes by what the other side holds when it runs."""
    root = str(tmp_path)
    load = tables.Load(spark, root)
    columns = {"event_id": F.col("id"), "time_sec": F.lit(1.0), "status": F.lit("x")}
    load.append(spark.range(1, 41).select(*[c.alias(n) for n, c in columns.items()]), "fact_session_status")
    sizes = []
    for n in (2, 30):
        events = load.scratch(spark.range(1, n + 1).select(F.col("id").alias("event_id")), f"events{n}").where("event_id > 0")
        some = warehouse.of_events(load.read("fact_session_status"), events)
        assert some.count() == n
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan.lower()
        sizes.append(len(plan))
    assert abs(sizes[0] - sizes[1]) < 100


def test_telemetry_is_read_and_sorted_once(spark, tmp_path, monkeypatch):
    scans, placed, rows = [], warehouse.placed_samples, warehouse.telemetry_rows

    def check(df, stride):
        plan = rows(df, stride)._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "csv" not in plan and "parquet" in plan
        return rows(df, stride)

    monkeypatch.setattr(warehouse, "placed_samples", lambda *a: scans.append(a[2]) or placed(*a))
    monkeypatch.setattr(warehouse, "telemetry_rows", check)
    t = build_warehouse(spark, *small(tmp_path), telemetry_stride=3, spatial_stride=5)
    assert scans == [[3, 5]]
    assert t["fact_telemetry"].count() == 9 and t["telemetry_spatial"].count() == 5
