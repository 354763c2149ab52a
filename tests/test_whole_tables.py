"""The fact and track queries over whole tables: no line, event or vector is left out before the operator."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sixfold.plans import warehouse

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


def test_every_row_meets_its_driver(spark):
    rows = {name: spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("lineitem", "events", "embeddings")}
    count = lambda name: entry.queries()[name](spark, SMALL).count()
    sampled = lambda df, key, stride: df.groupBy(*key).count().agg(F.sum(F.ceil(F.col("count") / stride))).first()[0]
    assert count("lap_facts_all") == rows["lineitem"].count()
    assert count("series_facts_all") == rows["events"].count()
    assert count("telemetry_facts_all") == sampled(rows["events"], ["user_id"], 3)
    assert count("spatial_facts_all") == sampled(rows["events"], ["user_id"], 4)
    points = sampled(rows["embeddings"], ["label", F.col("vec_id") % 20], 2)
    assert count("track_points_all") == count("speed_trace_all") == points


def test_null_cells_and_unknown_drivers(spark):
    drivers = spark.createDataFrame([(1, "AB", "7", 70), (2, "AB", "8", 70)], "event_id bigint, driver_code string, driver_number string, driver_id bigint")
    laps = spark.createDataFrame(
        [(1, " AB", "1.0", "80.5"), (1, "AB", None, "81"), (1, "AB", "bad", "81"), (1, "XY", "1", "82"), (1, None, "1", "83"), (3, "AB", "1", "84"), (2, "AB", "1", "85")],
        "event_id bigint, Driver string, LapNumber string, LapTime string",
    )
    got = warehouse.lap_facts(laps, drivers, warehouse.seed_compounds(spark)).select("event_id", "driver_id", "lap_number", "lap_time_sec").collect()
    assert sorted((r.event_id, r.driver_id, r.lap_number, float(r.lap_time_sec)) for r in got) == [(1, 70, 1, 80.5), (2, 70, 1, 85.0)]
    cells = [(1, "7", str(i), "1" if i % 3 else None) for i in range(7)] + [(1, "7", None, "1"), (1, "9", "0", "1"), (1, None, "0", "1"), (2, "7", "0", "1"), (2, "8", "bad", "1")]
    samples = spark.createDataFrame(cells, "event_id bigint, Driver string, SessionTime string, X string").withColumn("Y", F.col("X"))
    times = lambda df: sorted(float(r.session_time_sec) for r in df.collect())
    assert times(warehouse.telemetry_facts(samples, drivers, stride=2)) == [0, 2, 4, 6]
    assert times(warehouse.spatial_facts(samples, drivers, stride=2)) == [2, 4]


@pytest.mark.parametrize("name, key", [("lap_facts", "compound"), ("result_facts", "status")])
def test_no_fact_is_dealt_by_one_of_few_names(spark, tmp_path, name, key):
    lines = [(i, i % 7, i % 3, i % 4, float(i), 1.0, 0.1, 0.02 * (i % 2), "ANR"[i % 3], "OF"[i % 2]) for i in range(40)]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, f"S{i}", i % 2) for i in range(5)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    made = entry.queries()[name](spark, str(tmp_path))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning({key}_" not in plan and "BroadcastHashJoin" in plan
    assert made.count() == {"lap_facts": 40, "result_facts": 5}[name]


@pytest.mark.parametrize("name", ["driver_cards", "driver_event_results", "graph_network"])
def test_bridge_and_results_are_aggregated_before_they_are_joined(spark, tmp_path, name):
    lines = [(i // 2, i % 4, i % 3, float(i % 9), "ANR"[i % 3], "OF"[i % 2]) for i in range(30)] + [(7, 99, 1, 1.0, "A", "O")]  # 99: no supplier
    spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").selectExpr(
        "*", "1L AS l_partkey", "1D AS l_extendedprice", "1D AS l_discount", "1D AS l_tax"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, f"S{i}", i % 2) for i in range(4)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "A", 0), (1, "B", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(i, "O", "5-LOW") for i in range(15)], "o_orderkey bigint, o_orderstatus string, o_orderpriority string").selectExpr(
        "*", "timestamp_ntz '2024-01-01' AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    made = entry.queries()[name](spark, str(tmp_path))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "min(l_linenumber" not in plan
    assert made.count() == len({(a, b) for a, b, *_ in lines if b < 99})
    if name == "driver_cards":
        got = {(r.event_id, r.driver_id): (r.driver_code, r.color, r.final_position) for r in made.collect()}
        most = {}
        for a, b, n, *_ in lines:
            most[a, b] = max(most.get((a, b), 0), n)
        assert got == {(a, b): (f"S{b}", ("#666666", "#1")[b % 2], n) for (a, b), n in most.items() if b < 99}


@pytest.mark.parametrize("name, key, rows", [("dimension_keys", "brand", 3), ("bridge_rows", "team_name", 5)])
def test_no_row_is_dealt_by_one_of_few_names(spark, tmp_path, name, key, rows):
    spark.range(200_000).selectExpr("id AS p_partkey", "concat('B', id % 3) AS p_brand", "cast(id % 9 AS int) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i, f"S{i}", i % 2) for i in range(5)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "64k")
    try:
        made = entry.queries()[name](spark, str(tmp_path))
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "SortMergeJoin" in x and f"[{key}#" in x]
        assert made.count() == rows
    finally:
        spark.conf.set(limit, before)
