import datetime

import pytest
from pyspark.sql import functions as F

from sixfold.operators import keys, quality
from sixfold.plans.warehouse import compound_members, seed_compounds, seed_statuses, status_members, to_documents
from sixfold.sources import bronze, tables


def test_four_violations(spark):
    rows = spark.createDataFrame(
        [(1, 10, "{}", [1.0, 2.0, 3.0]), (1, 11, "{", [1.0]), (2, 99, None, None), (None, None, '{"a":1}', [0.0, 0.0, 0.0])],
        "id int, parent int, payload string, v array<float>",
    )
    parent = spark.createDataFrame([(10,), (11,), (11,)], "pid int")
    report = [
        quality.duplicate_keys(rows, "t", ["id"]).first(),
        quality.orphans(rows, "t", "parent", parent, "p", "pid").first(),
        *quality.row_rules(rows, "t", ["id"], ["payload"], {"v": 3}).collect(),
    ]
    assert {r.rule: r.violations for r in report} == {
        "primary key id": 1, "foreign key parent -> p.pid": 1, "not null id": 1, "json payload": 1, "length v = 3": 1,
    }
    assert quality.violating_rows(rows, ["id"]).count() == 3


def test_rules_in_one_pass(spark):
    rows = spark.createDataFrame(
        [(1, 10, "{}", [1.0, 2.0, 3.0], 0.0), (1, 11, "{", [1.0], -0.0), (2, 99, None, None, 5.0), (3, 99, None, None, None), (None, None, '{"a":1}', [0.0, 0.0, 0.0], 7.0)],
        "id int, parent int, payload string, v array<float>, d double",
    )
    t = {"t": rows, "p": spark.createDataFrame([(10,), (11,), (11,)], "pid bigint"), "none": rows.where("id > 100")}
    rules = [
        quality.Rule("t", "primary key", ("id",)),
        quality.Rule("t", "unique", ("d",)),
        quality.Rule("t", "unique", ("id", "parent")),
        quality.Rule("p", "primary key", ("pid",)),
        quality.Rule("t", "foreign key", ("parent",), parent=("p", "pid")),
        quality.Rule("t", "foreign key", ("id",), parent=("p", "pid"), parent_name="other"),
        quality.Rule("t", "foreign key", ("parent",), parent=("none", "id")),
        quality.Rule("t", "not null", ("id",)),
        quality.Rule("t", "json", ("payload",)),
        quality.Rule("t", "length", ("v",), length=3),
        quality.Rule("none", "primary key", ("id",)),
        quality.Rule("none", "not null", ("id",), table="nothing"),
    ]
    report = quality.rule_report(t, rules)
    assert sorted(map(tuple, report.collect())) == sorted([
        ("t", "primary key id", 1), ("t", "unique d", 1), ("t", "unique id,parent", 0), ("p", "primary key pid", 1), ("t", "foreign key parent -> p.pid", 2),
        ("t", "foreign key id -> other.pid", 4), ("t", "foreign key parent -> none.id", 4), ("t", "not null id", 1), ("t", "json payload", 1),
        ("t", "length v = 3", 1), ("none", "primary key id", 0), ("nothing", "not null id", 0),
    ])
    with pytest.raises(TypeError):
        quality.rule_report(t, [quality.Rule("t", "foreign key", ("payload",), parent=("p", "pid"))])


def test_rules_scan_each_table_once(spark, tmp_path):
    for name in ("child", "parent"):
        spark.range(50).select(F.col("id"), (F.col("id") % 7).alias("ref")).write.parquet(str(tmp_path / name))
    t = {name: spark.read.parquet(str(tmp_path / name)) for name in ("child", "parent")}
    rules = [quality.Rule(n, kind, (c,)) for n in t for kind in ("primary key", "not null") for c in ("id", "ref")]
    rules += [quality.Rule("child", "foreign key", (c,), parent=("parent", "id")) for c in ("id", "ref")]
    plan = quality.rule_report(t, rules)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 2


def test_counts(spark):
    got = {r.table_name: (r.table_type, r.row_count) for r in quality.table_counts({"dim_x": spark.range(3), "f1_messages": None, "telemetry_spatial": spark.range(1), "other": spark.range(2)}).collect()}
    assert got == {"dim_x": ("Dimension", 3), "f1_messages": ("Vector", 0), "telemetry_spatial": ("Spatial", 1), "other": ("Other", 2)}


def test_keys_are_dense_and_stable(spark):
    old = keys.assign_keys(spark.createDataFrame([(f"n{i}",) for i in range(500)], "name string"), ["name"], "id")
    first = {r.name: r.id for r in old.collect()}
    assert sorted(first.values()) == list(range(1, 501))
    assert {r.name: r.id for r in old.repartition(7).collect()} == first
    incoming = spark.createDataFrame([("n1",), ("new",), ("new",), (None,)], "name string")
    assert [(r.id, r.name) for r in keys.new_members(old, incoming, "name", "id").collect()] == [(501, "new")]


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (None, 1, "n"), (1, 3, "a"), (None, 2, "m")], "k int, at int, v string")
    got = sorted((tuple(r) for r in tables.first_per_key(df, ["k"], ["at"]).collect()), key=str)
    assert got == [(1, 3, "a"), (None, 1, "n")]
    stored = spark.createDataFrame([(None,)], "k int")
    assert [tuple(r) for r in tables.absent(df, stored, ["k"], ["at"]).collect()] == [(1, 3, "a")]


def test_lookup_members(spark):
    names = spark.createDataFrame([(" soft ",), ("c6",), ("C6 ",), (None,), ("",)], "compound_name string")
    assert [tuple(r) for r in compound_members(names, seed_compounds(spark)).collect()] == [(10, "C6", "OTHER")]
    statuses = spark.createDataFrame([("+3 Laps",), ("Finished",), ("Fire",)], "status_name string")
    assert {r.status_name: r.is_classified for r in status_members(statuses, seed_statuses(spark)).collect()} == {"+3 Laps": 1, "Fire": 0}


def test_row_to_document(spark):
    df = spark.createDataFrame([(1, None, "x\"y")], "event_id int, a int, b string")
    assert to_documents(df, "kind").first().payload == '{"a":null,"b":"x\\"y"}'


def test_bronze_round_trip(spark, tmp_path):
    root = str(tmp_path)
    with pytest.warns(UserWarning):
        assert bronze.read_dataset(spark, root, "laps") is None
    with pytest.warns(UserWarning):
        assert bronze.read_session_info(spark, root) is None
    laps = spark.createDataFrame([("NOR", datetime.timedelta(seconds=95.5), 'say "hi", ok', None)], "Driver string, LapTime interval day to second, Note string, Gone string")
    tagged = bronze.tag_and_concat({"4": laps, "81": laps, "1": laps}, "2024_X_R", limit=2)
    assert tagged.count() == 2
    assert bronze.write_dataset(tagged, root, "laps", "2024_X_R")
    with pytest.warns(UserWarning):
        assert not bronze.write_dataset(laps.where("1 = 0"), root, "weather", "2024_X_R")
    back = bronze.read_dataset(spark, root, "laps").orderBy("Driver").collect()
    assert [(r.Driver, r.LapTime, r.Note, r.Gone, r.session_id) for r in back] == [("4", "95.5", 'say "hi", ok', None, "2024_X_R"), ("81", "95.5", 'say "hi", ok', None, "2024_X_R")]
    info = spark.createDataFrame([("2024_X_R", 2024, None)], "session_id string, year int, event_name string")
    bronze.write_session_info(info, root, "2024_X_R")
    doc = bronze.read_session_info(spark, root).first()
    assert doc.session_id == "2024_X_R" and '"event_name":null' in doc.document and '"exported_at":"2' in doc.document
    order = spark.createDataFrame([("81", 2), ("4", 1)], "Driver string, place int")
    assert [r.Driver for r in bronze.limit_drivers(tagged, order, 1).collect()] == ["4"]


def test_missing_cells(spark, tmp_path):
    (tmp_path / "weather_2024_X_R.csv").write_text("Time,AirTemp\n1.0,NaN\n2.0,None\n3.0,5\n,7\n")
    got = bronze.read_dataset(spark, str(tmp_path), "weather").orderBy("_row").collect()
    assert [(r.Time, r.AirTemp) for r in got] == [("1.0", None), ("2.0", None), ("3.0", "5"), (None, "7")]


def test_replace_one_event(spark, tmp_path):
    root = str(tmp_path)
    rows = [(1, 1.0, "a"), (2, 1.0, "b")]
    make = lambda r: spark.createDataFrame(r, "event_id bigint, time_sec double, status string")
    stored = lambda: sorted((r.event_id, float(r.time_sec), r.status) for r in tables.read_warehouse(spark, root)["fact_session_status"].collect())
    load = tables.Load(spark, root)
    load.append(make(rows), "fact_session_status")
    load.replace(make([(2, 5.0, "c"), (2, 6.0, "d")]), "fact_session_status")
    assert stored() == []  # not before the commit
    load.commit()
    assert stored() == [(1, 1.0, "a"), (2, 5.0, "c"), (2, 6.0, "d")]
    later = tables.Load(spark, root)
    later.replace(make([(2, 7.0, "e"), (3, 1.0, "f")]), "fact_session_status")
    later.append(make([(1, 2.0, "g")]), "fact_session_status")
    assert len(stored()) == 3
    later.commit()
    assert stored() == [(1, 1.0, "a"), (1, 2.0, "g"), (2, 7.0, "e"), (3, 1.0, "f")]
    assert tables.read_warehouse(spark, root)["fact_lap"].count() == 0
    first, second = tables.Load(spark, root), tables.Load(spark, root)
    first.commit()
    with pytest.raises(tables.CommitConflict):
        second.commit()


def test_feed_is_stored(spark, tmp_path):
    path = quality.write_feed(spark.range(3), str(tmp_path), "feed")
    assert spark.read.parquet(path).agg(F.count("*")).first()[0] == 3
