"""Ordered windows: the split form must equal the plain window, also with hot keys, ties, NULLs and outliers."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sixfold.operators.ordered import stride_sample, with_ordered

ASKED = dict(
    row_number="rn",
    previous={"prev": "v", "prev_id": "id"},
    following={"next": "v"},
    last_seen={"seen": "v"},
    first={"start": "v"},
    running_sum={"total": "n"},
    key_sum={"all": "n"},
)


def rows(seed, kind):
    rng = random.Random(seed)
    out = []
    for i in range(1500):
        key = rng.choice(["hot", "hot", "hot", None, "a", "b", "c", "d"])
        t = rng.random() * 100
        if kind == "outlier" and i % 300 == 0:
            t = -1e12 if i % 600 else 1e12
        if kind == "burst":
            t = 5.0 + rng.randrange(8) if rng.random() < 0.9 else t
        if kind == "nulls" and rng.random() < 0.1:
            t = None
        if kind == "nan" and rng.random() < 0.05:
            t = float(rng.choice(["nan", "inf", "-inf"]))
        out.append((key, t, i, rng.choice([None, rng.randrange(50)]), rng.choice([None, 1, 2, 3])))
    return out


@pytest.mark.parametrize("kind", ["plain", "outlier", "burst", "nulls", "nan"])
def test_split_equals_plain_window(spark, kind):
    df = spark.createDataFrame(rows(3, kind), "k string, t double, id int, v int, n bigint")
    split = with_ordered(df, ["k"], ["t", "id"], hot_rows=40, **ASKED)
    plain = with_ordered(df, ["k"], ["t", "id"], hot_rows=None, **ASKED)
    assert split.columns == plain.columns
    key = lambda r: r["id"]
    assert list(map(str, sorted(split.collect(), key=key))) == list(map(str, sorted(plain.collect(), key=key)))


@pytest.mark.parametrize("kind", ["plain", "outlier", "burst"])
def test_split_from_a_small_sample(spark, monkeypatch, kind):
    from sixfold.operators import ordered

    monkeypatch.setattr(ordered, "SAMPLE", 70)
    df = spark.createDataFrame(rows(4, kind), "k string, t double, id int, v int, n bigint")
    split = with_ordered(df, ["k"], ["t", "id"], hot_rows=30, **ASKED)
    plain = with_ordered(df, ["k"], ["t", "id"], hot_rows=None, **ASKED)
    key = lambda r: r["id"]
    assert list(map(str, sorted(split.collect(), key=key))) == list(map(str, sorted(plain.collect(), key=key)))


def test_few_places_with_many_copies(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), (F.col("id") % 4).alias("t"), F.lit(1).alias("v"))
    out = with_ordered(df, ["k"], ["t"], row_number="rn", running_sum={"s": "v"}, hot_rows=100)
    assert sorted(r.rn for r in out.collect()) == list(range(1, 3001))
    assert out.groupBy("t").agg(F.min("rn")).orderBy("t").collect()[3][1] == 2251


def test_global_order(spark):
    df = spark.createDataFrame(rows(5, "plain"), "k string, t double, id int, v int, n bigint")
    out = with_ordered(df, [], ["t", "id"], row_number="rn", hot_rows=50)
    assert [r.rn for r in out.orderBy("t", "id").collect()] == list(range(1, 1501))


def test_hot_key_is_cut_into_bounded_groups(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("t"), "id")
    from sixfold.operators import ordered

    place = ordered.position(df, "t")
    cuts = ordered._hot_cuts(df, ["k"], ["t", "id"], place, 1000)
    sizes = ordered._with_chunk(df, ["k"], cuts, place, "inner").groupBy("_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 1000


def test_stride_restarts_per_key(spark):
    df = spark.createDataFrame([(d, float(i), i) for d in ("a", "b") for i in range(25)], "d string, t double, i int")
    for hot in (None, 5):
        got = sorted((r.d, r.i) for r in stride_sample(df, 10, ["d"], ["t"], hot_rows=hot).collect())
        assert got == [(d, i) for d in ("a", "b") for i in (0, 10, 20)]


def test_text_order_is_refused(spark):
    with pytest.raises(TypeError):
        with_ordered(spark.createDataFrame([("a", "b")], "k string, t string"), ["k"], ["t"], row_number="rn")


@pytest.mark.parametrize("names", [["t", "id"], ["t", "name", "id"]])
def test_rows_of_one_time_are_cut_apart(spark, names):
    from sixfold.operators import ordered

    df = spark.range(20_000).select(
        F.lit("hot").alias("k"), F.lit(7.0).alias("t"), (F.col("id") * 7919 % 20_000).alias("id"), F.concat(F.lit("n"), F.col("id") % 3).alias("name")
    )
    place = F.struct(*names)
    cuts = ordered._hot_cuts(df, ["k"], names, place, 500)
    sizes = ordered._with_chunk(df, ["k"], cuts, place, "inner").groupBy("_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 500
    how = dict(row_number="rn", previous={"before": "id"}, running_sum={"sum": "id"})
    split = with_ordered(df, ["k"], names, hot_rows=500, **how)
    plain = with_ordered(df, ["k"], names, hot_rows=None, **how)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_more_cuts_than_one_block(spark):
    df = spark.range(12_000).select(F.lit(1).alias("k"), (F.col("id") % 500).cast("double").alias("t"), "id")
    split = with_ordered(df, ["k"], ["t", "id"], row_number="rn", following={"next": "id"}, hot_rows=20)
    plain = with_ordered(df, ["k"], ["t", "id"], row_number="rn", following={"next": "id"}, hot_rows=None)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
