import datetime
import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from sixfold.functions.columns import durations_to_seconds, flag, iso_timestamp, number, session_id, slug, stddev_or_zero, text, truncated, whole
from sixfold.functions.embedding import byte_embedding, embed
from sixfold.functions.vectors import cosine_distance, from_text, literal, unit


def one(df):
    return [tuple(r) for r in df.collect()]


def test_slug(spark):
    df = spark.createDataFrame([(" São  Paulo GP! ",), ("a b\tc-_1",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(slug("t")).collect()] == ["So_Paulo_GP", "a_b_c-_1", "", None]
    assert df.limit(1).select(session_id(F.lit(2024), "t", F.lit(" R "))).first()[0] == "2024_So_Paulo_GP_R"


def test_numbers(spark):
    cells = ["12.0", "R", "", None, "12.9", "-3.7", " 5 ", "NaN", "inf", "-Infinity", "1d", "1f", "1e3", "2.35"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = {r.c: r for r in df.select("c", whole("c").alias("w"), number("c").alias("d"), number("c", "decimal(5,1)").alias("m")).collect()}
    assert [got[c].w for c in cells] == [12, None, None, None, 12, -3, 5, None, None, None, None, None, 1000, 2]
    assert [got[c].d for c in ("NaN", "inf", "1d", "1e3", "R")] == [None, None, None, 1000.0, None]
    assert float(got["2.35"].m) == 2.4 and got["R"].m is None and got["NaN"].m is None


def test_flag_and_text(spark):
    df = spark.createDataFrame([(True, "x"), (False, "  "), (None, None)], "b boolean, t string")
    assert one(df.select(flag("b"), text("t"))) == [(1, "x"), (0, None), (0, None)]
    cells = spark.createDataFrame([("True",), ("False",), ("maybe",), (None,)], "c string")
    assert [r[0] for r in cells.select(flag("c")).collect()] == [1, 0, 0, 0]


def test_timestamps(spark):
    cells = ["2024-09-22T20:00:00", "2024-09-22 20:00:00.250", "2024-09-22T20:00:00Z", "2024-09-22T20:00:00+08:00", "2024-09-22", "soon", "2024-13-01", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    at = datetime.datetime(2024, 9, 22, 20)
    expected = [at, at.replace(microsecond=250000), at, at, at.replace(hour=0), None, None, None]
    assert [r[0] for r in df.select(iso_timestamp("c")).collect()] == expected


def test_durations_and_truncation(spark):
    df = spark.createDataFrame([(datetime.timedelta(minutes=1, microseconds=500000), -1.5)], "d interval day to second, x double")
    assert one(durations_to_seconds(df)) == [(60.5, -1.5)]
    assert df.select(truncated("x")).first()[0] == -1


def test_spread_of_one_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0)], "k string, v double")
    assert dict(one(df.groupBy("k").agg(stddev_or_zero("v")))) == {"a": 0.0, "b": math.sqrt(2)}


def test_hash_embedding(spark):
    texts = ["SAFETY CAR", "SAFETY CAR", "", None] + [f"m{i}" for i in range(250)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    got = {r.i: r.e for r in df.select("i", embed("t").alias("e")).collect()}
    assert got[0] == got[1] and got[3] is None and len(got[2]) == 384
    seed = int.from_bytes(hashlib.sha256(b"SAFETY CAR").digest()[:4], "big")
    wanted = np.random.default_rng(seed).standard_normal(384).astype(np.float32)
    assert np.array_equal(np.array(got[0], dtype=np.float32), wanted / np.linalg.norm(wanted))


def test_own_encoder_sees_batches(spark):
    def build():
        return lambda texts: np.full((len(texts), 2), float(len(texts)))

    df = spark.createDataFrame([("x",)] * 5, "t string").coalesce(1)
    assert sorted(r.e[0] for r in df.select(embed("t", build, batch=2).alias("e")).collect()) == [1.0, 2.0, 2.0, 2.0, 2.0]


def test_byte_embedding(spark):
    got = spark.createDataFrame([("héllo",)], "t string").select(byte_embedding("t").alias("e")).first().e
    digest = hashlib.sha256("héllo".encode()).digest()
    assert len(got) == 48 and got[32:] == got[16:32]
    assert got[:32] == [b / 255 - 0.5 for b in digest]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([0.0, 2.0],), ([-3.0, 0.0],), ([0.0, 0.0],), ([1.0],), (None,)], "v array<float>")
    got = [r[0] for r in df.select(cosine_distance(F.col("v"), literal([2.0, 0.0]))).collect()]
    assert got == [0.0, 1.0, 2.0, None, None, None]
    assert df.limit(2).select(unit(F.col("v"))).collect()[1][0] == [0.0, 1.0]
    assert spark.range(1).select(from_text(F.lit("[1.5,2]"))).first()[0] == [1.5, 2.0]
