import numpy as np
import pytest
from pyspark.sql import functions as F

from sixfold.operators import vector as vec

SCHEMA = "msg_id int, category string, message_text string, embedding array<float>"


@pytest.fixture(scope="module")
def messages(spark):
    rng = np.random.default_rng(0)
    rows = [(i, ["Flag", "Drs", "SafetyCar", None][i % 4], f"Incident {i}" if i % 3 == 0 else f"m {i}", [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    rows.append((60, "Flag", None, None))
    return spark.createDataFrame(rows, SCHEMA)


def ranked(messages, query, keep=lambda r: True):
    out = []
    for r in messages.collect():
        if r.embedding is not None and keep(r):
            a, b = np.array(r.embedding, dtype=float), np.array(query, dtype=float)
            out.append((1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), r.msg_id))
    return [i for _, i in sorted(out)]


def test_nearest(messages):
    query = [1.0, 0.5, 0, 0, -1, 0, 0, 2]
    assert [r.msg_id for r in vec.nearest(messages, query, k=8).collect()] == ranked(messages, query)[:8]
    drs = vec.nearest(messages, query, k=8, where=F.col("category") == "Drs").collect()
    assert [r.msg_id for r in drs] == ranked(messages, query, lambda r: r.category == "Drs")[:8]
    assert all(r.distance == round(r.distance, 4) for r in drs)


def test_distances(spark):
    df = spark.createDataFrame([(1, "a", "", [1.0, 0.0]), (2, "a", "", [0.0, 1.0]), (3, "a", "", [-2.0, 0.0])], SCHEMA)
    assert [r.distance for r in vec.nearest(df, [5.0, 0.0]).collect()] == [0.0, 1.0, 2.0]


def test_several_queries(messages):
    queries = {"x": [1.0] + [0.0] * 7, "y": [0.0, -1.0] + [0.0] * 6}
    got = vec.nearest_to_each(messages, queries, k=5)
    for name, q in queries.items():
        assert [r.msg_id for r in got.where(F.col("query") == name).orderBy("place").collect()] == ranked(messages, q)[:5]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_example(messages):
    seed = messages.where("msg_id = 2").first().embedding
    got = [r.msg_id for r in vec.nearest_to_example(messages, F.col("category") == "SafetyCar", k=8).collect()]
    assert got == ranked(messages, seed, lambda r: r.msg_id != 2)[:8]


def test_keyword(messages):
    query = [1.0] * 8
    got = vec.similar_with_keyword(messages, query).collect()
    assert [r.msg_id for r in got] == ranked(messages, query)[:6]
    assert [r.has_keyword for r in got] == [r.msg_id % 3 == 0 for r in got]


def test_categories(messages):
    got = {r.category: (r.cnt, r.total) for r in vec.category_counts(messages).collect()}
    assert got == {"Flag": (15, 60), "Drs": (15, 60), "SafetyCar": (15, 60), "Unknown": (15, 60)}


def test_projection(messages):
    rows = [r for r in messages.orderBy("msg_id").collect() if r.embedding is not None]
    x = np.array([r.embedding for r in rows], dtype=float)
    z = (x - x.mean(0)) / x.std(0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    vt = vt[:2] * np.sign([v[np.abs(v).argmax()] for v in vt[:2]])[:, None]
    got = vec.project(messages).orderBy("msg_id").collect()
    assert np.allclose([[r.pc1, r.pc2] for r in got], z @ vt.T, atol=1e-6)
    assert got[0].explained_1 == pytest.approx(s[0] ** 2 / (s**2).sum())
