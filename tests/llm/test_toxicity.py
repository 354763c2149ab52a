"""The chain of classifiers against the same steps written out row by row, and few labels."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sixfold.llm import toxicity as tox
from sixfold.llm.textscan import Texts


def labelled(n=60):
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(50)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words, 12))
        low, toxic = int(rng.random() < 0.4), int(rng.random() < 0.3)
        rows.append((i, f"{text} {'junk blah' if low else ''} {'nasty vile' if toxic else ''}", low, toxic))
    return rows + [(n, rows[0][1], *rows[0][2:]), (n + 1, None, 1, 1), (n + 2, "word1", None, 1)]


def test_each_step_of_the_chain(spark):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], *r[2:]) for r in rows], "doc_id bigint, low int, toxic int")
    chain = tox.fit_chain(docs, labels, ("low", "toxic"))
    # By hand: all rows are taken (chance 1 each), a text's fold goes by its hash.
    taken = [r for r in rows if r[1] is not None and r[2] is not None]
    folds = dict(docs.select("doc_id", tox.fold_of("text", 3)).collect())
    assert folds[0] == folds[60]  # copies share a fold
    fold = np.array([folds[r[0]] for r in taken])
    assert set(fold) == {0, 1, 2}
    found = [tox.features(Texts(pa.array([r[1]])))[1] for r in taken]
    row, feature = np.repeat(np.arange(len(taken)), [len(f) for f in found]), np.concatenate(found)
    low, toxic = (np.array([r[k] for r in taken], float) for k in (2, 3))

    def model(y, dense, inside):
        weights, extra, intercept = tox.fit_logistic(row[inside[row]], feature[inside[row]], dense, y, inside / 1.0)
        return sigmoid(np.array([weights[f].sum() for f in found]) + dense @ extra + intercept)

    sigmoid, none = tox.sigmoid, np.zeros((len(taken), 0))
    unseen = np.zeros(len(taken))
    for k in range(3):
        unseen[fold == k] = model(low, none, fold != k)[fold == k]
    everything = np.ones(len(taken), bool)
    p_low, p_toxic = model(low, none, everything), model(toxic, tox.logit(unseen)[:, None], everything)
    got = chain.score(Texts(pa.array([r[1] for r in taken])), fold)
    assert np.allclose(got["low"], p_low, atol=1e-4) and np.allclose(got["toxic"], p_toxic, atol=1e-3)
    assert abs(p_low - unseen).max() > 0.1  # what is handed on is not what the model of all rows says


def test_poor_texts_are_not_toxic_where_labels_are_few(spark):
    rows = labelled(400)
    docs = spark.createDataFrame([(*r[:2], "x", 1) for r in rows], "doc_id bigint, text string, fold string, p_low int")
    labels = spark.createDataFrame([(r[0], *r[2:]) for r in rows] + [(None, 1, 1), (0, 0, 0)], "doc_id bigint, low int, toxic int")
    scored = tox.score_toxicity(docs, labels, ("low", "toxic"))
    assert scored.columns == ["doc_id", "text", "fold", "p_low", "p_toxic"] and scored.count() == len(rows)
    p = {r.doc_id: r.p_toxic for r in scored.collect()}
    known = [r for r in rows if r[1] is not None and r[2] is not None]
    poor, bad = [r[0] for r in known if r[2] and not r[3]], [r[0] for r in known if r[3]]
    assert sum(p[i] >= 0.5 for i in poor) <= len(poor) // 25 and sum(p[i] >= 0.5 for i in bad) >= len(bad) * 0.95
    assert p[401] == 0.0  # a null text
    empty = tox.score_toxicity(docs, labels.where("false"), ("low", "toxic"))
    assert {r.p_toxic for r in empty.collect()} == {0.0}
    assert tox.score_toxicity(docs.where(F.lit(False)), labels, ("low", "toxic")).count() == 0
