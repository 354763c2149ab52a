"""Toxicity as a chain of linear classifiers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.llm.store import cut
from sixfold.llm.textscan import ALNUM, LOWER, VALUES, Texts, Words, extend, mix, span_hash, sums

#: Hashed features.
BITS = 18
#: Labelled rows that the classifiers are fitted on, about.
MAX_TRAIN = 12_000
#: Features of one classifier.
MAX_FEATURES = 2_000
FOLDS = 3
#: Weight of the squared coefficients.
RIDGE = 1e-5


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text: words and their first four and five bytes. Returns the texts and the features, sorted."""
    words = Words(texts, ALNUM)
    c = sums(texts.buf, VALUES[LOWER])
    found = [span_hash(c, words.start, words.end)]
    for size in (4, 5):
        long = words.end - words.start > size
        h = span_hash(c, words.start, np.minimum(words.start + size, words.end))
        found.append(mix(h[long] + np.uint64(size)))
        words_of = words.text[long]
        found.append(words_of)
    text = np.concatenate([words.text, found[2], found[4]])
    h = np.concatenate([found[0], found[1], found[3]])
    key = np.unique((text.astype(np.uint64) << np.uint64(BITS)) | (h >> np.uint64(64 - BITS)))
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def telling(row: np.ndarray, feature: np.ndarray, y: np.ndarray, inside: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` features whose log odds ratio stands out most from its standard error."""
    used, place = np.unique(feature, return_inverse=True)
    n1, n0 = (inside & (y > 0)).sum() + 1.0, (inside & (y <= 0)).sum() + 1.0
    a = np.bincount(place, weights=y[row] > 0, minlength=len(used)) + 0.5
    b = np.bincount(place, weights=y[row] <= 0, minlength=len(used)) + 0.5
    ratio = np.log(a / (n1 - a + 0.5)) - np.log(b / (n0 - b + 0.5))
    z = np.abs(ratio) / np.sqrt(1 / a + 1 / b + 1 / (n1 - a + 0.5) + 1 / (n0 - b + 0.5))
    return np.sort(used[np.argsort(-z, kind="stable")[:most]])


def fit_logistic(row: np.ndarray, feature: np.ndarray, dense: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300, l2: float = RIDGE, most: int = MAX_FEATURES):
    """Logistic regression over binary features (pairs of row and feature) and some dense columns, by full-batch Adam."""
    inside = weight > 0
    used = telling(row, feature, y, inside, most)
    found = np.isin(feature, used)
    row, place, n = row[found], np.searchsorted(used, feature[found]), len(y)
    size = len(used) + dense.shape[1] + 1
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    weight = weight / weight.sum()
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[place], minlength=n) + dense @ w[len(used) : -1] + w[-1]
        error = (sigmoid(z) - y) * weight
        g = np.concatenate([np.bincount(place, weights=error[row], minlength=len(used)), dense.T @ error, [error.sum()]])
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w[: len(used)]
    return weights, w[len(used) : -1], float(w[-1])


class Chain:
    """Fitted links in order: (category, and per model feature weights, weights of the logits of the links before, intercept).

    Models 0 to ``folds - 1`` did not see their fold, the last one saw all rows. A link's answer comes from the last one. What it hands
    on to later links comes from the model that did not see the text's fold, as in training: else a text that a model was fitted on
    would hand on a certainty that the later links never met.
    """

    def __init__(self, links: list):
        self.links = links

    def score(self, texts: Texts, fold: np.ndarray) -> dict[str, np.ndarray]:
        text, feature = features(texts)
        out, before, any_word = {}, [], np.bincount(text, minlength=texts.n) > 0
        for name, weights, extra, intercept in self.links:

            def p(model: np.ndarray) -> np.ndarray:
                z = np.bincount(text, weights=weights[model[text], feature], minlength=texts.n) + intercept[model]
                for k, earlier in enumerate(before):
                    z = z + extra[model, k] * earlier
                return np.where(any_word, sigmoid(z), 0.0)

            out[name] = p(np.full(texts.n, len(weights) - 1))
            if len(out) < len(self.links):
                before.append(logit(p(fold)))
        return out


def fold_of(text: str, folds: int):
    """The fold of a text: copies of it share one, whatever their ids."""
    return F.pmod(F.xxhash64(F.lit(6), text), F.lit(folds)).cast("int")


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], max_train: int = MAX_TRAIN, folds: int = FOLDS, max_features: int = MAX_FEATURES, ridge: float = RIDGE) -> Chain:
    """Fit one classifier per category, in order, on a bounded sample of the labelled ``docs`` (``doc_id, text``);
    ``labels`` has one row per ``doc_id`` with a 0/1 column per category.

    The later classifiers also see the logits of the earlier categories. What they see in training comes from models that did not have
    that row (out of fold), so it is as uncertain as it will be on new texts. Of about ``max_train`` rows, every category's rarer and
    commoner value get equal shares, chosen by a hash of the id; weights undo this. Of the hashed features the ``max_features`` that tell
    most get a weight. Every model is fitted in a task of its own.
    Rows with a null text or a null label are left out.
    """
    there = docs.where("text IS NOT NULL").select("doc_id")
    known = cut(labels.dropna(subset=["doc_id", *categories]).select("doc_id", *[F.col(c).cast("int").alias(c) for c in categories]).join(there, "doc_id", "left_semi"))
    sizes = {(c, v): n for c in categories for v, n in known.groupBy(c).count().collect()}
    share = max_train / (2 * len(categories))
    # Each row's chance is the largest that one of its labels gives it.
    chance = F.greatest(*[F.coalesce(*[F.when(F.col(c) == v, F.lit(min(1.0, share / n))) for (d, v), n in sizes.items() if d == c], F.lit(0.0)) for c in categories], F.lit(0.0))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id"), 11) / F.lit(float(1 << 53))
    chosen = known.withColumn("chance", chance).where(unit < F.col("chance"))  # about max_train rows of a few numbers
    sample = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").withColumn("fold", fold_of("text", folds))

    def encode(_, texts: Texts) -> dict:
        text, feature = features(texts)
        return {"features": np.split(feature.astype(np.int32), np.searchsorted(text, np.arange(1, texts.n)))}

    encoded = extend(sample, encode, {"features": ("array<int>", pa.list_(pa.int32()))}, without=("text",))
    rows = cut(encoded.withColumn("row", F.monotonically_increasing_id()))
    copies = rows.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(folds))))

    links, seen = [], {}
    for k, category in enumerate(categories):
        fit = _link_fitter(category, dict(seen), k, max_features, ridge)
        # Nothing comes after the last link, so it needs the model of all rows only.
        fitted = copies.where(F.col("model") >= (folds if k == len(categories) - 1 else 0)).groupBy("model").applyInPandas(fit, "model int, weights binary, extra array<double>, intercept double, rows array<bigint>, p array<double>").collect()
        first = min((f.model for f in fitted), default=0)
        weights, extra, intercept = np.zeros((folds + 1 - first, 1 << BITS), np.float32), np.zeros((folds + 1 - first, k)), np.zeros(folds + 1 - first)
        for f in fitted:
            at = f.model - first
            weights[at], extra[at], intercept[at] = np.frombuffer(bytes(f.weights), np.float32), f.extra, f.intercept
            for r, p in zip(f.rows, f.p):
                seen[r] = [*seen.get(r, []), p]
        if fitted:
            links.append((category, weights, extra, intercept))
    return Chain(links)


def _link_fitter(category: str, earlier: dict[int, list[float]], k: int, most: int, ridge: float):
    """Fits one model of a link on the rows outside its fold and predicts the rows of the fold; model number ``folds`` sees all rows."""

    def fit(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["doc_id", "row"]).reset_index(drop=True)
        model = int(pdf["model"].iloc[0])
        dense = np.array([logit(np.array(earlier[r])) for r in pdf["row"]]).reshape(len(pdf), k) if k else np.zeros((len(pdf), 0))
        y, inside = pdf[category].to_numpy(float), pdf["fold"].to_numpy() != model
        lengths = np.array([len(f) for f in pdf["features"]], np.int64)
        row, feature = np.repeat(np.arange(len(pdf)), lengths), np.concatenate([*pdf["features"], np.zeros(0, np.int32)]).astype(np.int64)
        weight = inside / pdf["chance"].to_numpy() if inside.any() else np.ones(len(pdf))  # all rows in one fold: nothing else to fit on
        known = inside if inside.any() else ~inside
        weights, extra, intercept = fit_logistic(row[known[row]], feature[known[row]], dense, y, weight, l2=ridge, most=most)
        out = ~inside
        z = np.bincount(row, weights=weights[feature], minlength=len(pdf)) + dense @ extra + intercept
        return pd.DataFrame(
            {"model": [model], "weights": [weights.tobytes()], "extra": [list(extra)], "intercept": [intercept], "rows": [pdf["row"][out].tolist()], "p": [sigmoid(z[out]).tolist()]}
        )

    return fit


def score_toxicity(docs: DataFrame, labels: DataFrame, categories: Sequence[str], max_train: int = MAX_TRAIN, folds: int = FOLDS, **how) -> DataFrame:
    """``docs`` with ``p_<category>`` (double) for each category: fitted on the labelled documents, applied to all of them.

    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id`` and a 0/1 column for each category, from weak to strong signal. Of several
    labels of one document the largest counts. Earlier links hand on to later ones what a model says that saw neither the text nor a copy of it. A null text, or one without words, has probability 0; without labelled rows all have.
    Repeated rows are scored each. Texts are read twice and never shuffled whole; the model is one array of ``2**BITS`` per category.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    chain = fit_chain(docs.select("doc_id", "text"), known, categories, max_train, folds, **how)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fold = "fold"
    while fold in docs.columns:
        fold += "_"

    def work(part: pa.RecordBatch, texts: Texts) -> dict:
        p = shared.value.score(texts, np.asarray(part.column(part.schema.get_field_index(fold))))
        return {f"p_{c}": p.get(c, np.zeros(texts.n)) for c in categories}

    return extend(docs.withColumn(fold, fold_of("text", folds)), work, {f"p_{c}": ("double", pa.float64()) for c in categories}, without=(fold,))


def label_columns(labels: DataFrame) -> DataFrame:
    """The label table as the chain's categories: low quality first, as junk often is what toxic words stand in, then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


CATEGORIES = ("low_quality", "toxic")


def op1(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    scored = score_toxicity(docs, label_columns(spark.read.parquet(f"{sf}/labels.parquet")), CATEGORIES)
    return scored.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


QUERIES = {"op1_toxicity_chain": (op1, None)}
