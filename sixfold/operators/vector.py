"""Vector search on ``array<float>`` columns: top k, filters, examples, categories, projection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sixfold.functions.vectors import dot, literal


def category_counts(messages: DataFrame, category: str = "category", vector: str = "embedding") -> DataFrame:
    """Rows with a vector per category (``Unknown`` where missing) and in all."""
    embedded = messages.where(F.col(vector).isNotNull())
    counts = embedded.groupBy(F.coalesce(F.nullif(F.col(category).cast("string"), F.lit("")), F.lit("Unknown")).alias(category)).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counts.withColumn("total", embedded.agg(F.count(F.lit(1)).alias("_total")).scalar())


def _measured(rows: DataFrame, query: Column | Sequence[float], vector: str, unit_vectors: bool, out: str) -> DataFrame:
    """Add the similarity to a query vector. Lengths that are known to be 1 are not computed for every row."""
    if isinstance(query, Column):
        # The query is a column first: a scalar subquery may not stand inside the vector functions.
        rows, direction = rows.withColumn("_query", query), F.col("_query")
        along = F.try_divide(dot(F.col(vector), direction), F.sqrt(dot(direction, direction)))
    else:
        length = math.sqrt(sum(float(x) * float(x) for x in query))
        along = dot(F.col(vector), literal([float(x) / length for x in query])) if length else F.lit(None).cast("double")
    similarity = along if unit_vectors else F.try_divide(along, F.sqrt(dot(F.col(vector), F.col(vector))))
    return rows.withColumn(out, similarity).drop("_query")


def nearest(
    messages: DataFrame, query: Column | Sequence[float], key: str = "msg_id", k: int = 8, where: Column | None = None, vector: str = "embedding",
    unit_vectors: bool = False,
) -> DataFrame:
    """The ``k`` rows closest to a query vector by cosine distance; a filter goes to the scan first. Ties by key.

    ``unit_vectors``: the stored vectors have length 1, as the warehouse writes them, so that one dot product is enough.
    """
    rows = messages if where is None else messages.where(where)
    measured = _measured(rows.where(F.col(vector).isNotNull()), query, vector, unit_vectors, "_similarity")
    found = measured.withColumn("_distance", 1 - F.col("_similarity")).orderBy(F.col("_distance").asc_nulls_last(), key).limit(k)
    return found.withColumn("distance", F.round("_distance", 4)).drop("_distance", "_similarity", vector)


def nearest_to_each(
    messages: DataFrame, queries: Mapping[str, Sequence[float]], key: str = "msg_id", k: int = 8, vector: str = "embedding", unit_vectors: bool = False
) -> DataFrame:
    """The ``k`` closest rows for every one of a few named query vectors, in one scan.

    Only keys and distances are ranked; each task keeps its own k best per query before the shuffle, so a query's window sees at most
    k rows per task. The other columns are joined to the best rows: k for each query, so the side that is broadcast is bounded.
    ``key`` must be unique.
    """
    rows = messages.where(F.col(vector).isNotNull()).select(key, vector)
    for i, query in enumerate(queries.values()):
        rows = _measured(rows, query, vector, unit_vectors, f"_similarity_{i}")
    hits = F.array(*[F.struct(F.lit(name).alias("query"), (1 - F.col(f"_similarity_{i}")).alias("_distance")) for i, name in enumerate(queries)])
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("_distance").asc_nulls_last(), key))
    best = rows.select(key, F.inline(hits)).withColumn("_place", place).where(F.col("_place") <= k)
    placed = best.select("query", key, F.round("_distance", 4).alias("distance"), F.col("_place").cast("bigint").alias("place"))
    rest = [c for c in messages.columns if c != vector]
    return messages.select(*rest).join(F.broadcast(placed), key).select("query", *rest, "distance", "place")


def nearest_to_example(
    messages: DataFrame, category: Column, key: str = "msg_id", k: int = 8, vector: str = "embedding", unit_vectors: bool = False
) -> DataFrame:
    """The ``k`` rows closest to the first row (smallest key) of a category, without that row."""
    # One value for the whole plan, not a join: the seed's key and vector as scalar subqueries.
    first = messages.where(category).agg(F.min(F.struct(key, vector)).alias("_seed"))
    seed_key = first.select(F.col("_seed")[key].alias("_key")).scalar()
    seed_vector = first.select(F.col("_seed")[vector].alias("_vector")).scalar()
    return nearest(messages, seed_vector, key, k, where=F.col(key) != seed_key, vector=vector, unit_vectors=unit_vectors)


def similar_with_keyword(
    messages: DataFrame, query: Column | Sequence[float], word: str = "INCIDENT", text: str = "message_text", key: str = "msg_id", k: int = 6,
    vector: str = "embedding", unit_vectors: bool = False,
) -> DataFrame:
    """The ``k`` rows most similar to a query, and whether their text holds a word (in any case)."""
    measured = _measured(messages.where(F.col(vector).isNotNull()), query, vector, unit_vectors, "similarity")
    best = measured.orderBy(F.col("similarity").desc_nulls_last(), key).limit(k)
    return best.withColumn("has_keyword", F.coalesce(F.upper(text).contains(word.upper()), F.lit(False))).drop(vector)


def project(messages: DataFrame, vector: str = "embedding", k: int = 2) -> DataFrame:
    """Standardised vectors on their first ``k`` principal components (``pc1`` ...), with each one's share of the variance.

    Not lazy: fitting runs three jobs while the plan is built. It reads the table twice and sends only sums over the vector's own width to the driver. The sign of a component is
    fixed so that its largest loading is positive. Scaling is by the population spread.
    """
    rows = messages.where(F.col(vector).isNotNull()).withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    scaler = StandardScaler(withMean=True, inputCol="_features", outputCol="_scaled").fit(rows)
    scaled = scaler.transform(rows)
    model = PCA(k=k, inputCol="_scaled", outputCol="_pcs").fit(scaled)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]
    n = rows.agg(F.count(F.lit(1)).cast("double").alias("_n")).scalar()
    to_population = F.sqrt(n / F.nullif(n - 1, F.lit(0.0)))
    projected = model.transform(scaled).withColumn("_pcs", vector_to_array("_pcs"))
    columns = {f"pc{i + 1}": F.col("_pcs")[i] * signs[i] * to_population for i in range(k)}
    shares = {f"explained_{i + 1}": F.lit(float(model.explainedVariance[i])) for i in range(k)}
    return projected.withColumns({**columns, **shares}).drop("_features", "_scaled", "_pcs", vector)
