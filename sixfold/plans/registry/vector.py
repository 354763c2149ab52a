"""Vector search, projection and text embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sixfold.functions.embedding import byte_embedding, embed
from sixfold.functions.vectors import dot
from sixfold.operators import vector as vec
from sixfold.plans.inputs import message_documents, table
from sixfold.plans.registry.documents import race_control_messages
from sixfold.plans.warehouse import message_rows


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("msg_id"),
        F.col("label").alias("category"),
        F.concat(F.when(F.col("label") % 3 == 0, "An incident ").otherwise("Message "), F.col("vec_id").cast("string")).alias("message_text"),
        "embedding",
    )


def _query_vector(spark, sf, vec_id):
    """The query is the vector of one row, read inside the same plan."""
    return table(spark, sf, "embeddings").where(F.col("vec_id") == vec_id).agg(F.first("embedding").alias("_q")).scalar()


def topk(spark, sf):
    return vec.nearest(_vectors(spark, sf), _query_vector(spark, sf, 0), k=8)


def hybrid(spark, sf):
    return vec.nearest(_vectors(spark, sf), _query_vector(spark, sf, 0), k=8, where=F.col("category") == 3)


def example(spark, sf):
    return vec.nearest_to_example(_vectors(spark, sf), F.col("category") == 3, k=8)


def keyword(spark, sf):
    found = vec.similar_with_keyword(_vectors(spark, sf), _query_vector(spark, sf, 0), k=6)
    return found.withColumn("similarity", F.round("similarity", 4)).withColumn("has_keyword", F.col("has_keyword").cast("int"))


# Two query directions: the first axis, and the first two axes together.
AXES = {"first": [1.0] + [0.0] * 63, "both": [1.0, 1.0] + [0.0] * 62}


def several(spark, sf):
    return vec.nearest_to_each(_vectors(spark, sf), AXES, k=8)


def pca(spark, sf):
    return vec.project(_vectors(spark, sf))


def pca_moments(spark, sf):
    """What does not depend on a solver's choices: means of 0, variances in proportion to the shares, no correlation, the first share."""
    found = vec.project(_vectors(spark, sf))
    ratio = lambda i: F.round(F.var_pop(f"pc{i}") / (F.first(f"explained_{i}") * 64), 6)
    return found.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.abs(F.avg(f"pc{i}")), 6).alias(f"mean_{i}") for i in (1, 2)],
        *[ratio(i).alias(f"ratio_{i}") for i in (1, 2)],
        F.round(F.abs(F.corr("pc1", "pc2")), 6).alias("correlation"),
        F.round(F.first("explained_1"), 4).alias("share_1"),
    )


def embedded_documents(spark, sf):
    """Per text, a null one too: its copies share one vector of the right size and length."""
    vectors = table(spark, sf, "documents").select(F.sha2("text", 256).alias("text_sha256"), embed("text").alias("e"))
    measured = vectors.select("text_sha256", F.xxhash64("e").alias("vector"), F.size("e").alias("size"), F.round(F.sqrt(dot(F.col("e"), F.col("e"))), 4).alias("length"))
    return measured.groupBy("text_sha256").agg(
        (F.min("vector") == F.max("vector")).alias("one_vector"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("dimensions"), F.max("length").alias("length")
    )


def embedded_messages(spark, sf):
    raw = race_control_messages(spark, sf).select(
        F.col("doc_id"), "event_id", F.col("msg_time").alias("Time"), F.col("category").alias("Category"), F.col("flag").alias("Flag"),
        F.col("scope").alias("Scope"), F.col("message_text").alias("Message"), F.col("doc_id").alias("SessionTime"),
    )
    rows = message_rows(raw).withColumn("embedding", embed("embed_text"))
    return rows.select("msg_id", "category", "embed_text", F.size("embedding").alias("dimensions"))


def byte_vectors(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(byte_embedding("text")).alias("at", "value"))


Q0 = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
TEXT = "CASE WHEN label % 3 = 0 THEN 'An incident ' ELSE 'Message ' END || vec_id AS message_text"
ROW = f"vec_id AS msg_id, label::BIGINT AS category, {TEXT}"


def _nearest(query: str, rows: str = "embeddings", k: int = 8) -> str:
    measured = f"1 - list_cosine_similarity(embedding::DOUBLE[], {query})"
    return f"SELECT {ROW}, round({measured}, 4) AS distance FROM {rows} ORDER BY {measured}, vec_id LIMIT {k}"


_AXES = {
    "first": "list_concat([1.0::DOUBLE], list_transform(range(63), lambda i: 0.0::DOUBLE))",
    "both": "list_concat([1.0::DOUBLE, 1.0::DOUBLE], list_transform(range(62), lambda i: 0.0::DOUBLE))",
}

QUERIES = {
    "vector_topk": (topk, _nearest(Q0)),
    "vector_several": (
        several,
        " UNION ALL ".join(
            f"""(SELECT '{name}' AS query, * EXCLUDE (d), row_number() OVER (ORDER BY d, msg_id) AS place FROM (
                  SELECT {ROW}, round(1 - list_cosine_similarity(embedding::DOUBLE[], {axis}), 4) AS distance,
                         1 - list_cosine_similarity(embedding::DOUBLE[], {axis}) AS d FROM embeddings) QUALIFY place <= 8)"""
            for name, axis in _AXES.items()
        ),
    ),
    "vector_hybrid": (hybrid, _nearest(Q0, "(SELECT * FROM embeddings WHERE label = 3)")),
    "vector_example": (
        example,
        _nearest(
            "(SELECT arg_min(embedding, vec_id)::DOUBLE[] FROM embeddings WHERE label = 3)",
            "(SELECT * FROM embeddings WHERE vec_id <> (SELECT min(vec_id) FROM embeddings WHERE label = 3))",
        ),
    ),
    "vector_categories": (
        lambda spark, sf: vec.category_counts(_vectors(spark, sf)),
        "SELECT label::VARCHAR AS category, count(*) AS cnt, (SELECT count(*) FROM embeddings) AS total FROM embeddings GROUP BY label",
    ),
    "vector_keyword": (
        keyword,
        f"""SELECT {ROW}, round(list_cosine_similarity(embedding::DOUBLE[], {Q0}), 4) AS similarity, (label % 3 = 0)::BIGINT AS has_keyword
            FROM embeddings ORDER BY list_cosine_similarity(embedding::DOUBLE[], {Q0}) DESC, vec_id LIMIT 6""",
    ),
    "pca2": (pca, None),
    "pca_moments": (
        pca_moments,
        # The first share by power iteration on the matrix of correlations.
        """WITH RECURSIVE x AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
           s AS (SELECT d, avg(v) AS m, stddev_pop(v) AS sd FROM x GROUP BY d),
           y AS (SELECT vec_id, d, (v - m) / sd AS v FROM x JOIN s USING (d)),
           c AS (SELECT a.d AS i, b.d AS j, avg(a.v * b.v) AS r FROM y a JOIN y b USING (vec_id) GROUP BY 1, 2),
           m AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(r ORDER BY j) AS r FROM c GROUP BY i)),
           p AS (SELECT 0 AS k, list_transform(range(64), lambda i: 1.0::DOUBLE + i / 64) AS v UNION ALL
                 SELECT k + 1, list_transform(w, lambda e: e / sqrt(list_dot_product(w, w)))
                 FROM (SELECT k, list_transform(m, lambda line: list_dot_product(line, v)) AS w FROM p, m WHERE k < 1000))
           SELECT (SELECT count(*) FROM embeddings) AS n, 0.0::DOUBLE AS mean_1, 0.0::DOUBLE AS mean_2, 1.0::DOUBLE AS ratio_1,
                  1.0::DOUBLE AS ratio_2, 0.0::DOUBLE AS correlation,
                  round(list_dot_product(v, list_transform(m, lambda line: list_dot_product(line, v))) / 64, 4) AS share_1
           FROM p, m WHERE k = 1000""",
    ),
    "embedded_documents": (
        embedded_documents,
        """SELECT sha256(text) AS text_sha256, true AS one_vector, count(*) AS copies, CASE WHEN text IS NOT NULL THEN 384::BIGINT END AS dimensions,
             CASE WHEN text IS NOT NULL THEN 1.0::DOUBLE END AS length
           FROM documents GROUP BY text""",
    ),
    "embedded_messages": (
        embedded_messages,
        r"""SELECT conv_id * 1000000000 + turn AS msg_id, nullif(trim(role), '') AS category,
              CASE WHEN trim(role) = '' THEN '' ELSE trim(role) || ': ' END || regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS embed_text,
              384::BIGINT AS dimensions FROM conversations WHERE conv_id IS NOT NULL""",
    ),
    "byte_embedding": (
        byte_vectors,
        """SELECT doc_id, i::BIGINT AS "at", ('0x' || substr(h, (2 * CASE WHEN i < 32 THEN i ELSE i - 16 END + 1)::INT, 2))::INT / 255 - 0.5 AS value
           FROM (SELECT doc_id, sha256(text) AS h FROM documents), range(48) r(i)""",
    ),
}
