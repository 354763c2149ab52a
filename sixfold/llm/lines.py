"""Lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def drop_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10, max_docs: int = 1) -> DataFrame:
    """Drop lines whose key stands in more than ``max_docs`` documents, except in the document with the smallest id that holds it.

    A line's key is the line without white space at its ends, A-Z in lower case; keys of fewer than ``min_chars`` code points are never
    dropped. Keys travel as 128 bits of hash. Only (document, position, hash) is shuffled to count and to decide; texts are shuffled
    once, to be put together again by position.

    Returns the input's rows and columns with ``text`` replaced, and ``__n_lines`` and ``__n_dropped`` (in place of columns of these names).
    A null text stays null (one empty line), an empty text is one empty line. Rows with the same id count as one document, each row is
    cut by itself. A row with a null id is counted nowhere and loses nothing. Copies within one document all go or all stay.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), body.alias("body")).where("id IS NOT NULL")
    lines = (
        rows.select("id", F.xxhash64("body").alias("row"), F.posexplode(F.transform(F.split("body", "\n", -1), line_key)).alias("pos", "key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    shared = (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("id").alias("n"), F.min("id").alias("keeper"))
        .where(F.col("n") > max_docs)
        .select("h1", "h2", "keeper")
    )
    # A very common line is one row on the right, so Spark can split its rows on the left.
    gone = (
        lines.join(shared, ["h1", "h2"])
        .where("id <> keeper")
        .groupBy("id", "row")
        .agg(F.collect_set("pos").alias("gone"))
    )
    # The input's columns stand in one struct, so that none of them meets a name used here.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), body.alias("body"))
    found = whole.join(gone, (F.col(f"doc.`{doc_id}`") == F.col("id")) & (F.xxhash64("body") == F.col("row")), "left")
    split = F.split("body", "\n", -1)
    # array_except works with a hash set and keeps the order, so a text of many lines stays linear.
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone")), lambda p: F.get(split, p))
    out = F.when(F.col("gone").isNull(), F.col(f"doc.`{text}`")).otherwise(F.array_join(left, "\n"))
    return found.select(
        *[out.alias(c) if c == text else F.col(f"doc.`{c}`") for c in docs.columns if c not in ("__n_lines", "__n_dropped")],
        F.size(split).cast("long").alias("__n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("__n_dropped"),
    )


def op8(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return drop_shared_lines(docs).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.greatest(F.col("__n_dropped"), F.lit(0)).alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def line_sql(table: str, columns: str = "doc_id, text") -> str:
    """CTEs ``l`` (lines) and ``marked`` (with ``gone``) over a table of documents; ``rid`` is the row."""
    return rf"""d AS (SELECT row_number() OVER () AS rid, * FROM {table}),
l AS (SELECT rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.*, coalesce(s.keeper <> k.doc_id, false) AS gone FROM k LEFT JOIN s ON k.key = s.key)"""


OP8_SQL = f"""WITH {line_sql("documents")}
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid"""

QUERIES = {"op8_line_dedup": (op8, OP8_SQL)}
