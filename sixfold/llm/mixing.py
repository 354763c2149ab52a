"""Mixing sources to target weights. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sixfold.llm.store import cut

#: Documents that one task puts in order.
BLOCK = 2_000
#: Copies of the small table of sources, so that one source's rows go to so many tasks.
SALTS = 32


def word_count(text: Column) -> Column:
    r"""Number of words ``[^\x20\x09-\x0D]+``; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, total: int | None = None) -> DataFrame:
    """One row per source: ``source, n_docs, source_size, weight, target``.

    ``sized`` has ``source`` and ``size``. Sources in code point order, null last, take the weights in turn. They share ``total`` (all
    sizes if None) by weight. A source whose share is above ``max_epochs`` times its size is clamped there and the excess is shared by
    the others in proportion to their weights, round after round, until no share is above its limit. If ``total`` is beyond all
    limits, every source stops at its limit. Each round sends two sums to the driver; nothing is sorted in one task.
    """
    sources = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    # Rank by ranges of names: sizes of the ranges before plus the place in the own range. The checkpoint fixes the ranges.
    ranged = cut(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranged.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last()))
    turn = (F.col("start") + inside - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))
    weighed = cut(ranged.join(starts, "range").withColumn("weight", weight).select("source", "n_docs", "source_size", "weight"))

    limit = F.col("source_size") * max_epochs
    sums = weighed.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    goal = (sums.s or 0) if total is None else total
    level, clamped = (goal / sums.w if sums.w else 0.0), -1
    while True:
        above = limit <= F.lit(level) * F.col("weight")
        now = weighed.agg(
            F.count(F.when(above, 1)).alias("n"), F.sum(F.when(above, limit)).alias("s"), F.sum(F.when(~above, F.col("weight"))).alias("w")
        ).first()
        if now.n == clamped or not now.w:
            break
        level, clamped = (goal - (now.s or 0)) / now.w, now.n
    return weighed.withColumn("target", F.least(limit.cast("double"), F.lit(float(level)) * F.col("weight")))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, total: int | None = None, seed: int = 17) -> DataFrame:
    """Decide how often each document is repeated: ``doc_id, row, source, size, source_size, target, repeats, taken``,
    a row per input row; ``row`` is a hash of the text.

    ``docs`` has ``doc_id, text, source``; other columns are ignored. A source is repeated ``target / source_size`` times: every
    document the whole number of times, and for the fraction the documents that come first in a seeded random order of the source,
    until their sizes reach it. So the words taken differ from the target by at most one document, and reruns agree. The order is
    made in blocks of about ``BLOCK`` documents whose sizes are added up, so a source of any size is spread over tasks.

    A null text has size 0 and is never repeated beyond the whole number; null is a source of its own, last in order; repeated rows
    are separate documents of the same id; a source of size 0 has target 0; an empty table gives no rows.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("place"), F.xxhash64("text").alias("row")))
    targets = source_targets(sized, weights, max_epochs, total).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "s")
    salted = sized.withColumn("salt", F.pmod(F.col("place"), F.lit(SALTS)).cast("int"))
    known = salted.join(targets, salted["source"].eqNullSafe(targets["s"]) & (salted["salt"] == targets["salt"])).select(
        "doc_id", "source", "size", "place", "row", "n_docs", "source_size", "target"
    )
    unit = F.shiftrightunsigned("place", 11) / F.lit(float(1 << 53))
    blocked = known.withColumn("block", F.floor(unit * F.ceil(F.col("n_docs") / BLOCK)))
    blocks = blocked.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(F.col("source").alias("s"), F.col("block").alias("b"), F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "block").orderBy("unsigned", "doc_id", "row", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        blocked.withColumn("unsigned", unit)
        .withColumn("upto", F.sum("size").over(inside))
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    )
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(epochs), F.lit(max_epochs))
    rest = F.col("target") - whole * F.col("source_size")
    middle = F.col("start") + F.col("upto") - F.col("size") / 2
    again = ((middle < rest) & (F.col("size") > 0) & (whole < max_epochs)).cast("long")
    return (
        placed.withColumn("repeats", (whole + again).cast("long"))
        .withColumn("taken", F.col("repeats") * F.col("size"))
        .select("doc_id", "row", "source", "size", "source_size", "target", "repeats", "taken")
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents that the mix takes, each row once, with ``repeats`` and ``taken``; ``docs`` as for ``mix``.

    Rows of the same id, source and text share out what ``mix`` gives to as many rows: repeats of one source differ by one at most, so
    the first of them, in an order by all columns, get one more.
    """
    key = F.xxhash64(F.isnull("doc_id"), "doc_id", F.isnull("source"), "source")
    plan = mix(docs, **how).select(key.alias("key"), "row", "size", "repeats")
    given = plan.groupBy("key", "row").agg(F.min("repeats").alias("least"), F.max("size").alias("size"), F.sum("repeats").alias("sum"), F.count("*").alias("n")).where("sum > 0")
    kept = docs.drop("repeats", "taken")
    ordered = [F.col(f"`{f.name}`") for f in kept.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    # The input's columns stand in one struct, so that none of them meets a name used here.
    whole = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("doc"), key.alias("key"), F.xxhash64("text").alias("row"), F.xxhash64(*ordered).alias("order"))
    placed = whole.join(given, ["key", "row"]).withColumn("place", F.row_number().over(Window.partitionBy("key", "row").orderBy("order")))
    more = F.col("place") <= F.col("sum") - F.col("least") * F.col("n")
    shared = placed.withColumn("repeats", F.col("least") + more.cast("long")).where("repeats > 0")
    return shared.select(*[F.col(f"doc.`{c}`") for c in kept.columns], "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def op5(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


QUERIES = {"op5_mix_sources": (op5, None)}
