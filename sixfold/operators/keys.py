"""Surrogate keys for dimensions, and resolving facts against them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sixfold.sources.tables import absent

BUCKETS = 4096


def assign_keys(rows: DataFrame, natural_key: Iterable[str], key: str, after: Column | int = 0) -> DataFrame:
    """Number distinct rows ``after + 1, after + 2, ...`` without a gap.

    Rows are numbered per hash bucket of their natural key and shifted by the sizes of the buckets before, so no task sees
    more than one bucket. The numbers depend on the set of natural keys only, hence a retried task gives the same ones.
    """
    natural_key = list(natural_key)
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*natural_key), F.lit(BUCKETS)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most BUCKETS rows: small enough for one task and for a broadcast.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural_key))
    numbered = bucketed.withColumn("_within", within).join(F.broadcast(offsets), "_bucket")
    after = F.lit(after) if isinstance(after, int) else after
    return numbered.select((after + F.col("_before") + F.col("_within")).cast("bigint").alias(key), *rows.columns)


def highest(existing: DataFrame, key: str) -> Column:
    """The largest key in use, 0 if there is none."""
    return existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("_max")).scalar()


def new_members(existing: DataFrame, incoming: DataFrame, natural_key: str, key: str, order: Iterable[str] = ()) -> DataFrame:
    """Dimension rows to add: incoming natural keys that are not stored, one row each, with the next free keys."""
    named = incoming.where(F.col(natural_key).isNotNull())
    return assign_keys(absent(named, existing, [natural_key], order), [natural_key], key, highest(existing, key))


def resolve(fact: DataFrame, dimension: DataFrame, on: Iterable[str], key: str, how: str = "inner") -> DataFrame:
    """Replace natural keys by the surrogate key; rows without a match are dropped (or get NULL with ``how='left'``).

    The strategy is left to Spark: a dimension that measures small is broadcast, a large one is joined by sort-merge with
    skewed keys split at run time.
    """
    on = list(on)
    return fact.join(dimension.select(*on, key), on, how)


def row_ids(df: DataFrame, key: str, after: Column | int = 0, row: str = "_row") -> DataFrame:
    """Unique, growing ids from the row numbers of a scan, without a shuffle (copies of one row do not meet in one task)."""
    after = F.lit(after) if isinstance(after, int) else after
    return df.withColumn(key, after + 1 + F.col(row))
