"""Registered queries: name -> (build DataFrame from a session and a data folder, the same result as SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sixfold.plans.registry import demo, documents, ingest, relational, spatial, timeseries, vector

ALL = {}
for _part in (relational, timeseries, documents, spatial, vector, ingest, demo):
    if ALL.keys() & _part.QUERIES.keys():
        raise ValueError("a query name is used twice")
    ALL |= _part.QUERIES


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and decimals as DOUBLE, so that results compare across engines."""
    columns = []
    for f in df.schema:
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            columns.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            columns.append(F.col(f"`{f.name}`").cast("bigint").alias(f.name))
        else:
            columns.append(F.col(f"`{f.name}`"))
    return df.select(*columns)


def _query(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: plain_types(build(spark, sf))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(build) for name, (build, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql is not None}
