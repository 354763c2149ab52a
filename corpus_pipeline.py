"""The corpus pipeline: stages over the documents, each working on what the one before has kept and written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sixfold.llm import decontaminate, jaccard, lines, mixing, toxicity
from sixfold.llm.store import shared_folder


def _with_text(changed: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the documents, their length brought up to date."""
    return changed.select(*[F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic. A null text stays."""
    labels = toxicity.label_columns(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_toxicity(docs, labels, toxicity.CATEGORIES)
    return scored.where("p_toxic < 0.5").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has are cut out. A text may become empty; the document stays."""
    return _with_text(lines.drop_shared_lines(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one(docs, words=5, num=80, den=100)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out; documents that are mostly test items go."""
    return _with_text(decontaminate.remove_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with how often each is repeated."""
    return mixing.mixed(docs)


STAGES = [("toxicity", toxic), ("line_dedup", line_dedup), ("ngram_jaccard", near_duplicates), ("decontaminate", benchmark_items), ("mix_sources", mix)]

#: No SQL can express the classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a Parquet table in the shared folder that the next one reads."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
