"""The training-data pipeline: quality rules, near duplicates, benchmark passages, mixture, token files.

Every stage takes what the one before kept and returns the columns of ``documents``; the last returns one row per
document of the token files. ``run`` writes each stage as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.decontamination import keep_clean
from tidewatch.llm.entropy_mix import remixed
from tidewatch.llm.jaccard_join import keep_first
from tidewatch.llm.quality_outliers import keep_good
from tidewatch.llm.queries import word_tokenizer
from tidewatch.llm.token_files import tokenize
from tidewatch.session import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id."""
    return keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: none, once or more."""
    return remixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix; returned is what they say of each document."""
    return tokenize(docs, word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
    ("token_files", token_files),
]

#: No stage but the base rules can be said in SQL; the tests hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
