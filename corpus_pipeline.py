"""From raw documents to a training mix, in five stages over whole tables.

Low-quality documents go, then those in no learned language, then all but one of
each group of near-duplicates, then those that hold a benchmark item; the rest
is mixed to target weights. Every stage is written to the shared folder as
Parquet and read again as the input of the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationkit.llm import decontamination, langid, mixing, quality, superminhash
from stationkit.llm.queries import table
from stationkit.plans.stored import fresh_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted good by the line field."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    return langid.keep_known(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is at least 0.8 alike in shingles of five words."""
    return superminhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mix", mixed),
]

# A conditional random field and suffix automata have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
