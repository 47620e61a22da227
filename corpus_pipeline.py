"""The training-data pipeline: filter, deduplicate, decontaminate, mix and encode `documents`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stream_commerce.llm import decontaminate, minmax, mixing, queries, toxicity
from stream_commerce.llm.shared import read, saved, with_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scores, signatures and tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents predicted toxic."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group at similarity 0.8 on five-word shingles."""
    return minmax.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that domain token shares meet flattened targets."""
    return mixing.mixed(docs, queries.quality_domains(spark, sf_dir, docs), queries.FLATTEN)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token ids to rANS files and return where each document's ids are."""
    return queries.encoded(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", with_path(clean_language)),
    ("near_duplicates", with_path(near_duplicates)),
    ("decontaminate", with_path(decontaminated)),
    ("mix", with_path(mixed)),
    ("tokens", with_path(tokens)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
