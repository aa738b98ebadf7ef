"""The corpus pipeline: five stages over ``documents``, each one operator of ``rideflow.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rideflow.llm import decontamination, mixing, quality, secrets, simhash
from rideflow.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of these documents."""
    return quality.accepted(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that of the smallest doc_id."""
    return simhash.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.without_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with ``copy`` from 1 up."""
    return mixing.emitted(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("mixing", mix),
]

#: The first stage compresses texts, which SQL cannot express; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
