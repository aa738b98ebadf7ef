"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rideflow.llm import (
    decontamination, embedding_dedup, html_text, licenses, merkle, mixing, packing, quality, runs, secrets, simhash, tokens, tool_calls,
)
from rideflow.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = "piece_bpe_32k.model"
PACKING_TOKENIZER = "byte_bpe_50k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_report(read_table(spark, sf_dir, "embeddings"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read_table(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_report(read_table(spark, sf_dir, "documents"), str(public_tokenizers.path(TOKENIZER)))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_report(read_table(spark, sf_dir, "pages"))


@query
def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.linked_calls(read_table(spark, sf_dir, "conversations"))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(read_table(spark, sf_dir, "documents"))


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(read_table(spark, sf_dir, "documents"))


@query
def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(read_table(spark, sf_dir, "documents"), str(public_tokenizers.path(PACKING_TOKENIZER)))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(read_table(spark, sf_dir, "documents"))
