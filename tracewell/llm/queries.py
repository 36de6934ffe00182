"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracewell.llm import (
    chat,
    decontamination,
    html_extraction,
    language_id,
    near_duplicates,
    packing,
    quality_classifier,
    repetition,
    sharding,
    warc,
)
from tracewell.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.digest(table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.digest(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_decontamination": op2_decontamination,
    "op3_warc_derivatives": op3_warc_derivatives,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_language_id": op6_language_id,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_minhash": op8_minhash,
    "op9_sharding": op9_sharding,
    "op10_chat": op10_chat,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": decontamination.ORACLE,
    "op4_quality_rules": repetition.ORACLE,
    "op8_minhash": near_duplicates.ORACLE,
    "op10_chat": chat.ORACLE,
}
