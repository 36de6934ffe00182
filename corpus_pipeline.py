"""A corpus from raw documents to packed token sequences, as stages that each hand on a table of documents.

Stages: documents that repeat themselves go, then those whose language can't be told; of near duplicates one stays;
those that hold benchmark passages go; the rest are packed.  All but the last return the columns of their input,
whatever other columns there are; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracewell.llm import decontamination, language_id, near_duplicates, packing, repetition
from tracewell.llm.common import durable, table


#: Near copies by either rule: five words at 0.8, and what op8_minhash links. 28 bands miss a pair at 0.8 with probability 4e-7.
NEAR = (near_duplicates.Settings(), near_duplicates.Settings(shingle=5, percent=80, bands=28))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that repeat themselves too much go, and those of fewer than ten words, so null and empty ones too.

    Rows are judged one by one, repeated ones alike.
    """
    return repetition.passing(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those whose language has a score under 0.3, by a model of the rows that aren't held out.

    Where no row names a language nothing can be told, so all go.
    """
    return language_id.identified(docs)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links join, the row of least id stays; of rows alike in id and text, one.

    Rows of one id with different texts are judged each by its own.  Rows without an id, and texts without words, stay.
    """
    return near_duplicates.one_of_each(docs, rules=NEAR)


def benchmark_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a window of the benchmark go; null and empty ones stay, and so do all if the benchmark is empty."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece; a null or empty text is one piece, of the end's id alone."""
    return packing.pieces(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", languages),
    ("near_duplicates", near_duplicate_removal),
    ("decontamination", benchmark_removal),
    ("packing", packed),
]

#: The languages are told by a fitted model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
