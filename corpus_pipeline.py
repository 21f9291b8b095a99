"""A corpus pipeline: the rows of `documents` made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's `docs`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkveil.llm import decontaminate, language, mixing, queries, simhash, tokenfiles
from inkveil.llm.common import staged
from inkveil.sources.corpora import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; those without a letter go."""
    return language.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints (3 words, two bits) stays, that of the
    smallest id."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go; others stay as they are."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; those of small sources come again, up to the repetition limit."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and where each document lies in them."""
    return tokenfiles.report(docs, queries.byte_bpe)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("token_files", token_files),
]

# classifiers, fingerprints and tokenizers are beyond SQL; tests hold it against plain Python
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
