"""One query for each operator, over the whole of its tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkveil.llm import (
    alignment,
    decontaminate,
    language,
    lines,
    mixing,
    quality,
    secrets,
    simhash,
    spots,
    sql,
    tokencount,
    tokenfiles,
    toxicity,
    whitening,
)
from inkveil.sources.corpora import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: its fingerprint, and the least id its links lead to."""
    return simhash.near_duplicates(table(spark, d, "documents"))


def op2_quality(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: what is counted, whether the base rules fail, the verdict."""
    return quality.report(table(spark, d, "documents"))


def op3_mixing(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document taken into the mix, as often as it is taken."""
    return mixing.report(table(spark, d, "documents"))


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: score and prediction, learnt from labels outside the fold."""
    return toxicity.scored(table(spark, d, "documents"), table(spark, d, "labels"))


def op5_language(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: predicted language and score; `und` without a letter."""
    return language.identified(table(spark, d, "documents"))


def op6_secrets(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: numbers of base finds and the spans of all."""
    return secrets.report(table(spark, d, "documents"))


def op7_lines(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: its lines, how many go, the digest of what stays."""
    return lines.report(table(spark, d, "documents"))


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_token_files(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document, read back from the token files: place, number, checksum."""
    return tokenfiles.report(table(spark, d, "documents"), byte_bpe)


def op9_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: words hit by benchmark windows, and the verdict."""
    return decontaminate.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: bytes, tokens, and whether they exceed the limit."""
    return tokencount.counted(table(spark, d, "documents"), word_bpe)


def op11_whitening(spark: SparkSession, d: str) -> DataFrame:
    """A row for each embedding that is all numbers and each of 32 components."""
    return whitening.whitened(table(spark, d, "embeddings"))


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_alignment(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: tokens of two tokenizers, groups, links and their counts."""
    return alignment.report(table(spark, d, "documents"), byte_bpe, piece_bpe)


def op13_spots(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document: fingerprints of its text, edited and not, and how near they are."""
    return spots.report(table(spark, d, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_language": op5_language,
    "op6_secrets": op6_secrets,
    "op7_lines": op7_lines,
    "op8_token_files": op8_token_files,
    "op9_decontaminate": op9_decontaminate,
    "op10_token_counts": op10_token_counts,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_spots": op13_spots,
}

ORACLES: dict[str, str] = {
    "op2_quality": sql.OP2,
    "op6_secrets": sql.OP6,
    "op7_lines": sql.OP7,
    "op9_decontaminate": sql.OP9,
}
